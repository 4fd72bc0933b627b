"""Operators for large-scale training-data preparation.

Nothing outside this subpackage imports it. Every operator is a function from
DataFrames to a DataFrame; ``queries`` holds the thin query and SQL registry.
"""
