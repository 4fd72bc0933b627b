"""Spark-native engine for building, vetting and measuring prose corpora."""
