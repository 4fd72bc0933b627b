"""Bounded samples of labelled rows for classifiers that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def known_labels(labels: DataFrame, label: str, usable: Column | None, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, y) with y 0 or 1, one row an id; of several labels of an id the largest holds."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
    if usable is not None:
        known = known.filter(usable)
    return known.groupBy("doc_id").agg(F.max("y").alias("y"))


def balanced_sample(known: DataFrame, sample: int) -> tuple[DataFrame, float]:
    """At most ``sample`` rows of each class, by a hash of the id, and the smoothed share of class 1 among all rows."""
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = known.filter("y = 0").orderBy(*order).limit(sample).unionAll(known.filter("y = 1").orderBy(*order).limit(sample))
    return some.select(F.col("doc_id").alias("sample_id"), "y"), (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
