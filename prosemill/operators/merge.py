"""Coverage rules between keyed tables, and the merge of gate results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.functions.text import row_fingerprint

GATE_COLUMNS = ("gate_decision", "gate_score", "gate_fails", "gate_defaulted")


class CoverageError(ValueError):
    """A key is repeated, in both tables, or in neither."""


def duplicate_keys(rows: DataFrame, key: str = "k") -> DataFrame:
    return rows.groupBy(key).count().filter("count > 1")


def coverage(keys: DataFrame, results: DataFrame, rejects: DataFrame, key: str = "k") -> DataFrame:
    """One row of counts: keys, covered, uncovered, in both, and the covered percentage."""
    have = results.select(key).distinct().withColumn("_r", F.lit(1))
    gone = rejects.select(key).distinct().withColumn("_x", F.lit(1))
    joined = keys.select(key).distinct().join(have, key, "left").join(gone, key, "left")
    covered = F.col("_r").isNotNull() | F.col("_x").isNotNull()
    counts = joined.agg(F.count("*").alias("n_keys"), F.count_if(covered).alias("n_covered"), F.count_if(~covered).alias("n_uncovered"), F.count_if(F.col("_r").isNotNull() & F.col("_x").isNotNull()).alias("n_both"))
    return counts.withColumn("covered_pct", F.bround(F.try_divide(F.lit(100.0) * F.col("n_covered"), F.col("n_keys")), 2))


def merge_gates(corpus: DataFrame, results: DataFrame, rejects: DataFrame) -> DataFrame:
    """corpus with new gate columns where a result is; other rows keep theirs. Content never changes.

    Raises CoverageError on repeated result keys, on keys in both tables, and
    on corpus keys in neither.
    """
    if not duplicate_keys(results).isEmpty():
        raise CoverageError("results repeat a key")
    counts = coverage(corpus, results, rejects).first()
    if counts["n_both"] or counts["n_uncovered"]:
        raise CoverageError(f"{counts['n_both']} keys in both tables, {counts['n_uncovered']} in neither")
    new = results.select("k", *[F.col(c).alias(f"_{c}") for c in GATE_COLUMNS], F.lit(True).alias("_has"))
    joined = corpus.join(new, "k", "left")
    for c in GATE_COLUMNS:
        old = F.col(c) if c in corpus.columns else F.lit(None).cast(results.schema[c].dataType)
        joined = joined.withColumn(c, F.when(F.col("_has"), F.col(f"_{c}")).otherwise(old))
    return joined.drop("_has", *[f"_{c}" for c in GATE_COLUMNS])


def dry_run(corpus: DataFrame, results: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row of what merge_gates would find, without merging: the counts of coverage, repeated result keys, and a map of decisions."""
    repeated = duplicate_keys(results).agg(F.count("*").alias("n_repeated"))
    decisions = results.groupBy("gate_decision").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("gate_decision", "n")))).alias("decisions"))
    return coverage(corpus, results, rejects).crossJoin(repeated).crossJoin(decisions)


def content_changes(before: DataFrame, after: DataFrame, ignore: tuple[str, ...] = GATE_COLUMNS) -> DataFrame:
    """Keys whose content (all but the ignored columns) differs."""
    columns = sorted(set(before.columns) - set(ignore))
    a, b = (rows.select("k", row_fingerprint(*columns).alias(name)) for rows, name in ((before, "_a"), (after, "_b")))
    return a.join(b, "k", "full").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select("k")


def overlay(*layers: DataFrame, key: str = "k") -> DataFrame:
    """One row a key; later layers win over earlier ones."""
    ranked = [layer.withColumn("_layer", F.lit(i)) for i, layer in enumerate(layers)]
    whole = ranked[0]
    for layer in ranked[1:]:
        whole = whole.unionByName(layer)
    row = F.struct(*[c for c in layers[0].columns if c != key])
    return whole.groupBy(key).agg(F.max_by(row, "_layer").alias("_row")).select(key, "_row.*")
