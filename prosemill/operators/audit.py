"""End-state audit of a corpus in one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.functions import patterns as P
from prosemill.functions import text as T


def audit(corpus: DataFrame, low: int = 40, high: int = 700) -> DataFrame:
    """One row of counts over a corpus (k, text, prose, verdict, stop, ends, n_tok, and raw in legacy rows)."""
    surface = T.surface(F.col("prose"), F.col("text"))
    empty = F.coalesce(T.normalise(surface), F.lit("")) == ""
    residue = ~empty & surface.rlike(P.java(P.HEADING_LINE))
    failed = F.coalesce(F.col("verdict") == "failed", F.lit(False))
    legacy = F.col("raw").isNotNull() if "raw" in corpus.columns else F.lit(False)
    usable = F.col("verdict").isin("pass", "style")
    return corpus.agg(
        F.count("*").alias("n_rows"),
        F.count_if(usable).alias("n_usable"),
        F.count_if(~F.coalesce("ends", F.lit(False))).alias("n_not_ended"),
        F.count_if(F.col("prose").isNotNull() != F.coalesce(F.col("verdict") == "style", F.lit(False))).alias("n_style_mismatch"),
        F.count_if(empty).alias("n_empty"),
        F.count_if(legacy).alias("n_legacy"),
        F.count_if(residue & ~failed).alias("n_residue"),
        F.count_if(residue & failed).alias("n_residue_failed"),
        F.count_if(~empty & ~F.coalesce(F.col("n_tok").between(low, high), F.lit(False))).alias("n_out_of_band"),
        (F.count_if(~empty) - F.count_distinct(F.when(~empty, F.coalesce("k", F.lit(""))))).alias("n_repeated_keys"),
    )


def violations(counts: dict[str, int], expected_rows: int | None = None) -> list[str]:
    """Names of the counts that must be zero and are not; the band is only counted."""
    wrong = [c for c in ("n_style_mismatch", "n_legacy", "n_residue", "n_repeated_keys", "n_empty") if counts[c]]
    return wrong + ["n_rows"] * (expected_rows is not None and counts["n_rows"] != expected_rows)


def top_first_words(rows: DataFrame, surface: str = "text", top: int = 5) -> DataFrame:
    """Most frequent first words (up to a space); equal counts in the order of the words."""
    word = F.get(F.split(F.col(surface), " "), F.lit(0))
    return rows.filter(T.normalise(F.col(surface)) != "").groupBy(word.alias("word")).count().orderBy(F.desc("count"), "word").limit(top)


def tally(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy(*columns).agg(F.count("*").alias("n"))
