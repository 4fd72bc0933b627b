"""Session helpers shared by the operators: checkpoints, id splits, partition counts."""

from __future__ import annotations

import ctypes

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill.sources.shared import checkpoint_root, cut

__all__ = ["checkpoint_root", "cut", "in_fold", "partitions", "release", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_fold(id_col: Column, folds: int, fold: int) -> Column:
    """True where crc32(id as text) mod folds is fold; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def release() -> None:
    """Give freed memory of a Python worker back to the system, where the C library can."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
