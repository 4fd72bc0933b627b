"""Tables that cut a lineage, in the folder that a cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where it is unset, a session on one machine has a private one; a cluster must name it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root:
        root = context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="prosemill-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def _clear_exchanges(df: DataFrame) -> None:
    """Remove the files of the exchanges that df, as it was computed, reads directly; they would stay until the driver collects its garbage."""
    cleaner = df.sparkSession.sparkContext._jsc.sc().cleaner()
    rdds, found = [df._jdf.queryExecution().toRdd()], set()
    while rdds:
        each = rdds.pop().dependencies()
        for dependency in (each.apply(i) for i in range(each.size())):
            if dependency.getClass().getSimpleName() == "ShuffleDependency":
                found.add(dependency.shuffleId())
            else:
                rdds.append(dependency.rdd())
    for number in found if cleaner.isDefined() else ():
        cleaner.get().doCleanupShuffle(number, True)


def cut(df: DataFrame, clear: bool = False) -> DataFrame:
    """Compute df once and cut its lineage, in the shared checkpoint folder. With clear, what it was exchanged by is removed: for a df that nothing else reads."""
    checkpoint_root(df.sparkSession)
    done = df.checkpoint()
    if clear:
        _clear_exchanges(df)
    return done


def stored(df: DataFrame) -> DataFrame:
    """Compute df once and cut its lineage as cut does, by columns: whoever reads the result reads the columns needed only. For wide rows."""
    path = f"{checkpoint_root(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
