"""An append-only log of rows as a stream: each content key is emitted once, across restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from prosemill.functions.text import content_key


def stream_lines(spark: SparkSession, path: str, schema: T.StructType, files_a_batch: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).json(path)


def first_of_key(rows: DataFrame, event_time: str | None = None, delay: str = "7 days") -> DataFrame:
    """rows with their key k, the first of each key only. With an event time, keys older than the delay are forgotten."""
    keyed = rows.withColumn("k", content_key(F.coalesce("text", F.lit(""))))
    if event_time is None:
        return keyed.dropDuplicates(["k"])
    # Watermarks need an instant, and the event tables hold local times.
    timed = keyed.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["k"])


def append_stream(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append what is new and stop; run again to go on where the last run ended."""
    return rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
