"""Positions, even and hashed samples, folds and slices. All are functions of keys, not of how rows are dealt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def running_total(rows: DataFrame, key: str, value: Column, into: str) -> DataFrame:
    """rows with the sum of value over all rows of a smaller key. key: numeric, distinct.

    Rows are summed within ranges of the key, and the totals of the ranges
    before are added, so no task sees all rows. The ranges follow the quantiles.
    """
    number = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = [i / number for i in range(1, number)] or [0.5]
    cuts = sorted(set(rows.agg(F.percentile_approx(key, at)).first()[0] or []))
    part = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(key))) if cuts else F.lit(0)
    marked = rows.withColumn("_part", part).withColumn("_value", value)
    sums = {r["_part"]: r["s"] for r in marked.groupBy("_part").agg(F.sum("_value").alias("s")).collect()}
    before, total = [], 0
    for p in range(len(cuts) + 1):
        before.append(total)
        total += sums.get(p) or 0
    within = F.sum("_value").over(Window.partitionBy("_part").orderBy(key).rowsBetween(Window.unboundedPreceding, -1))
    start = F.element_at(F.array(*map(F.lit, before)), F.col("_part") + 1)
    return marked.withColumn(into, F.coalesce(within, F.lit(0)) + start).drop("_part", "_value")


def with_position(rows: DataFrame, key: str, into: str = "position") -> DataFrame:
    """rows with the place (from 0) of each in the order of a distinct numeric key."""
    return running_total(rows, key, F.lit(1).cast("long"), into)


def even_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """(i, row): the rows at the rounded (half to even) positions i * (N - 1) / (n - 1)."""
    total = rows.count()
    step = F.lit(float(total - 1) / max(n - 1, 1))
    wanted = rows.sparkSession.range(n if total else 0).select(F.col("id").alias("i"), F.bround(F.col("id") * step, 0).cast("long").alias("_at"))
    placed = with_position(rows, key, "_position")
    return wanted.join(placed, F.col("_at") == F.col("_position")).drop("_at", "_position")


def seeded(seed: int, key: str | Column) -> Column:
    """A text that orders keys at random, the same in any engine: md5 of seed:key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), (F.col(key) if isinstance(key, str) else key).cast("string")))


def shuffled_slice(rows: DataFrame, key: str, seed: int, start: int, stop: int) -> DataFrame:
    """Rows [start, stop) of a seeded order; slices of one seed that do not overlap are disjoint."""
    order = [seeded(seed, key), F.col(key)]
    first = rows.orderBy(*order).limit(stop)
    return first.withColumn("_n", F.row_number().over(Window.orderBy(*order))).filter(F.col("_n") > start).drop("_n")


def shard(rows: DataFrame, key: str, number: int, of: int) -> DataFrame:
    return rows.filter(F.pmod(F.col(key), F.lit(of)) == number)


def folds(rows: DataFrame, key: str, label: str, k: int = 5, seed: int = 7) -> DataFrame:
    """rows with ``fold``: of each label, the rows go round the folds in the order of a hash of the key.

    So the folds' sizes differ by one at most within a label. Labels are
    classes, of which there are few; their counts are read first.
    """
    counts = sorted(rows.groupBy(label).count().collect(), key=lambda r: str(r[label]))
    number, start, before = F.lit(0), F.lit(0), 0
    for i, row in enumerate(counts):
        own = F.col(label).eqNullSafe(F.lit(row[label]))
        number, start = F.when(own, F.lit(i)).otherwise(number), F.when(own, F.lit(before)).otherwise(start)
        before += row["count"]
    order = F.shiftleft(number.cast("long"), 48) + F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 16)
    placed = with_position(rows.withColumn("_order", order).withColumn("_start", start), "_order", "_place")
    return placed.withColumn("fold", F.pmod(F.col("_place") - F.col("_start"), F.lit(k)).cast("int")).drop("_order", "_start", "_place")


def pick_one(items: Column, seed: int, key: Column) -> Column:
    """One element of an array, chosen by a hash of the key; null of an empty array."""
    spot = F.pmod(F.conv(F.substring(seeded(seed, key), 1, 8), 16, 10).cast("long"), F.greatest(F.size(items), F.lit(1))).cast("int")
    return F.get(items, spot)


def sample_within(rows: DataFrame, group: str, key: str, n: int, seed: int) -> DataFrame:
    """n rows of each group without replacement: the first by a seeded order of the key.

    They are first taken of each of 256 parts of a group, so that no task holds a large group.
    """
    marked = rows.withColumn("_order", seeded(seed, key)).withColumn("_part", F.substring("_order", 1, 2))
    for by in ((group, "_part"), (group,)):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("_order", key))
        marked = marked.withColumn("_n", place).filter(F.col("_n") <= n).drop("_n")
    return marked.drop("_order", "_part")


def job_grid(openers: DataFrame, repeats: int, gold: DataFrame) -> DataFrame:
    """Every opener with every repeat and a gold pair that rotates by job number.

    openers: (o, opener) and gold: (g, sentence), numbered from 0.
    """
    n = gold.count()
    jobs = openers.crossJoin(openers.sparkSession.range(repeats).withColumnRenamed("id", "repeat")).withColumn("i", F.col("o") * repeats + F.col("repeat"))
    first, second = (gold.select(F.col("g").alias(f"g{x}"), F.col("sentence").alias(f"sentence{x}")) for x in (1, 2))
    return jobs.join(first, F.col("i") % n == F.col("g1")).join(second, (F.col("i") + 1) % n == F.col("g2")).select("i", "opener", "repeat", "sentence1", "sentence2")
