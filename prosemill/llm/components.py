"""Connected components of a link table, by joins and minima only.

Each round lets every vertex point at the least id among itself and its
neighbours, follows the pointers to their roots by doubling, and contracts the
links onto the roots. Minima are combined before the shuffle, so a vertex with
very many links costs one row per task. No group is ever gathered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm.runtime import cut


def _roots(pointer: DataFrame) -> DataFrame:
    """Follow (node, root) pointers, which never rise, to their ends."""
    while True:
        ahead = pointer.select(F.col("node").alias("at"), F.col("root").alias("next"))
        stepped = cut(
            pointer.join(ahead, pointer["root"] == ahead["at"], "left").select(
                "node",
                F.coalesce("next", "root").alias("root"),
                (F.coalesce("next", "root") < F.col("root")).alias("moved"),
            )
        )
        pointer = stepped.select("node", "root")
        if stepped.filter("moved").isEmpty():
            return pointer


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every vertex that has a link to another one.

    links: two columns of comparable ids; direction, repeats, self-links and
    rows with a null do not matter. component is the least id that is
    reachable. No links: no rows.
    """
    x, y = F.col(a), F.col(b)
    edges = cut(links.filter(x != y).select(F.least(x, y).alias("u"), F.greatest(x, y).alias("v")).distinct())
    levels: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("other")), F.struct(F.col("v").alias("node"), F.col("u").alias("other")))).alias("e")).select("e.*")
        least = both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("root"))
        level = _roots(cut(least))
        levels.append(level)
        of_u, of_v = (level.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")) for end in "uv")
        ends = edges.join(of_u, "u").join(of_v, "v").filter("root_u != root_v")
        edges = cut(ends.select(F.least("root_u", "root_v").alias("u"), F.greatest("root_u", "root_v").alias("v")).distinct())
    if not levels:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))

    def onto(low: DataFrame, high: DataFrame) -> DataFrame:
        up = high.select(F.col("node").alias("at"), F.col("root").alias("next"))
        return low.join(up, low["root"] == up["at"], "left").select("node", F.coalesce("next", "root").alias("root"))

    return reduce(onto, levels).select("node", F.col("root").alias("component"))
