"""Embedding near-duplicates by an epsilon grid order join.

Cosine t or more between unit vectors is a distance of at most
eps = sqrt(2 - 2t). Vectors are rotated onto principal axes, which are fitted
on a bounded sample, and sorted by their grid cells of width eps on the
leading ones. The sorted sequence is cut into blocks with bounding boxes, and
blocks into a tree of intervals. From the pair (root, root) down, a pair of
intervals whose boxes lie further apart than eps is dropped; projections onto
orthonormal axes never lengthen distances, so no link is lost.

Pairs of blocks that are left are compared by tiles, squares of consecutive
blocks, so a block travels to as many tasks as there are tiles in a row. Within
a pair of blocks two vectors are dropped on partial distances: the product of
their leading coordinates plus the product of the lengths of the rest bounds
their cosine from above. What remains is decided in double precision.

Equal vectors are merged before. A tile gives a row for each vector that has
links there, with their number and a root of its links, never the pairs.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, FloatType

from prosemill.llm.components import connected_components
from prosemill.llm.runtime import cut, partitions

#: Vectors a block, children an interval, axes of the boxes and of partial distances, rows of the sample for the axes.
BLOCK, FANOUT, AXES, PARTIAL, SAMPLE = 4096, 16, 16, 24, 4096
#: At most so many blocks on a side of a tile.
_TILE = 16
#: Single precision finds candidates down to this much below the threshold; double precision decides.
_SLACK = 1e-4


def unit_vectors(x: np.ndarray) -> np.ndarray:
    """Rows of length 1. Each is scaled by a power of two first, so that squares neither vanish nor overflow."""
    _, power = np.frexp(np.abs(x).max(1, initial=0.0))
    scaled = np.ldexp(x, -power[:, None])
    return scaled / np.sqrt((scaled * scaled).sum(1))[:, None]


def _linkable(v: Column) -> Column:
    """Not null or zero, and all components finite."""
    wide = F.transform(v, lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(wide, lambda x: x != 0), F.lit(False))


def _axes(units: DataFrame, size: int, sample: int) -> np.ndarray:
    """All orthonormal axes as columns, by falling variance over a sample of the unit vectors in the order of a hash."""
    rows = units.orderBy(F.xxhash64("uid"), "uid").limit(sample).select("v").toPandas()["v"]
    x = unit_vectors(np.stack([np.asarray(v, np.float64) for v in rows]))
    value, vector = np.linalg.eigh(np.cov(x.T, bias=True).reshape(size, size) if len(x) > 1 else np.eye(size))
    return np.ascontiguousarray(vector[:, np.argsort(-value, kind="stable")])


def _placed(units: DataFrame, axes: np.ndarray, eps: float) -> DataFrame:
    """units with their grid key on the leading axes (as many as fit in 62 bits) and coordinates on the axes of the boxes."""
    cells, axes = int(2 / eps) + 2, axes[:, :AXES]
    leading = max(1, min(axes.shape[1], int(62 * np.log(2) / np.log(cells))))

    @pandas_udf("struct<cell: long, at: array<double>>")
    def place(vectors: pd.Series) -> pd.DataFrame:
        x = np.stack([np.asarray(v, np.float64) for v in vectors]) if len(vectors) else np.zeros((0, len(axes)))
        at = unit_vectors(x) @ axes
        cell = np.clip(np.floor((at[:, :leading] + 1) / eps).astype(np.int64), 0, cells - 1)
        key = np.zeros(len(x), np.int64)
        for column in cell.T:
            key = key * cells + column
        return pd.DataFrame({"cell": key, "at": list(at)})

    return units.withColumn("p", place("v")).select("uid", "copies", "v", "p.cell", "p.at")


def _in_blocks(placed: DataFrame, block: int) -> DataFrame:
    """One row a block of the sequence in grid order: block, low, high, ids, copies and vectors (packed)."""
    kind = "<f4" if isinstance(placed.schema["v"].dataType, ArrayType) and isinstance(placed.schema["v"].dataType.elementType, FloatType) else "<f8"
    order = [F.col("cell"), F.xxhash64("uid"), F.col("uid")]
    dealt = placed.repartitionByRange(partitions(placed.sparkSession), *order).sortWithinPartitions(*order)
    ranked = cut(dealt.withColumn("spot", F.monotonically_increasing_id()).withColumn("part", F.shiftright("spot", 33)))
    sizes = ranked.groupBy("part").count().toPandas().sort_values("part")
    before = pd.DataFrame({"part": sizes["part"], "before": sizes["count"].cumsum() - sizes["count"]})
    offsets = placed.sparkSession.createDataFrame(before, "part long, before long")
    spot = F.col("before") + F.col("spot").bitwiseAND((1 << 33) - 1)
    numbered = ranked.join(F.broadcast(offsets), "part").select((spot / block).cast("long").alias("block"), "uid", "copies", "v", "at")

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        at = np.stack(frame["at"].to_list())
        vectors = np.stack(frame["v"].to_list()).astype(kind)
        return pd.DataFrame(
            {
                "block": [frame["block"].iloc[0]],
                "low": [at.min(0)],
                "high": [at.max(0)],
                "ids": [frame["uid"].to_numpy().astype("<i8").tobytes()],
                "copies": [frame["copies"].to_numpy().astype("<i8").tobytes()],
                "vectors": [vectors.tobytes()],
            }
        )

    return cut(numbered.groupBy("block").applyInPandas(pack, "block long, low array<double>, high array<double>, ids binary, copies binary, vectors binary")), kind


def _apart(a: str, b: str) -> Column:
    """Squared distance of two boxes."""
    gap = F.zip_with(
        F.arrays_zip(F.col(f"{a}_low").alias("low"), F.col(f"{a}_high").alias("high")),
        F.arrays_zip(F.col(f"{b}_low").alias("low"), F.col(f"{b}_high").alias("high")),
        lambda x, y: F.greatest(x["low"] - y["high"], y["low"] - x["high"], F.lit(0.0)),
    )
    return F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g)


def _near_blocks(boxes: DataFrame, eps: float, fanout: int) -> DataFrame:
    """Pairs (a, b), a <= b, of blocks whose boxes are within eps, by recursion over the tree of intervals."""
    size = first["n"] if (first := boxes.select(F.size("low").alias("n")).first()) else AXES
    levels = [boxes.select(F.col("block").alias("node"), "low", "high")]
    while levels[-1].limit(2).count() > 1:
        bounds = [F.min(F.col("low")[i]).alias(f"l{i}") for i in range(size)] + [F.max(F.col("high")[i]).alias(f"h{i}") for i in range(size)]
        up = levels[-1].groupBy((F.col("node") / fanout).cast("long").alias("node")).agg(*bounds)
        levels.append(cut(up.select("node", F.array(*[f"l{i}" for i in range(size)]).alias("low"), F.array(*[f"h{i}" for i in range(size)]).alias("high"))))
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    slack = eps * eps * (1 + 1e-9) + 1e-9
    for level in reversed(levels[:-1]):
        child = level.select("node", "low", "high", (F.col("node") / fanout).cast("long").alias("parent"))
        of_a, of_b = (child.select(*[F.col(c).alias(f"{x}_{c}") for c in child.columns]) for x in "xy")
        down = pairs.join(of_a, F.col("a") == F.col("x_parent")).join(of_b, F.col("b") == F.col("y_parent"))
        kept = down.filter((F.col("x_node") <= F.col("y_node")) & (_apart("x", "y") <= slack))
        pairs = cut(kept.select(F.col("x_node").alias("a"), F.col("y_node").alias("b")))
    return pairs


def _bounded(unit: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Leading coordinates and the length of the rest: products of two such rows are at least the cosine."""
    at = unit @ axes[:, :PARTIAL]
    return np.column_stack([at, np.sqrt(np.maximum(0, 1 - (at * at).sum(1)))]).astype(np.float32)


def compare(left: np.ndarray, right: np.ndarray | None, axes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the linked pairs of two sets of vectors, or (i < j) of one."""
    same = right is None
    u = unit_vectors(left)
    v = u if same else unit_vectors(right)
    low_u = _bounded(u, axes)
    low_v = (low_u if same else _bounded(v, axes)).T
    rows, columns, step = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 1024
    for at in range(0, len(u), step):
        i, j = np.nonzero(low_u[at : at + step] @ low_v >= threshold - _SLACK)
        i = i + at
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), 1 << 17):
            p, q = i[k : k + (1 << 17)], j[k : k + (1 << 17)]
            linked = (u[p] * v[q]).sum(1) >= threshold - 1e-12
            p, q = p[linked], q[linked]
            exact = _cosine(left[p], (left if same else right)[q]) >= threshold
            rows.append(p[exact])
            columns.append(q[exact])
    return np.concatenate(rows), np.concatenate(columns)


def _cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines row by row; powers of two are taken out first, which changes no digit of the result."""
    x, y = (np.ldexp(z, -np.frexp(np.abs(z).max(1, initial=0.0))[1][:, None]) for z in (x, y))
    return (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1))


def _links(threshold: float, kind: str, axes: np.ndarray):
    """Rows (node, links, root) of the vectors that have links in a tile: its blocks, and in the column pairs what to compare."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        blocks = {}
        for row in frame.itertuples():
            vectors = np.frombuffer(row.vectors, kind).reshape(-1, len(axes)).astype(np.float64)
            blocks[row.block] = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.copies, "<i8"), vectors
        found = []
        for pair in frame["pairs"].iloc[0]:
            a, b = blocks[pair["a"]], blocks[pair["b"]]
            same = pair["a"] == pair["b"]
            i, j = compare(a[2], None if same else b[2], axes, threshold)
            if len(i):
                ids, copies = (a[x] if same else np.concatenate([a[x], b[x]]) for x in (0, 1))
                j = j if same else j + len(a[0])
                links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
                some = np.flatnonzero(links)
                found.append(pd.DataFrame({"node": ids[some], "links": links[some].astype(np.int64), "root": ids[_roots(len(ids), i, j)[some]]}))
        return pd.concat(found) if found else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("node", "links", "root")})

    return run


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, i, before[j])
        np.minimum.at(root, j, before[i])
        root = root[root]
        if (root == before).all():
            return root


def _tiled(pairs: DataFrame, blocks: DataFrame, side: int) -> DataFrame:
    """Rows (x, y, block, ids, copies, vectors, pairs): for each tile (x, y) that has near blocks, the blocks it needs and the pairs (at most side squared)."""
    tile = [F.floor(F.col(c) / side).alias(name) for c, name in (("a", "x"), ("b", "y"))]
    held = cut(pairs.select(*tile, "a", "b").groupBy("x", "y").agg(F.collect_list(F.struct("a", "b")).alias("pairs")))
    need = held.select("x", "y", "pairs", F.explode(F.array_distinct(F.flatten(F.transform("pairs", lambda p: F.array(p["a"], p["b"]))))).alias("block"))
    return need.join(blocks.select("block", "ids", "copies", "vectors"), "block")


def _of_one_length(units: DataFrame, size: int, threshold: float, block: int, fanout: int, sample: int) -> DataFrame:
    """(node, links, root) of the vectors of one length that have links to others; units: distinct vectors (uid, v, copies)."""
    eps = max(sqrt(max(0.0, 2 - 2 * threshold)), 1e-3)
    axes = _axes(units, size, sample)
    blocks, kind = _in_blocks(_placed(units, axes, eps), block)
    pairs = _near_blocks(blocks, eps, fanout)
    # A tile has as many blocks on a side as leave every task about two tiles.
    number = blocks.count()
    side = max(1, min(_TILE, ceil(number / sqrt(4 * partitions(units.sparkSession)))))
    return _tiled(pairs, blocks, side).groupBy("x", "y").applyInPandas(_links(threshold, kind, axes), "node long, links long, root long")


def link_vectors(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, fanout: int = FANOUT, sample: int = SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    n_links counts the other rows at cosine >= threshold in double precision;
    component_id is the least id reachable by links; kept marks the row whose
    id that is. Vectors of different lengths link with nothing of each other;
    every length is joined by itself, in turn. Rows without an id, and vectors
    that are null, empty, zero or hold null or non-finite components, link with
    nothing. Repeated rows count each. An empty table gives no rows. Other
    columns are not read.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is over 0 and at most 1")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    usable = rows.filter(F.col("vec_id").isNotNull() & _linkable(F.col("v")))
    units = cut(usable.groupBy("v").agg(F.min("vec_id").alias("uid"), F.count("*").alias("copies")))
    lengths = sorted(r["n"] for r in units.select(F.size("v").alias("n")).distinct().collect())
    parts = [_of_one_length(units.filter(F.size("v") == n), n, threshold, block, fanout, sample) for n in lengths]
    none = units.select(*[F.lit(0).cast("long").alias(c) for c in ("node", "links", "root")]).limit(0)
    found = cut(reduce(DataFrame.unionByName, parts, none))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected_components(found, "node", "root").withColumnRenamed("node", "member")
    known = units.join(counts, F.col("uid") == F.col("node"), "left").join(groups, F.col("uid") == F.col("member"), "left")
    known = cut(known.select(F.col("v").alias("unit"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "uid").alias("component_id")))
    linked = rows.join(known, (F.col("v") == F.col("unit")) & F.col("vec_id").isNotNull(), "left")
    component = F.coalesce("component_id", "vec_id")
    return linked.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
