"""Document fingerprints: one-permutation MinHash with optimal densification and packed low bits.

Each five-word shingle is hashed once; the top bits of the hash choose a bin
and the bin keeps its least remainder. An empty bin takes the value of the
first filled bin in an order of all bins that is random but fixed for it, so
every filled bin is as likely. Of each bin the low ``BITS`` bits are kept. Two
unequal values agree in them by chance, which the estimate takes off again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from prosemill.llm.runtime import partitions

BINS, BITS, WORDS = 512, 4, 5
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_CHUNK = 1 << 18
_FEW = 64
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _orders() -> tuple[np.ndarray, np.ndarray]:
    """orders[i]: the bins in the order that bin i tries them; places[i, j]: when it tries j."""
    orders = np.random.default_rng(20170701).permuted(np.tile(np.arange(BINS), (BINS, 1)), axis=1)
    return orders, np.argsort(orders, axis=1)


@lru_cache(maxsize=1)
def _salts() -> np.ndarray:
    """Values are mixed with their bin before truncation, so copies of one value agree by chance independently."""
    return _mix(np.arange(1, BINS + 1, dtype=np.uint64) * np.uint64(_BASE))


def _word_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of byte ranges, by differences of running sums modulo 2**64."""
    n = len(buffer)
    powers = np.ones(n + 1, np.uint64)
    powers[1:] = np.multiply.accumulate(np.full(n, _BASE, np.uint64))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
    back = np.ones(n + 1, np.uint64)
    back[1:] = np.multiply.accumulate(np.full(n, _UNBASE, np.uint64))
    return _mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def _minima(raw: Sequence[bytes]) -> np.ndarray:
    """Least remainder by text and bin; _EMPTY where a bin has no shingle."""
    table = np.full(len(raw) * BINS, _EMPTY)
    buffer = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    space = _SPACE[buffer]
    starts, ends = np.flatnonzero(space[:-1] & ~space[1:]) + 1, np.flatnonzero(~space[:-1] & space[1:]) + 1
    if not len(starts):
        return table.reshape(-1, BINS)
    hashes = _word_hashes(buffer, starts, ends)
    limits = np.cumsum([0, *(len(r) + 1 for r in raw)]) + 1
    first = np.searchsorted(starts, limits)
    size = np.diff(first)
    owner = np.repeat(np.arange(len(raw)), size)
    count = np.where(size == 0, 0, np.maximum(size - WORDS + 1, 1))
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[:-1], count)
    shingle, width = np.zeros(len(at), np.uint64), np.repeat(np.minimum(size, WORDS), count)
    for k in range(WORDS):
        within = k < width
        part = hashes[np.minimum(at + k, len(hashes) - 1)]
        shingle += np.where(within, (part ^ np.uint64(k + 1)) * np.uint64(pow(_BASE, k + 1, 1 << 64)), np.uint64(0))
    shingle = _mix(shingle)
    shift = np.uint64(64 - BINS.bit_length() + 1)
    spot = owner[at] * BINS + (shingle >> shift).astype(np.int64)
    np.minimum.at(table, spot, shingle & ((np.uint64(1) << shift) - np.uint64(1)))
    return table.reshape(-1, BINS)


def _densify(table: np.ndarray) -> np.ndarray:
    orders, places = _orders()
    filled = table != _EMPTY
    number = filled.sum(1)
    out = table.copy()
    for r in np.flatnonzero((number > 0) & (number < _FEW)):
        bins = np.flatnonzero(filled[r])
        out[r] = table[r, bins[np.argmin(places[:, bins], axis=1)]]
        out[r, bins] = table[r, bins]
    row, empty = np.nonzero(~filled & (number >= _FEW)[:, None])
    for attempt in range(BINS):
        if not len(row):
            break
        value = table[row, orders[empty, attempt]]
        good = value != _EMPTY
        out[row[good], empty[good]] = value[good]
        row, empty = row[~good], empty[~good]
    return out


def sketch(texts: Sequence[str | None]) -> np.ndarray:
    """Packed fingerprints, one row of bytes for each text; a text without words has zeros only.

    Words are runs of non-space bytes with A-Z lower-cased. A text of fewer
    words than a shingle is one shingle.
    """
    out, raw, size = [], [], 0
    for i, text in enumerate(texts):
        raw.append((text or "").encode("utf-8", "surrogatepass").lower())
        size += len(raw[-1])
        if size >= _CHUNK or i == len(texts) - 1 or len(raw) >= 2048:
            low = (_mix(_densify(_minima(raw)) ^ _salts()) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
            low[[not r.strip() for r in raw]] = 0
            out.append(np.packbits(np.unpackbits(low[..., None], axis=2)[:, :, 8 - BITS :].reshape(len(raw), -1), axis=1))
            raw, size = [], 0
    return np.concatenate(out) if out else np.zeros((0, BINS * BITS // 8), np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of the shingles of packed fingerprints, row by row.

    Two texts without words are alike (1), one with and one without are not (0).
    """
    bits = np.unpackbits(a ^ b, axis=1).reshape(len(a), BINS, BITS)
    agree = (bits.max(2) == 0).mean(1)
    chance = 2.0**-BITS
    value = np.clip((agree - chance) / (1 - chance), 0, 1)
    blank_a, blank_b = ~a.any(1), ~b.any(1)
    return np.where(blank_a | blank_b, (blank_a & blank_b).astype(float), value)


def fingerprint(text: Column) -> Column:
    """Packed fingerprint of a text column, as lower-case hex."""

    @pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([r.tobytes().hex() for r in sketch(texts.tolist())], dtype=object)

    return of(text)


class _Ranges:
    """Ranges of the order (id descending, null last; then the text's hash), of about as many rows each.

    An id that takes several of the cut points, or null, has ranges of its own by hash.
    """

    def __init__(self, docs: DataFrame, number: int) -> None:
        at = [i / number for i in range(1, number)]
        row = docs.agg(F.percentile_approx("doc_id", at, 100 * number), F.count("*"), F.count("doc_id")).first()
        found = [int(c) for c in row[0] or []]
        self.cuts = np.array(sorted(set(found)), np.int64)
        # ranges of an id that is a cut point, besides the one of the ids above it up to the next cut point
        self.own = np.array([found.count(c) if found.count(c) > 1 else 0 for c in self.cuts.tolist()], np.int64)
        self.null = max(1, round(number * (row[1] - row[2]) / max(1, row[1])))
        sizes = np.append(self.own[::-1], 0) + 1
        self.start = np.cumsum(sizes) - sizes
        self.total = int(sizes.sum())

    def of(self, ids: pd.Series, null: pd.Series, marks: pd.Series) -> np.ndarray:
        """The number of each row's range."""
        at = np.searchsorted(self.cuts, ids.to_numpy(), "right")
        low, share = np.maximum(at - 1, 0), (marks.to_numpy().astype(np.float64) + 2.0**63) / 2.0**64
        if len(self.cuts):
            own = np.where((at > 0) & (self.cuts[low] == ids.to_numpy()), self.own[low], 0)
        else:
            own = np.zeros(len(at), np.int64)
        inside = np.where(own > 0, 1 + np.minimum((share * own).astype(np.int64), own - 1), 0)
        number = self.start[len(self.cuts) - at] + inside
        return np.where(null, self.total + np.minimum((share * self.null).astype(np.int64), self.null - 1), number)


def _order_columns() -> tuple[Column, Column, Column]:
    """Ids with nulls filled, where they were (a null would turn a batch of ids into floats), and the texts' hashes."""
    return F.coalesce("doc_id", F.lit(0).cast("long")), F.col("doc_id").isNull(), F.xxhash64("text")


def with_next(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) dealt by ranges of their order: part, ahead, doc_id, text, sorted.

    The rows of a range are followed by those at the head of the next one
    (ahead = 1), so that each row's follower is in its own partition. One
    shuffle of the texts, and no ordering in a single task.
    """
    number = 4 * partitions(docs.sparkSession)
    ranges = _Ranges(docs.select("doc_id"), number)

    @pandas_udf("int")
    def range_of(ids: pd.Series, null: pd.Series, marks: pd.Series) -> pd.Series:
        return pd.Series(ranges.of(ids, null, marks))

    first = F.min(F.struct(F.bitwise_not(F.coalesce("doc_id", F.lit(0).cast("long"))).alias("id"), F.xxhash64("text").alias("mark"))).alias("head")
    heads = {r["r"]: tuple(r["head"]) for r in docs.groupBy(range_of(*_order_columns()).alias("r")).agg(first).collect()}
    order = sorted(heads)
    before = {r: order[i - 1] for i, r in enumerate(order)}

    @pandas_udf("array<int>")
    def places(ids: pd.Series, null: pd.Series, marks: pd.Series) -> pd.Series:
        rows = zip(ranges.of(ids, null, marks).tolist(), (~ids).tolist(), marks.tolist(), strict=True)
        return pd.Series([[r, before[r]] if (i, mark) == heads[r] else [r] for r, i, mark in rows], dtype=object)

    dealt = docs.select("doc_id", "text", F.posexplode(places(*_order_columns())).alias("ahead", "part"))
    return dealt.repartition(number, "part").sortWithinPartitions("part", "ahead", F.desc_nulls_last("doc_id"), F.xxhash64("text"))


SCHEMA = "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, str, str]]]:
    """(doc_id, text, text of the next document), by batches of a few MB."""
    held, out, size = None, [], 0
    for batch in batches:
        for part, ahead, doc, text in zip(*(batch.column(c).to_pylist() for c in ("part", "ahead", "doc_id", "text")), strict=True):
            if held is not None and held[0] == part:
                out.append((held[1], held[2], text))
                size += len(held[2]) + len(text)
            held = None if ahead else (part, doc, text)
            if size >= 8 * _CHUNK or len(out) >= 4096:
                yield out
                out, size = [], 0
    if out:
        yield out


def compare_neighbours(docs: DataFrame, share: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and the likeness to that and to the next document.

    The next document is the one with the next smaller id, and the first after
    the last (of a single document: itself). The edited text has the last
    1/share of the code points replaced by as many of the next document's
    first, or all of them. Null texts are empty. Rows of one id follow each
    other by a hash of the text; rows without an id come last. An empty table
    gives no rows. Other columns are not read, and may have any names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _pairs(batches):
            ids, texts, nexts = (list(x) for x in zip(*rows, strict=True))
            edited = [t[: len(t) - len(t) // share] + n[: len(t) // share] for t, n in zip(texts, nexts, strict=True)]
            place = {t: i for i, t in enumerate(dict.fromkeys(texts + nexts))}
            marks, changed = sketch(list(place)), sketch(edited)
            own, after = marks[[place[t] for t in texts]], marks[[place[t] for t in nexts]]
            columns = [
                pa.array(ids, pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(edited, pa.string()),
                pa.array([r.tobytes().hex() for r in own], pa.string()),
                pa.array([r.tobytes().hex() for r in changed], pa.string()),
                pa.array(likeness(own, changed)),
                pa.array(likeness(own, after)),
            ]
            yield pa.RecordBatch.from_arrays(columns, NAMES)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return with_next(rows).mapInArrow(run, SCHEMA)
