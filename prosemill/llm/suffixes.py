"""Suffix-array de-duplication of repeated byte strings: prefix doubling over sampled positions.

``doubled_repeats`` is prefix doubling in its plain form: Spark joins the rank
of every byte position with the rank at a growing offset, groups equal pairs,
drops what one document only has, and ranks again until the threshold. It holds
a row for each byte in every round, which no budget stands (README has figures),
so ``remove_repeats`` ranks pairs at growing offsets with two changes that keep
the work in proportion to the repeats. First, a sample of positions stands for
all: in each window of ``length`` bytes the 16-byte string with the least hash
is its anchor, so equal windows have the same anchor at the same place. The
windows of one anchor that follow each other form a run. Second, a rank is a
hash of the bytes it stands for, so equal strings have equal ranks wherever
they are ranked, and rows are sorted within buckets of ranks, by numpy, instead
of all together.

Round 1 ranks (anchor, run). Anchors that one document has drop out. Runs that
are equal differ in document only, so all but those of the least document are
covered as a whole. A run whose anchor also stands in other runs goes on if the
string on its left or its right doubles to one that another document has. Round
2 ranks, for the single windows of those runs, (first half, last half), which
together are the whole window, past the threshold.

Rows travel packed by task and bucket. A task keeps of each pair only the rows
of the least document it has seen; the others are covered, and go to their
documents by buckets of their own choice. Anchors of very many contexts (found
on a sample of the texts, the ``_HOTTEST`` most frequent ones) are not gathered:
such a row goes out as three, by its run, its left and its right string, of
which again a task sends one of each.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prosemill.llm.runtime import cut, partitions, release

ANCHOR = 16
#: Bytes of a rank that travel. Its high bits choose the bucket besides, and a pair of ranks counts.
RANK = 5
_SEGMENT = 1 << 18
_ROOM = 1 << 19
_FLUSH = 1 << 19
_BUCKET_BYTES = 8 << 20
#: One text in so many is looked at for anchors of very many contexts; how often one must stand there; how many are split at most.
_SAMPLED, _HOT, _HOTTEST = 64, 512, 1 << 18
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64
#: Id of rows without one: such documents come after all others.
_LAST = (1 << 63) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        out = np.full(_ROOM, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(_BASE), run(pow(_BASE, -1, 1 << 64))


class _Hashes:
    """Hashes of byte ranges of a buffer, by differences of running sums modulo 2**64."""

    def __init__(self, buffer: np.ndarray) -> None:
        power, self.back = _powers()
        self.sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum((buffer.astype(np.uint64) + _U(1)) * power[: len(buffer)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


class _Rows:
    """Columns of ranked rows: rank pair, side ranks (0: none), document, start, count and reach of the run."""

    NAMES = ("v", "r", "left", "right", "doc", "start", "count", "reach")

    def __init__(self, **columns: np.ndarray) -> None:
        self.__dict__.update(columns)

    def take(self, which: np.ndarray) -> _Rows:
        return _Rows(**{n: getattr(self, n)[which] for n in self.NAMES})

    @staticmethod
    def join(parts: Sequence[_Rows]) -> _Rows:
        return _Rows(**{n: np.concatenate([getattr(p, n) for p in parts]) for n in _Rows.NAMES})


def _chunks(raw: Sequence[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(document, offset in it, bytes) of segments that share length - 1 bytes with the next, in chunks."""
    docs, offsets, parts, size = [], [], [], 0
    for i, text in enumerate(raw):
        for at in range(0, len(text) - length + 1, _SEGMENT - length + 1):
            part = text[at : at + _SEGMENT]
            if size + len(part) > _SEGMENT and parts:
                yield np.array(docs), np.array(offsets), parts
                docs, offsets, parts, size = [], [], [], 0
            docs.append(i)
            offsets.append(at)
            parts.append(part)
            size += len(part)
    if parts:
        yield np.array(docs), np.array(offsets), parts


def _slices(raw: Sequence[bytes]) -> Iterator[slice]:
    """Consecutive texts of a few MB together."""
    begin = size = 0
    for i, text in enumerate(raw):
        size += len(text)
        if size >= 8 * _SEGMENT or i == len(raw) - 1:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0


def anchors(raw: Sequence[bytes], length: int) -> Iterator[_Rows]:
    """The runs of all windows of the texts; doc is the place in raw."""
    windows, side = length - ANCHOR + 1, (length - ANCHOR + 1) // 2
    low = _U(_ROOM - 1)
    for docs, offsets, parts in _chunks(raw, length):
        sizes = np.array([len(p) for p in parts])
        n = int(sizes.sum())
        joined = b"".join(parts) + bytes(ANCHOR)
        words = [np.ndarray((n,), "<u8", joined, o, (1,)).astype(np.uint64) for o in (0, 8)]
        rank = _mix(_mix(words[0]) ^ words[1])
        least = (rank & ~low) | np.arange(n, dtype=np.uint64)
        span = 1
        while 2 * span <= windows:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < windows:
            least = np.minimum(least[: -(windows - span)], least[windows - span :])
        begin, end = np.cumsum(sizes) - sizes, np.cumsum(sizes)
        segment = np.repeat(np.arange(len(parts)), sizes)
        p = np.flatnonzero(np.arange(len(least)) + length <= end[segment[: len(least)]])
        a, s = (least[p] & low).astype(np.int64), segment[p]
        change = np.ones(len(p), bool)
        change[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1])
        first = np.flatnonzero(change)
        a, s, start = a[first], s[first], p[first]
        count = np.diff(np.append(first, len(p)))
        hashes = _Hashes(np.frombuffer(joined, np.uint8)[:n])
        reach = a - start

        def beside(i: np.ndarray, j: np.ndarray, s: np.ndarray = s, begin: np.ndarray = begin, end: np.ndarray = end, hashes: _Hashes = hashes) -> np.ndarray:
            inside = (i >= begin[s]) & (j <= end[s])
            value = hashes.of(np.where(inside, i, 0), np.where(inside, j, 0)) & _U(0xFFFF)
            return np.where(inside, np.maximum(value, _U(1)), _U(0)).astype(np.uint16)

        yield _Rows(
            v=_mix(rank[a]),  # least hashes are small; buckets ask for even ones
            r=_mix(hashes.of(start, start + count + length - 1) + reach.astype(np.uint64)),
            left=beside(a - side, a),
            right=beside(a + ANCHOR, a + ANCHOR + side),
            doc=docs[s],
            start=start - begin[s] + offsets[s],
            count=count.astype(np.uint16),
            reach=reach.astype(np.uint16),
        )


def _place(rows: _Rows, flags: np.ndarray | int = 0) -> np.ndarray:
    """start, reach, count and flags in one integer; flags 0: covered, 1 and 2: doubles on the left, on the right."""
    return rows.start << 28 | rows.reach.astype(np.int64) << 16 | rows.count.astype(np.int64) << 4 | flags


def _unplace(places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return places >> 28, places >> 16 & 0xFFF, places >> 4 & 0xFFF, places & 15


def _planes(x: np.ndarray, width: int) -> bytes:
    """The low bytes of integers, all first bytes before all second ones."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplanes(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _pack(rows: _Rows, keys: np.ndarray, flags: np.ndarray | None = None) -> bytes:
    """rows in the order of documents, with their ranks, or with flags where what they are is known; keys: (id, text hash) by doc."""
    order = np.lexsort((rows.start, rows.doc))
    rows = rows.take(order)
    used, local = np.unique(rows.doc, return_inverse=True)
    steps = np.where(np.diff(local, prepend=-1) != 0, rows.start, np.diff(rows.start, prepend=0))
    places = _planes(local, 4) + _planes(steps, 6) + _planes(rows.count, 2) + _planes(rows.reach, 2)
    if flags is not None:
        return pickle.dumps((keys[used], len(local), pa.Codec("zstd").compress(places + flags[order].astype(np.uint8).tobytes(), asbytes=True)), protocol=5)
    return pickle.dumps((keys[used], len(local), pa.Codec("zstd").compress(places, asbytes=True), _planes(rows.v, RANK), _planes(rows.r, RANK), rows.left, rows.right), protocol=5)


def _unpack(blob: bytes) -> tuple[np.ndarray, _Rows, np.ndarray | None]:
    keys, size, places, *ranks = pickle.loads(blob)
    places = pa.Codec("zstd").decompress(places, (14 if ranks else 15) * size, asbytes=True)
    cuts = np.cumsum([0, 4, 6, 2, 2]) * size
    doc, step, count, reach = (_unplanes(places[a:b], w).astype(np.int64) for a, b, w in zip(cuts, cuts[1:], (4, 6, 2, 2), strict=False))
    head = np.maximum.accumulate(np.where(np.diff(doc, prepend=-1) != 0, np.arange(size), 0))
    total = np.cumsum(step)
    start = total - (total[head] - step[head])
    if ranks:
        (v, r), (left, right), flags = (_unplanes(x, RANK) for x in ranks[:2]), ranks[2:], None
    else:
        v, r, left, right = np.zeros((4, size), np.uint64)
        flags = np.frombuffer(places[cuts[-1] :], np.uint8).astype(np.int64)
    return keys, _Rows(v=v, r=r, left=left.astype(np.uint16), right=right.astype(np.uint16), doc=doc, start=start, count=count.astype(np.uint16), reach=reach.astype(np.uint16)), flags


def _groups(*columns: np.ndarray) -> np.ndarray:
    """Number of the group of each row; rows are sorted by the columns."""
    change = np.zeros(len(columns[0]), bool)
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.cumsum(change)


def _repeated(v: np.ndarray) -> np.ndarray:
    """Places of the values that occur more than once, sorted by value."""
    order = np.argsort(v, kind="stable")
    same = v[order][1:] == v[order][:-1]
    return order[np.append(same, False) | np.append(False, same)] if len(order) else order


def _of_several(ids: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are in a group, by equal columns, of more than one id, and which of those are the group's first of the least id."""
    several, least = np.zeros((2, len(ids)), bool)
    if not len(ids):
        return several, least
    order = np.lexsort((ids, *columns))
    group = _groups(*(c[order] for c in columns))
    first = np.flatnonzero(np.diff(group, prepend=-1))
    last = np.append(first[1:], len(order)) - 1
    wide = ids[order][first] < ids[order][last]
    several[order] = wide[group]
    least[order[first[wide]]] = True
    return several, least


class _Sender:
    """Collects a task's rows and packs them by bucket of the first rank. hot: sorted anchors that are split."""

    def __init__(self, buckets: int, hot: np.ndarray | None = None) -> None:
        self.buckets, self.rows, self.keys, self.size = buckets, [], [], 0
        self.hot = np.zeros(0, np.uint64) if hot is None else hot
        self.docs = 0

    def add(self, rows: _Rows) -> None:
        """rows number from 0 the documents that document() is to name next."""
        rows.doc = rows.doc + self.docs
        self.rows.append(rows)
        self.size += len(rows.v)

    def document(self, keys: np.ndarray) -> None:
        """(id, text hash) of documents."""
        self.keys.append(keys)
        self.docs += len(keys)

    def _split(self, rows: _Rows, ids: np.ndarray) -> tuple[list[_Rows], list[tuple[_Rows, int]]]:
        """Rows of hot anchors by run and by either side, and with their flag those that double within this task. A row by a side has run 0."""
        none, sent, known = np.zeros(len(ids), np.uint16), [], []
        sent.append(_Rows(**{**rows.__dict__, "v": _mix(rows.v ^ rows.r), "left": none, "right": none}))
        for flag, side in ((1, "left"), (2, "right")):
            string = getattr(rows, side)
            spot = np.flatnonzero(string > 0)
            there, own = rows.take(spot), string[spot].astype(np.uint64)
            several, least = _of_several(ids[spot], own, there.v)
            known.append((there.take(several), flag))
            plain = _Rows(**{**there.__dict__, "v": _mix(there.v ^ _mix(own << _U(2) | _U(flag))), "r": np.zeros(len(spot), np.uint64), "left": none[spot], "right": none[spot], side: string[spot]})
            sent.append(plain.take(~several | least))
        return sent, known

    def flush(self) -> Iterator[tuple[int, bytes]]:
        if self.size:
            rows, keys = _Rows.join(self.rows), np.concatenate(self.keys)
            ids = keys[:, 0][rows.doc]
            some = _repeated(rows.v)
            some = some[np.lexsort((ids[some], rows.r[some], rows.v[some]))]
            group = _groups(rows.v[some], rows.r[some])
            covered = np.zeros(len(ids), bool)
            if len(some):
                first = np.flatnonzero(np.diff(group, prepend=-1))
                covered[some] = ids[some] > ids[some][first][group]
            known = [(rows.take(covered), 0)]
            rows, ids = rows.take(~covered), ids[~covered]
            if len(self.hot):
                hot = self.hot[np.minimum(np.searchsorted(self.hot, rows.v), len(self.hot) - 1)] == rows.v
                parts, doubled = self._split(rows.take(hot), ids[hot])
                rows, known = _Rows.join([rows.take(~hot), *parts]), known + doubled
            yield from self._known(known, keys)
            bucket = ((rows.v >> _U(32)) * _U(self.buckets) >> _U(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            limits = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
            for b in range(self.buckets):
                if limits[b] < limits[b + 1]:
                    yield b, _pack(rows.take(order[limits[b] : limits[b + 1]]), keys)
        self.rows, self.keys, self.size, self.docs = [], [], 0, 0
        release()

    def _known(self, known: list[tuple[_Rows, int]], keys: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """Rows that ask nothing more, dealt evenly over the buckets on the way to their documents."""
        rows = _Rows.join([r for r, _ in known])
        flags = np.concatenate([np.full(len(r.v), f) for r, f in known])
        order = np.argsort(rows.doc, kind="stable")
        for at in range(0, len(order), 1 << 12):
            which = order[at : at + (1 << 12)]
            yield int(keys[rows.doc[which[0]], 1]) % self.buckets, _pack(rows.take(which), keys, flags[which])


def _sent(blobs: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for bucket, blob in blobs:
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([blob], pa.binary())], ["bucket", "blob"])


def _round(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, text hash, place) of what one bucket shows to be covered or to go on."""
    parts = [_unpack(b) for b in blobs]
    shift = np.cumsum([0, *(len(k) for k, _, _ in parts)])
    for (_, rows, _), s in zip(parts, shift, strict=False):
        rows.doc = rows.doc + s
    keys = np.concatenate([k for k, _, _ in parts])
    out = [(rows.doc, _place(rows, flags)) for _, rows, flags in parts if flags is not None]
    asked = [rows for _, rows, flags in parts if flags is None]
    if asked:
        rows = _Rows.join(asked)
        rows = rows.take(_repeated(rows.v))
        ids = keys[:, 0][rows.doc]
        order = np.lexsort((ids, rows.r, rows.v))
        rows, ids = rows.take(order), ids[order]
    if asked and len(ids):
        pair = _groups(rows.v, rows.r)
        least = ids[np.flatnonzero(np.diff(pair, prepend=-1))][pair]
        later = (ids > least) & (rows.r > 0)
        out.append((rows.doc[later], _place(rows.take(later))))
        rest, rest_ids = rows.take(~later), ids[~later]
        flags = np.zeros(len(rest_ids), np.int64)
        for bit, side in ((1, rest.left), (2, rest.right)):
            flags |= np.where((side > 0) & _of_several(rest_ids, side, rest.v)[0], bit, 0)
        goes = flags > 0
        out.append((rest.doc[goes], _place(rest.take(goes), flags[goes])))
    doc, place = (np.concatenate([np.zeros(0, np.int64), *(o[i] for o in out)]).astype(np.int64) for i in (0, 1))
    return keys[doc, 0], keys[doc, 1], place


def _ranked(sent: DataFrame, buckets: int) -> DataFrame:
    """(key, text_hash, place) of a round, from its packed rows."""

    def emit(held: list[bytes]) -> Iterator[pa.RecordBatch]:
        columns = _round(held)
        for at in range(0, len(columns[0]), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(c[at : at + (1 << 17)]) for c in columns], ["key", "text_hash", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [blob for batch in batches for blob in batch.column(1).to_pylist()]
        if held:
            yield from emit(held)
        release()

    return sent.repartitionById(buckets, F.col("bucket")).mapInArrow(run, "key long, text_hash long, place long")


def _windows(text: bytes, places: np.ndarray, length: int) -> _Rows:
    """The single windows of the runs that go on, ranked by their halves. A window that holds the whole left string asks for that side's flag, others for the right's."""
    start, reach, count, flags = _unplace(places)
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    p, o, f = np.repeat(start, count) + step, np.repeat(reach, count) - step, np.repeat(flags, count)
    p = np.unique(p[f & np.where(o >= (length - ANCHOR + 1) // 2, 1, 2) > 0])
    v, r = np.zeros((2, len(p)), np.uint64)
    half = (length + 1) // 2
    for at in range(0, len(text), _SEGMENT):
        here = slice(*np.searchsorted(p, (at, at + _SEGMENT)))
        if here.start < here.stop:
            hashes, q = _Hashes(np.frombuffer(text, np.uint8)[at : at + _SEGMENT + length]), p[here] - at
            v[here], r[here] = hashes.of(q, q + half), hashes.of(q + length - half, q + length)
    none = np.zeros(len(p), np.uint16)
    return _Rows(v=v, r=r, left=none, right=none, doc=np.zeros(len(p), np.int64), start=p, count=np.ones(len(p), np.uint16), reach=none)


def _fields(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def removed_mask(size: int, places: np.ndarray, length: int) -> np.ndarray:
    """True for the bytes that covered runs take."""
    edge = np.zeros(size + 1, np.int64)
    start, _, count, _ = _unplace(places)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + count + length - 1, -1)
    return np.cumsum(edge[:size]) > 0


def whole_characters(raw: bytes, mask: np.ndarray) -> np.ndarray:
    """The mask of removed bytes, without the characters of which some bytes stay."""
    begins = np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)
    if not len(begins):
        return mask
    return np.repeat(np.logical_and.reduceat(mask, begins), np.diff(np.append(begins, len(raw))))


def _hot_anchors(texts: DataFrame, length: int) -> np.ndarray:
    """Sorted ranks of the anchors that stand most often in sample texts; which ones are split decides about work only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(0).to_pylist()
            for part in _slices(raw):
                for rows in anchors(raw[part], length):
                    v, n = np.unique(rows.v, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)), pa.array(n)], ["v", "n"])

    counted = texts.mapInArrow(run, "v long, n long").groupBy("v").agg(F.sum("n").alias("n")).filter(F.col("n") >= _HOT)
    found = counted.orderBy(F.desc("n"), "v").limit(_HOTTEST).toPandas()["v"]
    return np.sort(found.to_numpy(np.int64).view(np.uint64))


def doubled_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, pos): where in which document a string of ``length`` bytes starts that a document with a smaller id has too.

    Plain prefix doubling, a row for each byte: the rank of a string is where
    the first equal one starts (document, position); a round joins every
    position with the rank at the offset that has been reached, and ranks the
    pairs. A string that one document only has is dropped, with all that it
    begins or ends. For small tables and comparisons; ids are not null, rows of
    one id are one text, and nulls are empty.
    """
    spread = docs.select(F.col(id_col).cast("long").alias("key"), F.hex(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")).alias("h"))
    byte = F.expr("transform(sequence(1, length(h) - 1, 2), i -> substring(h, i, 2))")
    rows = spread.filter("h <> ''").select("key", F.posexplode(byte).alias("pos", "b"))
    ranks, size = rows.select("key", F.col("pos").cast("long").alias("pos"), F.struct(F.conv("b", 16, 10).cast("long").alias("key"), F.lit(0).cast("long").alias("pos")).alias("rank")), 1
    while size < length:
        step = min(size, length - size)
        ahead = ranks.select("key", (F.col("pos") - step).alias("pos"), F.col("rank").alias("next"))
        pairs = cut(ranks.join(ahead, ["key", "pos"]))
        first = pairs.groupBy("rank", "next").agg(F.min(F.struct("key", "pos")).alias("new"), F.max("key").alias("last")).filter("new.key < last")
        ranks = cut(pairs.join(first, ["rank", "next"]).select("key", "pos", F.col("new").alias("rank")))
        size += step
    return ranks.filter("key > rank.key").select("key", "pos")


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", characters: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, row): every row's text without the bytes that stand in an earlier document.

    A byte goes if a string of ``length`` bytes that covers it also starts in a
    document with a smaller id, judged on the input. kept holds the remaining
    bytes, which may end inside a character; with ``characters`` a character
    goes only if all its bytes do, so kept is text. row holds the columns named
    in ``carry``, whatever their names; others are not read. Null texts are
    empty; rows of one id are one document and never take from each other;
    rows without an id come after all others. An empty table gives no rows.
    """
    if not ANCHOR < length <= 4096:
        raise ValueError("strings are longer than an anchor of 16 bytes, and at most 4096 bytes long")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in carry] or [F.lit(True).alias("none")])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), row.alias("row")).select(F.coalesce("doc_id", F.lit(_LAST)).alias("key"), F.xxhash64("text").alias("text_hash"), "doc_id", F.col("text").cast("binary").alias("text"), "row")
    carried = T.StructField("row", rows.schema["row"].dataType)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(partitions(spark), ceil(total / _BUCKET_BYTES))
    hot = _hot_anchors(rows.filter(F.pmod("text_hash", F.lit(_SAMPLED)) == 0).select("text"), length)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(buckets, hot)
        for batch in batches:
            keys, raw = np.column_stack([batch.column(i).to_numpy() for i in (0, 1)]), batch.column(2).to_pylist()
            for part in _slices(raw):
                for runs in anchors(raw[part], length):
                    sender.add(runs)
                sender.document(keys[part])
                if sender.size >= _FLUSH:
                    yield from _sent(sender.flush())
        yield from _sent(sender.flush())

    # The rows of round 1 are the most that is ever exchanged, and not needed beside those of round 2.
    ranked = cut(_ranked(rows.select("key", "text_hash", "text").mapInArrow(first, "bucket int, blob binary"), buckets), clear=True)

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=3)
        for batch in batches:
            raw = batch.column(3).to_pylist()
            packed = [codec.compress(t, asbytes=True) if t else b"" for t in raw]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array([len(t) for t in raw], pa.int64()), pa.array(packed, pa.binary()), batch.column(4)], ["key", "text_hash", "doc_id", "n_bytes", "packed", "row"])

    packed = rows.mapInArrow(squeeze, _fields("key long, text_hash long, doc_id long, n_bytes long, packed binary").add(carried)).repartition(buckets, "key", "text_hash")
    go_on = F.col("place").bitwiseAND(15) != 0

    def of_doc(places: DataFrame) -> DataFrame:
        return places.groupBy("key", "text_hash").agg(F.collect_list("place").alias("places"))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender, codec = _Sender(buckets), pa.Codec("zstd")
        for batch in batches:
            keys = np.column_stack([batch.column(i).to_numpy() for i in (0, 1)])
            for i, (n, packed, places) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("n_bytes", "packed", "places")), strict=True)):
                if not places:
                    continue
                sender.add(_windows(codec.decompress(packed, n, asbytes=True), np.array(places), length))
                sender.document(keys[i : i + 1])
                if sender.size >= _FLUSH:
                    yield from _sent(sender.flush())
        yield from _sent(sender.flush())

    # Both joins with the texts are left joins of all their columns, so they share one exchange.
    windows = packed.join(of_doc(ranked.filter(go_on)), ["key", "text_hash"], "left").mapInArrow(second, "bucket int, blob binary")
    covered = ranked.filter(~go_on).unionByName(_ranked(windows, buckets))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            gone, spans, kept = [], [], []
            for n, packed, places in zip(*(batch.column(c).to_pylist() for c in ("n_bytes", "packed", "places")), strict=True):
                raw = codec.decompress(packed, n, asbytes=True) if n else b""
                if places:
                    mask = removed_mask(n, np.array(places), length)
                    if characters:
                        mask = whole_characters(raw, mask)
                    gone.append(int(mask.sum()))
                    spans.append(int((np.diff(mask.astype(np.int8), prepend=0) == 1).sum()))
                    raw = np.frombuffer(raw, np.uint8)[~mask].tobytes()
                else:
                    gone.append(0)
                    spans.append(0)
                kept.append(raw)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary()), batch.column("row")], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "row"])

    whole = packed.join(of_doc(covered), ["key", "text_hash"], "left")
    return whole.mapInArrow(finish, _fields("doc_id long, n_bytes long, n_removed long, n_spans long, kept binary").add(carried))

