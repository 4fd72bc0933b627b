"""SimHash near-duplicate detection by multi-index hashing.

A fingerprint is cut into segments, and stored in the table of every segment
under its own key there.

``simhash_groups`` links fingerprints of 64 bits at distance 4 or less. They
agree in one of three segments but for one bit at most, so a fingerprint also
looks up every key within a Hamming ball of radius 1 of its own, and no link is
lost; every match is checked on all 64 bits. A pair that differs in one bit of a
segment is found from the side where the bit is 0, so only those flips are sent.

``similar_groups`` links texts whose sets of shingles have a Jaccard similarity
of 0.8, say, or more. At 0.8 a bit of a SimHash differs with probability 0.15,
so 64 bits are too few to tell: it takes fingerprints of 2,048 bits, stores them
by as many segments as find such a pair under one key with the probability asked
for, and links matches by their complete distance. A ball of 19 keys would find
4 times as many pairs a segment, for 19 times the keys.

Equal fingerprints are merged first. A bucket of more than ``block`` distinct
fingerprints is dealt over several tasks, each holding a block of it against
all its probes, and no task passes on all pairs of a group.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from prosemill.llm.components import connected_components
from prosemill.llm.runtime import checkpoint_root, cut, release

#: (word, first bit, width) of the segments of a fingerprint of 64 bits.
SEGMENTS = ((0, 0, 22), (0, 22, 21), (0, 43, 21))
_PAIRS = 1 << 20
_SHINGLES = 1 << 16
#: A wide fingerprint takes its bit vectors from a table of so many rows, each with a sign.
_ROWS = 1024
#: Bits of a wide fingerprint at least; words of a chunk of distances.
WIDE, _CHUNK = 2048, 1 << 22
#: So many hot buckets or ids are broadcast, a few MB.
_FEW = 100_000


def _hashes(text: str | None, words: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles, repeats included, in bounded parts; a text of fewer words is one shingle."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    begins = np.cumsum(lengths + 1) - lengths - 1
    width = min(words, len(tokens))
    n = len(tokens) - width + 1
    starts, ends, digest = begins[:n].tolist(), (begins + lengths)[width - 1 :].tolist(), xxhash.xxh64_intdigest
    for at in range(0, n, _SHINGLES):
        part = zip(starts[at : at + _SHINGLES], ends[at : at + _SHINGLES], strict=True)
        yield np.array([digest(joined[i:j], seed) for i, j in part], dtype="<u8")


def simhash64(text: str | None, words: int = 4, seed: int = 42) -> int:
    """SimHash of a whole text over shingles of so many words, as an unsigned integer."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in _hashes(text, words, seed):
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, words: int = 4, seed: int = 42) -> Column:
    """The SimHash of a text column as a signed 64-bit column; null and blank texts give 0."""

    @pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash64(t, words, seed) for t in texts], dtype=np.uint64).view(np.int64))

    return of(text)


# --- probes and matches ---------------------------------------------------------------


def _matches(bits: int, take: Callable[[np.ndarray, np.ndarray, np.ndarray], pd.DataFrame], name: str = "fp"):
    """Sorted rows (bucket, part, stored first) to what take(bucket, left, right) makes of the matches at distance <= bits, by different values of the column name."""

    def against(stored: pd.DataFrame, probes: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Every probe against all stored fingerprints of its bucket and part."""
        s_key = stored["key"].to_numpy()
        s_fp, p_fp, p_bucket = stored["fp"].to_numpy(), probes["fp"].to_numpy(), probes["bucket"].to_numpy()
        s_name, p_name = stored["name"].to_numpy(), probes["name"].to_numpy()
        first = np.searchsorted(s_key, probes["key"].to_numpy(), "left")
        count = np.searchsorted(s_key, probes["key"].to_numpy(), "right") - first
        done = 0
        while done < len(p_fp):
            total = np.cumsum(count[done:])
            n_rows = max(1, int(np.searchsorted(total, _PAIRS, "right")))
            own, n = first[done : done + n_rows], count[done : done + n_rows]
            row = np.repeat(np.arange(done, done + len(n)), n)
            spot = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(own, n)
            near = np.bitwise_count((p_fp[row] ^ s_fp[spot]).view(np.uint64)) <= bits
            row, spot = row[near], spot[near]
            near = p_name[row] != s_name[spot]
            if near.any():
                yield take(p_bucket[row[near]], p_name[row[near]], s_name[spot[near]])
            done += n_rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, at = pd.DataFrame({c: np.array([], np.int64) for c in ("key", "fp", "name")}), None
        for frame in batches:
            if frame.empty:
                continue
            change = np.ones(len(frame), bool)
            bucket, part = frame["bucket"].to_numpy(), frame["part"].to_numpy()
            change[1:] = (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])
            keys = np.cumsum(change)
            carried = held.assign(key=1) if at == (bucket[0], part[0]) else held.iloc[:0]
            fresh = pd.DataFrame({"key": keys, "fp": frame["fp"].to_numpy(), "name": frame[name].to_numpy(), "bucket": bucket})
            own = frame["stored"].to_numpy()
            stored = pd.concat([carried, fresh[own][["key", "fp", "name"]]])
            yield from against(stored, fresh)
            # The last group can go on in the next batch; its rows there meet what is stored of it here.
            held, at = stored[stored["key"] == keys[-1]], (bucket[-1], part[-1])

    return run


class _Forest:
    """Union-find over the links of one chunk; keeps the links that joined two trees."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def _root(self, x: int) -> int:
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = up.setdefault(y, y)
            x = up[x]
        return x

    def add(self, x: int, y: int) -> bool:
        x, y = self._root(x), self._root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _forest(bucket: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """A spanning forest of links."""
    tree = _Forest()
    kept = [(x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True) if tree.add(x, y)]
    return pd.DataFrame(kept, columns=["a", "b"], dtype=np.int64)


def _members(bucket: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """What has a match, by bucket."""
    return pd.DataFrame({"bucket": np.concatenate([bucket, bucket]), "key": np.concatenate([a, b])}).drop_duplicates()


def _segment_keys(fingerprint: str, segments: tuple[tuple[int, int, int], ...]) -> list[Column]:
    """The column keys: for each segment its number and value together, and its width. fingerprint: a long, or binary of 64-bit words."""

    def word(number: int) -> Column:
        if fingerprint == "fp":
            return F.col("fp")
        return F.conv(F.hex(F.substring(fingerprint, 8 * number + 1, 8)), 16, -10).cast("long")

    keys = [F.struct(F.shiftrightunsigned(word(w), low).bitwiseAND((1 << width) - 1).bitwiseOR(s << 40).alias("own"), F.lit(width).alias("width")) for s, (w, low, width) in enumerate(segments)]
    return [F.array(*keys).alias("keys")]


def few_by_broadcast(df: DataFrame) -> DataFrame:
    """df, computed before, for a join by broadcast if it has few rows: that saves an exchange of the other side. More of them are joined like any table."""
    return F.broadcast(df) if df.count() <= _FEW else df


def _in_parts(rows: DataFrame, load: DataFrame, name: str, block: int) -> DataFrame:
    """rows (bucket, name, stored and others) with a part: each row meets all that is stored in its bucket; load: rows stored by bucket.

    Rows that are not stored go to all parts. A stored one goes to its own part and those before it: what is stored in later parts comes to it.
    """
    hot = cut(load.filter(F.col("count") > block).select("bucket", F.ceil(F.col("count") / block).cast("int").alias("parts")))
    dealt = rows.join(few_by_broadcast(hot), "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    at = F.pmod(F.xxhash64(name), F.col("parts")).cast("int")
    others = [c for c in rows.columns if c not in ("bucket", name, "stored")]
    spread = dealt.select("bucket", name, F.explode(F.sequence(F.lit(0), F.when(F.col("stored"), at).otherwise(F.col("parts") - 1))).alias("part"), F.col("stored").alias("own"), at.alias("at"), *others)
    return spread.select("bucket", "part", name, (F.col("own") & (F.col("at") == F.col("part"))).alias("stored"), *others)


def _dealt(fps: DataFrame, block: int, name: str = "fp", radius: int = 1) -> DataFrame:
    """Rows (bucket, part, name, stored, fp) sorted in their tasks: every row stored under its keys and, for a radius of 1, sought under their flips of a 0.

    fps: name, fp (the first word of a wide one) and keys. A bucket's number says its segment.
    """
    columns = list(dict.fromkeys([name, "fp"]))
    own = fps.select(*columns, F.explode("keys").alias("k")).select(*columns, "k.own", "k.width")
    flips = "transform(filter(sequence(0, width - 1), b -> (own & shiftleft(1L, b)) = 0), b -> struct(own | shiftleft(1L, b) AS bucket, false AS stored))"
    rows = own.select(F.col("own").alias("bucket"), *columns, F.lit(True).alias("stored"))
    if radius:
        rows = own.select(*columns, F.expr(f"explode(concat(array(struct(own AS bucket, true AS stored)), {flips}))").alias("p")).select("p.bucket", *columns, "p.stored")
    dealt = _in_parts(rows, own.groupBy(F.col("own").alias("bucket")).count(), name, block)
    return dealt.repartition("bucket", "part").sortWithinPartitions("bucket", "part", F.desc("stored"))


def near_links(fps: DataFrame, bits: int = 4, block: int = 4096) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of fp at distance <= bits (4 at most).

    fps: distinct fingerprints in column fp.
    """
    if not 0 <= bits <= 4:
        raise ValueError("three segments with balls of radius 1 find distances up to 4")
    return _dealt(fps.select("fp", *_segment_keys("fp", SEGMENTS)), block).mapInPandas(_matches(bits, _forest), "a long, b long")


def _node(least: Column, mark: Column) -> Column:
    """What stands for rows of one mark among links: their least id, and behind all of those with ids the marks without any."""
    return F.struct(least.isNull().alias("no_id"), F.coalesce(least, F.lit(0)).cast("long").alias("id"), mark.alias("mark"))


def _least_id(node: Column) -> Column:
    return F.when(~node["no_id"], node["id"])


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, bits: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the least id reachable by links.

    Null and blank texts have fingerprint 0 and link like any other. Repeated
    ids and texts keep their rows. A row without an id belongs to the group of
    its fingerprint; a group without any id has a null component. An empty
    table gives none. Other columns of docs are not read.
    """
    marked = cut(docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), words, seed).alias("fp")))
    least = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")).select("fp", _node(F.col("first_id"), F.col("fp")).alias("own")))
    links = near_links(least, bits)
    of_a, of_b = (least.select(F.col("fp").alias(end), F.col("own").alias(f"own_{end}")) for end in "ab")
    linked = connected_components(links.join(of_a, "a").join(of_b, "b").select("own_a", "own_b"), "own_a", "own_b")
    grouped = least.join(linked, least["own"] == linked["node"], "left").select(F.col("fp").alias("of"), _least_id(F.coalesce("component", "own")).alias("component_id"))
    return marked.join(grouped, marked["fp"] == grouped["of"], "left").select("doc_id", "fp", "component_id")


# --- similarity of sets -----------------------------------------------------------------


def differing(similarity: float) -> float:
    """The probability that a bit of the SimHash differs between sets of equal size at a Jaccard similarity."""
    return math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi


def wide_segments(similarity: float, missed: float, width: int = 18, radius: int = 1) -> tuple[tuple[int, int, int], ...]:
    """Segments of so many bits, such that a pair at the similarity differs in more than ``radius`` bits of each with probability ``missed``."""
    p = differing(similarity)
    hit = sum(math.comb(width, k) * p**k * (1 - p) ** (width - k) for k in range(radius + 1))
    number = max(1, math.ceil(math.log(missed) / math.log1p(-hit))) if hit < 1 else 1
    a_word = 64 // width
    return tuple((s // a_word, s % a_word * width, width) for s in range(number))


@lru_cache(maxsize=2)
def _table(bits: int) -> np.ndarray:
    return np.random.default_rng(64).choice(np.array([-1, 1], np.float32), (_ROWS, bits))


def shingle_set(text: str | None, words: int, seed: int = 42) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; a blank text has none."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *_hashes(text, words, seed)]))


def _sketch(words: int, n_words: int):
    """Rows (doc_id, key, size, fp, words) of texts: the hash and size of the set of shingles and its wide SimHash.

    The bit vector of a shingle is a row of a fixed random table or its
    complement, as its hash says; a bit of the SimHash is 1 if it is set in over
    half of them. So signed counts of rows, times the table, give all bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(64 * n_words)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                sizes, keys, counts = [], [], np.zeros((batch.num_rows, _ROWS), np.float32)
                for i, text in enumerate(batch.column(1)):
                    marks = shingle_set(text.as_py(), words)
                    counts[i] = np.bincount((marks % np.uint64(_ROWS)).astype(np.int64), np.where(marks >> np.uint64(63), 1.0, -1.0), _ROWS)
                    sizes.append(len(marks))
                    keys.append(xxhash.xxh64_intdigest(marks.tobytes()))
                bits = np.packbits(counts @ table > 0, axis=1, bitorder="little").view("<u8")
                columns = [batch.column(0), pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), pa.array(bits[:, 0].view(np.int64)), pa.array([b.tobytes() for b in bits], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "size", "fp", "words"])
        release()

    return run


def _near(a: np.ndarray, b: np.ndarray, far: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of the rows of a and b at distance <= far, in chunks."""
    step = max(1, _CHUNK // max(1, b.size))
    for at in range(0, len(a), step):
        distance = np.zeros((len(a[at : at + step]), len(b)), np.uint16)
        for x, y in zip(a[at : at + step].T, b.T, strict=True):
            distance += np.bitwise_count(x[:, None] ^ y)
        i, j = np.nonzero(distance <= far)
        yield i + at, j


def _linked(far: int):
    """Sorted rows (bucket, part, stored first) of wide fingerprints to a spanning forest of the links by complete distance.

    What is near the first fingerprint stored in a group is one tree by that;
    only what is not is held against all others. No group is held but for the
    fingerprints stored in it, which are ``block`` at most.
    """

    def links(keys: np.ndarray, stored: np.ndarray, other_keys: np.ndarray, others: np.ndarray) -> Iterator[pd.DataFrame]:
        a, b, tree = [], [], _Forest()

        def take(x: np.ndarray, y: np.ndarray) -> None:
            for p, q in zip(keys[x].tolist(), other_keys[y].tolist(), strict=True):
                if tree.add(p, q):
                    a.append(p)
                    b.append(q)

        first = np.zeros(1, np.int64)
        with_first = [np.concatenate([j for _, j in _near(stored[:1], rows, far)]) for rows in (stored, others)]
        apart = [np.setdiff1d(np.arange(len(rows)), near) for rows, near in zip((stored, others), with_first, strict=True)]
        for k in with_first[0].tolist():
            if tree.add(int(keys[0]), int(keys[k])):
                a.append(int(keys[0]))
                b.append(int(keys[k]))
        take(np.repeat(first, len(with_first[1])), with_first[1])
        for i, j in _near(stored[apart[0]], others, far):
            take(apart[0][i], j)
        for i, j in _near(stored[with_first[0]], others[apart[1]], far):
            take(with_first[0][i], apart[1][j])
        if a:
            yield pd.DataFrame({"a": a, "b": b}, dtype=np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, keys, stored = None, np.zeros(0, np.int64), None
        for frame in batches:
            for group, rows in frame.groupby(["bucket", "part"], sort=False):
                words = np.frombuffer(b"".join(rows["words"]), "<u8").reshape(len(rows), -1)
                own = rows["stored"].to_numpy()
                if group != at:
                    at, keys, stored = group, np.zeros(0, np.int64), words[:0]
                keys, stored = np.concatenate([keys, rows["key"].to_numpy()[own]]), np.concatenate([stored, words[own]])
                if len(keys):
                    yield from links(keys, stored, rows["key"].to_numpy(), words)

    return run


def _stored(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again: a checkpoint would carry size estimates on, which joins multiply every round."""
    path = f"{checkpoint_root(df.sparkSession)}/similar-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _deleted(*tables: DataFrame) -> None:
    """Remove the files of tables that are not read any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _reach(probability: float, n: int, z: float) -> int:
    """So many of n bits differ at most, but for chance beyond z standard deviations."""
    return math.ceil(n * probability + z * math.sqrt(n * probability * (1 - probability)))


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8, missed: float = 0.01, width: int = 18, block: int = 4096) -> DataFrame:
    """(doc_id, component_id) of every row; component_id is the least id reachable by links of Jaccard similarity >= similarity.

    The similarity is that of the sets of shingles (``words`` lower-case words
    long), as their SimHash tells it: the complete distance of two fingerprints
    stands for it with a standard error of about 0.02, and the limit is set one
    such error low, so pairs at the similarity link for the most part, and
    pairs well below it do not. A pair right at the similarity is not found
    with probability ``missed``, and 0.6 % for the check of the first word; the
    chance falls fast above it, and a group holds together by any of its links.
    A text has a row for each segment (87) at most, however many are like it; in
    a bucket of many blocks, one for each block up to its own. Strangers that
    share a key grow with their square, about n / 3,000 for each of n documents;
    each costs a comparison of one word. A larger ``width`` has fewer of them,
    and more segments.

    Null and blank texts have the empty set and are copies of each other.
    Repeated ids and texts keep their rows. A row without an id belongs to the
    group of its text; a group without any id has a null component. An empty
    table gives no rows. Other columns of docs are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    segments, p = wide_segments(similarity, missed, width, 0), differing(similarity)
    n_words = max(WIDE // 64, segments[-1][0] + 1)
    marked = _stored(rows.mapInArrow(_sketch(words, n_words), "doc_id long, key long, size long, fp long, words binary"))
    sets = _stored(marked.groupBy("key").agg(F.min("doc_id").alias("first_id"), *[F.first(c).alias(c) for c in ("size", "fp", "words")]))
    wide = sets.filter("size > 0")
    found = _dealt(wide.select("key", "fp", *_segment_keys("words", segments)), block, "key", 0).mapInPandas(_matches(_reach(p, 64, 2.5), _members, "key"), "bucket long, key long")
    held = _stored(found.distinct())
    dealt = _in_parts(held.withColumn("stored", F.lit(True)), held.groupBy("bucket").count(), "key", block)
    dealt = dealt.join(wide.select("key", "words"), "key").repartition("bucket", "part").sortWithinPartitions("bucket", "part", F.desc("stored"))
    links = dealt.select("bucket", "part", "key", "stored", "words").mapInPandas(_linked(_reach(p, 64 * n_words, 1.0)), "a long, b long")
    own = sets.select("key", _node(F.col("first_id"), F.col("key")).alias("own"))
    of_a, of_b = (own.select(F.col("key").alias(end), F.col("own").alias(f"own_{end}")) for end in "ab")
    linked = connected_components(cut(links.distinct()).join(of_a, "a").join(of_b, "b").select("own_a", "own_b"), "own_a", "own_b")
    grouped = own.join(linked, own["own"] == linked["node"], "left").select("key", _least_id(F.coalesce("component", "own")).alias("component_id"))
    result = _stored(marked.select("doc_id", "key").join(grouped, "key", "left").select("doc_id", "component_id"))
    _deleted(marked, sets, held)
    return result
