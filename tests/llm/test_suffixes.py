import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from prosemill.llm import suffixes
from prosemill.llm.suffixes import remove_repeats


def brute(rows, length=50):
    """(id, n_bytes, n_removed, n_spans, kept) by a table of all strings."""
    first = {}
    last = 1 << 64
    keyed = [(last if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in keyed:
        for p in range(len(t) - length + 1):
            s = t[p : p + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for (i, _), (key, t) in zip(rows, keyed, strict=True):
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < key:
                gone[p : p + length] = b"\1" * length
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, bytes(c for c, g in zip(t, gone, strict=True) if not g)))
    return sorted(out, key=str)


def got(docs, length=50):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in remove_repeats(docs, length).collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("length", [17, 20, 50, 51, 200])
def test_like_brute_force(spark, length):
    rng = random.Random(length)
    blocks = ["".join(rng.choice("ab é") for _ in range(rng.randint(5, 130))) for _ in range(25)]
    rows = [(i, "".join(rng.choice(blocks) for _ in range(rng.randint(0, 12)))) for i in range(150)]
    rows += [(200, "a" * 3000), (201, "b" * 70 + "a" * 500), (202, "é" * 100), (203, "x" * (length - 1)), (204, "x" * length), (205, "x" * (length + 1))]
    rng.shuffle(rows)
    assert got(table(spark, rows), length) == brute(rows, length)


def test_plain_doubling_finds_the_same(spark):
    rng = random.Random(6)
    blocks = ["".join(rng.choice("abcé ") for _ in range(rng.randint(5, 60))) for _ in range(8)]
    rows = [(i, "".join(rng.choice(blocks) for _ in range(rng.randint(0, 4)))) for i in range(12)] + [(20, None)]
    found = {}
    for r in suffixes.doubled_repeats(table(spark, rows), 50).collect():
        found.setdefault(r["key"], set()).update(range(r["pos"], r["pos"] + 50))
    assert {i: len(found.get(i, ())) for i, _ in rows} == {r[0]: r[2] for r in brute(rows)}


def test_anchors_of_very_many_contexts_are_split(spark, monkeypatch):
    """One anchor in thousands of contexts, and a passage in a third of the documents: results stay whole, and no bucket gathers the anchor."""
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    passage = word(70)
    rows = [(i, word(30) + "the very same anchor string" + word(30)) for i in range(3000)] + [(4000 + i, word(20) + passage + word(20)) for i in range(1000)]
    rows += [(9000 + i, rows[i][1][3:] + "x") for i in range(0, 300, 3)]
    rng.shuffle(rows)
    monkeypatch.setattr(suffixes, "_SAMPLED", 1)
    monkeypatch.setattr(suffixes, "_HOT", 50)
    hot = suffixes._hot_anchors(table(spark, rows).select(F.col("text").cast("binary")), 50)
    assert 3 <= len(hot) < 200
    assert got(table(spark, rows)) == brute(rows)
    sender = suffixes._Sender(40, hot)
    for runs in suffixes.anchors([t.encode() for _, t in rows], 50):
        sender.add(runs)
    sender.document(np.array([[i, i * 7919] for i, _ in rows]))
    sizes = {}
    for bucket, blob in sender.flush():
        _, runs, known = suffixes._unpack(blob)
        if known is None:
            sizes[bucket] = sizes.get(bucket, 0) + len(runs.v)
    assert max(sizes.values()) < 2 * sum(sizes.values()) / 40


def test_a_text_of_several_segments(spark):
    rng = random.Random(11)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(400_000))
    rows = [(1, "start " + shared), (2, shared[1000:390_000] + " end"), (3, "q" * 100 + shared[300_000:])]
    out = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in remove_repeats(table(spark, rows), 50).collect()}
    assert out == {1: (0, 0), 2: (389_000, 1), 3: (100_000, 1)}


def test_nulls_empties_and_repeated_ids(spark):
    passage = "a passage of more than fifty bytes that stands in several documents"
    rows = [(3, None), (4, ""), (None, passage), (7, passage + " seven"), (7, "other " + passage), (7, passage + " seven"), (9, passage), (None, passage + "!")]
    assert got(table(spark, rows)) == brute(rows)


def test_the_files_of_round_1_are_gone_before_round_2(spark):
    """The rows of round 1 are large; what the second round and the result need is in checkpoints."""
    rng = random.Random(12)
    rows = [(i, "".join(rng.choices("abcdefgh ", k=3000))) for i in range(600)] + [(1000 + i, rng.choice("xyz") * 60) for i in range(20)]
    docs, local = spark.createDataFrame(rows, "doc_id long, text string"), spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {str(f) for top in [str(d) for d in local.localDirs()] for f in Path(top).glob("*/shuffle_*.data")}

    before = files()
    out = remove_repeats(docs, 50)
    assert sum(Path(f).stat().st_size for f in files() - before) < 200_000
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out.collect()), key=str) == brute(rows)


def test_segments_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "_SEGMENT", 300)
    monkeypatch.setattr(suffixes, "_FLUSH", 200)
    rng = random.Random(8)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(1500))
    raw = [("x" * 77 + shared).encode(), (shared[200:1300] + "tail").encode()]
    runs = [r for r in suffixes.anchors(raw, 50)]
    covered = {(int(d), int(p) + k) for r in runs for d, p, c in zip(r.doc, r.start, r.count, strict=True) for k in range(c)}
    assert covered == {(d, p) for d, t in enumerate(raw) for p in range(len(t) - 49)}


def test_characters_stay_whole_and_columns_are_carried(spark):
    shared = "é" * 40
    rows = spark.createDataFrame([(1, "a" + shared + "b", "x"), (2, "ü" + shared + "c", "y")], "doc_id long, text string, `packed` string").withColumn("key", F.lit(5)).withColumn("row", F.lit("z"))
    out = remove_repeats(rows, 50, characters=True, carry=rows.columns).filter("doc_id = 2").first()
    assert bytes(out["kept"]).decode() == "üc"
    assert out["row"].asDict() == {"doc_id": 2, "text": "ü" + shared + "c", "packed": "y", "key": 5, "row": "z"}
    whole = suffixes.whole_characters("aéb".encode(), __import__("numpy").array([True, True, False, True]))
    assert whole.tolist() == [True, False, False, True]


def test_empty_table(spark):
    assert remove_repeats(table(spark, [(1, "x")]).limit(0)).count() == 0
