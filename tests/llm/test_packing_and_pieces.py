import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from prosemill.llm import packing
from prosemill.llm.packing import _Bins, byte_bpe, pack_documents
from prosemill.llm.pieces import Pieces, decode_pieces, encode_pieces, load
from prosemill.llm.queries import tokenizer_file

BPE, PIECES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
TEXTS = ["", "Hello  wörld\n new 漢字 \U0001f600", "a" * 3000, " " * 500, "the end <|endoftext|> of it", "don't we'll I'm 1234 !!", "word " * 1500, "\n\n\t x"]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_the_librarys(text):
    assert byte_bpe(BPE)(text).tolist() == Tokenizer.from_file(BPE).encode(text, add_special_tokens=False).ids


def packed(lengths, capacity=1024, least=16):
    """The pieces (doc, start, length, sequence) that one task makes of documents of these lengths."""
    bins = _Bins(capacity, 0, least)
    for doc, n in enumerate(lengths):
        bins.add((doc, 0, np.arange(n, dtype="<u4"), n))
    bins.finish()
    return [(r[0], r[1], r[2], r[4]) for r in bins.rows]


def test_classes_fill_by_count():
    """Bins of class k hold k whole remainders; without cuts nothing else does."""
    pieces = packed([400, 300, 1024, 400, 300, 300, 2048 + 5], least=None)
    by_sequence = {}
    for doc, _, n, s in pieces:
        by_sequence.setdefault(s, []).append((doc, n))
    assert sorted(by_sequence.values()) == sorted([[(2, 1024)], [(0, 400), (3, 400)], [(1, 300), (4, 300), (5, 300)], [(6, 1024)], [(6, 1024)], [(6, 5)]])


def test_a_gap_is_filled_from_the_next_document():
    assert packed([400, 400, 700]) == [(0, 0, 400, 0), (1, 0, 400, 0), (2, 0, 224, 0), (2, 224, 476, 1)]
    assert packed([400, 400, 100, 50, 90]) == [(0, 0, 400, 0), (1, 0, 400, 0), (2, 0, 100, 0), (3, 0, 50, 0), (4, 0, 74, 0), (4, 74, 16, 1)]


@pytest.mark.parametrize("least", [1, 16, None])
def test_pieces_cover_documents_once(least):
    rng = random.Random(least or 0)
    for _ in range(60):
        lengths = [rng.choice([1, 5, 15, 16, 17, 40, 300, 511, 512, 513, 1023, 1024, 1025, 3000, rng.randint(1, 2500)]) for _ in range(rng.randint(1, 60))]
        pieces, at, sums = packed(lengths, least=least), {}, {}
        for doc, start, n, s in sorted(pieces):
            assert start == at.get(doc, 0) and n > 0 and (least is None or n >= min(least, lengths[doc]) or n == lengths[doc] % 1024)
            at[doc], sums[s] = start + n, sums.get(s, 0) + n
        assert at == dict(enumerate(lengths)) and max(sums.values()) <= 1024
        if least:
            assert sum(1024 - n for n in sums.values()) <= 1024 + least * len(sums)


@pytest.mark.parametrize("least", [16, None])
def test_every_id_lies_in_one_piece_and_sequences_have_no_gaps(spark, least):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(TEXTS[5].split()) for _ in range(rng.randint(0, 900)))) for i in range(60)] + [(100, None), (101, ""), (102, "long text " * 20_000), (None, "no id"), (7, "again"), (7, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("offset", F.lit(1)).repartition(3)
    pieces = pack_documents(docs, BPE, 1024, least).toPandas()
    sequences = pieces.groupby("sequence_id")
    for _, s in sequences:
        s = s.sort_values("offset")
        assert (s["offset"] == s["length"].cumsum() - s["length"]).all() and s["length"].sum() <= 1024
    encode = byte_bpe(BPE)
    for i, text in rows[:63]:
        mine = pieces[pieces["doc_id"] == i].sort_values("start")
        if i == 7:
            assert len(mine) >= 3
            continue
        joined = np.frombuffer(b"".join(mine["ids"]), "<u4").tolist()
        assert joined == [*encode(text or "").tolist(), 0]
        assert (mine["start"] == mine["length"].cumsum() - mine["length"]).all() and (mine["doc_tokens"] == len(joined)).all()
    assert pieces["length"].sum() == sum(len(encode(t or "")) + 1 for _, t in rows)


def test_open_bins_hold_no_whole_documents():
    bins = _Bins(1024, 0, None)
    for doc in range(50):
        n = 98 * 1024 + 100 + doc
        bins.add((doc, 0, np.arange(n, dtype="<u4"), n))
    bins.take()
    held = [p[2] if p[2].base is None else p[2].base for pieces in bins.open.values() for p in pieces]
    assert held and sum(x.nbytes for x in held) < 50 * 1024 * 4


def test_a_task_holds_few_texts_at_a_time(spark, monkeypatch):
    """What a task needs besides its batch does not grow with the batch."""
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(packing, "byte_bpe", lambda path: lambda text: np.full(1500, len(text), "<u4"))
    task = pack_documents(SimpleNamespace(select=lambda *columns: SimpleNamespace(mapInArrow=lambda run, schema: run)), BPE)
    batch = pa.RecordBatch.from_arrays([pa.array(range(8000), pa.int64()), pa.array(["x" * 3000] * 8000)], ["doc_id", "text"])
    tracemalloc.start()
    ids = sum(sum(out.column(2).to_pylist()) for out in task(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids == 8000 * 1501 and peak < 12 << 20


def test_the_quick_encoder_on_many_characters():
    """The faster encoder gives the library's ids on strings over all kinds of characters."""
    rng, slow = random.Random(3), Tokenizer.from_file(BPE)
    kinds = [range(32, 127), range(0, 0x300), range(0x300, 0xD800), range(0xE000, 0x11000), range(0x1F300, 0x1F700), (9, 10, 13, 32, 160, 0x2003, 0x3000)]
    for _ in range(1500):
        text = "".join(chr(rng.choice(rng.choice(kinds))) for _ in range(rng.randint(1, 30)))
        assert byte_bpe(BPE)(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(none, BPE).count() == encode_pieces(none, PIECES).count() == 0
    with pytest.raises(ValueError):
        pack_documents(none, BPE, 100, least=80)


def best_score(pieces, text):
    """Highest total score by plain search over the whole text."""
    flat = ("▁" + text).replace(" ", "▁")
    best = [0.0] + [float("-inf")] * len(flat)
    for end in range(1, len(flat) + 1):
        for start in range(max(0, end - pieces.widest), end):
            score = pieces.score_of.get(flat[start:end], pieces.missing if end - start == 1 else None)
            if score is not None:
                best[end] = max(best[end], best[start] + score)
    return best[-1]


@pytest.mark.parametrize("text", [t for t in TEXTS if t] + ["quick brown foxes", "ing ", "x" * 70 + "ing the", "ab漢字ing" * 900])
def test_segmentation_is_the_best_one(text):
    pieces = load(PIECES)
    ids = np.frombuffer(pieces.encode([text])[0], "<u4").tolist()
    score, held = 0.0, 0
    for i in ids:
        if i in pieces.byte_of:
            held += pieces.byte_of[i] & 0xC0 != 0x80
        else:
            score += pieces.score_of[pieces.text[i]]
    assert score + held * pieces.missing == pytest.approx(best_score(pieces, text))


def test_long_units_are_found_alike_alone_and_together():
    """A unit's ids do not depend on what it is searched with, nor on the spans of end positions."""
    rng = random.Random(4)
    units = ["".join(rng.choice("aeinrst漢字") for _ in range(rng.choice([3, 65, 66, 80, 150, 4096, 4100, 5000]))) for _ in range(40)]
    together = load(PIECES).encode(units)
    for unit, ids in zip(units, together, strict=True):
        pieces = load(PIECES)
        pieces.known.clear()
        assert pieces.encode([unit]) == [ids]


def test_units_that_come_again_are_searched_once(monkeypatch):
    """Units in use outlive the memory of others, which stays bounded, and ids are those of a search anew."""
    monkeypatch.setattr("prosemill.llm.pieces._KEPT", 100)
    searched, rng, pieces = [], random.Random(5), Pieces(PIECES)
    batch = pieces._batch
    monkeypatch.setattr(pieces, "_batch", lambda units: (searched.extend(units), batch(units)))
    for k in range(20):
        text = "the " + " ".join(f"{rng.choice(['word', 'ing', '漢'])}{k}x{i}" for i in range(40))
        got = pieces.encode([text, "the end"])
        alone = load(PIECES)
        alone.known.clear()
        assert got == [alone.encode([text])[0], alone.encode(["the end"])[0]] and len(pieces.known) <= 100
    assert searched.count("▁the") == searched.count("▁end") == 1


def test_no_segmentation_of_the_library_scores_higher():
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = proto.ModelProto()
    model.ParseFromString(open(PIECES, "rb").read())
    model.trainer_spec.model_type = 1
    other, pieces = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString()), load(PIECES)
    for text in ("Hello there world", "in the morning light", "antidisestablishmentarianism"):
        mine = np.frombuffer(pieces.encode([text])[0], "<u4").tolist()
        assert sum(map(other.get_score, mine)) >= sum(map(other.get_score, other.encode(text)))


def test_round_trip_by_tables(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (None, "x"), (3, "x"), (60, "b" * 100_000), (61, "mark ▁ here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    back = decode_pieces(encode_pieces(docs, PIECES), PIECES).toPandas()
    assert len(back) == len(rows)
    texts = back.dropna(subset=["doc_id"])
    for i, t in rows:
        if i not in (None, 3, 61):
            assert texts[texts["doc_id"] == i]["text"].tolist() == [t or ""]
    assert texts[texts["doc_id"] == 61]["text"].tolist() == ["mark   here"]
