import random

import pytest

import corpus_pipeline
from prosemill.llm import simhash
from prosemill.llm.simhash import differing, shingle_set, similar_groups, wide_segments


def brute_groups(rows, least=0.8):
    sets = []
    for _, text in rows:
        words = (text or "").lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] == sets[j] or common >= least * (len(sets[i]) + len(sets[j]) - common):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc)
    return {doc: min(g) for g in groups.values() for doc in g}


def edited(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"new{rng.getrandbits(40)}"
    return words


def family(seed):
    """Copies of few texts with growing edits, a hot family and chains: pairs lie on both sides of 0.8."""
    rng, texts = random.Random(seed), []
    for n in (12, 40, 150, 600):
        for _ in range(5):
            base = [f"w{rng.randrange(5000)}" for _ in range(n)]
            texts += [base] + [edited(rng, base, rng.randint(1, max(1, n // 25))) for _ in range(6)]
    hot = [f"h{i}" for i in range(200)]
    texts += [edited(rng, hot, rng.randint(1, 5)) for _ in range(60)]
    chain = [f"c{i}" for i in range(120)]
    for _ in range(20):
        texts.append(chain)
        chain = edited(rng, chain, 2)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(9000, None), (9001, " "), (9002, "One"), (9003, "one")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [4096, 7])
def test_groups_lie_between_those_of_a_higher_and_a_lower_similarity(spark, block):
    """Every pair clearly above the limit is together, and no document clearly below it to all others."""
    rows = family(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in similar_groups(docs, missed=1e-6, block=block, width=12).collect()}
    high, low = brute_groups(rows, 0.86), brute_groups(rows, 0.72)
    assert all(got[doc] == got[least] for doc, least in high.items())
    assert all(low[doc] == low[least] for doc, least in got.items())
    exact = brute_groups(rows)
    assert sum(got[d] == exact[d] for d in got) > 0.9 * len(got)


def test_the_stage_keeps_one_of_each_group(spark):
    rows = family(4)
    out = sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect())
    assert set(brute_groups(rows, 0.72).values()) <= set(out) <= set(brute_groups(rows, 0.86).values())


def test_rows_without_id_and_empty_tables(spark):
    rows = [(7, "a b c d e f"), (None, "A b c d e f"), (2, "a b c d e f"), (None, "quite another text"), (7, "a b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["component_id"]) for r in similar_groups(docs).collect()]
    assert sorted(got, key=str) == sorted([(7, 2), (None, 2), (2, 2), (None, None), (7, 2)], key=str)
    assert similar_groups(docs.limit(0)).count() == 0
    assert len(shingle_set("a b c", 5)) == 1 and not len(shingle_set(None, 5))


def test_segments_find_pairs_at_the_similarity():
    """The share of pairs at 0.8 that no segment finds, of simulated fingerprints, is the one asked for."""
    rng = __import__("numpy").random.default_rng(5)
    for bits in (12, 18, 24):
        segments = wide_segments(0.8, 0.01, bits)
        found = sum((rng.random((4000, width)) < differing(0.8)).sum(1) <= 1 for _, _, width in segments)
        assert 0.003 < (found == 0).mean() < 0.02
        assert all(low + width <= 64 for _, low, width in segments)


def test_an_id_of_two_texts_joins_nothing(spark):
    rows = [(7, "one two three four five six"), (7, "quite other words stand here now"), (9, "quite other words stand here now")]
    got = [tuple(r) for r in similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == [(7, 7), (7, 7), (9, 7)]


def test_rows_of_a_hot_bucket_meet_once(spark):
    """Every pair of a bucket meets where one of it is stored, unless neither is; stored rows are not sent to all parts."""
    rows = [(5, i, i % 4 > 0) for i in range(60)] + [(6, 100 + i, True) for i in range(5)]
    table = spark.createDataFrame(rows, "bucket long, key long, stored boolean")
    load = table.filter("stored").groupBy("bucket").count()
    dealt = [tuple(r) for r in simhash._in_parts(table, load, "key", 10).collect()]
    stored = {(b, key): part for b, part, key, own in dealt if own}
    assert sorted(stored) == sorted((b, key) for b, key, own in rows if own)
    seen = {(b, part, key) for b, part, key, _ in dealt}
    assert all((5, stored[5, i], j) in seen or (5, j) in stored and (5, stored[5, j], i) in seen for i in range(60) if i % 4 for j in range(60))
    assert len(dealt) == len(seen) < 0.8 * (60 * 5 + 5)


def test_rows_of_a_large_group_are_bounded_by_its_segments(spark, monkeypatch):
    """However many texts are like it, a text has one row a segment at most where complete distances are compared."""
    rng, base, counts, in_parts = random.Random(6), [f"g{i}" for i in range(300)], [], simhash._in_parts

    def counted(rows, load, name, block):
        counts.append(rows.count())
        return in_parts(rows, load, name, block)

    monkeypatch.setattr(simhash, "_in_parts", counted)
    rows = [(i, " ".join(edited(rng, base, rng.randint(1, 3)))) for i in range(600)]
    groups = similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["component_id"] for r in groups.collect()} == {0}
    assert 600 < counts[-1] <= 600 * 87
