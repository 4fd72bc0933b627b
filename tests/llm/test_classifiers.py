import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from prosemill.llm.quality import STATS, fit_rules, score_quality, train_rules, with_statistics
from prosemill.llm.runtime import in_fold
from prosemill.llm.toxicity import _pairs, fit_ngrams, score_toxicity, train_ngrams

WORDS = "river stone lamp harbor winter table garden letter window bread".split()


def sentences(rng, bad, n=30):
    words = [rng.choice(WORDS) for _ in range(n)]
    if bad:
        words.insert(rng.randrange(n), rng.choice(["scumbag", "moronic"]))
    return " ".join(words)


def corpus(n, seed):
    rng = random.Random(seed)
    return [(i, sentences(rng, i % 3 == 0), int(i % 3 == 0)) for i in range(n)]


def test_a_text_is_scored_alike_wherever_it_stands(monkeypatch):
    from prosemill.llm import toxicity

    texts = ["ab " * 50, "", None, "xyz" * 400, "q"]
    whole = np.concatenate([*_pairs(texts, (3, 4), 16)])
    monkeypatch.setattr(toxicity, "_CHUNK", 64)
    cut = np.concatenate([*_pairs(texts, (3, 4), 16)])
    assert sorted(whole.tolist()) == sorted(cut.tolist()) and len(set(cut.tolist())) == len(cut)


def test_toxicity_learns_and_leaves_held_out_rows_alone(spark):
    rows = corpus(300, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    held = in_fold(F.col("doc_id"), 5, 0)
    out = score_toxicity(docs, labels, usable=~held).withColumn("held", held).toPandas().set_index("doc_id")
    right = [(out.loc[i, "score"] >= 0.5) == bool(y) for i, _, y in rows if out.loc[i, "held"]]
    assert len(right) > 30 and np.mean(right) > 0.95
    changed = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = score_toxicity(docs, changed, usable=~held).toPandas().set_index("doc_id")
    assert np.allclose(out["score"], again["score"])


def test_odd_rows_are_scored(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (3, None), (4, 7)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(1, "bad"), (2, None), (2, ""), (None, "good"), (9, "bad " * 300_000)], "doc_id long, text string")
    out = score_toxicity(docs, labels).toPandas()
    assert len(out) == 5 and out["score"].between(0, 1).all()
    assert out[out["doc_id"] == 2]["score"].nunique() == 1
    assert score_toxicity(docs.limit(0), labels).count() == 0
    assert score_toxicity(docs, labels.limit(0)).select("score").distinct().first()["score"] == pytest.approx(0.5)


def test_the_fit_takes_little_memory_of_the_driver():
    rng = np.random.default_rng(3)
    texts = ["".join(map(chr, rng.integers(97, 105, 2_000))) for _ in range(600)]
    tracemalloc.start()
    train_ngrams(texts, [i % 2 for i in range(600)], 0.5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 90e6


def test_one_class_gives_the_rate():
    assert train_ngrams(["a", "b"], [0, 0], 0.25).bias == pytest.approx(np.log(1 / 3))
    assert train_rules(np.zeros((2, len(STATS))), [1, 1], 0.75).bias == pytest.approx(np.log(3))


def test_statistics(spark):
    texts = [None, "", "Ab, cd\nAb, cd\n#1 é"]
    rows = [with_statistics(spark.createDataFrame([(t,)], "text string")).select("q.*").first().asDict() for t in texts]
    assert rows[0] == rows[1] and rows[1]["chars"] == 0
    assert (rows[2]["chars"], rows[2]["lines"], rows[2]["words"]) == (18, 3, 6)
    assert rows[2]["upper"] == pytest.approx(2 / 18) and rows[2]["symbols"] == pytest.approx(1 / 18) and rows[2]["wide"] == pytest.approx(1 / 18)
    assert rows[2]["distinct_lines"] == pytest.approx(2 / 3) and rows[2]["distinct_words"] == pytest.approx(4 / 6)


def test_quality_rules_are_sparse_and_right(spark):
    rng = random.Random(3)
    rows = [(i, " | ".join(WORDS) * rng.randint(1, 5) if i % 4 == 0 else sentences(rng, False, rng.randint(20, 90)), int(i % 4 != 0)) for i in range(300)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, q string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    held = in_fold(F.col("doc_id"), 3, 1)
    model = fit_rules(docs, labels, usable=~held)
    assert 0 < len(model.rules) <= 60 and all(1 <= len(r) <= 3 for r in model.rules)
    out = score_quality(docs, labels, usable=~held)
    assert out.columns == ["doc_id", "text", "q", "score"]
    out = out.withColumn("held", held).toPandas().set_index("doc_id")
    assert np.mean([(out.loc[i, "score"] >= 0.5) == bool(y) for i, _, y in rows if out.loc[i, "held"]]) > 0.97
    assert "Python" not in score_quality(docs, labels)._jdf.queryExecution().executedPlan().toString()


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "a"), (5, "w " * 400_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (5, 0)], "doc_id long, quality int")
    assert score_quality(docs, labels).filter("score between 0 and 1").count() == 4
    assert score_quality(docs.limit(0), labels).count() == 0
    assert score_quality(docs, labels.limit(0)).filter("score = 0.5").count() == 4


def test_fit_is_a_function_of_the_rows(spark):
    rows = corpus(60, 5)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    a, b = fit_ngrams(docs, labels), fit_ngrams(docs.repartition(7), labels.repartition(5))
    assert (a.features == b.features).all() and np.allclose(a.weights, b.weights)
