import json
import random

import pytest
from pyspark.sql import functions as F

from prosemill.functions import labels as L
from prosemill.operators import acceptance, census, rank, sampling
from prosemill.sources import records
from prosemill.streaming import ingest


@pytest.mark.parametrize("pairs", [[(1, 3), (0, 1), (0, 2)], [(1, 1), (0, 1), (1, 1)], [(1, 1), (0, 2), (1, 2), (0, 2), (1, 5), (0, 0)], [(1, 1)]])
def test_auc_is_the_pairwise_one(spark, pairs):
    value = rank.auc(spark.createDataFrame(pairs, "y int, s long"), "y", "s").first()["auc"]
    ones, zeros = ([s for y, s in pairs if y == c] for c in (1, 0))
    expected = sum((x > y) + (x == y) / 2 for x in ones for y in zeros) / (len(ones) * len(zeros)) if zeros else None
    assert value == expected


def test_spearman_and_positions(spark):
    rows = [(i, (i * 7) % 50) for i in range(50)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "a long, b long").repartition(5)
    assert rank.spearman(df.withColumn("c", F.col("a") * F.col("a")), "a", "c").first()["rho"] == pytest.approx(1)
    placed = sampling.with_position(df.withColumn("a", F.col("a") * 3), "a")
    assert all(r["position"] * 3 == r["a"] for r in placed.collect())
    assert [r["i"] for r in sampling.even_sample(df, "a", 5).orderBy("i").collect()] == [0, 1, 2, 3, 4]
    assert [r["a"] for r in sampling.even_sample(df, "a", 5).orderBy("i").collect()] == [0, 12, 24, 37, 49]


def test_slices_are_disjoint_and_folds_cover(spark):
    df = spark.range(100).toDF("k").withColumn("y", F.col("k") % 2)
    a, b = ({r["k"] for r in sampling.shuffled_slice(df, "k", 7, *r).collect()} for r in ((0, 40), (40, 100)))
    assert len(a) == 40 and a | b == set(range(100)) and not a & b
    assert sampling.folds(df, "k", "y").select("fold").distinct().count() == 5
    assert sampling.sample_within(df, "y", "k", 3, 7).count() == 6


def test_judge_and_pairs(spark):
    tokens = spark.createDataFrame([("s", " G", 0.0), ("s", "S", 0.0), ("t", "x", 0.0)], "sentence string, token string, logprob double")
    assert {r["sentence"]: r["p"] for r in rank.judge_probability(tokens).collect()} == {"s": 0.5, "t": None}
    scores = spark.createDataFrame([("a", 0.1), ("b", 0.4), ("c", 0.3)], "k string, s double")
    pairs = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "zz")], "kf string, kg string")
    assert tuple(rank.paired_wins(pairs, scores).first())[:2] == (2, 0.5)
    low, high = rank.bootstrap_interval(spark.range(200).select("id", (F.col("id") % 2).cast("double").alias("s")), "s", "id", 400).first()
    assert 0.4 < low < 0.5 < high < 0.6


def test_census_small_cases(spark):
    docs = spark.createDataFrame([(1, "x", "a b c d e f g h i"), (2, "x", "a b c d e f g h i j"), (3, "y", "")], "doc_id long, lang string, text string")
    assert tuple(census.repeated_ngrams(docs, 8).first()) == (5, 3, 40.0)
    assert {r["lang"]: (r["tokens"], r["vocabulary"]) for r in census.vocabulary(docs, "lang").collect()} == {"x": (19, 10)}
    assert {r["lang"]: r["distinct2"] for r in census.diversity(docs, "lang").collect()} == {"x": 1.0, "y": 1.0}
    phrases = spark.createDataFrame([(1, "x", 'It was palpable. "So palpable," she said. Palpable!')], docs.schema)
    assert census.phrase_census(phrases, "lang").first()["docs_with_zero"] == 0
    assert spark.createDataFrame([('palpable "palpable" Palpable',)], "t string").select(census.phrase_count(F.col("t"), "cliche").alias("n")).first()["n"] == 3


def test_compressed_bits_in_order(spark):
    import zlib

    docs = spark.createDataFrame([(i, "x" if i % 2 else "y", f"text number {i} " * 5) for i in range(20)], "doc_id long, lang string, text string").repartition(4)
    got = {r["lang"]: r["bits_per_char"] for r in census.compressed_bits(docs, "lang", "doc_id").collect()}
    blob = " ".join(f"text number {i} " * 5 for i in range(1, 20, 2))
    assert got["x"] == pytest.approx(len(zlib.compress(blob.encode(), 9)) * 8 / len(blob), abs=0.02)


def test_reply_parsing(spark):
    def parse(text):
        row = spark.createDataFrame([(text,)], "t string").select(L.parse_reply(F.col("t")).alias("r")).first()["r"]
        return row["world"], row["energy"], row["tags"], row["ok"]

    assert parse("WORLD: Contemporary\nENERGY: Relational\nTAGS: Romance, Horror; romance") == ("Contemporary", "Relational", ["Romance", "Horror"], True)
    assert parse('world - **"Sci-Fi".**\nENERGY: a love of danger\nTAGS: none') == ("Science Fiction", "External", [], True)
    assert parse("<think>WORLD: Contemporary</think>ENERGY: x") == ("?", "?", [], False)
    assert parse("WORLD: N/A\nENERGY: inner") == ("none", "Relational", [], False)
    assert parse("") == ("?", "?", [], False)


def test_acceptance(spark):
    def accept(a, b):
        return spark.createDataFrame([(a, b)], "a string, b string").select(acceptance.accepted_rewrite(F.col("a"), F.col("b")).alias("x")).first()["x"]

    src = "The red fox ran over the hill. It slept there."
    assert accept(src, "The small animal ran over the place. It slept there.")
    assert not accept(src, src)
    assert not accept(src, "The fox ran 3 miles over the hill. It slept there.")
    assert not accept(src, None)
    refusal = lambda t, k: spark.createDataFrame([(t, k)], "t string, k string").select(acceptance.refusal(F.col("t"), F.col("k")).alias("x")).first()["x"]
    assert refusal("short", "babble") == "short"
    assert refusal(" ".join(f"w{i}" for i in range(50)), "babble") is None
    assert refusal(" ".join(f"w{i}" for i in range(50)), "cliche") == "lowtics"


def test_json_lines_skip_blank_and_torn(spark, tmp_path):
    path = tmp_path / "bench_tag.jsonl"
    path.write_text(json.dumps({"idx": 0, "n": "a", "p": "b"}) + "\n\n" + json.dumps({"idx": 1, "n": "é", "p": "b"}) + '\n{"idx": 2, "n": "c', encoding="utf-8")
    rows = records.read_lines(spark, str(path), records.LEAVES).orderBy("idx")
    assert [(r["idx"], r["n"]) for r in rows.collect()] == [(0, "a"), (1, "é")]
    assert rows.select(records.source_tag(F.col("source")).alias("t")).first()["t"] == "tag"
    assert len(records.file_fingerprints(spark, str(path)).first()["sha8"]) == 8
    with pytest.raises(ValueError):
        records.replace_lines(rows, str(path), str(path) + "/")
    out = str(tmp_path / "out")
    records.append_lines(rows.select("idx", F.lit(None).cast("string").alias("gone")), out)
    assert all("gone" not in r["value"] for r in spark.read.text(out).collect())


def test_taxonomy(spark):
    rows = spark.createDataFrame([(0, " drama ", ["noir", "x", "crime"]), (1, "crime", ["noir", "heist"])], "pos int, genre string, subgenres array<string>")
    assert [(r["n"], r["p"]) for r in records.taxonomy_leaves(rows).collect()] == [("crime", "drama"), ("drama", "drama"), ("heist", "crime"), ("noir", "drama")]
    assert [r["name"] for r in records.taxonomy_names(rows).collect()] == ["crime", "drama", "heist", "noir"]
    assert [r["idx"] for r in records.leaf_index(records.taxonomy_leaves(rows)).orderBy("n").collect()] == [0, 1, 2, 3]


def test_stream_goes_on_where_it_ended(spark, tmp_path):
    source, target, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string").write.json(source)
    rows = lambda: ingest.first_of_key(ingest.stream_lines(spark, source, spark.read.json(source).schema))
    ingest.append_stream(rows(), target, state).awaitTermination()
    spark.createDataFrame([(3, "a  b"), (4, "d")], "doc_id long, text string").write.mode("append").json(source)
    ingest.append_stream(rows(), target, state).awaitTermination()
    assert sorted(r["text"] for r in spark.read.parquet(target).collect()) == ["a b", "c", "d"]


def test_contrast_sets_and_paragraph_scores(spark):
    rows = spark.createDataFrame([("a", 5), ("b", 7), ("a", 25), ("c", 5)], "source string, n int")
    assert rank.contrast(rows, "source", "a", "b").count() == 3
    assert {(r["source"], r["y"]) for r in rank.contrast(rows, "source", "a", "b", "n").collect()} == {("a", 1), ("b", 0)}
    long = "One two three four five six seven eight nine."
    texts = spark.createDataFrame([("p", f"{long} Short one."), ("q", "Short one."), ("r", "unknown")], "k string, text string")
    known = spark.createDataFrame([(long, 0.5), ("Short one.", 1.0)], "sentence string, p double")
    assert {r["k"]: r["score"] for r in rank.paragraph_scores(texts, known).collect()} == {"p": 0.5, "q": 1.0, "r": None}


def test_folds_are_stratified(spark):
    rows = spark.createDataFrame([(i, "a" if i % 9 == 0 else "b" if i % 2 else None) for i in range(103)], "k long, y string").repartition(4)
    counts = {}
    for r in sampling.folds(rows, "k", "y", 5).collect():
        counts.setdefault(r["y"], [0] * 5)[r["fold"]] += 1
    assert all(max(c) - min(c) <= 1 for c in counts.values()) and sum(map(sum, counts.values())) == 103
    few = sampling.folds(spark.createDataFrame([(i, 1) for i in range(10)], "k long, y int"), "k", "y", 5)
    assert sorted(r["fold"] for r in few.collect()) == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]


def test_bootstrap_weights_have_mean_and_variance_one(spark):
    """The interval of a mean is close to that of the normal law, and does not depend on how rows are dealt."""
    rng = random.Random(3)
    values = [(i, rng.random()) for i in range(4000)] + [(9999, None)]
    rows = spark.createDataFrame(values, "id long, s double")
    low, high = rank.bootstrap_interval(rows.repartition(3), "s", "id", 1000).first()
    known = [v for _, v in values if v is not None]
    mean = sum(known) / len(known)
    error = (sum((v - mean) ** 2 for v in known) / len(known)) ** 0.5 / len(known) ** 0.5
    assert low == pytest.approx(mean - 1.96 * error, abs=0.15 * error) and high == pytest.approx(mean + 1.96 * error, abs=0.15 * error)
    again = rank.bootstrap_interval(rows.repartition(7), "s", "id", 1000).first()
    assert tuple(again) == pytest.approx((low, high))


@pytest.mark.parametrize("n", [1, 2, 5, 8])
def test_upper_medians(spark, n):
    values = [(i * 7) % 5 for i in range(n)]
    from prosemill.functions import text as T

    got = spark.createDataFrame([(v,) for v in values], "v long").agg(T.upper_median("v").cast("long").alias("m")).first()["m"]
    assert got == sorted(values)[n // 2]
    scores = spark.createDataFrame([(f"f{i}", 0.0) for i in range(n)] + [(f"g{i}", v / 10) for i, v in enumerate(values)], "k string, s double")
    pairs = spark.createDataFrame([(f"f{i}", f"g{i}") for i in range(n)], "kf string, kg string")
    out = rank.paired_wins(pairs, scores).first()
    assert out["n"] == n and out["median_margin"] == pytest.approx(sorted(values)[n // 2] / 10) and out["decision"] == ("GO" if sum(v > 0 for v in values) / n > 0.85 else "STOP")


def test_no_pairs_have_no_median(spark):
    none = rank.paired_wins(spark.createDataFrame([], "kf string, kg string"), spark.createDataFrame([("a", 1.0)], "k string, s double")).first()
    assert none["n"] == 0 and none["median_margin"] is None


def test_arrays_pools_and_writes(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "a.json").write_text('[{"n": "x"}, {"n": "y"}]')
    element = T.StructType([T.StructField("n", T.StringType())])
    assert [(r["pos"], r["value"]["n"]) for r in records.read_array(spark, str(tmp_path / "a.json"), element).orderBy("pos").collect()] == [(0, "x"), (1, "y")]
    labels = spark.createDataFrame([("a", 0.5, "s"), ("b", 0.1, "s")], "k string, s double, src string")
    texts, bench = spark.createDataFrame([("a", "text")], "k string, text string"), spark.createDataFrame([("a", True, None)], "k string, ok boolean, fail string")
    pool, missing = acceptance.pool(labels, texts, bench)
    assert [tuple(r) for r in pool.collect()] == [("a", "text", "s", 0.5, True, None)] and [r["k"] for r in missing.collect()] == ["b"]
    rows = spark.createDataFrame([("z", 1, "a"), ("y", None, "b")], "extra string, n_tok int, k string")
    assert records.canonical(rows).columns == ["k", "n_tok", "extra"]
    records.split_write(rows, F.col("n_tok") > 0, str(tmp_path / "kept"), str(tmp_path / "gone"))
    assert spark.read.json(str(tmp_path / "kept")).count() == spark.read.json(str(tmp_path / "gone")).count() == 1
    shown = spark.createDataFrame([(None, ["a", "b"]), ("t", None)], "t string, p array<string>").select(records.document_text(F.col("t"), F.col("p")).alias("x"))
    assert [r["x"] for r in shown.collect()] == ["a\n\nb", "t"]


def test_subwords_by_a_real_tokenizer(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from prosemill.operators.labels import subword_counts, tokenizer_counter

    path = public.path("byte_bpe_50k.json")
    texts = ["The quick brown fox.", "", "é漢字 " * 50]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "k string, text string")
    got = {r["k"]: r["n"] for r in subword_counts(rows, tokenizer_counter(path)).collect()}
    assert got == {str(i): len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_phrases_are_found_by_their_landmarks(spark):
    assert [census.landmark(p) for p in (r"\bshivers? ran down\b", r"\bprickl(e|ed|ing)\b", r"\btime (stood|ran) still\b")] == [" ran down", "prickl", " still"]
    rows = spark.createDataFrame([("Something stirred.",), ("\u017fomething \u017ftirred, SHIVERS RAN DOWN",), ("The a\u0131r hummed",), ("prick l",)], "t string")
    counts = rows.select((census.phrase_count(F.col("t"), "uncanny") + census.phrase_count(F.col("t"), "cliche")).alias("n")).collect()
    assert [r["n"] for r in counts] == [1, 2, 1, 0]


@pytest.mark.parametrize("most", [1, 50, 1_000_000])
def test_repeated_ngrams_are_exchanged_in_parts(spark, most):
    dice = random.Random(3)
    texts = [" ".join(dice.choice("abc") for _ in range(dice.randrange(60))) for _ in range(80)] + ["", None, "a b c"]
    found = census.repeated_ngrams(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5), 4, most=most)
    own = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in ((t or "").split() for t in texts)]
    total, distinct = sum(map(len, own)), len(set().union(*own))
    assert tuple(found.first())[:2] == (total, distinct)
    assert "FlatMapGroupsInArrow" in found._jdf.queryExecution().optimizedPlan().toString()
    assert tuple(census.repeated_ngrams(spark.createDataFrame([("a b",)], "text string"), 4).first()) == (0, 0, None)


def test_folds_are_fitted_side_by_side(spark, monkeypatch):
    import threading

    from pyspark.ml.classification import LogisticRegression

    both, fit = threading.Barrier(2, timeout=60), LogisticRegression.fit

    def together(self, *args):
        both.wait()
        return fit(self, *args)

    monkeypatch.setattr(LogisticRegression, "fit", together)
    rows = spark.createDataFrame([(i, [float(i % 2), 1.0, float(i % 5)], i % 2) for i in range(40)], "i long, v array<float>, y int")
    assert {r["fold"]: r["auc"] for r in rank.probe(rows, "i", "v", "y", k=2).collect()} == {0: 1.0, 1: 1.0}
