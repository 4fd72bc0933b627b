
import numpy as np
import pytest
from pyspark.sql import functions as F

from prosemill.llm.fingerprints import BINS, compare_neighbours, fingerprint, likeness, sketch, with_next
from prosemill.llm.vectors import compare, link_vectors, unit_vectors


def brute_links(ids, vectors, threshold):
    unit = np.array(vectors, np.float64)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    label = np.array(ids)
    while True:
        low = np.array([min([label[i], *label[near[i]]]) for i in range(len(ids))])
        if (low == label).all():
            return near.sum(1), label
        label = low


@pytest.mark.parametrize("block,fanout,kind", [(4096, 16, "float"), (20, 2, "float"), (20, 3, "double")])
def test_like_brute_force(spark, block, fanout, kind):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    vectors = np.concatenate([centres[rng.integers(0, 12, 200)] + rng.normal(size=(200, 8)) * 0.25, np.repeat(rng.normal(size=(1, 8)), 30, 0), rng.normal(size=(40, 8))]).astype(np.float32)
    ids = rng.permutation(len(vectors)).tolist()
    rows = spark.createDataFrame([(i, v.tolist(), "x") for i, v in zip(ids, vectors, strict=True)], f"vec_id long, embedding array<{kind}>, cell string").repartition(5)
    got = link_vectors(rows, 0.9, block=block, fanout=fanout, sample=50).toPandas().set_index("vec_id").loc[ids]
    links, component = brute_links(ids, vectors, 0.9)
    assert (got["n_links"].to_numpy() == links).all()
    assert (got["component_id"].to_numpy() == component).all()
    assert (got["kept"].to_numpy() == (np.array(ids) == component)).all()


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [1.0, 0.0, 0.0]), (7, [None, 1.0]), (8, [0.95, 0.31]), (9, []), (10, [inf, 0.0]), (None, [1.0, 0.0]), (2, [1.0, 0.0])]
    got = sorted((tuple(r) for r in link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()), key=str)
    linked = {1: (3, 1, True), 2: (3, 1, False), 8: (3, 1, False)}
    assert got == sorted([(i, *linked.get(i, (0, i, True))) for i, _ in rows], key=str)
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert link_vectors(none).count() == 0
    with pytest.raises(ValueError):
        link_vectors(none, 0.0)


def test_lengths_are_joined_apart_and_magnitudes_do_not_matter(spark):
    rng = np.random.default_rng(2)
    rows, ids = [], iter(range(1000))
    for size, n in ((5, 60), (3, 20), (2, 5), (1, 3)):
        base = rng.normal(size=(6, size))
        for k in range(n):
            v = (base[k % 6] + rng.normal(size=size) * 0.1) * 10.0 ** rng.choice([-300, -200, -1, 0, 3, 200, 300])
            rows.append((next(ids), v.tolist()))
    rows += [(next(ids), [1e-200, 0.0]), (next(ids), [2e-200, 0.0]), (next(ids), [1e200, 1e180]), (next(ids), [5e-324, 0.0])]
    got = link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), 0.9, block=7, fanout=2, sample=30).toPandas().set_index("vec_id")
    for size in (1, 2, 3, 5):
        part = [(i, np.array(v)) for i, v in rows if len(v) == size]
        unit = unit_vectors(np.stack([v for _, v in part]))
        links, component = brute_links([i for i, _ in part], unit, 0.9)
        mine = got.loc[[i for i, _ in part]]
        assert mine["n_links"].tolist() == links.tolist() and mine["component_id"].tolist() == component.tolist()


@pytest.mark.parametrize("size", [3, 40, 100])
def test_partial_distances_drop_no_pair(size):
    rng = np.random.default_rng(size)
    x = rng.normal(size=(300, size))
    x[150:] = x[:150] + rng.normal(size=(150, size)) * 0.45
    axes = np.linalg.qr(rng.normal(size=(size, size)))[0]
    i, j = compare(x, None, axes, 0.9)
    unit = unit_vectors(x)
    p, q = np.nonzero(np.triu(unit @ unit.T >= 0.9, 1))
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(zip(p.tolist(), q.tolist(), strict=True)) and len(i) > 20


def shingles(text):
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_likeness_estimates_jaccard():
    rng = np.random.default_rng(1)
    errors = []
    for n in (1, 3, 12, 60, 400, 3000):
        for share in (0.0, 0.1, 0.5, 0.9, 1.0):
            words = [f"w{rng.integers(1 << 40)}" for _ in range(n)]
            other = words[: int(n * share)] + [f"v{rng.integers(1 << 40)}" for _ in range(n - int(n * share))]
            a, b = " ".join(words), " ".join(other)
            s, t = shingles(a), shingles(b)
            pair = sketch([a, b])
            errors.append(likeness(pair[:1], pair[1:])[0] - len(s & t) / len(s | t))
    assert np.abs(errors).max() < 0.25 and np.sqrt(np.mean(np.square(errors))) < 0.06 and abs(np.mean(errors)) < 0.03


def test_sketch_does_not_depend_on_its_neighbours():
    texts = ["", None, " \n", "one", "A b\tc d e f", "word " * 50_000, "é ü ß"]
    together = sketch(texts)
    for t, row in zip(texts, together, strict=True):
        assert (sketch([t])[0] == row).all()
    assert (sketch(["A  B c D e f g"]) == sketch(["a b\nC d E f g "])).all()
    assert likeness(together[:1], together[2:3])[0] == 1 and likeness(together[:1], together[3:4])[0] == 0
    assert together.shape[1] * 8 == BINS * 4


@pytest.mark.parametrize("parts", [1, 4, 40])
def test_neighbours_and_edits(spark, parts):
    rows = [(i * 3 % 101, f"text {i} é " * (i % 7)) for i in range(101)] + [(500, None), (501, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("clash")).withColumn("ahead", F.lit(9)).repartition(parts)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r["doc_id"]: r for r in compare_neighbours(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        k = len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        assert got[i]["n_chars"] == len(text) and got[i]["edited_text"] == edited
        own, changed, other = (sketch([t]) for t in (text, edited, after))
        assert got[i]["fingerprint"] == own[0].tobytes().hex() and got[i]["edited_fingerprint"] == changed[0].tobytes().hex()
        assert got[i]["near_edited"] == likeness(own, changed)[0] and got[i]["near_next"] == likeness(own, other)[0]


def test_odd_neighbours(spark):
    one = spark.createDataFrame([(5, "a b c d e f")], "doc_id long, text string")
    assert compare_neighbours(one).first()["near_next"] == 1
    assert compare_neighbours(one.limit(0)).count() == 0
    rows = spark.createDataFrame([(None, "x"), (None, "y"), (3, "a"), (3, "a"), (3, "b"), (2**62 + 1, "c")], "doc_id long, text string")
    out = compare_neighbours(rows).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(["None", "None", "3", "3", "3", str(2**62 + 1)])
    hexed = one.select(fingerprint(F.col("text")).alias("f")).first()["f"]
    assert hexed == sketch(["a b c d e f"])[0].tobytes().hex()


def test_a_hot_id_is_dealt_over_many_tasks(spark):
    """A third of the rows have one id and a third have none: results are those of one order, and no task holds a third."""
    rows = [(i, f"text {i}") for i in range(60)] + [(30, f"hot {i} é") for i in range(60)] + [(None, f"none {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    dealt = with_next(docs).filter("ahead = 0").groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert dealt.sum() == len(rows) and dealt.max() < len(rows) / 4
    mark = {r["text"]: r["m"] for r in docs.select("text", F.xxhash64("text").alias("m")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), mark[r[1]]))
    got = {r["text_of"]: r["edited_text"] for r in compare_neighbours(docs).withColumn("text_of", F.col("edited_text")).collect()}
    expected = {t[: len(t) - len(t) // 3] + after[: len(t) // 3] for (_, t), (_, after) in zip(order, order[1:] + order[:1], strict=True)}
    assert set(got) == expected
