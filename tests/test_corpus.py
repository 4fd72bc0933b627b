import random

import pytest
from pyspark.sql import functions as F

from prosemill.operators import audit, corpus, labels, merge

GOOD = "The keeper of the old house walked to the {0} harbor. The harbor was calm and the keeper watched the {0} boats. The boats came home to the harbor in the evening. Then the keeper lit the lamp of the house and the lamp burned over the {0} water."
LEAVES = "idx long, n string, p string"
DRAWS = "idx long, att long, text string, stop string"


def table(spark, rows, schema):
    rows = list(rows)
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, schema).repartition(3)


def test_build_retries_exhausts_and_resolves_equal_texts(spark):
    leaves = table(spark, [(0, "a", "a"), (1, "b", "q"), (2, "c", "q"), (3, "d", "q")], LEAVES)
    same = GOOD.format("grey")
    draws = [(0, 0, same, "stop"), (1, 0, "too short.", "stop"), (1, 1, GOOD.format("blue"), "stop"), (2, 0, same, "stop"), (2, 1, GOOD.format("green"), "stop"), (3, 0, GOOD.format("red"), "length"), (3, 1, GOOD.format("tall").rstrip("."), "stop")]
    rows, rejects = corpus.build(leaves, table(spark, draws, DRAWS))
    got = {r["idx"]: (r["verdict"], r["att"], r["draws"]) for r in rows.collect()}
    assert got == {0: ("pass", 0, 1), 1: ("pass", 1, 2), 2: ("pass", 1, 2), 3: ("exhausted", 1, 2)}
    lost = {(r["idx"], r["att"]): (r["verdict"], r["gates"]) for r in rejects.collect()}
    assert lost == {(1, 1): ("failed", ["len", "incoherent"]), (2, 1): ("dupe", None), (3, 1): ("failed", ["no-stop"]), (3, 2): ("failed", ["no-end"])}


def test_a_key_shipped_before_blocks(spark):
    leaves = table(spark, [(0, "a", "a")], LEAVES)
    draws = table(spark, [(0, 0, GOOD.format("grey"), "stop"), (0, 1, GOOD.format("blue"), "stop")], DRAWS)
    first, _ = corpus.build(leaves, draws)
    again, _ = corpus.build(leaves, draws, seen=first.select("k"))
    assert [r["att"] for r in again.collect()] == [1]


def test_patch_takes_later_attempts(spark):
    leaves = table(spark, [(0, "a", "a"), (1, "b", "b")], LEAVES)
    draws = table(spark, [(0, 0, GOOD.format("grey"), "stop"), (1, 0, "no.", "stop"), (1, 60, GOOD.format("grey"), "stop"), (1, 61, GOOD.format("blue"), "stop")], DRAWS)
    rows, _ = corpus.build(leaves, draws)
    dead = rows.filter("verdict = 'exhausted'").select(F.col("genre").alias("n"))
    assert [(r["genre"], r["draws"]) for r in corpus.patch(leaves, dead, draws, rows).collect()] == [("b", 61)]


def test_empty_tables(spark):
    rows, rejects = corpus.build(spark.createDataFrame([], LEAVES), spark.createDataFrame([], DRAWS))
    assert rows.count() == rejects.count() == 0


def test_repair_is_idempotent_and_migrates(spark):
    old = spark.createDataFrame([("# T\n" + GOOD.format("old"), None, "pass", 7), ("flat", GOOD.format("new"), "failed", 8), (None, None, "pass", 9)], "text string, raw string, verdict string, id int")
    once = corpus.repair(old)
    got = {r["id"]: (r["verdict"], r["changed"]) for r in once.collect()}
    assert got == {7: ("style", True), 8: ("pass", True)}
    assert not corpus.repair(once.drop("changed")).filter("changed").count()


def test_first_wins_and_prompts(spark):
    rows = spark.createDataFrame([(2, "x"), (0, "x"), (1, "y")], "idx long, k string").withColumn("verdict", F.lit("pass"))
    assert {r["idx"]: r["verdict"] for r in corpus.first_wins(rows).collect()} == {0: "pass", 1: "pass", 2: "dupe"}
    shown = spark.createDataFrame([("a", "a"), ("a", "b")], "n string, p string").select(corpus.prompt(F.col("n"), F.col("p")).alias("x"))
    assert [r["x"] for r in shown.collect()] == ["Write a story in English. Genre: a.\n\n", "Write a story in English. Genre: b. Subgenre: a.\n\n"]


def test_audit_counts(spark):
    rows = [("k1", "A b.", None, "pass", True, 50), ("k1", "C d.", None, "style", True, 50), ("k2", "x", "Chapter 2\nA b.", "style", False, 5), ("k3", " ", None, "pass", True, 50)]
    counts = audit.audit(spark.createDataFrame(rows, "k string, text string, prose string, verdict string, ends boolean, n_tok long")).first().asDict()
    assert counts == {"n_rows": 4, "n_usable": 4, "n_not_ended": 1, "n_style_mismatch": 1, "n_empty": 1, "n_legacy": 0, "n_residue": 1, "n_residue_failed": 0, "n_out_of_band": 1, "n_repeated_keys": 1}
    assert audit.violations(counts, 5) == ["n_style_mismatch", "n_residue", "n_repeated_keys", "n_empty", "n_rows"]


W = ["Contemporary", "Science Fiction", "Historical & Western"]


def vote(spark, *worlds, tags=((), (), ())):
    rows = [("k", i + 1, w, "External", list(t)) for i, (w, t) in enumerate(zip(worlds, tags, strict=False))]
    out = labels.vote(spark.createDataFrame(rows, "k string, pass int, world string, energy string, tags array<string>")).select("world", "tags", "confidence").first()
    return tuple(out) if out else None


def test_votes(spark):
    assert vote(spark, W[0], W[0], W[0])[0] == W[0]
    assert vote(spark, W[0], W[1], W[1])[0] == W[1]
    assert vote(spark, W[2], W[1], W[0])[0] == W[2]
    assert vote(spark, "?", W[1], W[0])[0] == W[1]
    assert vote(spark, "?", "none") is None
    assert vote(spark, W[0])[2] == "unanimous"
    tags = (("Horror", "Romance"), ("Romance", "Horror"), ("Horror",))
    assert vote(spark, W[0], W[0], W[0], tags=tags)[1] == ["Romance", "Horror"]


def test_majority_confidence(spark):
    def of(*values):
        row = spark.createDataFrame([(list(values),)], "v array<string>").select(labels.majority(F.col("v")).alias("m")).first()["m"]
        return row["value"], row["confidence"]

    assert of("a", "b", "a") == ("a", "2-1")
    assert of("a", "b") == ("a", "tie")
    assert of() == (None, "missing")
    assert of("a") == ("a", "unanimous")


def test_gate_merge_and_its_rules(spark):
    rows = spark.createDataFrame([("a", "x", "old"), ("b", "y", "old")], "k string, text string, gate_decision string")
    result = spark.createDataFrame([("a", "PASS", 0.9, ["f"], [])], "k string, gate_decision string, gate_score double, gate_fails array<string>, gate_defaulted array<string>")
    gone = spark.createDataFrame([("b", "why")], "k string, reason string")
    merged = merge.merge_gates(rows, result, gone)
    assert {r["k"]: (r["gate_decision"], r["gate_score"]) for r in merged.collect()} == {"a": ("PASS", 0.9), "b": ("old", None)}
    assert merge.content_changes(rows, merged).count() == 0
    for bad in ((result.union(result), gone), (result, gone.union(spark.createDataFrame([("a", "why")], gone.schema))), (result, gone.limit(0))):
        with pytest.raises(merge.CoverageError):
            merge.merge_gates(rows, *bad)


def test_settings_and_subwords(spark):
    config = corpus.configured(corpus.BuildConfig(), "attempts=40", "max_words=240")
    assert (config.attempts, config.max_words, config.base_seed) == (40, 240, 911_000_000)
    with pytest.raises(ValueError):
        corpus.configured(config, "attempt=1")
    rows = spark.createDataFrame([("a", "one two", None), ("b", "x", "one two three"), ("c", None, None)], "k string, text string, prose string")
    counts = labels.subword_counts(rows, lambda texts: [len(t.split()) for t in texts], 2)
    assert {r["k"]: r["n"] for r in counts.collect()} == {"a": 2, "b": 3, "c": 0}
    shown = rows.select(labels.classifier_input(F.col("prose"), F.col("text"), 4).alias("x"))
    assert [r["x"] for r in shown.collect()] == ["one ", "one ", ""]


def test_waves_do_not_change_a_build(spark):
    """Leaves that lose their text late go on where they were, whatever the waves are."""
    rng = random.Random(5)
    leaves = table(spark, [(i, f"n{i}", f"n{i}") for i in range(8)], LEAVES)
    words = ["grey", "blue", "red", "tall", "old"]
    draws = [(i, a, GOOD.format(rng.choice(words)) if rng.random() < 0.6 else "short.", "stop") for i in range(8) for a in range(5)]
    got = []
    for wave in (2, 60):
        rows, rejects = corpus.build(leaves, table(spark, draws, DRAWS), wave=wave)
        got.append((sorted((r["idx"], r["att"], r["verdict"]) for r in rows.collect()), sorted((r["idx"], r["att"], r["verdict"]) for r in rejects.collect())))
    assert got[0] == got[1]
    held, expected = set(), {}
    for i in range(8):  # leaves in order take their first passing text that nobody before them has
        texts = [t for j, _, t, _ in sorted(draws) if j == i]
        expected[i] = next((a for a, t in enumerate(texts) if t != "short." and t not in held), None)
        held |= {texts[expected[i]]} if expected[i] is not None else set()
    assert {i: a for i, a, v in got[0][0] if v != "exhausted"} == {i: a for i, a in expected.items() if a is not None}


def test_second_draws_have_their_own_seed(spark):
    leaves = table(spark, [(3, "a", "a"), (4, "b", "p")], LEAVES)
    draws = table(spark, [(3, 0, "too short", "stop"), (4, 2, GOOD, "stop"), (4, 3, None, "stop")], DRAWS)
    got = {(r["idx"], r["att"]): r["seed"] for r in corpus.retry_requests(leaves, draws).collect()}
    assert got == {(3, 0): 911_000_030 + 555_555, (4, 3): 911_000_043 + 555_555}


def test_sweeps_stop_when_nothing_is_missing(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    asked = []

    def ask(missing, number):
        asked.append(sorted(r["k"] for r in missing.collect()))
        good = F.col("k") <= "abc"[number - 1]
        return missing.select("k", F.when(good, W[0]).otherwise("?").alias("world"), F.lit("External").alias("energy"))

    votes, missing = labels.sweep(rows, ask)
    assert asked == [["a", "b", "c"], ["b", "c"], ["c"]] and missing.isEmpty()
    assert {r["k"]: r["sweep"] for r in votes.collect()} == {"a": 1, "b": 2, "c": 3}
    assert labels.sweep(rows, lambda m, n: m.select("k", F.lit("?").alias("world"), F.lit("?").alias("energy")), most=2)[1].count() == 3


def test_outcomes_of_blank_stories_and_lost_replies(spark):
    rows = spark.createDataFrame([("a", None, " \n"), ("b", "p", "t"), ("c", "", "t")], "k string, prose string, text string")
    replies = spark.createDataFrame([("a", "WORLD: Contemporary\nENERGY: External"), ("b", "WORLD: Contemporary\nENERGY: External\nTAGS: Horror")], "k string, raw string")
    got = {r["k"]: (r["world"], r["energy"], r["tags"], r["raw"], r["ok"]) for r in labels.outcomes(rows, replies).collect()}
    assert got["a"] == ("?", "?", [], "<empty>", False) and got["c"] == ("<err no reply>", "?", [], "", False)
    assert got["b"][:3] == ("Contemporary", "External", ["Horror"]) and got["b"][4]


def test_merged_votes_and_the_dry_run(spark):
    rows = spark.createDataFrame([("a", "old"), ("b", "old")], "k string, world string")
    votes = spark.createDataFrame([("a", 1, W[1], "External", ["Horror"])], "k string, pass int, world string, energy string, tags array<string>")
    assert {r["k"]: (r["world"], r["confidence"]) for r in labels.merge_votes(rows, votes).collect()} == {"a": (W[1], "unanimous"), "b": (None, None)}
    results = spark.createDataFrame([("a", "PASS"), ("a", "FAIL")], "k string, gate_decision string")
    found = merge.dry_run(rows, results, spark.createDataFrame([("a", "x")], "k string, reason string")).first()
    assert (found["n_keys"], found["n_covered"], found["n_uncovered"], found["n_both"], found["n_repeated"]) == (2, 1, 1, 1, 1)
    assert found["decisions"] == {"PASS": 1, "FAIL": 1}


def test_pending_leaves(spark):
    leaves = table(spark, [(i, f"n{i}", "p") for i in range(6)], LEAVES)
    done = spark.createDataFrame([("n1",), ("n1",)], "n string")
    assert [r["idx"] for r in corpus.pending(leaves, done, shard=1, shards=2).orderBy("idx").collect()] == [3, 5]


def test_choosing_among_draws_does_not_read_texts(spark, tmp_path):
    leaves = spark.createDataFrame([(0, "a", "p"), (1, "b", "p")], "idx long, n string, p string")
    draws = spark.createDataFrame([(i, a, f"text {i} {a}", "stop") for i in (0, 1) for a in (0, 1)], "idx long, att long, text string, stop string")
    rows, _ = corpus.build(leaves, draws, config=corpus.BuildConfig(attempts=2))
    plan = corpus.yields(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan and "prompt" not in plan
