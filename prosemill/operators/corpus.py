"""From leaves and draws to a corpus: prompts, verdicts, retries, first-wins keys, repair.

Completions are an input table of draws (idx, att, text, stop). The outcome is
the same however rows are ordered or dealt: each leaf ships its first passing
draw, and of equal texts the leaf with the lowest index keeps the text while
the others go on to their next passing draw.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.functions import text as T
from prosemill.functions.gates import verdict, with_gates
from prosemill.functions.strip import stripped
from prosemill.sources.shared import cut, stored


@dataclass(frozen=True)
class BuildConfig:
    """Fixed values of a build; the seed of a draw is base + 10 * idx + att."""

    base_seed: int = 911_000_000
    first_attempt: int = 0
    attempts: int = 60
    max_words: int = 700
    short_words: int = 30
    short_seed: int = 555_555


def configured(config: BuildConfig, *settings: str) -> BuildConfig:
    """config with KEY=VALUE settings; values take the type of the field's default."""
    changes = {}
    for setting in settings:
        key, _, value = setting.partition("=")
        if not hasattr(config, key):
            raise ValueError(f"no setting is named {key}")
        changes[key] = type(getattr(config, key))(value)
    return replace(config, **changes)


def prompt(leaf: Column, parent: Column) -> Column:
    alone = F.format_string("Write a story in English. Genre: %s.\n\n", leaf)
    nested = F.format_string("Write a story in English. Genre: %s. Subgenre: %s.\n\n", parent, leaf)
    return F.when(parent == leaf, alone).otherwise(nested)


def seed(idx: Column, att: Column, config: BuildConfig = BuildConfig()) -> Column:
    return F.lit(config.base_seed).cast("long") + idx * 10 + att


def _is_short(text: Column, config: BuildConfig) -> Column:
    return F.size(T.tokens(F.coalesce(text, F.lit("")))) < config.short_words


def retry_requests(leaves: DataFrame, draws: DataFrame, config: BuildConfig = BuildConfig()) -> DataFrame:
    """(idx, att, prompt, seed) of the second draws to ask for: those of first draws with too few words, by a seed of their own."""
    short = draws.filter(_is_short(F.col("text"), config)).join(leaves, "idx")
    return short.select("idx", "att", prompt(F.col("n"), F.col("p")).alias("prompt"), (seed(F.col("idx"), F.col("att"), config) + config.short_seed).alias("seed"))


def replace_short(draws: DataFrame, seconds: DataFrame, config: BuildConfig = BuildConfig()) -> DataFrame:
    """draws with the second draw (same idx and att, its own seed) wherever the first has too few words."""
    other = seconds.select("idx", "att", F.col("text").alias("_text"), F.col("stop").alias("_stop"))
    short = _is_short(F.col("text"), config) & F.col("_text").isNotNull()
    joined = draws.join(other, ["idx", "att"], "left")
    return joined.select("idx", "att", F.when(short, F.col("_text")).otherwise(F.col("text")).alias("text"), F.when(short, F.col("_stop")).otherwise(F.col("stop")).alias("stop"))


def pending(leaves: DataFrame, done: DataFrame, key: str = "n", shard: int = 0, shards: int = 1) -> DataFrame:
    """Leaves of one shard that have no row yet."""
    return leaves.filter(F.col("idx") % shards == shard).join(done.select(key).distinct(), key, "left_anti")


def judge(rows: DataFrame, config: BuildConfig = BuildConfig(), with_stop: bool = True) -> DataFrame:
    """rows (text, and stop if with_stop) with n_tok, k, prose, ends, gates, review and verdict."""
    wide = rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("_s", stripped(F.col("text"), hinted=True))
    flat = T.normalise(T.surface(F.col("_s.prose"), F.col("text")))
    gated = with_gates(wide.withColumn("_target", flat), "_target", "text", config.max_words, F.col("_s"))
    hard = F.col("hard")
    if with_stop:
        hard = F.when(F.coalesce(F.col("stop") == "stop", F.lit(False)), hard).otherwise(F.array_append(hard, F.lit("no-stop")))
        hard = F.when((F.size(hard) == 0) & ~T.ends(F.col("_target")), F.array(F.lit("no-end"))).otherwise(hard)
    gated = gated.withColumn("hard", hard)
    extra = F.array(
        F.when(F.col("_s.cuts") >= 2, "style-heavy"),
        F.when(F.col("_s.prose").rlike(r"^\p{IsLowercase}"), "lc-start"),
        F.when(F.col("_s.echo_cuts") > 0, "echo-lead"),
    )
    review = F.concat("soft", F.filter(extra, lambda x: x.isNotNull()))
    failed, none = F.size("hard") > 0, F.lit(None)
    kept_review = ~failed if with_stop else F.lit(True)
    return gated.select(
        *[F.col(c) for c in rows.columns if c not in ("text", "prose", "ends", "gates", "review", "verdict", "n_tok", "k")],
        "text",
        F.size(T.tokens(F.col("text"))).cast("long").alias("n_tok"),
        T.content_key(F.col("text")).alias("k"),
        F.when(~failed, F.col("_s.prose")).alias("prose"),
        T.ends(F.col("_target")).alias("ends"),
        F.when(failed, F.col("hard")).otherwise(none).alias("gates"),
        F.when(kept_review & (F.size(review) > 0), review).otherwise(none).alias("review"),
        verdict(F.col("hard"), F.col("_s.prose")).alias("verdict"),
    )


def attempts(leaves: DataFrame, draws: DataFrame, config: BuildConfig = BuildConfig()) -> DataFrame:
    """A judged row for every draw of a leaf within the range of attempts."""
    last = config.first_attempt + config.attempts
    wanted = draws.filter(F.col("att").between(config.first_attempt, last - 1))
    rows = wanted.join(leaves, "idx").select("idx", "att", F.col("n").alias("genre"), F.col("p").alias("parent"), prompt(F.col("n"), F.col("p")).alias("prompt"), seed(F.col("idx"), F.col("att"), config).alias("seed"), "text", "stop")
    return judge(rows, config)


def first_wins(rows: DataFrame, key: str = "k", order: str = "idx") -> DataFrame:
    """rows whose key a row of smaller order has get the verdict dupe; null keys are one key.

    The least order of each key is combined before the shuffle and written, so
    the rows of a very common key can be dealt over many tasks in the join.
    """
    owner = cut(rows.groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_first")))
    joined = rows.join(owner, F.col(key).eqNullSafe(F.col("_key")), "left")
    return joined.withColumn("verdict", F.when(F.col(order) > F.col("_first"), "dupe").otherwise(F.col("verdict"))).drop("_key", "_first")


def _settle(good: DataFrame, lost: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """(picked, lost): each leaf's first passing draw whose key no leaf of lower index holds; lost are the (idx, k) given up on the way."""
    while True:
        left = good if lost is None else good.join(lost, ["idx", "k"], "left_anti")
        picked = cut(left.groupBy("idx").agg(F.min_by(F.struct("att", "k"), "att").alias("p")).select("idx", "p.att", "p.k"))
        owner = picked.groupBy("k").agg(F.min("idx").alias("owner"))
        losing = cut(picked.join(owner, "k").filter("idx != owner").select("idx", "k"))
        if losing.isEmpty():
            return picked, lost
        lost = losing if lost is None else cut(lost.unionByName(losing))


def build(leaves: DataFrame, draws: DataFrame, seen: DataFrame | None = None, config: BuildConfig = BuildConfig(), wave: int = 4) -> tuple[DataFrame, DataFrame]:
    """(corpus, rejects). corpus has one row a leaf: shipped, or its last draw as exhausted.

    seen: keys (k) that earlier runs shipped. draws counts the draws up to the
    row; in rejects att counts from 1. Leaves that lose their text to a lower
    index try again until nothing changes, so the result is a fixed point, and
    the same whatever the waves are.

    Draws are judged in waves, for the leaves that have none to ship yet: the
    next ``wave`` attempts of each, and twice as many in every wave to come.
    Each wave is written by columns, so no wave is judged again, and choosing
    among draws does not read their texts.
    """
    last = config.first_attempt + config.attempts
    judged: DataFrame | None = None
    state, picked, lost = leaves.select("idx", F.lit(config.first_attempt).alias("upto")), None, None
    while True:
        waiting = state if picked is None else state.join(picked.select("idx"), "idx", "left_anti")
        todo = cut(waiting.join(draws.select("idx", "att"), "idx").filter(F.col("att").between(F.col("upto"), last - 1)).select("idx", "upto").distinct())
        if todo.isEmpty():
            break
        until = F.least(F.col("upto") + wave, F.lit(last))
        asked = draws.join(todo, "idx").filter((F.col("att") >= F.col("upto")) & (F.col("att") < until)).drop("upto")
        fresh = stored(attempts(leaves, asked, config))
        judged = fresh if judged is None else judged.unionByName(fresh)
        state = cut(state.join(todo.select("idx", until.alias("_next")), "idx", "left").select("idx", F.coalesce("_next", "upto").alias("upto")))
        good = judged.filter(F.col("verdict").isin("pass", "style")).select("idx", "att", "k")
        if seen is not None:
            good = good.join(seen.select("k").distinct(), "k", "left_anti")
        picked, lost = _settle(good, lost)
        wave *= 2
    if judged is None:
        judged = cut(attempts(leaves, draws.limit(0), config))
        picked = judged.select("idx", "att", "k")
    exhausted = judged.groupBy("idx").agg(F.max("att").alias("att")).join(picked.select("idx"), "idx", "left_anti")
    chosen = cut(picked.select("idx", "att", F.lit(True).alias("_ships")).unionByName(exhausted.select("idx", "att", F.lit(False).alias("_ships"))))
    draws_used = F.col("att") - config.first_attempt + 1
    corpus = judged.join(chosen, ["idx", "att"]).withColumn("draws", draws_used).withColumn("verdict", F.when(F.col("_ships"), F.col("verdict")).otherwise("exhausted")).drop("_ships")
    until = chosen.select("idx", F.col("att").alias("_last"), "_ships")
    rejects = judged.join(until, "idx").filter((F.col("att") < F.col("_last")) | ((F.col("att") == F.col("_last")) & ~F.col("_ships")))
    rejects = rejects.withColumn("verdict", F.when(F.col("verdict") == "failed", "failed").otherwise("dupe")).withColumn("att", F.col("att") + 1).drop("_last", "_ships")
    return corpus, rejects


def patch(leaves: DataFrame, dead: DataFrame, draws: DataFrame, corpus: DataFrame, config: BuildConfig = BuildConfig(first_attempt=60, attempts=140)) -> DataFrame:
    """Rows for exhausted leaves from later attempts whose text the corpus does not have; draws is the attempt's number."""
    wanted = leaves.join(dead.select("n").distinct(), "n", "left_semi")
    rows, _ = build(wanted, draws, corpus.filter(F.col("verdict").isin("pass", "style")).select("k"), config)
    return rows.filter(F.col("verdict").isin("pass", "style")).withColumn("draws", F.col("att"))


def repair(rows: DataFrame, config: BuildConfig = BuildConfig()) -> DataFrame:
    """Strip and gate stored rows again, from raw or else text. Rows with neither are left out; stop and ends do not count.

    changed tells whether prose, gates, verdict or text differ from before.
    """
    raw = F.nullif(F.col("raw"), F.lit("")) if "raw" in rows.columns else F.lit(None).cast("string")
    source = F.coalesce(raw, F.col("text"))
    kept = [c for c in rows.columns if c not in ("raw", "text", "prose", "gates", "review", "verdict")]
    before = F.struct(*[F.col(c) if c in rows.columns else F.lit(None).cast(kind).alias(c) for c, kind in (("text", "string"), ("prose", "string"), ("gates", "array<string>"), ("verdict", "string"))])
    ready = rows.filter(source.isNotNull()).select(F.struct(*kept).alias("_kept"), before.alias("_before"), source.alias("text"))
    done = judge(ready, config, with_stop=False)
    after = F.struct("text", "prose", "gates", "verdict")
    return done.select("_kept.*", "text", "prose", "gates", "review", "verdict", (~after.eqNullSafe(F.col("_before"))).alias("changed"))


def yields(corpus: DataFrame) -> DataFrame:
    """Leaves, shipped leaves, draws a leaf and draws a shipped leaf."""
    ships = F.col("verdict").isin("pass", "style")
    return corpus.agg(F.count("*").alias("leaves"), F.count_if(ships).alias("shipped"), F.avg("draws").alias("draws_a_leaf"), F.avg(F.when(ships, F.col("draws"))).alias("draws_a_ship"))


def failure_census(rejects: DataFrame, top: int = 6) -> DataFrame:
    """Most frequent (stop, first gate) of discarded draws."""
    first = F.coalesce(F.get(F.col("gates"), 0), F.lit("dupe"))
    return rejects.groupBy("stop", first.alias("gate")).count().orderBy(F.desc("count"), "stop", "gate").limit(top)
