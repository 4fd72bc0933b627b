"""Majority votes over label passes, and their merge into a corpus."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.functions.labels import parse_reply
from prosemill.functions.text import materialised, normalise
from prosemill.functions.vocab import ENERGIES, TAGS, WORLDS
from prosemill.sources.shared import cut


def valid(votes: DataFrame) -> DataFrame:
    return votes.filter(F.col("world").isin(*WORLDS) & F.col("energy").isin(*ENERGIES))


def majority(values: Column) -> Column:
    """Struct (value, confidence) of an array of votes in pass order: unanimous, 2-1, tie (then the first) or missing."""
    known = F.filter(values, lambda v: v.isNotNull())
    options = F.array_distinct(known)
    counted = F.transform(options, lambda o, i: F.struct(F.size(F.filter(known, lambda v: v == o)).alias("n"), (-i).alias("place"), o.alias("value")))
    top = F.array_max(counted)
    single, most = F.size(options) == 1, top["n"] * 2 > F.size(known)
    confidence = F.when(F.size(options) == 0, "missing").when(single, "unanimous").when(most, "2-1").otherwise("tie")
    return F.struct(F.when(single | most, top["value"]).otherwise(F.get(values, F.lit(0))).alias("value"), confidence.alias("confidence"))


def tag_quorum(tags: Column, quorum: int = 2) -> Column:
    """Tags that at least so many votes hold, in the canonical order. tags: an array of arrays."""
    return F.filter(F.array(*[F.lit(t) for t in TAGS]), lambda t: F.size(F.filter(tags, lambda v: F.array_contains(v, t))) >= quorum)


def vote(votes: DataFrame) -> DataFrame:
    """(k, world, energy, tags, confidence) from the valid votes (k, pass, world, energy, tags) of each key."""
    ordered = F.array_sort(F.collect_list(F.struct("pass", "world", "energy", F.coalesce("tags", F.array().cast("array<string>")).alias("tags"))))
    grouped = valid(votes).groupBy("k").agg(ordered.alias("v"))
    world, energy = majority(F.transform("v", lambda x: x["world"])), majority(F.transform("v", lambda x: x["energy"]))
    done = grouped.select("k", world.alias("w"), energy.alias("e"), tag_quorum(F.transform("v", lambda x: x["tags"])).alias("tags"))
    return done.select("k", F.col("w.value").alias("world"), F.col("e.value").alias("energy"), "tags", F.col("e.confidence").alias("confidence"))


def merge_votes(corpus: DataFrame, votes: DataFrame) -> DataFrame:
    """corpus with the voted labels; rows without a valid vote have none."""
    kept = corpus.drop("world", "energy", "tags", "confidence")
    return kept.join(vote(votes), "k", "left")


def still_missing(corpus: DataFrame, votes: DataFrame) -> DataFrame:
    """Rows without a valid vote: the input of the next sweep."""
    return corpus.join(valid(votes).select("k").distinct(), "k", "left_anti")


def sweep(corpus: DataFrame, ask: Callable[[DataFrame, int], DataFrame], most: int = 5) -> tuple[DataFrame, DataFrame]:
    """(votes, missing) after asking again, at most so many times, for the rows without a valid vote.

    ask(rows, number) returns votes (k, world, energy, ...) for rows; invalid
    ones are dropped, and so are those of keys that have one. votes have the
    number of their sweep.
    """
    missing, votes = corpus, None
    for number in range(1, most + 1):
        answered = cut(valid(ask(missing, number)).withColumn("sweep", F.lit(number)))
        votes = answered if votes is None else votes.unionByName(answered)
        missing = cut(still_missing(missing, answered))
        if missing.isEmpty():
            break
    return votes, missing


def outcomes(corpus: DataFrame, replies: DataFrame, most: int = 8_000) -> DataFrame:
    """(k, world, energy, tags, raw, ok) of every row: its parsed reply (k, raw), or what stands for a blank story or a lost reply."""
    story = classifier_input(F.col("prose"), F.col("text"), most)
    joined = corpus.select("k", (normalise(story) == "").alias("_blank")).join(replies.select("k", F.col("raw").alias("_raw")), "k", "left")
    parsed = materialised(joined, "_p", r=parse_reply(F.coalesce("_raw", F.lit("")))).select("k", "_blank", "_raw", F.col("_p.r").alias("_p"))
    none = F.array().cast("array<string>")
    world = F.when(F.col("_blank"), "?").when(F.col("_raw").isNull(), "<err no reply>").otherwise(F.col("_p.world"))
    asked = ~F.col("_blank")
    return parsed.select("k", world.alias("world"), F.when(asked, F.col("_p.energy")).otherwise("?").alias("energy"), F.when(asked, F.col("_p.tags")).otherwise(none).alias("tags"), F.when(asked, F.coalesce("_raw", F.lit(""))).otherwise("<empty>").alias("raw"), (asked & F.col("_p.ok")).alias("ok"))


def classifier_input(prose: Column, text: Column, most: int = 8_000) -> Column:
    """The first characters of the prose, or of the text where the prose is missing or empty."""
    return F.substring(F.coalesce(F.nullif(prose, F.lit("")), text, F.lit("")), 1, most)


def subword_counts(corpus: DataFrame, count: Callable[[list[str]], list[int]], batch: int = 512) -> DataFrame:
    """(k, n) of every row's surface, by a tokenizer that counts a list of texts at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["text"].tolist()
            numbers = [n for at in range(0, len(texts), batch) for n in count(texts[at : at + batch])]
            yield pd.DataFrame({"k": frame["k"], "n": numbers})

    surface = F.coalesce("prose", "text", F.lit("")) if "prose" in corpus.columns else F.coalesce("text", F.lit(""))
    return corpus.select("k", surface.alias("text")).mapInPandas(run, "k string, n long")


def tokenizer_counter(path: str) -> Callable[[list[str]], list[int]]:
    """A counter for subword_counts by a file of the tokenizers library, special tokens not added. The file is read once a worker."""
    held: list = []

    def count(texts: list[str]) -> list[int]:
        if not held:
            from tokenizers import Tokenizer

            held.append(Tokenizer.from_file(path))
        return [len(e.ids) for e in held[0].encode_batch(texts, add_special_tokens=False)]

    return count


def retokenise(corpus: DataFrame, counts: DataFrame) -> DataFrame:
    """n_tok from a table of subword counts (k, n); the old value moves to n_word."""
    joined = corpus.drop("n_word").join(counts.select("k", F.col("n").alias("_n")), "k", "left")
    return joined.withColumn("n_word", F.col("n_tok")).withColumn("n_tok", F.coalesce("_n", "n_tok")).drop("_n")
