"""Parsing of classifier replies into canonical labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from prosemill.functions.text import let
from prosemill.functions.vocab import ENERGIES, NONE_WORDS, TAGS, WORLDS


def without_thinking(reply: Column) -> Column:
    return F.regexp_replace(reply, "(?s)<think>.*?</think>", "")


def slot(reply: Column, name: str) -> Column:
    """What follows the slot's name on its line; null where the slot is missing."""
    return let(F.regexp_extract(reply, rf"(?idU){name}\s*[:\-]\s*(.+)", 1), lambda value: F.when(value != "", value))


def canonical(value: Column, table: Mapping[str, Sequence[str]]) -> Column:
    """The label itself, or that of the longest keyword contained (the first of equals); 'none' for words of absence; else null."""
    bare = value
    for mark in (r"[\s]", r"\*", '"', "'", r"\.", r"[\s]"):
        bare = F.regexp_replace(bare, rf"(?U)^(?:{mark})+|(?:{mark})+\z", "")
    keywords = [(label, word, place) for place, (label, word) in enumerate((label, word) for label, words in table.items() for word in words)]

    def chosen(low: Column) -> Column:
        options = F.array(*[F.when(F.contains(low, F.lit(word)), F.struct(F.lit(len(word)).alias("length"), F.lit(-place).alias("place"), F.lit(label).alias("label"))) for label, word, place in keywords])
        choice = F.when((low == "") | low.isin(*NONE_WORDS), "none")
        for label in table:
            choice = choice.when(low == label.lower(), label)
        return choice.otherwise(F.array_max(options)["label"])

    return let(F.lower(bare), chosen)


def tag_list(value: Column) -> Column:
    """Distinct canonical tags of a list in the order of first mention."""
    found = F.transform(F.split(F.coalesce(value, F.lit("")), "[,;]"), lambda part: canonical(part, TAGS))
    return F.array_distinct(F.filter(found, lambda t: t.isNotNull() & (t != "none")))


def parse_reply(reply: Column) -> Column:
    """Struct (world, energy, tags, ok) of a raw reply; '?' stands for a missing label."""

    def of(bare: Column) -> Column:
        labels = F.struct(canonical(slot(bare, "WORLD"), WORLDS).alias("world"), canonical(slot(bare, "ENERGY"), ENERGIES).alias("energy"), tag_list(slot(bare, "TAGS")).alias("tags"))
        return let(labels, told)

    def told(found: Column) -> Column:
        world, energy = found["world"], found["energy"]
        ok = F.coalesce(world.isin(*WORLDS) & energy.isin(*ENERGIES), F.lit(False))
        return F.struct(F.coalesce(world, F.lit("?")).alias("world"), F.coalesce(energy, F.lit("?")).alias("energy"), found["tags"].alias("tags"), ok.alias("ok"))

    return let(without_thinking(reply), of)
