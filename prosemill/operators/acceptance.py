"""Acceptance of generated positives and of rewritten twins; paragraphs and sentence filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prosemill.functions import patterns as P
from prosemill.functions import text as T
from prosemill.operators.census import phrase_count

#: Fixed values of the instruments.
PARAGRAPH_WORDS, SENTENCE_WORDS = 110, (8, 40)


def eligible(sentences: Column, low: int = SENTENCE_WORDS[0], high: int = SENTENCE_WORDS[1]) -> Column:
    """Sentences within the word limits."""
    return F.filter(sentences, lambda s: F.size(T.tokens(s)).between(low, high))


def refusal(text: Column, kind: Column, least: int = 40, by_tokens: bool = False, no_digits: bool = False) -> Column:
    """Why a generated paragraph is refused, first reason only: short, loop, format, lowtics, digits; null if it is not."""
    words = T.tokens(text)
    length = F.size(words) if by_tokens else F.when(T.normalise(text) == "", 0).otherwise(F.size(F.split(T.normalise(text), " ")))
    reason = F.when(length < least, "short").when(T.repeats(T.gram_hashes(words, 8, drop_last=1)), "loop").when(text.rlike(P.java(P.FORMAT, "iu")), "format")
    reason = reason.when((kind == "cliche") & (phrase_count(text, "cliche") < 2), "lowtics")
    return reason.when(text.rlike(r"\p{Nd}"), "digits") if no_digits else reason


def accepted_rewrite(source: Column, target: Column) -> Column:
    """Whether a rewrite differs, is plain prose of like length and sentence number, and shares some but not all words."""
    a, b = T.tokens(source), T.tokens(target)
    ratio = F.size(b) / F.greatest(F.size(a), F.lit(1))
    sentences = F.abs(F.size(T.sentences(source)) - F.size(T.sentences(target)))
    union = F.size(F.array_union(a, b))
    overlap = F.size(F.array_intersect(F.array_distinct(a), F.array_distinct(b))) / F.greatest(union, F.lit(1))
    plain = ~target.rlike(r"(?m)^#|\*\*|^Paragraph|^Rewritten") & ~target.contains("______") & ~target.rlike(r"\p{Nd}")
    ok = (target != "") & (target != source) & plain & ratio.between(0.6, 1.5) & (sentences <= 1) & overlap.between(0.15, 0.9)
    return F.coalesce(ok, F.lit(False))


def paragraphs(sentences: DataFrame, size: int = 5, group: str = "doc_id", order: str = "pos", text: str = "sentence") -> DataFrame:
    """(group, paragraph, text): runs of so many sentences, joined by spaces; what is left over is dropped."""
    number = F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1
    chunk = sentences.withColumn("paragraph", F.floor(number / size))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda s: s[text])
    return chunk.groupBy(group, "paragraph").agg(F.array_join(ordered, " ").alias("text"), F.count("*").alias("n")).filter(F.col("n") == size).drop("n")


def without_held_out_openings(sentences: DataFrame, gold: DataFrame, text: str = "sentence", words: int = 8) -> DataFrame:
    """Sentences whose first words are not those of a gold sentence."""
    own = sentences.withColumn("_head", F.array_join(F.slice(T.tokens(F.col(text)), 1, words), " "))
    heads = gold.select(F.array_join(F.slice(T.tokens(F.col(text)), 1, words), " ").alias("_head")).distinct()
    return own.join(heads, "_head", "left_anti").drop("_head")


def pool(labels: DataFrame, texts: DataFrame, bench: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pool, missing): labels (k, s, src) with their texts and, where the bench has them, ok and fail; and the labels without a text."""
    joined = labels.join(texts.select("k", "text"), "k").join(bench.select("k", "ok", "fail"), "k", "left")
    return joined.select("k", "text", "src", "s", "ok", "fail"), labels.join(texts.select("k"), "k", "left_anti")
