"""Corpus instruments: phrase rates, n-gram diversity, repeats across documents, compressed size."""

from __future__ import annotations

import re._parser as re_parser
import zlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.functions import text as T
from prosemill.functions.patterns import java
from prosemill.functions.vocab import CLICHE, UNCANNY

FAMILIES = {"cliche": CLICHE, "uncanny": UNCANNY}


#: Letters beyond ASCII that match s, i and k where case does not count, and that lower() leaves or takes apart.
FOLDED = "[\u017f\u0130\u0131\u212a]"


def landmark(phrase: str) -> str:
    """The longest text, in lower case, that every match of a phrase holds."""
    runs, run = [""], ""
    for kind, value in re_parser.parse(phrase):
        run = run + chr(value) if kind is re_parser.LITERAL else ""
        runs.append(run)
    return max(runs, key=len).lower()


def phrase_count(text: Column, family: str, lower: Column | None = None, folded: Column | None = None) -> Column:
    """Non-overlapping matches of all phrases of a family. A phrase is searched only where its landmark is found.

    lower: the text in lower case; folded: whether it holds FOLDED letters. Both are made of text if they are not given.
    """
    low = F.lower(text) if lower is None else lower
    odd = text.rlike(FOLDED) if folded is None else folded
    counts = [F.when(odd | F.contains(low, F.lit(landmark(p))), F.regexp_count(text, F.lit(java(p, "iu")))).otherwise(0) for p in FAMILIES[family]]
    return reduce(add, counts).cast("long")


def phrase_census(docs: DataFrame, by: str, text_col: str = "text") -> DataFrame:
    """Documents, words and phrase rates per 1,000 words of each corpus, quoted speech left out of the phrases."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = T.materialised(docs.select(by, text.alias("_text")), "_b", bare=T.without_quotes(F.col("_text")))
    ready = T.materialised(cut, "_l", low=F.lower("_b.bare"), odd=F.col("_b.bare").rlike(FOLDED))
    counts = [phrase_count(F.col("_b.bare"), f, F.col("_l.low"), F.col("_l.odd")).alias(f) for f in FAMILIES]
    words = F.greatest(F.size(T.tokens(F.col("_text"))).cast("long"), F.lit(1).cast("long"))
    rows = T.materialised(ready, "_c", w=words, **dict(zip(FAMILIES, counts, strict=True))).select(by, "_c.*")
    rates = [F.bround(1000 * F.sum(f) / F.sum("w"), 2).alias(f"{f}_per_1kw") for f in FAMILIES]
    return rows.groupBy(by).agg(F.count("*").alias("docs"), F.sum("w").alias("words_total"), F.bround(F.avg("w"), 0).cast("long").alias("words_mean"), T.upper_median("w").cast("long").alias("words_median"), *rates, F.count_if(reduce(add, map(F.col, FAMILIES)) == 0).alias("docs_with_zero"))


def distinct_share(words: Column, n: int) -> Column:
    """Share of distinct n-grams of a document; 1 where it has none."""
    share = T.let(T.gram_hashes(words, n), lambda g: F.try_divide(F.size(F.array_distinct(g)).cast("double"), F.size(g).cast("double")))
    return F.coalesce(share, F.lit(1.0))


def diversity(docs: DataFrame, by: str, text_col: str = "text") -> DataFrame:
    rows = T.materialised(docs, "_w", words=T.tokens(F.coalesce(F.col(text_col), F.lit(""))))
    return rows.select(by, distinct_share(F.col("_w.words"), 2).alias("d2"), distinct_share(F.col("_w.words"), 3).alias("d3")).groupBy(by).agg(F.bround(F.avg("d2"), 3).alias("distinct2"), F.bround(F.avg("d3"), 3).alias("distinct3"))


def _own_grams(docs: DataFrame, n: int, text_col: str, *keep: str) -> DataFrame:
    """Distinct n-grams g of each document."""
    rows = T.materialised(docs, "_w", words=T.tokens(F.coalesce(F.col(text_col), F.lit(""))))
    return rows.select(*keep, F.explode(F.array_distinct(T.ngrams(F.col("_w.words"), n))).alias("g"))


#: Parts that the hashes of n-grams are dealt over, by their last bits.
PARTS = 4096


def _spread_bits(x: np.ndarray, factor: int) -> np.ndarray:
    x = x * np.uint64(factor)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _hashed_grams(words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of hash, as two numbers, of each n words in a row."""
    count = len(words) - n + 1
    first, second = np.zeros(count, np.uint64), np.zeros(count, np.uint64)
    for i in range(n):
        word = words[i : i + count]
        first, second = _spread_bits(first ^ word, 0xBF58476D1CE4E5B9), _spread_bits(second + word, 0x94D049BB133111EB)
    return first, second


def _packed(held: list[tuple[np.ndarray, np.ndarray]], total: int) -> pa.RecordBatch:
    """(part, grams, total): the distinct grams held, 10 bytes each, in a row for each part; the first row has the total."""
    first, second = (np.concatenate(side) for side in zip(*held, strict=True))
    part = second % np.uint64(PARTS)
    order = np.lexsort((second, first, part))
    first, second, part = first[order], second[order], part[order]
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    first, second, part = first[new], second[new], part[new]
    grams = np.empty(len(first), [("a", "<u8"), ("b", "<u2")])
    grams["a"], grams["b"] = first, second >> np.uint64(48)
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    blobs = [grams[i:j].tobytes() for i, j in zip(starts, [*starts[1:], len(grams)], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(part[starts].astype(np.int32)), pa.array(blobs, pa.binary()), pa.array([total] + [0] * (len(starts) - 1), pa.int64())], ["part", "grams", "total"])


def repeated_ngrams(docs: DataFrame, n: int = 8, text_col: str = "text", most: int = 1_000_000) -> DataFrame:
    """n-grams by document, distinct ones, and the repeated percentage; each document counts an n-gram once.

    Across documents n-grams are compared by 92 bits of hash, not as texts: 12
    say the part, and the others are exchanged as bytes, packed for each part
    and freed of repeats in so many (most) n-grams of a task at a time.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, total = [], 0, 0
        for batch in batches:
            lists = batch.column(0)
            flat, ends = lists.flatten().to_numpy().view(np.uint64), np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]
            for i, j in zip(ends[:-1], ends[1:], strict=True):
                if j - i < n:
                    continue
                first, second = _hashed_grams(flat[i:j], n)
                _, own = np.unique(first, return_index=True)
                held.append((first[own], second[own]))
                size, total = size + len(own), total + len(own)
                if size >= most:
                    yield _packed(held, total)
                    held, size, total = [], 0, 0
        if held:
            yield _packed(held, total)

    def count(table: pa.Table) -> pa.Table:
        grams = np.frombuffer(b"".join(table["grams"].to_pylist()), [("a", "<u8"), ("b", "<u2")])
        first, second = grams["a"], grams["b"]
        order = np.lexsort((second, first))
        first, second = first[order], second[order]
        distinct = 1 + np.count_nonzero((first[1:] != first[:-1]) | (second[1:] != second[:-1]))
        return pa.table({"c": pa.array([sum(table["total"].to_pylist())], pa.int64()), "d": pa.array([distinct], pa.int64())})

    words = docs.select(F.transform(T.tokens(F.coalesce(F.col(text_col), F.lit(""))), lambda w: F.xxhash64(w)).alias("words"))
    packed = words.mapInArrow(pack, "part int, grams binary, total long")
    counted = packed.groupBy("part").applyInArrow(count, "c long, d long").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total"), F.coalesce(F.sum("d"), F.lit(0)).alias("n_distinct"))
    return counted.select("total", "n_distinct", F.bround(F.try_divide(100.0 * (F.col("total") - F.col("n_distinct")), F.col("total")), 2).alias("repeated_pct"))


def vocabulary(docs: DataFrame, by: str, text_col: str = "text") -> DataFrame:
    words = docs.select(by, F.explode(T.tokens(F.coalesce(F.col(text_col), F.lit("")))).alias("w"))
    return words.groupBy(by, "w").agg(F.count("*").alias("c")).groupBy(by).agg(F.sum("c").alias("tokens"), F.count("*").alias("vocabulary"))


def compressed_bits(docs: DataFrame, by: str, order: str, text_col: str = "text", level: int = 9) -> DataFrame:
    """zlib bits per character of each corpus, documents in order with a space between.

    Compression has one state for a corpus, so each is one stream in one task,
    read in sorted batches and never held; more machines do not shorten it. The
    number asked for is that of the whole stream, which blocks would change.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, packer, size, chars, done = None, None, 0, 0, []
        for frame in batches:
            for corpus, text in zip(frame[by], frame["_text"], strict=True):
                if packer is None or corpus != name:
                    if packer is not None:
                        done.append((name, round((size + len(packer.flush())) * 8 / max(chars, 1), 3)))
                    name, packer, size, chars = corpus, zlib.compressobj(level), 0, 0
                elif packer is not None:
                    size, chars = size + len(packer.compress(b" ")), chars + 1
                size, chars = size + len(packer.compress(text.encode())), chars + len(text)
        if packer is not None:
            done.append((name, round((size + len(packer.flush())) * 8 / max(chars, 1), 3)))
        yield pd.DataFrame(done, columns=[by, "bits_per_char"])

    rows = docs.select(F.coalesce(F.col(by), F.lit("")).alias(by), F.col(order).alias("_order"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return rows.repartition(by).sortWithinPartitions(by, "_order").mapInPandas(run, f"{by} string, bits_per_char double")


def held_out_overlap(docs: DataFrame, held_out: DataFrame, n: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shared): documents that share n-grams with held-out texts, and how many distinct ones."""
    gold = _own_grams(held_out, n, "text").distinct()
    own = _own_grams(docs, n, text_col, id_col)
    return own.join(gold, "g", "left_semi").groupBy(id_col).agg(F.count("*").alias("n_shared"))
