"""Text primitives as Spark columns.

Patterns follow one rule for Unicode: white space is the class WS (all that
Python calls a space), ``(?d)`` keeps line ends to the newline, ``(?iu)`` folds
case over all letters and ``(?U)`` gives word boundaries over all letters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Every code point that separates words, for Java patterns.
WS = r"[\t-\r\x1c-\x1f \x85\p{Z}]"
WS_NOT_SPACE = r"[\t-\r\x1c-\x1f\x85\p{Z}&&[^ ]]"
WORD = r"[a-z0-9']+"
SENTENCE_END = rf"(?<=[.!?]){WS}+|\n+"
#: A closing mark, then at most one straight quote or bracket (fixed values).
TERMINAL = r"""[.!?…]["')\]]?$"""
QUOTED = r'["“][^"”]*["”]'


def materialised(rows: DataFrame, name: str, **columns: Column) -> DataFrame:
    """rows with a struct of columns that are computed once.

    Projections alone do not ensure that: the optimiser puts an expression in
    the place of each use of it, also inside the functions of array elements.
    Nothing is moved over an explode of one element.
    """
    return rows.select("*", F.explode(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))).alias(name))


def normalise(text: Column) -> Column:
    """Runs of white space become one space; none at the ends. A space that stands alone is no match: most are."""
    return F.trim(F.regexp_replace(text, f"{WS_NOT_SPACE}{WS}*| {WS}+", " "))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def sentences(text: Column) -> Column:
    """Pieces between sentence ends and newlines; the piece after a final end may be empty."""
    return F.split(text, SENTENCE_END)


def first_words(text: Column, n: int) -> Column:
    return F.array_join(F.slice(F.split(normalise(text), " "), 1, n), " ")


def content_key(text: Column) -> Column:
    """First 16 hex digits of the SHA-1 of the normalised text: equal keys mean equal words and case."""
    return F.substring(F.sha1(normalise(text)), 1, 16)


def ends(text: Column) -> Column:
    return text.rlike(f"(?d){TERMINAL}")


def without_quotes(text: Column) -> Column:
    return F.regexp_replace(text, QUOTED, " ")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often it stands there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ngrams(words: Column, n: int, drop_last: int = 0) -> Column:
    """All n-grams of an array of words, as strings; drop_last leaves out so many at the end."""

    def of(w: Column) -> Column:
        last = F.size(w) - n - drop_last
        grams = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(w, i + 1, F.lit(n)), " "))
        return F.when(last >= 0, grams).otherwise(F.array().cast("array<string>"))

    return let(words, of)


def _joined(first: Column, then: Column, step: int) -> Column:
    """Hashes of first at each place with then so many places on."""
    m = F.greatest(F.size(then) - step, F.lit(0))
    return F.zip_with(F.slice(first, F.lit(1), m), F.slice(then, F.lit(1 + step), m), lambda a, b: F.xxhash64(a, b))


def gram_hashes(words: Column, n: int, drop_last: int = 0) -> Column:
    """All n-grams of an array of words, as 64-bit hashes: for comparisons within one text, where they do not collide in practice.

    Each word is hashed once. Hashes of twice the words come from pairs of
    neighbours, so the work for a gram grows with the logarithm of n.
    """

    def grown(block: Column, width: int, left: int, done: Column | None, held: int) -> Column:
        """block: hashes of width words; done: hashes of the held words before, for the lower bits of n; left: the bits to come."""
        if left & 1:
            now = block if done is None else _joined(done, block, held)
            if left == 1:
                return now
            return let(now, lambda d: let(_joined(block, block, width), lambda b: grown(b, 2 * width, left >> 1, d, held + width)))
        return let(_joined(block, block, width), lambda b: grown(b, 2 * width, left >> 1, done, held))

    grams = let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: grown(hashes, 1, n, None, 0))
    return let(grams, lambda g: F.slice(g, F.lit(1), F.greatest(F.size(g) - drop_last, F.lit(0)))) if drop_last else grams


def loop_hashes(words: Column) -> Column:
    """Struct (g8, g6) of the hashes of all 8-grams and 6-grams, both from the same hashes of four words."""

    def of(pairs: Column) -> Column:
        return let(_joined(pairs, pairs, 2), lambda fours: F.struct(_joined(fours, fours, 4).alias("g8"), _joined(fours, pairs, 4).alias("g6")))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: let(_joined(hashes, hashes, 1), of))


def repeats(items: Column) -> Column:
    return let(items, lambda x: F.size(F.array_distinct(x)) < F.size(x))


def upper_median(column: str) -> Column:
    """Aggregate: the element at n // 2 of the sorted values of a numeric column. It counts by value, so whole numbers combine before the shuffle."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{column}` DESC)")


def surface(prose: Column, text: Column) -> Column:
    """The text that would be used: prose where there is some, else the text."""
    return F.coalesce(prose, text)


def row_fingerprint(*columns: str) -> Column:
    """md5 over the named columns in the order of their names; absent values do not count."""
    return F.md5(F.to_json(F.struct(*sorted(columns))))
