"""Quality gates as Spark columns: hard gates fail a text, soft ones flag it for review."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.functions import patterns as P
from prosemill.functions import text as T
from prosemill.functions.hints import ALL, BITS
from prosemill.functions.vocab import FUNCTION_WORDS, STOP_WORDS, TYPOGRAPHIC


def _starts(text: Column, pattern: str, flags: str = "") -> Column:
    return text.rlike(P.java(rf"\A(?:{pattern})", flags))


def foreign_letters(text: Column) -> Column:
    """Characters beyond ASCII, typographic marks aside."""
    return F.length(F.regexp_replace(text, rf"[\x00-\x7f{TYPOGRAPHIC}]+", ""))


def function_share(text: Column) -> Column:
    """Share of English function words; null where there are no words."""
    return _share_of(F.regexp_extract_all(F.lower(text), F.lit("[a-z']+"), F.lit(0)))


def _share_of(words: Column) -> Column:
    known = F.size(F.filter(words, lambda w: w.isin(*FUNCTION_WORDS)))
    return F.try_divide(known.cast("double"), F.size(words).cast("double"))


def sentence_stems(text: Column) -> Column:
    """Distinct stems of each sentence of five words or more: the first four letters of its content words."""
    spoken = F.filter(F.transform(T.sentences(text), T.tokens), lambda words: F.size(words) >= 5)
    content = F.transform(spoken, lambda words: F.filter(words, lambda w: (F.length(w) >= 3) & ~w.isin(*STOP_WORDS)))
    return F.transform(content, lambda words: F.array_distinct(F.transform(words, lambda w: F.left(w, F.lit(4)))))


def cohesion(stems: Column) -> Column:
    """Share of neighbouring sentences that share a stem; 0 under three sentences."""
    n = F.size(stems)
    joined = F.zip_with(F.slice(stems, F.lit(1), n - 1), F.slice(stems, F.lit(2), n - 1), lambda a, b: F.coalesce(F.arrays_overlap(a, b), F.lit(False)).cast("int"))
    hits = F.aggregate(joined, F.lit(0), lambda a, x: a + x)
    return F.when(n >= 3, hits.cast("double") / (n - 1)).otherwise(0.0)


def echo_kept(hit: Column) -> Column:
    """True where a hit of the echo shape narrates after all: it is long, or has a finite verb or a told-by passive."""
    shape = _starts(hit, rf"\s*{P.ECHO}", "i")
    inner = F.regexp_extract(hit, P.java(rf"\A\s*{P.ECHO}", "iu"), 1)
    bare = F.regexp_replace(F.regexp_replace(hit, P.java(P.RELATIVE_CLAUSE, "iu"), " "), P.java(P.DESCRIBING_COPULA, "iu"), " ")
    narrates = ~_starts(inner, P.SPECIFYING, "iu") & (inner.rlike(P.java(P.FINITE_VERB, "iu")) | bare.rlike(P.java(P.PASSIVE_TELLING, "iu")))
    long = F.size(F.split(T.normalise(hit), " ")) > 12
    return shape & (long | narrates)


def lead_speech(text: Column) -> Column:
    """Opens with speech of an assistant."""
    return _starts(text, rf"\s*{P.LEAD_SPEECH}", "iu")


def about_story(text: Column) -> Column:
    """Opens with speech about a story."""
    opens = _starts(text, rf"\s*(?:{P.META_BODY})", "iu")
    sentence = F.regexp_extract(text, P.java(rf"\A\s*(?:{P.META_BODY})[^.!?]*[.!?]\s*", "ius"), 0)
    opener = F.regexp_extract(text, P.java(rf"\A\s*(?:{P.META_BODY})", "iu"), 0)
    hit = F.when(sentence != "", sentence).otherwise(opener)
    return opens & ~echo_kept(hit)


def _always(gate: str, found: Column) -> Column:
    return found


def outline(text: Column, raw: Column, hinted: Callable[[str, Column], Column] = _always) -> Column:
    return (
        hinted("roman", F.regexp_count(text, F.lit(P.java(P.ROMAN_HEAD))) >= 2)
        | text.rlike(P.java(P.OUTLINE_INTRO))
        | hinted("bullet", text.rlike(P.java(P.INSTRUCTION_BULLET)))
        | hinted("sheet", text.rlike(P.java(P.SHEET_HEAD, "iu")))
        | (F.regexp_count(raw, F.lit(P.java(P.LETTER_BULLET))) >= 2)
        | (F.regexp_count(raw, F.lit(P.java(P.NUMBER_BULLET))) >= 2)
    )


def with_gates(rows: DataFrame, text_col: str = "text", raw_col: str | None = None, max_words: int = 240, known: Column | None = None) -> DataFrame:
    """rows with ``hard`` and ``soft``, arrays of the gates that fired, in the order of evaluation.

    text_col is normalised text; raw_col (text_col where None) keeps its
    lines. Null texts count as empty. known: struct of the text's foreign
    letters and hints (functions/hints.py), where it was looked through before.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = text if raw_col is None else F.coalesce(F.col(raw_col), F.lit(""))
    looked = (foreign_letters(text), F.lit(ALL)) if known is None else (known["foreign"], known["hints"])
    step = T.materialised(rows, "_t", text=text, raw=raw, words=T.tokens(text), stems=sentence_stems(text), foreign=looked[0], hints=looked[1])
    words = F.col("_t.words")
    # Where no digits are, the words of the share are the tokens.
    share = F.when(F.col("_t.text").rlike("[0-9]"), function_share(F.col("_t.text"))).otherwise(_share_of(words))
    step = T.materialised(step, "_g", share=share, grams=T.loop_hashes(words), cohesion=cohesion(F.col("_t.stems")))
    n, t, r = F.size(words), F.col("_t.text"), F.col("_t.raw")
    g8, g6 = F.col("_g.grams.g8"), F.col("_g.grams.g6")
    band = (n >= 40) & (n <= max_words)
    distinct6 = F.try_divide(F.size(F.array_distinct(g6)).cast("double"), F.size(g6).cast("double"))
    loop = (n >= 9) & T.repeats(F.slice(g8, F.lit(1), F.greatest(F.size(g8) - 1, F.lit(0))))
    foreign, share, cohesive = F.col("_t.foreign"), F.col("_g.share"), F.col("_g.cohesion")

    def hinted(gate: str, found: Column) -> Column:
        return F.when(F.col("_t.hints").bitwiseAND(BITS[gate]) != 0, found).otherwise(False)

    wide = foreign > F.greatest(F.lit(8.0), F.length(t) * 0.01)
    english = ~wide & ((foreign > 0) | (F.coalesce(share, F.lit(0.0)) >= 0.15))
    hard = (
        ("len", ~band),
        ("loop", loop),
        ("format", hinted("format", t.rlike(P.java(P.FORMAT, "iu")))),
        ("meta", about_story(t)),
        ("define", hinted("define", t.rlike(P.java(P.DEFINE, "iu")))),
        ("template", hinted("label", t.rlike(P.java(P.TEMPLATE_LABEL))) | t.rlike(P.java(P.TEMPLATE_HEAD))),
        ("outline", outline(t, r, hinted)),
        ("english", ~english),
        ("meta", lead_speech(t)),
        ("incoherent", cohesive < 0.10),
        ("screenplay", F.regexp_count(r, F.lit(P.java(P.SPEAKER))) >= 2),
    )
    soft = (
        ("len-edge", band & ((n < 55) | (n > max_words - 15))),
        ("loop-ish", (n >= 8) & (distinct6 < 0.85)),
        ("echo", (n >= 8) & T.repeats(g8)),
        ("diacritics", english & (foreign > 0)),
        ("english-low", english & (foreign == 0) & (share < 0.22)),
        ("coherence-low", (cohesive >= 0.10) & (cohesive < 0.15)),
    )

    def fired(gates: tuple[tuple[str, Column], ...]) -> Column:
        return F.array_distinct(F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in gates]), lambda x: x.isNotNull()))

    return T.materialised(step, "_f", hard=fired(hard), soft=fired(soft)).select(*rows.columns, F.col("_f.hard").alias("hard"), F.col("_f.soft").alias("soft"))


def verdict(hard: Column, prose: Column) -> Column:
    return F.when(F.size(hard) > 0, "failed").when(prose.isNotNull(), "style").otherwise("pass")
