"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature is the presence of a hashed n-gram of code points in the lower-cased
text, white space collapsed. Its value is the log ratio of its smoothed
document rates in the two classes; a logistic model with an L2 penalty is
fitted over these values. The fit uses a bounded, balanced sample of the
labelled rows (``sample`` rows a class of at most ``max_chars`` characters, in
the order of a hash of the id), and its intercept is set back to the class
rates of all labelled rows. Scoring reads every whole text and needs no
shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from prosemill.llm.labels import balanced_sample, known_labels
from prosemill.llm.runtime import release

_CHUNK = 1 << 17


@dataclass(frozen=True)
class NgramModel:
    """Nonzero weights by hashed n-gram; weight is ratio times fitted coefficient."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    orders: tuple[int, ...]
    bits: int

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << self.bits, np.float32)
        table[self.features] = self.weights
        return table


def _segments(texts: Sequence[str | None], overlap: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Code points of the normalised texts, in chunks; a long text goes on in overlapping segments."""
    docs: list[int] = []
    parts: list[np.ndarray] = []
    size = 0
    for i, text in enumerate(texts):
        flat = " " + " ".join((text or "").lower().split()) + " "
        for at in range(0, max(1, len(flat) - overlap), _CHUNK):
            points = np.frombuffer(flat[at : at + _CHUNK + overlap].encode("utf-32-le", "surrogatepass"), "<u4")
            docs.append(i)
            parts.append(points)
            size += len(points)
            if size >= _CHUNK:
                yield docs, parts
                docs, parts, size = [], [], 0
    if docs:
        yield docs, parts


def _present(texts: Sequence[str | None], orders: tuple[int, ...], bits: int, live: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Sorted distinct keys (text index << bits | feature) of the n-grams in each chunk; live keeps some features only."""
    for docs, parts in _segments(texts, max(orders) - 1):
        points = np.concatenate(parts)
        segment = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        owner = np.array(docs, np.int64)
        rolling, keys = np.zeros(len(points), np.uint32), []
        for n in range(1, max(orders) + 1):
            if n > len(points):
                break
            rolling = rolling[: len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1 :]
            if n not in orders:
                continue
            mixed = (rolling ^ (rolling >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
            feature = (mixed * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)
            whole = segment[: len(feature)] == segment[n - 1 :]
            spot = np.flatnonzero(whole if live is None else whole & live[feature])
            keys.append(owner[segment[spot]] << bits | feature[spot].astype(np.int64))
        yield np.unique(np.concatenate(keys)) if keys else np.array([], np.int64)


def _pairs(texts: Sequence[str | None], orders: tuple[int, ...], bits: int, live: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """As _present, but a text whose segments lie in several chunks has each of its features once."""
    held = np.array([], np.int64)
    for keys in _present(texts, orders, bits, live):
        keys = np.union1d(held, keys) if len(held) else keys
        open_from = np.searchsorted(keys, (keys[-1] >> bits) << bits) if len(keys) else 0
        held = keys[open_from:]
        yield keys[:open_from]
    yield held


def _minimise(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, rounds: int = 80, memory: int = 8) -> np.ndarray:
    """L-BFGS with backtracking."""
    value, slope = loss(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, steps = slope.copy(), []
        for s, y in reversed(past):
            a = (s @ q) / (s @ y)
            q -= a * y
            steps.append(a)
        if past:
            s, y = past[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(past, reversed(steps), strict=True):
            q += (a - (y @ q) / (s @ y)) * s
        size, fall = 1.0 if past else 1 / max(1.0, float(np.abs(q).sum())), float(slope @ q)
        while size > 1e-12:
            after, new_slope = loss(x - size * q)
            if after <= value - 1e-4 * size * fall:
                break
            size /= 2
        else:
            break
        s, y = -size * q, new_slope - slope
        gain = value - after
        x, value, slope = x + s, after, new_slope
        if s @ y > 1e-12:
            past = [*past, (s, y)][-memory:]
        if gain < 1e-7 * abs(value):
            break
    return x


def _chosen(texts: Sequence[str | None], y: np.ndarray, orders: tuple[int, ...], bits: int, keep: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted features of the greatest weights that ``least`` texts have, and their log ratios."""
    counts = np.zeros((2, 1 << bits), np.int32)
    for keys in _pairs(texts, orders, bits):
        for c in (0, 1):
            counts[c] += np.bincount((keys & ((1 << bits) - 1))[y[keys >> bits] == c], minlength=1 << bits)
    spot = np.flatnonzero(counts.sum(0) >= least)
    counts = counts[:, spot]
    rates = (counts + 1) / (np.array([[len(y) - y.sum()], [y.sum()]]) + 2)
    ratio = np.log(rates[1] / rates[0])
    weight = np.abs(ratio) * np.sqrt(counts.sum(0))
    best = np.sort(np.argsort(-weight, kind="stable")[:keep])
    best = best[weight[best] > 0]
    return spot[best], ratio[best]


def train_ngrams(texts: Sequence[str | None], labels: Sequence[int], rate: float, orders: tuple[int, ...] = (3, 4, 5, 6), bits: int = 20, keep: int = 30_000, least: int = 3, penalty: float = 1.0) -> NgramModel:
    """Fit on texts in memory. rate: share of label 1 among all labelled rows, for the intercept.

    With one class only (or no text) the model is the constant rate.
    """
    y = np.asarray(labels, np.float64)
    rate = min(max(rate, 1e-6), 1 - 1e-6)
    prior = float(np.log(rate / (1 - rate)))
    if not 0 < y.sum() < len(y):
        return NgramModel(np.array([], np.int64), np.array([], np.float32), prior, orders, bits)
    chosen, ratio = _chosen(texts, y, orders, bits, keep, least)
    live, place, mask = np.zeros(1 << bits, bool), np.zeros(1 << bits, np.int32), (1 << bits) - 1
    live[chosen], place[chosen] = True, np.arange(len(chosen))
    blocks = [((keys >> bits).astype(np.int32), place[keys & mask]) for keys in _pairs(texts, orders, bits, live)]

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        scaled, margin, slope = ratio * x[:-1], np.full(len(y), x[-1]), np.zeros(len(chosen))
        for row, column in blocks:
            margin += np.bincount(row, scaled[column], len(y))
        p = 1 / (1 + np.exp(-np.clip(margin, -60, 60)))
        for row, column in blocks:
            slope += np.bincount(column, (p - y)[row], len(chosen))
        cost = np.logaddexp(0, margin).sum() - y @ margin + penalty * (x[:-1] @ x[:-1]) / 2
        return float(cost), np.append(ratio * slope + penalty * x[:-1], (p - y).sum())

    x = _minimise(loss, np.zeros(len(chosen) + 1))
    share = y.mean()
    bias = float(x[-1] + prior - np.log(share / (1 - share)))
    return NgramModel(chosen, (x[:-1] * ratio).astype(np.float32), bias, orders, bits)


def fit_ngrams(docs: DataFrame, labels: DataFrame, label: str = "toxic", usable: Column | None = None, sample: int = 1_500, max_chars: int = 20_000, id_col: str = "doc_id", text_col: str = "text", **options) -> NgramModel:
    """Fit on at most ``sample`` labelled rows a class, each of at most max_chars characters.

    usable: condition on column doc_id for rows to learn from. Of several
    labels of an id the largest holds; null labels and ids are left out. No
    labelled rows give the constant score of rate 0.5. The driver gives the
    memory of the fit back.
    """
    some, rate = balanced_sample(known_labels(labels, label, usable, id_col), sample)
    texts = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).filter(F.length("text") <= max_chars)
    rows = texts.join(F.broadcast(some), F.col("doc") == F.col("sample_id")).groupBy("sample_id", "y").agg(F.min("text").alias("text")).toPandas().sort_values("sample_id")
    model = train_ngrams(rows["text"].tolist(), rows["y"].tolist(), rate, **options)
    del rows
    release()
    return model


def ngram_score(model: NgramModel, text: Column) -> Column:
    """Probability of label 1 for a text column; null and empty texts are scored as texts without words."""

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = model.dense()
        live, mask = table != 0, (1 << model.bits) - 1
        for texts in batches:
            margin = np.full(len(texts), model.bias)
            for keys in _pairs(texts.tolist(), model.orders, model.bits, live):
                margin += np.bincount(keys >> model.bits, table[keys & mask], len(texts))
            yield pd.Series(1 / (1 + np.exp(-np.clip(margin, -60, 60))))

    return score(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, usable: Column | None = None, text_col: str = "text", score_col: str = "score", **options) -> DataFrame:
    """docs with a column of scores in 0 to 1, fitted on the labelled rows that ``usable`` admits.

    Rows are neither dropped nor multiplied; ids that are null or repeated are
    scored like others, and equal texts get equal scores. A column of docs
    named like the score is replaced.
    """
    model = fit_ngrams(docs, labels, usable=usable, text_col=text_col, **options)
    return docs.withColumn(score_col, ngram_score(model, F.col(text_col)))
