"""Quality: a sparse ensemble of rules over text statistics.

Boosted shallow trees propose conjunctive rules (the paths from a root to each
node); a logistic model with a lasso penalty over the rules keeps few of them;
the kept rules are compiled into one Spark column expression. Statistics are
Spark expressions as well, so scoring runs without Python. The trees see a
bounded, balanced sample of the labelled rows (``sample`` a class, by a hash
of the id), and the intercept is set back to the class rates of all of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.llm.labels import balanced_sample, known_labels

#: Listed one by one: a class of single characters is matched by a bit table.
_SYMBOLS = r"#$%&'()*+/<=>@\[\\\]\^_`{|}~"


@dataclass(frozen=True)
class Condition:
    stat: str
    above: bool
    cut: float


@dataclass(frozen=True)
class RuleModel:
    """score = sigmoid(bias + sum of the weights of the rules that hold)."""

    rules: tuple[tuple[Condition, ...], ...]
    weights: tuple[float, ...]
    bias: float


def _counts(text: Column) -> dict[str, Column]:
    def of_class(letters: str) -> Column:
        return F.length(F.regexp_replace(text, f"[^{letters}]++", ""))

    words, lines = F.split(text, r"\s++"), F.split(text, r"\n")
    return {
        "n_chars": F.length(text),
        "n_bytes": F.octet_length(text),
        "n_words": F.size(words),
        "n_distinct_words": F.size(F.array_distinct(words)),
        "n_lines": F.size(lines),
        "n_distinct_lines": F.size(F.array_distinct(lines)),
        "n_upper": of_class("A-Z"),
        "n_digits": of_class("0-9"),
        "n_marks": of_class(r".,;:!?"),
        "n_symbols": of_class(_SYMBOLS),
    }


def _rates() -> dict[str, Column]:
    c = {k: F.col(f"q.{k}").cast("double") for k in _counts(F.lit(""))}
    chars, words, lines = F.greatest(c["n_chars"], F.lit(1.0)), c["n_words"], c["n_lines"]
    return {
        "chars": c["n_chars"],
        "words": words,
        "lines": lines,
        "word_length": c["n_chars"] / words,
        "words_a_line": words / lines,
        "distinct_words": c["n_distinct_words"] / words,
        "distinct_lines": c["n_distinct_lines"] / lines,
        "upper": c["n_upper"] / chars,
        "digits": c["n_digits"] / chars,
        "marks": c["n_marks"] / chars,
        "symbols": c["n_symbols"] / chars,
        "wide": (c["n_bytes"] - c["n_chars"]) / chars,
    }


STATS = ("chars", "words", "lines", "word_length", "words_a_line", "distinct_words", "distinct_lines", "upper", "digits", "marks", "symbols", "wide")


def with_statistics(docs: DataFrame, text_col: str = "text", into: str = "q") -> DataFrame:
    """docs with a struct column ``into`` of the statistics of each whole text; null is the empty text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.withColumn("q", F.struct(*[v.alias(k) for k, v in _counts(text).items()]))
    rated = counted.withColumn("q", F.struct(*[v.alias(k) for k, v in _rates().items()]))
    return rated if into == "q" else rated.withColumnRenamed("q", into)


def _tree(binned: np.ndarray, slope: np.ndarray, curve: np.ndarray, depth: int, least: int, ridge: float) -> tuple[list[tuple[tuple[int, bool, int], ...]], np.ndarray]:
    """Paths to all nodes of one regression tree, and its value for every row."""
    paths: list[tuple[tuple[int, bool, int], ...]] = []
    value = np.zeros(len(slope))

    def grow(rows: np.ndarray, path: tuple[tuple[int, bool, int], ...]) -> None:
        g, h = slope[rows].sum(), curve[rows].sum()
        value[rows] = -g / (h + ridge)
        if path:
            paths.append(path)
        if len(path) == depth or len(rows) < 2 * least:
            return
        best, where = 1e-6, None
        for f in range(binned.shape[1]):
            b = binned[rows, f]
            n, gs, hs = (np.cumsum(np.bincount(b, w, 65))[:-1] for w in (None, slope[rows], curve[rows]))
            gain = gs**2 / (hs + ridge) + (g - gs) ** 2 / (h - hs + ridge) - g**2 / (h + ridge)
            gain[(n < least) | (len(rows) - n < least)] = -1
            k = int(np.argmax(gain))
            if gain[k] > best:
                best, where = float(gain[k]), (f, k)
        if where is None:
            return
        f, k = where
        over = binned[rows, f] > k
        grow(rows[~over], (*path, (f, False, k)))
        grow(rows[over], (*path, (f, True, k)))

    grow(np.arange(len(slope)), ())
    return paths, value


def _lasso(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic lasso by accelerated proximal steps; the intercept is free."""
    n = len(y)
    x = np.column_stack([x, np.ones(n)])
    step = 4 * n / max(1.0, np.linalg.norm(x, 2) ** 2)
    w = ahead = np.zeros(x.shape[1])
    t = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -60, 60)))
        moved = ahead - step * (x.T @ (p - y)) / n
        moved[:-1] = np.sign(moved[:-1]) * np.maximum(np.abs(moved[:-1]) - step * penalty, 0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = moved + (t - 1) / t_next * (moved - w)
        w, t = moved, t_next
    return w[:-1], float(w[-1])


def train_rules(values: np.ndarray, labels: np.ndarray, rate: float, trees: int = 40, depth: int = 3, rate_of_learning: float = 0.3, least: int = 10, penalty: float = 1e-3) -> RuleModel:
    """Fit on a matrix whose columns are STATS. rate: share of label 1 among all labelled rows.

    With one class only, or no rows, the model is the constant rate.
    """
    y = np.asarray(labels, np.float64)
    rate = min(max(rate, 1e-6), 1 - 1e-6)
    prior = float(np.log(rate / (1 - rate)))
    if not 0 < y.sum() < len(y):
        return RuleModel((), (), prior)
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, 65)[1:-1])) for column in values.T]
    binned = np.column_stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, values.T, strict=True)])
    margin, found = np.zeros(len(y)), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        paths, value = _tree(binned, p - y, p * (1 - p), depth, least, 1.0)
        found |= dict.fromkeys(tuple(sorted(path)) for path in paths)
        margin += rate_of_learning * value
    columns, rules = [], []
    for path in found:
        held = reduce(and_, [(binned[:, f] > k) == above for f, above, k in path])
        if 0 < held.sum() < len(y):
            columns.append(held)
            rules.append(tuple(Condition(STATS[f], above, float(cuts[f][k])) for f, above, k in path))
    if not rules:
        return RuleModel((), (), prior)
    weights, bias = _lasso(np.column_stack(columns).astype(np.float64), y, penalty)
    share = y.mean()
    kept = [(r, float(w)) for r, w in zip(rules, weights, strict=True) if w]
    return RuleModel(tuple(r for r, _ in kept), tuple(w for _, w in kept), float(bias + prior - np.log(share / (1 - share))))


def fit_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", usable: Column | None = None, sample: int = 5_000, id_col: str = "doc_id", text_col: str = "text", **options) -> RuleModel:
    """Fit on at most ``sample`` labelled rows a class; usable: condition on column doc_id for rows to learn from.

    Only their statistics come to the driver. Of several labels of an id the
    largest holds; null labels and ids are left out. No labelled rows give the
    constant score 0.5.
    """
    some, rate = balanced_sample(known_labels(labels, label, usable, id_col), sample)
    picked = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).join(F.broadcast(some), F.col("doc") == F.col("sample_id"))
    rows = with_statistics(picked.select("doc", "y", "text")).select("doc", "y", *[f"q.{s}" for s in STATS]).distinct().toPandas().sort_values(["doc", *STATS])
    return train_rules(rows[list(STATS)].to_numpy(np.float64), rows["y"].to_numpy(), rate, **options)


def rule_score(model: RuleModel, stats: str = "q") -> Column:
    """The model as a column expression over a struct column of statistics."""

    def holds(c: Condition) -> Column:
        stat = F.col(f"{stats}.{c.stat}")
        return stat > c.cut if c.above else stat <= c.cut

    total = F.lit(model.bias)
    for rule, weight in zip(model.rules, model.weights, strict=True):
        total = total + F.when(reduce(and_, map(holds, rule)), weight).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def score_quality(docs: DataFrame, labels: DataFrame, usable: Column | None = None, text_col: str = "text", score_col: str = "score", **options) -> DataFrame:
    """docs with a column of scores in 0 to 1, fitted on the labelled rows that ``usable`` admits.

    Rows are neither dropped nor multiplied; null and empty texts have the
    statistics of a text without characters. A column of docs named like the
    score is replaced, and one named like the internal struct is kept.
    """
    model = fit_rules(docs, labels, usable=usable, text_col=text_col, **options)
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    scored = with_statistics(kept).withColumn("out", rule_score(model))
    others = [F.col(f"row.`{c}`") for c in docs.columns if c != score_col]
    return scored.select(*others, F.col("out").alias(score_col))
