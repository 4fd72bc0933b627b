"""Scores and rankings: AUC, judge probability, paired wins, intervals, and shallow probes over embeddings."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.operators.sampling import running_total

#: A value above this one lets the teacher pass (fixed value).
GO = 0.85


def auc(rows: DataFrame, label: str, score: str) -> DataFrame:
    """One row (auc): probability that a row of label 1 scores over one of label 0, ties as half; null with one class.

    Rows are first counted by score, and the running sums go by ranges of the scores.
    """
    counted = rows.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(F.col(score).alias("s")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    wins = running_total(counted, "s", F.col("n"), "below").agg(F.sum(F.col("p") * (F.col("below") + F.col("n") / 2)).alias("w"), F.sum("p").alias("p"), F.sum("n").alias("n"))
    return wins.select(F.try_divide(F.col("w"), (F.col("p") * F.col("n")).cast("double")).alias("auc"))


def decision(value: Column, otherwise: str = "WEAK") -> Column:
    """GO above the limit; else WEAK for an AUC, or STOP for a win rate of matched pairs."""
    return F.when(value > GO, "GO").otherwise(otherwise)


def judge_probability(tokens: DataFrame, key: str = "sentence") -> DataFrame:
    """(key, p) from (key, token, logprob): mass of tokens that begin with G against S; null where both have none."""
    start = F.substring(F.upper(F.trim("token")), 1, 1)
    mass = tokens.groupBy(key).agg(*[F.coalesce(F.sum(F.when(start == c, F.exp("logprob"))), F.lit(0.0)).alias(c) for c in "GS"])
    return mass.select(key, F.when(F.col("G") + F.col("S") > 1e-9, F.col("G") / (F.col("G") + F.col("S"))).alias("p"))


def paragraph_scores(paragraphs: DataFrame, probabilities: DataFrame, key: str = "k") -> DataFrame:
    """(key, score): mean judge probability over a paragraph's eligible sentences, or that of its whole text where none is.

    probabilities: (sentence, p). A paragraph without any known probability has a null score.
    """
    from prosemill.functions.text import sentences
    from prosemill.operators.acceptance import eligible

    asked = F.array_distinct(eligible(sentences(F.col("text"))))
    parts = paragraphs.select(key, F.explode(F.when(F.size(asked) > 0, asked).otherwise(F.array("text"))).alias("sentence"))
    return parts.join(probabilities.select("sentence", "p"), "sentence", "left").groupBy(key).agg(F.avg("p").alias("score"))


def paired_wins(pairs: DataFrame, scores: DataFrame) -> DataFrame:
    """One row (n, win_rate, median_margin, decision) of pairs (kf, kg) whose second should score higher; pairs without both scores are left out.

    Margins are counted by value; the median (the element at n // 2) is found by running totals over ranges of them.
    """
    f, g = (scores.select(F.col("k").alias(k), F.col("s").alias(s)) for k, s in (("kf", "sf"), ("kg", "sg")))
    margin = pairs.join(f, "kf").join(g, "kg").select((F.col("sg") - F.col("sf")).alias("d")).filter("d is not null")
    counted = running_total(margin.groupBy("d").agg(F.count("*").alias("c")), "d", F.col("c"), "before")
    totals = counted.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), (F.sum(F.when(F.col("d") > 0, F.col("c")).otherwise(0)) / F.sum("c")).alias("win_rate"))
    half = F.floor(F.col("n") / 2)
    middle = counted.crossJoin(F.broadcast(totals)).filter((F.col("before") <= half) & (half < F.col("before") + F.col("c"))).select(F.col("d").alias("median_margin"))
    return totals.join(middle, F.lit(True), "left").select("n", "win_rate", "median_margin", decision(F.col("win_rate"), "STOP").alias("decision"))


def flag_rate(rows: DataFrame, score: str = "score", threshold: float = 0.12) -> DataFrame:
    return rows.agg(F.count("*").alias("n"), F.count_if(F.col(score).isNull()).alias("n_missing"), F.avg((F.col(score) >= threshold).cast("double")).alias("flag_rate"), F.avg(score).alias("mean_score"))


#: Cumulative probabilities of a Poisson number of mean 1 (fixed values).
_POISSON = (0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582, 0.99991676)


def bootstrap_interval(rows: DataFrame, score: str, key: str, rounds: int = 2000, seed: int = 7) -> DataFrame:
    """One row (low, high): 95 % interval of the mean of all scores that are not null, by Poisson weights from hashes of key and round.

    A task adds up the weighted sums of every round over its own rows, so
    what is shuffled is a row a round and task.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        total, weight = np.zeros(rounds), np.zeros(rounds)
        for batch in batches:
            values, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            for at in range(0, len(values), 512):
                x = marks[at : at + 512, None] ^ salt
                x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
                x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
                times = np.searchsorted(_POISSON, (x >> np.uint64(11)) * 2.0**-53, "right")
                total += values[at : at + 512] @ times
                weight += times.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(rounds)), pa.array(total), pa.array(weight)], ["round", "total", "weight"])

    ready = rows.filter(F.col(score).isNotNull()).select(F.col(score).cast("double"), F.xxhash64(F.lit(seed), F.col(key)))
    means = ready.mapInArrow(sums, "round long, total double, weight double").groupBy("round").agg(F.try_divide(F.sum("total"), F.sum("weight")).alias("m"))
    return means.agg(F.percentile("m", 0.025).alias("low"), F.percentile("m", 0.975).alias("high"))


def percentiles(rows: DataFrame, by: str, value: str) -> DataFrame:
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.percentile(value, 0.5).alias("median"), F.percentile(value, 0.9).alias("p90"))


def normalised(vector: Column) -> Column:
    """Unit vector in double precision; a zero vector stays zero."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(wide, lambda x: F.when(norm > 0, x / norm).otherwise(0.0))


def spearman(rows: DataFrame, a: str, b: str) -> DataFrame:
    """One row (rho): correlation of average ranks. Ranks are taken over distinct values, as in auc."""

    def ranks(column: str) -> DataFrame:
        counted = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias(f"v_{column}")).agg(F.count("*").alias("c"))
        below = running_total(counted, f"v_{column}", F.col("c"), "before")
        return below.select(f"v_{column}", (F.col("before") + (F.col("c") + 1) / 2).alias(f"r_{column}"))

    both = rows.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    joined = both.join(ranks(a), F.col(a) == F.col(f"v_{a}")).join(ranks(b), F.col(b) == F.col(f"v_{b}"))
    return joined.agg(F.corr(f"r_{a}", f"r_{b}").alias("rho"))


def _features(rows: DataFrame, vector: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return rows.withColumn("features", array_to_vector(normalised(F.col(vector))))


def at_once(fit: Callable[..., DataFrame], settings: Iterable) -> list[DataFrame]:
    """fit of every setting, side by side: a fit is many short jobs one after another, which leave most cores idle."""
    settings = list(settings)
    with ThreadPoolExecutor(max(len(settings), 1)) as pool:
        return list(pool.map(inheritable_thread_target(fit), settings))


def probe(rows: DataFrame, key: str, vector: str, label: str, head: str = "logistic", k: int = 5, seed: int = 7) -> DataFrame:
    """(fold, auc) of a classifier head under cross-validation; head: logistic, network or trees."""
    from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
    from pyspark.ml.functions import vector_to_array

    from prosemill.operators.sampling import folds

    ready = _features(folds(rows, key, label, k, seed), vector).select(key, "fold", F.col(label).cast("double").alias("label"), "features").persist()
    size = len(ready.first()["features"]) if not ready.isEmpty() else 0
    makers = {
        "logistic": lambda: LogisticRegression(regParam=0.01, maxIter=100),
        "network": lambda: MultilayerPerceptronClassifier(layers=[size, 64, 2], maxIter=100, seed=seed),
        "trees": lambda: GBTClassifier(maxIter=20, maxDepth=3, seed=seed),
    }

    def judged(fold: int) -> DataFrame:
        model = makers[head]().fit(ready.filter(F.col("fold") != fold))
        scored = model.transform(ready.filter(F.col("fold") == fold)).withColumn("p", vector_to_array("probability")[1])
        return auc(scored, "label", "p").withColumn("fold", F.lit(fold))

    out, *parts = at_once(judged, range(k))
    for part in parts:
        out = out.unionByName(part)
    return out.select("fold", "auc")


def contrast(rows: DataFrame, source: str, positive: str, negative: str, length: str | None = None, slack: int = 10) -> DataFrame:
    """Rows of two sources with y (1 for the positive one); with a length column only lengths that both have, by bins of slack."""
    pair = rows.filter(F.col(source).isin(positive, negative)).withColumn("y", (F.col(source) == positive).cast("int"))
    if length is None:
        return pair
    binned = pair.withColumn("_bin", F.floor(F.col(length) / slack))
    both = binned.groupBy("_bin").agg(F.count_distinct("y").alias("n")).filter("n = 2").select("_bin")
    return binned.join(both, "_bin", "left_semi").drop("_bin")


def gold_auc(train: DataFrame, gold: DataFrame, vector: str, label: str) -> DataFrame:
    """One row (auc) of the logistic head, fitted on train, over held-out gold rows."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array

    model = LogisticRegression(regParam=0.01, maxIter=100).fit(_features(train, vector).select("features", F.col(label).cast("double").alias("label")))
    scored = model.transform(_features(gold, vector)).withColumn("_p", vector_to_array("probability")[1])
    return auc(scored, label, "_p")


def distil(rows: DataFrame, key: str, vector: str, target: str, head: str = "ridge", seed: int = 7) -> DataFrame:
    """One row (rho, mae) on the 30 % held out by hash, of a regressor of a score; head: ridge or trees."""
    from pyspark.ml.regression import GBTRegressor, LinearRegression

    ready = _features(rows, vector).withColumn("label", F.col(target).cast("double")).withColumn("_held", F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(10)) < 3)
    learner = LinearRegression(regParam=1.0, elasticNetParam=0.0) if head == "ridge" else GBTRegressor(maxIter=20, maxDepth=3, seed=seed)
    scored = learner.fit(ready.filter(~F.col("_held"))).transform(ready.filter("_held")).select("label", "prediction")
    return spearman(scored, "label", "prediction").crossJoin(scored.agg(F.avg(F.abs(F.col("label") - F.col("prediction"))).alias("mae")))
