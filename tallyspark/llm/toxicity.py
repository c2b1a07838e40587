"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all other text is unlabelled, a mixture
with an unknown part of positives.  A linear classifier in numpy minimises the risk

    prior * E_pos[loss(+f)] + max(0, E_unl[loss(-f)] - prior * E_pos[loss(-f)])

The bracket estimates the risk on negatives, which cannot be below zero: where a
batch makes it negative the step goes back on that part only (non-negative
correction).  The class prior is the share of toxic rows among labelled rows.

Features are the different words of a text and their beginnings of four to seven
bytes.  Words are found in executors, counted by Spark over the training sample, and
the ``MAX_FEATURES`` that speak most for the positives enter the model.  Scores are
calibrated on labelled training rows (Platt), weighted to the share of positives among
all usable labels, so 0.7 has a meaning.

Training reads a bounded sample: at most ``MAX_POSITIVE`` positives, about
``MAX_UNLABELLED`` unlabelled texts and ``MAX_LABELLED`` labelled rows for the
calibration, taken by a hash of the id.  Every text is scored, whole.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import crc32_of_id, small_batches, smallest_by_hash, utf8
from tallyspark.llm.decontamination import words_of
from tallyspark.session import materialize

MAX_POSITIVE = 3_000
MAX_UNLABELLED = 9_000
MAX_LABELLED = 6_000
MAX_FEATURES = 2_048
MIN_COUNT = 2
MIN_SHARE = 100  # a feature occurs in one of so many positives at least
STEMS = (4, 5, 6, 7)
DEFAULT_PRIOR = 0.1


def features_of(text: bytes) -> set[bytes]:
    """The different words, and their stems marked by a leading ``<``."""
    words = set(words_of(text))
    stems = {b"<" + w[:n] for w in words for n in STEMS if len(w) > n}
    return words | stems


@dataclass(frozen=True)
class Model:
    """Feature weights; the score is a logistic function of their sum."""

    weights: dict[bytes, float] = field(default_factory=dict)
    bias: float = 0.0
    slope: float = 1.0
    offset: float = -3.0

    def margin(self, text: bytes) -> float:
        weights = self.weights
        return self.bias + sum(weights[f] for f in features_of(text) & weights.keys())

    def score(self, margins: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * margins + self.offset)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


class _Rows:
    """Binary sparse rows: the features of row i are columns[starts[i]:starts[i+1]]."""

    def __init__(self, lists, width: int):
        sizes = np.array([len(x) for x in lists], np.int64)
        self.n, self.width = len(sizes), width
        self.row = np.repeat(np.arange(self.n), sizes)
        parts = [np.asarray(x, np.int64) for x in lists if len(x)]
        self.column = np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], minlength=self.n)

    def back(self, per_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, per_row[self.row], minlength=self.width)


def fit_nnpu(
    positive: _Rows, unlabelled: _Rows, prior: float, steps: int = 400, rate: float = 0.05, l2: float = 1e-3
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative PU risk with logistic loss (Adam)."""
    width = positive.width
    theta, mean, square = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    theta[-1] = np.log(prior / (1 - prior))
    for step in range(1, steps + 1):
        f_pos = positive.dot(theta[:-1]) + theta[-1]
        f_unl = unlabelled.dot(theta[:-1]) + theta[-1]
        # Derivatives of log(1 + exp(-f)) and log(1 + exp(f)), averaged over rows.
        up = -_sigmoid(-f_pos) / positive.n
        down_pos, down_unl = _sigmoid(f_pos) / positive.n, _sigmoid(f_unl) / unlabelled.n
        negative_risk = np.logaddexp(0, f_unl).mean() - prior * np.logaddexp(0, f_pos).mean()
        if negative_risk >= 0:
            per_pos, per_unl = prior * up - prior * down_pos, down_unl
        else:
            per_pos, per_unl = prior * down_pos, -down_unl
        grad = np.append(
            positive.back(per_pos) + unlabelled.back(per_unl) + l2 * theta[:-1],
            per_pos.sum() + per_unl.sum(),
        )
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        theta -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def fit_platt(
    margins: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, steps: int = 50
) -> tuple[float, float]:
    """Slope and offset of a logistic curve through labelled margins (ridge Newton).

    A row counts ``weights`` times, once by default.  Targets are drawn in a little
    from 0 and 1 so that separable rows stay finite.
    """
    weights = np.ones_like(margins) if weights is None else weights
    n_pos, n_neg = (weights * labels).sum(), (weights * (1 - labels)).sum()
    target = np.where(labels == 1, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(steps):
        p = _sigmoid(x @ beta)
        grad = x.T @ (weights * (p - target)) + 1e-3 * beta
        hess = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        beta = beta - np.clip(move, -2.0, 2.0)
        if np.abs(move).max() < 1e-8:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


def _sample(docs: DataFrame, labels: DataFrame, usable: Column) -> tuple[DataFrame, dict[int, float]]:
    """(text, toxic, unlabelled): the bounded training rows, read in one pass.

    And for how many usable labels one that was taken stands, by toxic.
    """
    known = (
        labels.select(F.col("doc_id").alias("_id"), "toxic")
        .where(F.col("_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("_id")
        .agg(F.max("toxic").alias("toxic"))
        .where(usable_id("_id"))
    )
    counted = lambda rows: {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    whole = counted(known)
    chosen = (
        smallest_by_hash(known.where("toxic = 1"), "_id", MAX_POSITIVE, whole.get(1, 0))
        .unionByName(smallest_by_hash(known, "_id", MAX_LABELLED, sum(whole.values()))).distinct()
    )
    # Positives are taken beyond the labelled sample.
    taken = counted(chosen)
    stands_for = {toxic: whole[toxic] / n for toxic, n in taken.items()}
    share = min(1.0, MAX_UNLABELLED / max(1, docs.count()))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("unlabelled")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    # At most MAX_POSITIVE + MAX_LABELLED rows of two numbers are broadcast.
    rows = (
        docs.select("doc_id", utf8("text").alias("text"))
        .where(usable)
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"), "left")
        .withColumn("unlabelled", F.coalesce(drawn, F.lit(False)))
        .where(F.col("unlabelled") | F.col("toxic").isNotNull())
        .select("text", "toxic", "unlabelled")
    )
    return rows, stands_for


def usable_id(column: str) -> Column:
    """Rows whose label may be learnt from: the others are held out."""
    return F.coalesce(crc32_of_id(column) % 3 != 1, F.lit(True))


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def _features(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: list(features_of(t)))


def _indices(names: list[bytes]):
    place = {name: i for i, name in enumerate(names)}

    @F.pandas_udf("array<int>")
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [place[f] for f in features_of(t) if f in place])

    return found


def _most_telling(sample: DataFrame, positives: int, unlabelled: int) -> list[bytes]:
    """Features that are more frequent in positives, by the likelihood ratio they give."""
    counts = (
        sample.select(
            (F.col("toxic") == 1).cast("int").alias("p"),
            F.col("unlabelled").cast("int").alias("u"),
            F.explode(_features("text")).alias("feature"),
        )
        .groupBy("feature")
        .agg(F.sum(F.coalesce("p", F.lit(0))).alias("p"), F.sum("u").alias("u"))
        .where(F.col("p") >= max(MIN_COUNT, positives // MIN_SHARE))
    )
    in_pos = (F.col("p") + 0.5) / F.lit(positives + 1.0)
    in_unl = (F.col("u") + 0.5) / F.lit(unlabelled + 1.0)
    gain = F.col("p") * F.log(in_pos / in_unl)
    best = counts.where(in_pos > in_unl).orderBy(F.desc(gain), "feature").limit(MAX_FEATURES)
    return [bytes(r["feature"]) for r in best.collect()]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from labelled rows that are not held out.

    ``labels`` has doc_id and toxic (0 or 1; others and null are ignored, of repeated
    ids the larger counts).  Without positives or unlabelled texts the model has
    no features and gives every text the same low score.
    """
    small_batches(docs.sparkSession)
    taken, stands_for = _sample(docs, labels, usable_id("doc_id"))
    sample = materialize(taken, "toxicity-sample")
    sizes = sample.agg(
        F.expr("count_if(toxic = 1)"), F.expr("count_if(unlabelled)"), F.count("toxic")
    ).first()
    positives, unlabelled, labelled = sizes
    if not positives or not unlabelled:
        return Model()
    names = _most_telling(sample, positives, unlabelled)
    # Bounded by the sample: row count times MAX_FEATURES small numbers.
    rows = sample.select("toxic", "unlabelled", _indices(names)("text").alias("found")).toPandas()
    is_pos = rows.toxic == 1
    known = rows.toxic.notna()
    negatives = int((known & ~is_pos).sum())
    prior = DEFAULT_PRIOR
    if negatives:
        # Positives are taken beyond the labelled sample, so the prior is read from labels.
        prior = _prior(labels)
    pick = lambda mask: _Rows(list(rows.found[mask]), len(names))
    weights, bias = fit_nnpu(pick(is_pos), pick(rows.unlabelled), prior)
    weights[np.abs(weights) < 1e-3] = 0.0
    model = Model({n: float(w) for n, w in zip(names, weights, strict=True) if w}, bias)
    if not negatives:
        return Model(model.weights, bias, 1.0, 0.0)
    margins = _Rows(list(rows.found[known]), len(names)).dot(weights) + bias
    # So many positives as there are among all labels: the threshold means the same for any number.
    counts = rows.toxic[known].map(stands_for).to_numpy().astype(float)
    slope, offset = fit_platt(margins, is_pos[known].to_numpy().astype(float), counts / counts.mean())
    return Model(model.weights, bias, slope, offset)


def _prior(labels: DataFrame) -> float:
    share = labels.where(usable_id("doc_id") & F.col("toxic").isin(0, 1)).agg(F.avg("toxic")).first()[0]
    return min(0.5, max(0.001, share or DEFAULT_PRIOR))


def toxicity(model: Model, text: Column) -> Column:
    """The score of a binary column, 0 to 1."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([model.margin(t) for t in texts], float)))

    return score(text)


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Null and empty texts have no features and get the score of the bias.  Rows
    without id are never learnt from.  Repeated rows are all scored.
    """
    model = fit(docs, labels)
    return docs.select(
        "doc_id",
        (~usable_id("doc_id")).alias("held_out"),
        toxicity(model, utf8("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with their columns."""
    model = fit(docs, labels)
    return docs.where(toxicity(model, utf8("text")) < threshold)
