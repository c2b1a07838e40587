"""Mixing to target weights with soft domain membership.

A classifier trained on a labelled table gives each document a probability for every
domain.  A document with n tokens then holds n * p(domain) expected tokens of each
domain.  Non-negative rates per document are fitted so that the rated token totals
of the domains meet targets:

    minimise  sum over domains of (sum_i rate_i n_i p_i(d) - target_d)^2 / whole_d,   0 <= rate <= max_rate

by projected gradient.  A step is a combination of a document's probabilities: the
residual through the inverse Gram matrix of the rows that can still move (d x d sums of
the same job), damped by that of all rows, which is the gradient in a scale in which a
step undoes the residual.  Steps add up, and the sum is projected: a rate is its start less
the sum of its steps, clipped to the bounds.  Of several dampings the one that lowers the
misfit most is taken.  All dampings, and the totals
that are tried together, share one aggregation a step; a few numbers reach the driver.  A document's
rate is one clipped linear expression over its own probabilities and a literal: nothing is
kept between the steps, and no code is compiled for a new one.

Everything is column expressions and Spark's own models; no Python on executors.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import smallest_by_hash
from tallyspark.session import materialize

# Labelled rows read for training: at most so many of each domain, by a hash of the id.
MAX_PER_DOMAIN = 1_500
WORD_BUCKETS = 1 << 12
#: Targets count as met where no domain's total misses by more than this part of all tokens.
TOLERANCE = 1e-4
#: A total is given up when a step lowers its misfit by less than this part: while totals
#: are tried, and for the one that is returned without its targets met.
SLOW, STALLED = 0.2, 1e-2
#: Parts of the Gram matrix of all rows that are added to that of the rows that can move.
DAMPINGS = (0.0, 0.01, 0.1, 1.0)
#: Without a total given: the parts of the most the scarcest domain allows that are tried;
#: the largest that meets the targets counts.  If none does, the nearest, and the larger
#: of two that differ by TOLERANCE at most.
PARTS = (1.0, 0.99, 0.97, 0.94, 0.9, 0.85, 0.75, 0.6)
#: So many of them share the aggregations of a descent.
AT_A_TIME = 2


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def _shape(text: Column) -> dict[str, Column]:
    """How a text looks: shares of kinds of characters, lengths."""
    size = F.length(text)
    # Only what is counted matches, so most of a text is merely looked at.
    found = lambda pattern: size - F.length(F.regexp_replace(text, pattern, ""))
    words = F.size(F.col("_m_words"))
    lines = size - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return {
        "signs": _ratio(found(r"[%&*$#|!~^_=<>{}\[\]\\/+@]+"), size),
        "capitals": _ratio(found(r"\p{Lu}+"), size),
        "digits": _ratio(found(r"[0-9]+"), size),
        "spaces": _ratio(size - _solid(F.col("_m_spaced")), size),
        "length": F.log1p(size),
        "word_length": _ratio(size, words),
        "line_words": F.log1p(_ratio(words, lines)),
    }


def _features(docs: DataFrame) -> DataFrame:
    """Rows with ``_m_text``: word buckets and shape columns for the model."""
    text = F.col("_m_text")
    made = {"_m_words": words_of, "_m_spaced": spaced}
    worded = docs.withColumns({k: f(text) for k, f in made.items() if k not in docs.columns})
    shapes = {f"_m_{k}": v.cast("double") for k, v in _shape(text).items()}
    return worded.withColumns({**shapes, "_m_buckets": buckets_of(F.col("_m_words"))})


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits of any script."""
    # a-z and 0-9 are letters and digits too; named first they are settled at once.
    return F.array_remove(F.split(F.lower(text), r"[^a-z0-9\p{L}\p{N}]+"), "")


def buckets_of(words: Column) -> Column:
    """The different hash buckets of the words."""
    return F.array_distinct(F.transform(words, lambda w: F.pmod(F.hash(w), F.lit(WORD_BUCKETS))))


def spaced(text: Column) -> Column:
    """The text with one space for every run of white space (of any script)."""
    return F.regexp_replace(text, r"(?U)\s+", " ")


def _solid(spaced: Column) -> Column:
    """The number of characters that are not white space."""
    return F.length(F.replace(spaced, F.lit(" "), F.lit("")))


def _runs(spaced: Column) -> Column:
    trimmed = F.trim(spaced)
    return F.when(trimmed == "", 0).otherwise(F.length(trimmed) - _solid(trimmed) + 1).cast("long")


def count_tokens(text: Column) -> Column:
    """Runs of characters that are not white space."""
    return _runs(spaced(text))


def _summed_weights(words: list[float]) -> Column:
    """The weights of a text's buckets, from a literal: the same code whatever the numbers."""
    weights = F.from_json(F.lit(json.dumps(words)), "array<double>")
    return F.aggregate("_m_buckets", F.lit(0.0), lambda s, b: s + weights[b])


@dataclass(frozen=True)
class DomainModel:
    """Gives probabilities of ``domains``.

    ``known`` are the places of the domains with labelled texts; the others have
    probability 0.  Without ``weights`` the known ones are as likely as each other.
    ``weights`` has for each known domain the offset, one weight for each shape of a text
    (by its mean and deviation taken in) and one for each bucket of words.
    """

    domains: list[str]
    known: list[int]
    weights: list[tuple[float, dict[str, float], list[float]]] | None

    def memberships(self, docs: DataFrame, out: str) -> DataFrame:
        """``docs`` (with ``_m_text``) and an array of probabilities in ``out``."""
        if self.weights is None:
            share = [1.0 / len(self.known) if d in self.known else 0.0 for d in range(len(self.domains))]
            return docs.withColumn(out, F.array(*[F.lit(x) for x in share]))
        scores = []
        for offset, shape, words in self.weights:
            score = F.lit(offset) + _summed_weights(words)
            for name, weight in shape.items():
                score = score + F.lit(weight) * F.col(name)
            scores.append(score)
        made = _features(docs).withColumn("_m_scores", F.array(*scores))
        largest = F.array_max("_m_scores")
        made = made.withColumn("_m_odds", F.transform("_m_scores", lambda s: F.exp(s - largest)))
        whole = F.aggregate("_m_odds", F.lit(0.0), lambda a, b: a + b)
        place = {d: i for i, d in enumerate(self.known)}
        odds = F.col("_m_odds")
        p = F.array(*[odds[place[d]] / whole if d in place else F.lit(0.0) for d in range(len(self.domains))])
        return made.withColumn(out, p).select(*docs.columns, out)


def fit_domains(docs: DataFrame, labelled: DataFrame, domains: list[str]) -> DomainModel:
    """A soft classifier from ``labelled`` (doc_id, domain).

    Rows without id or with another domain are ignored, of an id with several domains
    the first in the alphabet counts.  A domain without labelled texts is left out, whichever
    it is; with one domain left all texts belong to it, with none to all alike.
    """
    names = F.array(*[F.lit(d) for d in domains])
    known = (
        labelled.where(F.col("doc_id").isNotNull() & F.array_contains(names, F.col("domain")))
        .groupBy(F.col("doc_id").alias("_m_id"))
        .agg((F.array_position(names, F.min("domain")) - 1).cast("int").alias("_m_domain"))
    )
    labels = {r[0]: r[1] for r in known.groupBy("_m_domain").count().collect()}
    chosen = None
    for i, total in sorted(labels.items()):
        part = smallest_by_hash(known.where(F.col("_m_domain") == i), "_m_id", MAX_PER_DOMAIN, total)
        chosen = part if chosen is None else chosen.unionByName(part)
    everything = list(range(len(domains)))
    if chosen is None:
        return DomainModel(domains, everything, None)
    # At most MAX_PER_DOMAIN short rows for each domain are broadcast.
    rows = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_m_text"))
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("_m_id"))
        .select("_m_text", "_m_domain")
    )
    sample = materialize(rows, "labelled-domains")
    counts = {r[0]: r[1] for r in sample.groupBy("_m_domain").count().collect()}
    places = sorted(counts)
    if len(places) < 2:
        return DomainModel(domains, places or everything, None)
    # A domain's rows weigh as many as it has labels, so the sample's equal parts do
    # not make rare domains likelier.
    weight, label = F.lit(0.0), F.lit(0.0)
    for i, domain in enumerate(places):
        weight = F.when(F.col("_m_domain") == domain, labels[domain] / counts[domain]).otherwise(weight)
        label = F.when(F.col("_m_domain") == domain, float(i)).otherwise(label)
    shape = [f"_m_{k}" for k in _shape(F.lit(""))]
    names = [str(i) for i in range(WORD_BUCKETS)]
    stages = [
        CountVectorizerModel.from_vocabulary(names, inputCol="_m_names", outputCol="_m_counted", binary=True),
        VectorAssembler(inputCols=shape, outputCol="_m_shape"),
        StandardScaler(inputCol="_m_shape", outputCol="_m_scaled", withMean=True),
        VectorAssembler(inputCols=["_m_counted", "_m_scaled"], outputCol="_m_features"),
        LogisticRegression(
            featuresCol="_m_features", labelCol="_m_label", probabilityCol="_m_probability",
            rawPredictionCol="_m_raw", predictionCol="_m_prediction", weightCol="_m_weight",
            family="multinomial", regParam=0.005, standardization=False, maxIter=30,
        ),
    ]
    train = _features(sample.withColumns({"_m_weight": weight, "_m_label": label}))
    named = train.withColumn("_m_names", F.col("_m_buckets").cast("array<string>")).coalesce(6)
    model = Pipeline(stages=stages).fit(named)
    scaler, regression = model.stages[2], model.stages[4]
    rows, offsets = regression.coefficientMatrix.toArray(), regression.interceptVector.toArray()
    mean, deviation = scaler.mean.toArray(), scaler.std.toArray()
    scale = np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation > 0)
    weights = []
    for row, offset in zip(rows, offsets, strict=True):
        own = row[WORD_BUCKETS:] * scale
        by_shape = dict(zip(shape, own.tolist(), strict=True))
        weights.append((float(offset - own @ mean), by_shape, row[:WORD_BUCKETS].tolist()))
    return DomainModel(domains, places, weights)


_TRIED = "array<struct<id:int,start:double,move:array<double>>>"


def _literal(tried: list[tuple[int, float, list[float]]]) -> Column:
    """Starts and sums of steps as one literal."""
    rows = [{"id": i, "start": start, "move": move} for i, start, move in tried]
    return F.from_json(F.lit(json.dumps(rows)), _TRIED)


def _rate(tried: Column, size: int, max_rate: float) -> Column:
    """clip(start - sum_d move_d * p_d)."""
    moved = tried["start"]
    for d in range(size):
        moved = moved - tried["move"][d] * F.col("_m_p")[d]
    return F.greatest(F.lit(0.0), F.least(F.lit(float(max_rate)), moved))


@dataclass
class Fit:
    """A sum of steps and the totals it gives; ``off``: the largest miss, as a part of all tokens."""

    start: float
    max_rate: float
    targets: list[float]
    totals: list[float]
    gram: np.ndarray
    move: list[float]
    ended: bool = False

    @property
    def residual(self) -> np.ndarray:
        return np.array(self.totals) - np.array(self.targets)

    @property
    def off(self) -> float:
        return float(np.abs(self.residual).max() / max(sum(self.targets), 1e-9))

    @property
    def rate(self) -> Column:
        return _rate(_literal([(0, self.start, self.move)])[0], len(self.targets), self.max_rate)


def fit_rates(held: DataFrame, weights: list[float], max_rate: float = 1.0, tokens: float | None = None) -> Fit:
    """Fit rates on rows with ``_m_tokens`` and ``_m_p`` (memberships).

    ``tokens`` is the total aimed at, met as nearly as the rates allow.  By default it is
    the most that the scarcest domain allows at ``max_rate``, or the largest of some
    smaller totals for which the targets are met (memberships are soft, so a document adds
    to several domains).  Where no total meets them, the one with the smallest relative
    misfit is returned.
    """
    size = len(weights)
    scale = sum(weights)
    share = [w / scale for w in weights]
    n, p = F.col("_m_tokens"), [F.col("_m_p")[d] for d in range(size)]
    pairs = [(d, e) for d in range(size) for e in range(d, size)]
    total = lambda x: F.coalesce(F.sum(x), F.lit(0.0))
    # The Gram matrix of what a step can move: a row by n p(d) a unit of p(e).
    sums = [
        *[total(F.col("_m_rate") * n * p[d]).alias(f"s{d}") for d in range(size)],
        *[total(F.when(F.col("_m_free"), n * p[d] * p[e])).alias(f"g{d}_{e}") for d, e in pairs],
    ]

    def read(row) -> tuple[list[float], np.ndarray]:
        gram = np.zeros((size, size))
        for d, e in pairs:
            gram[d, e] = gram[e, d] = row[f"g{d}_{e}"]
        return [row[f"s{d}"] for d in range(size)], gram

    everything = held.withColumns({"_m_rate": F.lit(1.0), "_m_free": F.lit(True)}).agg(*sums).first()
    whole, gram_of_all = read(everything)
    worth = np.array([1.0 / max(w, 1e-9) for w in whole])

    def misfit(totals, targets) -> float:
        return float((worth * (np.array(totals) - np.array(targets)) ** 2).sum())

    def begin(aim: float, start: float) -> Fit:
        # Every rate may leave its start.
        return Fit(start, max_rate, [aim * s for s in share], [start * w for w in whole], gram_of_all, [0.0] * size)

    free = (F.col("_m_rate") > 0) & (F.col("_m_rate") < max_rate)

    def descend(fits: list[Fit], slow: float) -> Fit | None:
        """The first of the fits that meets its targets, the others as near as they get."""
        while True:
            met = next((i for i, fit in enumerate(fits) if fit.off <= TOLERANCE), len(fits))
            # A total smaller than one that is met does not count any more.
            open_ = [fit for fit in fits[:met] if not fit.ended]
            if not open_:
                return fits[met] if met < len(fits) else None
            tried = []
            for fit in open_:
                for part in DAMPINGS:
                    step = np.linalg.lstsq(fit.gram + part * gram_of_all, fit.residual, rcond=1e-12)[0]
                    tried.append((fit, (np.array(fit.move) + step).tolist()))
            points = _literal([(i, fit.start, move) for i, (fit, move) in enumerate(tried)])
            rated = held.select("_m_tokens", "_m_p", F.explode(points).alias("_m_tried")).select(
                "_m_tokens", "_m_p", F.col("_m_tried.id").alias("id"), _rate(F.col("_m_tried"), size, max_rate).alias("_m_rate")
            )
            rows = {r["id"]: r for r in rated.withColumn("_m_free", free).groupBy("id").agg(*sums).collect()}
            for fit in open_:
                found = [(move, *read(rows[i])) for i, (of, move) in enumerate(tried) if of is fit and i in rows]
                if not found:
                    fit.ended = True
                    continue
                move, totals, gram = min(found, key=lambda x: misfit(x[1], fit.targets))
                before, now = misfit(fit.totals, fit.targets), misfit(totals, fit.targets)
                fit.ended = now > (1 - slow) * before
                if now < before:
                    fit.move, fit.totals, fit.gram = move, totals, gram

    if tokens is not None:
        fit = begin(tokens, min(1.0, max_rate))
        descend([fit], STALLED)
        return fit
    most = max_rate * min((whole[d] / share[d] for d in range(size) if share[d] > 0), default=0.0)
    nearest = None
    for i in range(0, len(PARTS), AT_A_TIME):
        fits = [begin(most * part, min(1.0, max_rate) * part) for part in PARTS[i : i + AT_A_TIME]]
        if met := descend(fits, SLOW):
            return met
        for fit in fits:
            if nearest is None or fit.off < nearest.off - TOLERANCE:
                nearest = fit
    nearest.ended = False
    descend([nearest], STALLED)
    return nearest


def copies(rate: Column, *keys: Column) -> Column:
    """A whole number with the rate as its mean, decided by a hash of the keys."""
    draw = F.pmod(F.xxhash64(*keys, F.lit("mixing")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("int")).cast("int")


def _held(docs: DataFrame, model: DomainModel) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("_m_text")).withColumns(
        {
            "_m_words": words_of(F.col("_m_text")),
            "_m_spaced": spaced(F.col("_m_text")),
            "_m_hash": F.xxhash64("_m_text"),
        }
    )
    with_p = model.memberships(rows, "_m_p")
    tokens = _runs(F.col("_m_spaced")).alias("_m_tokens")
    return materialize(with_p.select("doc_id", "_m_hash", tokens, "_m_p"), "memberships")


def mixing_rates(
    docs: DataFrame, labelled: DataFrame, weights: dict[str, float], max_rate: float = 1.0,
    tokens: float | None = None,
) -> DataFrame:
    """Per document: doc_id, n_tokens, memberships (by domain), rate, copies, text_hash.

    ``weights`` gives every domain its share of the tokens.  A domain without labelled texts
    is left out: its memberships are 0 and the others share its tokens.  Null and empty texts have no
    tokens; their rate follows from their memberships like any other.  Repeated
    rows get equal rates and draws.  An empty table gives no rows.
    """
    domains = sorted(weights)
    model = fit_domains(docs, labelled, domains)
    held = _held(docs, model)
    used = [weights[d] if i in model.known else 0.0 for i, d in enumerate(domains)]
    if not sum(used):
        used = [1.0 if i in model.known else 0.0 for i in range(len(domains))]
    fit = fit_rates(held, used, max_rate, tokens)
    named = F.struct(*[F.col("_m_p")[i].alias(d) for i, d in enumerate(domains)])
    return held.withColumn("rate", fit.rate).select(
        "doc_id",
        F.col("_m_tokens").alias("n_tokens"),
        named.alias("memberships"),
        "rate",
        copies(F.col("rate"), F.col("doc_id"), F.col("_m_hash")).alias("copies"),
        F.col("_m_hash").alias("text_hash"),
    )


def mixed_documents(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], **options) -> DataFrame:
    """The rows of ``docs`` as often as drawn, with their columns."""
    rates = mixing_rates(docs, labelled, weights, **options)
    mark = "_m"
    while any(c.startswith(mark) for c in docs.columns):
        mark = "_" + mark
    drawn = rates.groupBy(F.col("doc_id").alias(f"{mark}_id"), F.col("text_hash").alias(f"{mark}_of")).agg(
        F.max("copies").alias(f"{mark}_copies")
    )
    hashed = docs.withColumn(f"{mark}_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    return (
        hashed.join(
            drawn.where(F.col(f"{mark}_copies") > 0),
            F.col("doc_id").eqNullSafe(F.col(f"{mark}_id")) & (F.col(f"{mark}_hash") == F.col(f"{mark}_of")),
        )
        .withColumn(f"{mark}_copy", F.explode(F.sequence(F.lit(1), F.col(f"{mark}_copies"))))
        .select(*docs.columns)
    )
