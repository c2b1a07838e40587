"""URL filter: rules first, then gradient-boosted trees on lexical features.

Everything is built-in column expressions and Spark's own boosted trees; no Python
runs on the executors.

Rules pair a host (with all its subdomains) and a path prefix; the longest rule that
fits decides.  Where none fits, a model trained on labelled URLs does.  Its features
are lengths, depth, digit ratio, entropy, parameter counts and the smoothed block
rate of the host's suffix among the labelled URLs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.session import materialize

# Labelled URLs read for training, at most about so many, taken by a hash of the URL.
MAX_TRAINING = 20_000
SUFFIX_WEIGHT = 20.0
TREES, DEPTH = 15, 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    text = F.coalesce(url, F.lit(""))
    start = F.locate("://", text)
    rest = F.when(start > 0, F.substring(text, start + 3, F.length(text))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as struct (rule, verdict); null if none does.

    Of rules equally long the first one listed wins.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: -len(r.name))[::-1]:
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(
            fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        ).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Bits per character of the text's own character distribution; 0 if empty."""
    size = F.length(text)
    share = lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size
    terms = F.transform(
        F.array_distinct(F.filter(F.split(text, ""), lambda c: c != "")),
        lambda c: -share(c) * F.log2(share(c)),
    )
    return F.when(size > 0, F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)).otherwise(0.0)


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def lexical_features(url: Column) -> dict[str, Column]:
    text = F.coalesce(url, F.lit(""))
    host, path = host_and_path(url)
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    digits = lambda t: F.length(F.regexp_replace(t, r"[^0-9]", ""))
    features = {
        "url_length": F.length(text),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": _count(path, "/"),
        "host_labels": _count(host, ".") + 1,
        "host_hyphens": _count(host, "-"),
        "host_digits": _ratio(digits(host), F.length(host)),
        "url_digits": _ratio(digits(text), F.length(text)),
        "url_entropy": entropy(text),
        "host_entropy": entropy(host),
        "parameters": F.when(query != "", _count(query, "&") + 1).otherwise(0),
        "longest_label": F.array_max(F.transform(F.split(host, r"\."), F.length)),
        "vowels": _ratio(F.length(F.regexp_replace(host, r"[^aeiou]", "")), F.length(host)),
    }
    return {k: v.cast("double") for k, v in features.items()}


def suffix_of(url: Column) -> Column:
    return F.substring_index(host_and_path(url)[0], ".", -1)


@dataclass(frozen=True)
class UrlModel:
    """Boosted trees with the suffix statistics they were trained on.

    ``trees`` is None where the labelled URLs have one class or none; then ``constant`` is
    the probability of every URL.
    """

    trees: GBTClassificationModel | None
    suffixes: DataFrame | None
    rate: float
    constant: float = 0.0

    def block_probability(self, urls: DataFrame, url_column: str, out: str) -> DataFrame:
        """``urls`` with the probability of a block.

        No column may start with ``_m_`` or be called as Spark's models name theirs
        (prediction, probability, rawPrediction).
        """
        if self.trees is None:
            return urls.withColumn(out, F.lit(self.constant))
        featured = _with_features(urls, url_column, self.suffixes, self.rate)
        scored = self.trees.transform(featured)
        return scored.select(
            *urls.columns, vector_to_array(F.col("probability"))[1].alias(out)
        )


def _with_features(urls: DataFrame, url_column: str, suffixes: DataFrame, rate: float) -> DataFrame:
    features = lexical_features(F.col(url_column))
    named = urls.withColumns(
        {f"_m_{k}": v for k, v in features.items()} | {"_m_suffix": suffix_of(F.col(url_column))}
    )
    # One row per suffix: Spark broadcasts them if they are few, else may split a hot suffix.
    joined = named.join(suffixes, "_m_suffix", "left").withColumn(
        "_m_suffix_rate", F.coalesce("_m_suffix_rate", F.lit(rate))
    )
    columns = [*(f"_m_{k}" for k in features), "_m_suffix_rate"]
    return VectorAssembler(inputCols=columns, outputCol="_m_features").transform(joined)


def fit(labelled: DataFrame, url_column: str = "url", label_column: str = "label") -> UrlModel:
    """Train on URLs with label 1 (block) or 0 (allow); other rows are ignored.

    The trees see at most about ``MAX_TRAINING`` rows, chosen by a hash of the URL; the rates
    of suffixes come from all rows.
    """
    usable = labelled.select(
        F.col(url_column).alias("url"), F.col(label_column).cast("double").alias("label")
    ).where(F.col("url").isNotNull() & F.col("label").isin(0.0, 1.0))
    share = min(1.0, MAX_TRAINING / max(1, usable.count()))
    drawn = F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    sample = materialize(usable.where(drawn), "labelled-urls")
    n, blocked = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not n or blocked in (0.0, float(n)):
        return UrlModel(None, None, 0.0, constant=1.0 if n and blocked else 0.0)
    rate = usable.agg(F.avg("label")).first()[0]
    # Counted over all labelled URLs, map-side first; only the trees see a sample.
    suffixes = materialize(
        usable.groupBy(suffix_of(F.col("url")).alias("_m_suffix")).agg(
            ((F.sum("label") + SUFFIX_WEIGHT * rate) / (F.count("*") + SUFFIX_WEIGHT)).alias("_m_suffix_rate")
        ),
        "suffixes",
    )
    # Both classes weigh the same in training.
    weight = F.when(F.col("label") == 1, n / (2 * blocked)).otherwise(n / (2 * (n - blocked)))
    training = materialize(
        _with_features(sample, "url", suffixes, rate)
        .select("_m_features", F.col("label").alias("_m_label"), weight.alias("_m_weight"))
        .coalesce(4),
        "url-features",
    )
    trees = GBTClassifier(
        featuresCol="_m_features",
        labelCol="_m_label",
        weightCol="_m_weight",
        maxIter=TREES,
        maxDepth=DEPTH,
        stepSize=0.3,
        seed=42,
    ).fit(training)
    return UrlModel(trees, suffixes, rate)


def verdicts(
    urls: DataFrame, rules: list[Rule], model: UrlModel, id_column: str = "page_id",
    url_column: str = "url", threshold: float = 0.5,
) -> DataFrame:
    """Per row: the id, host, path, rule, verdict (allow or block) and block_probability.

    Null, empty and odd URLs get empty host and path, no rule, and the model's
    verdict on the empty features.  Repeated rows are all judged, URLs of any length are
    judged whole, further columns are not read, and an empty table gives no rows.
    """
    slim = urls.select(F.col(id_column).alias("row_id"), F.col(url_column).alias("url"))
    scored = model.block_probability(slim, "url", "block_probability")
    host, path = host_and_path(F.col("url"))
    found = scored.withColumns({"host": host, "path": path}).withColumn(
        "found", matching_rule(F.col("host"), F.col("path"), rules)
    )
    own = F.when(F.col("block_probability") >= threshold, "block").otherwise("allow")
    return found.select(
        F.col("row_id").alias(id_column),
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), own).alias("verdict"),
        "block_probability",
    )
