"""Language identification by Bayesian fusion of text, markup, address and host.

For a row with text x, declared language d, address suffix s and host h

    P(l | x, d, s, h)  ~  P(x | l) P(d | l) P(s | l) P(l | h)

* P(x | l): byte trigrams in hashed buckets, counted over all labelled texts.  Trigrams
  are not independent, so a text counts for at most ``EFFECTIVE`` of them.
* P(d | l), P(s | l): grouped sums of the text posteriors, smoothed by the share of d or s.
* P(l | h): sums by host, smoothed towards the host's domain, and that towards all rows
  (``PRIOR_WEIGHT`` pseudo-rows at each step).  A row's own part is left out.

All sums are combined map-side; what is joined back has one short row per host, domain,
declared language or suffix.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import small_batches, utf8
from tallyspark.llm.html_tree import parse
from tallyspark.llm.url_filter import host_and_path
from tallyspark.session import materialize

BUCKETS = 1 << 14
EFFECTIVE = 60.0
PRIOR_WEIGHT = 10.0
# Languages whose trigrams are counted in one pass over the labelled texts.
LANGUAGES_AT_A_TIME = 100
_FLOOR = 0.05  # pseudo-count of a trigram bucket
_CHUNK = 4_000_000
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256)
)


def _trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, owner) of every trigram around a letter; none crosses two texts."""
    joined = np.frombuffer(b"  ".join([b"", *texts, b""]).translate(_LETTERS), np.uint8).astype(np.uint32)
    sizes = np.array([len(t) for t in texts])
    begin = 2 + np.concatenate([[0], np.cumsum(sizes[:-1] + 2)])
    middle = np.flatnonzero(joined[1:-1] != 32) + 1
    code = (joined[middle - 1] << 16) | (joined[middle] << 8) | joined[middle + 1]
    bucket = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14)).astype(np.int64)
    return bucket, np.searchsorted(begin, middle, side="right") - 1


def _parts(texts: list[bytes]):
    """Consecutive slices of about ``_CHUNK`` bytes."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > _CHUNK:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text)
    if len(texts) > first:
        yield first, texts[first:]


@dataclass(frozen=True)
class TextModel:
    languages: list[str]
    log_share: np.ndarray  # one row of bucket log probabilities per language

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Mean log likelihood per language and number of trigrams of each text."""
        total = np.zeros((len(texts), len(self.languages)))
        count = np.zeros(len(texts), np.int64)
        for first, part in _parts(texts):
            bucket, owner = _trigrams(part)
            here = slice(first, first + len(part))
            count[here] = np.bincount(owner, minlength=len(part))
            for i, row in enumerate(self.log_share):
                total[here, i] = np.bincount(owner, row[bucket], minlength=len(part))
        return total / np.maximum(count, 1)[:, None], count


def fit_text(labelled: DataFrame, text_column: str = "text", label_column: str = "lang") -> TextModel:
    """Trigram counts over all texts with a label; null labels and texts add nothing."""
    spark = labelled.sparkSession
    small_batches(spark)
    label = F.col(label_column)
    # Every label counts; the model takes 64 KB for each.
    languages = sorted(r[0] for r in labelled.where(label.isNotNull()).select(label).distinct().collect())
    rows = labelled.select(label.alias("label"), utf8(text_column).alias("text"))
    blocks = [
        _log_shares(rows, languages[i : i + LANGUAGES_AT_A_TIME])
        for i in range(0, len(languages), LANGUAGES_AT_A_TIME)
    ]
    return TextModel(languages, np.concatenate([np.zeros((0, BUCKETS), np.float32), *blocks]))


def _log_shares(rows: DataFrame, languages: list[str]) -> np.ndarray:
    """Bucket log probabilities of some languages (``rows``: label, text), one row each."""
    place = {name: i for i, name in enumerate(languages)}

    def count(batches):
        sums = np.zeros((len(languages), BUCKETS), np.int64)
        for batch in batches:
            labels = batch.column("label").to_pylist()
            texts = batch.column("text").to_pylist()
            for first, part in _parts(texts):
                bucket, owner = _trigrams(part)
                which = np.array([place[x] for x in labels[first : first + len(part)]])[owner]
                flat = which * BUCKETS + bucket
                sums += np.bincount(flat, minlength=sums.size).reshape(sums.shape)
        which, bucket = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(which), pa.array(bucket), pa.array(sums[which, bucket])], names=["which", "bucket", "n"]
        )

    # At most LANGUAGES_AT_A_TIME * BUCKETS short rows reach the driver.
    counts = (
        rows.where(F.col("label").isin(*languages))
        .mapInArrow(count, "which long, bucket long, n long")
        .groupBy("which", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    table = np.full((len(languages), BUCKETS), _FLOOR)
    table[counts["which"], counts["bucket"]] += counts["n"]
    return np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def text_evidence(model: TextModel, text: Column) -> Column:
    """Tempered log likelihoods of a binary column, one per language."""

    @F.pandas_udf("array<double>")
    def score(texts: pd.Series) -> pd.Series:
        mean, count = model.score(list(texts))
        return pd.Series(list(mean * np.minimum(count, EFFECTIVE)[:, None]))

    return score(text)


def page_rows(pages: DataFrame, id_column: str = "page_id") -> DataFrame:
    """Evidence of web pages: id, text (binary), declared, suffix, domain, host."""
    small_batches(pages.sparkSession)

    @F.pandas_udf("binary")
    def body(htmls: pd.Series) -> pd.Series:
        def one(html):
            return "\n".join(t for _, furniture, t in parse(html).blocks if not furniture).encode()

        return htmls.map(one)

    html = F.coalesce("html", F.lit(""))
    lang = F.regexp_extract(html, r"""(?i)<html\b[^>]*?\slang\s*=\s*["']?([a-z]+)""", 1)
    host, _ = host_and_path(F.col("url"))
    blank = lambda c: F.when(c != "", c)
    return pages.select(
        F.col(id_column).alias("id"),
        body(html).alias("text"),
        blank(F.lower(lang)).alias("declared"),
        blank(F.substring_index(host, ".", -1)).alias("suffix"),
        blank(F.substring_index(host, ".", -2)).alias("domain"),
        blank(host).alias("host"),
    )


def document_rows(docs: DataFrame, id_column: str = "doc_id", source_column: str = "source") -> DataFrame:
    """Evidence of plain texts: the source stands for the host; nothing is declared."""
    none = F.lit(None).cast("string")
    source = F.concat(F.lit("source:"), F.col(source_column))
    return docs.select(
        F.col(id_column).alias("id"),
        utf8("text").alias("text"),
        none.alias("declared"),
        none.alias("suffix"),
        none.alias("domain"),
        source.alias("host"),
    )


def _normal(weights: Column) -> Column:
    total = F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)
    return F.transform(weights, lambda w: w / total)


def _posterior(logs: Column) -> Column:
    top = F.array_max(logs)
    return _normal(F.transform(logs, lambda x: F.exp(x - top)))


def _sums(rows: DataFrame, key: str, size: int) -> DataFrame:
    """(key, sums): the text posteriors of a group added up, as an array."""
    each = [F.sum(F.col("by_text")[i]) for i in range(size)]
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.array(*each).alias("sums"))


def identify(rows: DataFrame, model: TextModel) -> DataFrame:
    """Per row its columns but the text, and language, confidence, text_language, posterior.

    ``rows`` has text (binary), declared, suffix, domain and host; null evidence is left
    out.  A row without letters is judged by the rest.  Without any labelled text
    the language is null.  Ties go to the language first in the alphabet; repeated rows
    are all returned.
    """
    size = len(model.languages)
    others = [c for c in rows.columns if c != "text"]
    if not size:
        none = F.lit(None)
        return rows.select(
            *others, none.cast("string").alias("language"), none.cast("double").alias("confidence"),
            none.cast("string").alias("text_language"), none.cast("array<double>").alias("posterior"),
        )
    scored = materialize(rows.withColumn("evidence", text_evidence(model, F.col("text"))).drop("text"), "evidence")
    known = scored.withColumn("by_text", _posterior(F.col("evidence")))

    each = [F.coalesce(F.sum(F.col("by_text")[i]), F.lit(0.0)) for i in range(size)]
    # One row: the share of each language over all rows.
    overall = known.agg(F.array(*each).alias("s")).first()["s"]
    total = sum(overall)
    general = F.array(*[F.lit((x + 1.0) / (total + size)) for x in overall])
    in_all = F.array(*[F.lit(x) for x in overall])

    def likelihood(key: str) -> DataFrame:
        """log P(value | language), smoothed by the value's own share."""
        sums = _sums(known, key, size)
        share = F.aggregate("sums", F.lit(0.0), lambda a, b: a + b) / F.lit(max(total, 1e-9))
        logs = F.zip_with(
            F.col("sums"), in_all,
            lambda n, of: F.log((n + F.lit(PRIOR_WEIGHT) * share + 1e-6) / (of + F.lit(PRIOR_WEIGHT))),
        )
        return sums.select(key, logs.alias(f"{key}_logs"))

    domains = _sums(known, "domain", size).select("domain", F.col("sums").alias("domain_sums"))
    hosts = _sums(known, "host", size).select("host", F.col("sums").alias("host_sums"))
    zero = F.array(*[F.lit(0.0)] * size)

    def without_own(sums: Column) -> Column:
        """The group's sums without this row; zero for rows outside any group."""
        left = F.zip_with(sums, F.col("by_text"), lambda n, own: F.greatest(F.lit(0.0), n - own))
        return F.coalesce(left, zero)

    def smoothed(sums: Column, parent: Column) -> Column:
        count = F.aggregate(sums, F.lit(0.0), lambda a, b: a + b)
        return F.zip_with(sums, parent, lambda n, p: (n + F.lit(PRIOR_WEIGHT) * p) / (count + F.lit(PRIOR_WEIGHT)))

    # Rows without a key meet nothing; a hash of the row spreads them over the tasks.
    spread = F.concat(F.lit("\x00"), F.pmod(F.xxhash64(*others, "evidence"), F.lit(1 << 20)).cast("string"))

    def with_group(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
        right = right.withColumnRenamed(key, "_group")
        return left.join(right, F.coalesce(F.col(key), spread) == F.col("_group"), "left").drop("_group")

    joined = known
    for key, right in (
        ("declared", likelihood("declared")), ("suffix", likelihood("suffix")), ("domain", domains), ("host", hosts)
    ):
        joined = with_group(joined, right, key)
    joined = (
        joined.withColumn("domain_sums", without_own(F.col("domain_sums")))
        .withColumn("host_sums", without_own(F.col("host_sums")))
        .withColumn("domain_prior", smoothed(F.col("domain_sums"), general))
        .withColumn("prior", smoothed(F.col("host_sums"), F.col("domain_prior")))
    )
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    logs = add(F.col("evidence"), F.transform("prior", lambda p: F.log(p)))
    for key in ("declared", "suffix"):
        logs = add(logs, F.coalesce(F.col(f"{key}_logs"), zero))
    names = F.array(*[F.lit(x) for x in model.languages])

    def best(posterior: Column) -> Column:
        return F.element_at(names, F.array_position(posterior, F.array_max(posterior)).cast("int"))

    return joined.withColumn("posterior", _posterior(logs)).select(
        *others,
        best(F.col("posterior")).alias("language"),
        F.array_max("posterior").alias("confidence"),
        best(F.col("by_text")).alias("text_language"),
        "posterior",
    )
