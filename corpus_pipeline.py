"""A corpus pipeline: every stage reads what the one before it wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import decontamination, mixing, simhash, toxicity
from tallyspark.llm.common import table
from tallyspark.llm.queries import labelled_domains, shard_digest
from tallyspark.session import materialize

# Toxic documents have left before the mixing stage, so they are no domain of it.
WEIGHTS = {"good": 0.95, "poor": 0.05}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_group(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """At most one copy of a document; a domain above its share loses some."""
    labels = labelled_domains(table(spark, sf_dir, "labels"))
    return mixing.mixed_documents(docs, labels, WEIGHTS)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_digest(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", not_toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

# SimHash, trained models and crc32 are beyond SQL: tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
