"""Helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What is sent to a Python worker at a time: so many rows, and no more once they hold
# so many bytes.  Memory stays bounded by the longest text while the call cost is spread.
ROWS_PER_BATCH = 256
BYTES_PER_BATCH = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows and bytes of one Arrow batch, from here on in this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))


def utf8(column: str):
    """The UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def crc32_of_id(column: str):
    """crc32 of an id written as text, as an unsigned number."""
    return F.crc32(F.col(column).cast("string"))


def smallest_by_hash(rows: DataFrame, column: str, n: int, total: int) -> DataFrame:
    """The ``n`` rows whose hash of ``column`` is smallest; ``rows`` has ``total``.

    Only rows below a bound of which about twice as many are expected take part in the
    sort, so what all tasks send together does not grow with the number of tasks.
    """
    place = F.shiftrightunsigned(F.xxhash64(column), 1)
    if total > 2 * n + 1000:
        rows = rows.where(place < F.lit(int(2**63 * ((2 * n + 1000) / total))))
    return rows.orderBy(place, column).limit(n)
