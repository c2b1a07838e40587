"""Joins that stay balanced when one key holds a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.params import HotKeyPolicy

_SALT = "_salt"


def hot_keys(df: DataFrame, key: str, policy: HotKeyPolicy) -> DataFrame:
    """The heaviest keys: those with ``min_rows`` rows, at most ``max_keys`` of them.

    Reads only the key column and counts map-side before shuffling.  The list is
    an exact function of the data, so evaluating it twice gives the same set.  It
    only chooses a route: a key left out is handled the ordinary way, and holds
    less than ``1 / max_keys`` of all rows (or fewer than ``min_rows``).
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    heavy = counts.where(F.col("_n") >= policy.min_rows)
    return heavy.orderBy(F.desc("_n"), key).limit(policy.max_keys).select(key)


def _piece_of_row(df: DataFrame, pieces: int) -> Column:
    """A piece number that depends on the row and its input partition only.

    The partition number is part of the hash so that identical rows spread too;
    neither changes when a task is run again.
    """
    return F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.lit(pieces)).cast("int")


def spread_join(left: DataFrame, right: DataFrame, key: str, pieces: int) -> DataFrame:
    """Inner join of few left rows with very many right rows per key.

    The right rows of every key are dealt into ``pieces`` groups, the left rows
    are repeated once per group: one shuffle per side, balanced for any key.
    """
    dealt = right.withColumn(_SALT, _piece_of_row(right, pieces))
    repeated = left.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    return repeated.join(dealt, [key, _SALT]).drop(_SALT)
