"""Shards from a Feistel permutation with cycle walking over global row numbers.

Rows are numbered 0..n-1 in the order of their id.  A keyed Feistel network
permutes the numbers below the next power of four; a number that lands at n or
above is put through the network again until it falls below n (cycle walking),
which keeps the map a permutation of 0..n-1.  Place p then belongs to shard
``p % shards`` at slot ``p // shards``: sizes differ by one row at most, slots have no
gaps, and both follow from (row number, n, key) alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import utf8
from tallyspark.operators.ranking import distributed_row_number

ROUNDS = 6


def _round_keys(key: int) -> list[int]:
    """One 64-bit number per round, spread from the key."""
    return [(key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % 2**64 for r in range(ROUNDS)]


def _mix(half: np.ndarray, key: int, bits: int) -> np.ndarray:
    """The round function: ``bits`` well mixed bits of one half."""
    x = half ^ np.uint64(key)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) & np.uint64((1 << bits) - 1)


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _network(x: np.ndarray, bits: int, keys: list[int]) -> np.ndarray:
    left, right = x >> np.uint64(bits), x & np.uint64((1 << bits) - 1)
    for key in keys:
        left, right = right, left ^ _mix(right, key, bits)
    return (left << np.uint64(bits)) | right


def _network_back(x: np.ndarray, bits: int, keys: list[int]) -> np.ndarray:
    left, right = x >> np.uint64(bits), x & np.uint64((1 << bits) - 1)
    for key in reversed(keys):
        left, right = right ^ _mix(left, key, bits), left
    return (left << np.uint64(bits)) | right


def _walk(numbers: np.ndarray, n: int, key: int, step) -> np.ndarray:
    bits, keys = _half_bits(n), _round_keys(key)
    out = step(numbers.astype(np.uint64), bits, keys)
    outside = np.flatnonzero(out >= n)
    while len(outside):
        out[outside] = step(out[outside], bits, keys)
        outside = outside[out[outside] >= n]
    return out.astype(np.int64)


def place_of(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """The place of each row number in the shuffled order."""
    return _walk(np.asarray(numbers), n, key, _network)


def number_at(places: np.ndarray, n: int, key: int) -> np.ndarray:
    """The row number at each place: the inverse of :func:`place_of`."""
    return _walk(np.asarray(places), n, key, _network_back)


def shuffled_place(number: Column, n: int, key: int) -> Column:
    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(place_of(numbers.to_numpy(), n, key))

    return place(number)


def shard_rows(
    docs: DataFrame,
    shards: int,
    key: int = 42,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every row with its shard and slot.

    Columns: doc_id, size (UTF-8 bytes plus 8), text_crc32, row_number, shard, slot.
    Null text counts as empty; null ids are numbered first; rows that share an id
    are ordered by checksum, size and a hash of the text.  Rows equal in all of these
    may swap places, which leaves the result the same.  Equal texts are not kept
    together: a group may be larger than a shard.  An empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(utf8(text_column)) + F.lit(8)).cast("long").alias("size"),
        F.crc32(utf8(text_column)).alias("text_crc32"),
        F.xxhash64(utf8(text_column)).alias("text_hash"),
    )
    order = [F.col(c) for c in ("doc_id", "text_crc32", "size", "text_hash")]
    numbered = distributed_row_number(rows, order, "row_number")
    n = docs.count()
    place = shuffled_place(F.col("row_number") - F.lit(1), n, key)
    return numbered.withColumn("place", place).select(
        "doc_id",
        "size",
        "text_crc32",
        "row_number",
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"place div {shards}").alias("slot"),
    )
