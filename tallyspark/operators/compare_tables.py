"""Where two large tables differ, found by checksums of ever smaller key ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.session import materialize

_PLACE, _BUCKET, _SIGN = "_place", "_bucket", "_sign"


def _signed(df: DataFrame, key: Sequence[str], sign: int) -> DataFrame:
    return df.select("*", F.xxhash64(*key).alias(_PLACE), F.lit(sign).alias(_SIGN))


def differing_keys(left: DataFrame, right: DataFrame, key: Sequence[str], levels: int = 2, bits: int = 8) -> DataFrame:
    """Keys whose rows are not the same in both tables: key, left_only, right_only.

    ``left_only`` counts the rows of a key that the right table lacks, repeats counted, and
    the other way round.  Null is a value like any other.  Both tables have the same columns.

    The keys' hashes span a tree with 2**bits children a node.  Level by level one
    aggregation over both tables adds up the row checksums of each node, with opposite
    signs; only nodes that do not cancel out are looked into.  Rows move only for the
    leaves that differ, so tables that agree cost one scan each and no shuffle of rows.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError("the tables have different columns")
    columns = list(left.columns)
    both = _signed(left, key, 1).unionByName(_signed(right, key, -1))
    # Two checksums: one adds up hashes, one folds them.
    first, second = F.xxhash64(*columns), F.xxhash64(F.lit("second"), *reversed(columns))
    open_ = None
    for level in range(1, levels + 1):
        node = F.call_function("shiftrightunsigned", _PLACE, F.lit(64 - bits * level))
        rows = both.withColumn(_BUCKET, node)
        if open_ is not None:
            above = open_.select(F.col(_BUCKET).alias("_above"))
            # At most 2**(bits * (level - 1)) short rows.
            rows = rows.join(above, F.call_function("shiftrightunsigned", _BUCKET, F.lit(bits)) == F.col("_above"), "left_semi")
        sums = rows.groupBy(_BUCKET).agg(
            F.sum(F.col(_SIGN)).alias("n"),
            F.sum(F.col(_SIGN) * first.cast("decimal(20,0)")).alias("total"),
            F.bit_xor(second).alias("folded"),
        )
        open_ = materialize(sums.where("n <> 0 or total <> 0 or folded <> 0").select(_BUCKET), "differing")
        if open_.isEmpty():
            break
    leaf = F.call_function("shiftrightunsigned", _PLACE, F.lit(64 - bits * level))
    rows = both.withColumn(_BUCKET, leaf).join(open_, _BUCKET, "left_semi")
    # Equal rows cancel out, combined map-side.
    surplus = rows.groupBy(*columns).agg(F.sum(_SIGN).alias("n")).where("n <> 0")
    count = lambda n, name: F.sum(F.greatest(n, F.lit(0))).cast("long").alias(name)
    return surplus.groupBy(*key).agg(count(F.col("n"), "left_only"), count(-F.col("n"), "right_only"))
