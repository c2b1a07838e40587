"""Row numbers over a total order without putting the order into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.session import materialize

_POSITION = "_position"
_RANGE = "_range"
_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, row below


def distributed_row_number(
    df: DataFrame,
    order_by: Sequence[Column],
    out: str,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """``row_number`` over ``order_by`` (restarting per ``partition_by``).

    Rows are range-partitioned and sorted by the whole order, so every task gets
    an even share however the keys are spread.  Each row's place is its place
    inside the range plus the sizes of the ranges before it.  The ranges come
    from a sample, therefore they are written once and read back.

    ``order_by`` must be a total order.  With ``partition_by`` the first place
    of every key is broadcast: pass only a bounded number of keys.
    """
    order = [*(F.col(c) for c in partition_by), *order_by]
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_POSITION, F.monotonically_increasing_id())
    )
    fixed = materialize(ranged, "ranges").withColumn(
        _RANGE, F.shiftright(_POSITION, _LOCAL_BITS)
    )

    # One row per range partition: as many rows as there are shuffle partitions.
    sizes = fixed.groupBy(_RANGE).agg(F.count("*").alias("_size"))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(_RANGE, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))

    local = F.col(_POSITION).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    placed = fixed.join(F.broadcast(starts), _RANGE).withColumn(
        out, F.col("_start") + local + F.lit(1)
    )
    if partition_by:
        firsts = placed.groupBy(*partition_by).agg(F.min(out).alias("_first"))
        placed = placed.join(F.broadcast(firsts), list(partition_by)).withColumn(
            out, F.col(out) - F.col("_first") + F.lit(1)
        )
    return placed.select(*df.columns, out)
