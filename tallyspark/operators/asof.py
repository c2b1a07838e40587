"""As-of join: each row meets the latest row of the other side at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TIME, _BUCKET, _VALUE, _SIDE, _SEQ = "_asof_time", "_asof_bucket", "_asof_value", "_asof_side", "_asof_before"


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: Column | str,
    right_time: Column | str,
    values: Sequence[str],
    bucket: str = "day",
) -> DataFrame:
    """``left`` with ``values`` of the latest row of ``right`` at or before its time.

    Rows meet where ``by`` agree (a null key meets nothing).  Without an earlier row the
    values are null; left rows without a time meet nothing, right rows without one count
    for nothing.  Of right rows with equal key and time the largest by ``values`` counts.

    No range join: both sides are put in one order per key and bucket of time, and values are
    filled forward.  What a bucket starts with is filled forward over one row per key and
    bucket, so a key with a third of all rows is spread over its buckets.
    """
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    keys = list(by)
    names = [f"_asof_key{i}" for i in range(len(keys))]
    columns = list(left.columns)

    def sided(df: DataFrame, time: Column | str, side: int, value: Column, keep: Sequence[str]) -> DataFrame:
        at = as_column(time).cast("timestamp_ntz")
        return df.select(
            *keep,
            *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)],
            at.alias(_TIME),
            F.date_trunc(bucket, at).alias(_BUCKET),
            F.lit(side).alias(_SIDE),
            value.alias(_VALUE),
        )

    quotes = sided(right, right_time, 0, F.struct(*values), []).dropna(subset=[*names, _TIME])
    none = F.lit(None).cast(quotes.schema[_VALUE].dataType)
    rows = sided(left, left_time, 1, none, columns)
    in_bucket = [*names, _BUCKET]

    # One row per key and bucket: its last value, filled forward over the buckets.
    last = quotes.groupBy(*in_bucket).agg(F.max(F.struct(_TIME, _VALUE))[_VALUE].alias(_VALUE))
    buckets = rows.select(*in_bucket).unionByName(quotes.select(*in_bucket)).distinct()
    earlier = Window.partitionBy(*names).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.join(last, in_bucket, "left").select(
        *in_bucket, F.last(_VALUE, ignorenulls=True).over(earlier).alias(_SEQ)
    )

    # At equal times quotes come first, and of those the largest last.
    inside = Window.partitionBy(*in_bucket).orderBy(_TIME, _SIDE, _VALUE).rowsBetween(Window.unboundedPreceding, 0)
    both = rows.unionByName(quotes, allowMissingColumns=True)
    filled = both.withColumn(_VALUE, F.last(_VALUE, ignorenulls=True).over(inside)).where(F.col(_SIDE) == 1)
    joined = filled.join(starts, in_bucket, "left")
    found = F.when(F.col(_TIME).isNotNull(), F.coalesce(_VALUE, _SEQ))
    return joined.select(*columns, *[found[v].alias(v) for v in values])
