"""Multi-touch attribution: paths to conversion and four weightings.

Credits (:func:`mta_daily`) need no order inside a path, only its ends and counts, so
touches are combined per (account, day, channel) first: one route for all accounts.

Paths (:func:`int_attribution_paths`) number every touch.  Accounts of ordinary size are
handled with windows over the account: one shuffle and one sort of the touches.  An
account that holds a large share of all touches would end up in a single task
that way, so such accounts (see ``HotKeyPolicy``) take a second route: a join in
pieces, per-account totals that are combined map-side, and row numbers from a
range-partitioned sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.scalar import EXACT_WEIGHT, WEIGHT, decay, exact_sum, round_n, safe_ratio
from tallyspark.operators.ranking import distributed_row_number
from tallyspark.operators.skew import hot_keys, spread_join
from tallyspark.params import DEFAULTS, MeasurementParams
from tallyspark.session import materialize

_RAW = "time_decay_raw"
_TOTAL = "total_touches"
_SUM_RAW = "sum_decay_raw"
# Time first; the rest only makes the order total when ids or accounts repeat.
_ORDER = ["touch_timestamp", "touch_id", "pro_upgrade_date", "monthly_invoice_usd", "channel"]
_KINDS = ["first_touch", "last_touch", "linear", "time_decay"]
_PATH = [
    "account_id",
    "touch_id",
    "touch_timestamp",
    "touch_date",
    "channel",
    "campaign_id",
    "pro_upgrade_date",
    "monthly_invoice_usd",
]


def converted_accounts(stg_plg: DataFrame) -> DataFrame:
    """Accounts that upgraded, with date and invoice."""
    return stg_plg.where(F.col("is_pro_upgrade")).select(
        "account_id", "pro_upgrade_date", "monthly_invoice_usd"
    )


def touches_before_conversion(
    stg_touches: DataFrame, stg_plg: DataFrame, params: MeasurementParams = DEFAULTS
) -> DataFrame:
    """Touches of converted accounts up to the conversion day.  Grain: touch."""
    cold, hot = _routes(stg_touches, stg_plg, params)
    return cold.unionByName(hot).drop(_RAW)


def _paths(joined: DataFrame) -> DataFrame:
    return joined.where(F.col("touch_date") <= F.col("pro_upgrade_date")).select(*_PATH)


def _kind(exact: bool) -> str:
    return EXACT_WEIGHT if exact else WEIGHT


def _with_raw_decay(paths: DataFrame, params: MeasurementParams, exact: bool) -> DataFrame:
    days = F.date_diff(F.col("pro_upgrade_date"), F.col("touch_date"))
    raw = decay(days, params.decay_per_day)
    return paths.withColumn(_RAW, raw if exact else round_n(raw, 4))


def _ordered_in_account(paths: DataFrame, exact: bool = False) -> DataFrame:
    """Order and totals by windows: the join already put each account together."""
    account = Window.partitionBy("account_id")
    place = F.row_number().over(account.orderBy(*_ORDER)).cast("long")
    # Numbered first: the sort it needs also serves the totals.
    return paths.withColumn("touch_order_asc", place).select(
        "*",
        F.count("*").over(account).alias(_TOTAL),
        F.sum(F.col(_RAW).cast(_kind(exact))).over(account).cast("double").alias(_SUM_RAW),
    )


def _weights(is_first: Column, is_last: Column, exact: bool = False) -> list[Column]:
    """The four weights; published ones have four places, exact ones all."""
    one, none = F.lit(1.0), F.lit(0.0)
    linear, decayed = F.lit(1.0) / F.col(_TOTAL), safe_ratio(_RAW, _SUM_RAW)
    return [
        F.when(is_first, one).otherwise(none).alias("first_touch_weight"),
        F.when(is_last, one).otherwise(none).alias("last_touch_weight"),
        (linear if exact else round_n(linear, 4)).alias("linear_weight"),
        (decayed if exact else round_n(decayed, 4)).alias("time_decay_weight"),
    ]


def _routes(
    stg_touches: DataFrame,
    stg_plg: DataFrame,
    params: MeasurementParams,
    keep_list: bool = False,
    exact: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Paths with raw decay: those of ordinary accounts, those of hot accounts.

    ``keep_list`` writes the (bounded) list of hot accounts first, for callers
    that run more than one job and should not count the touches in each.
    """
    hot_ids = hot_keys(stg_touches, "account_id", params.hot_keys)
    if keep_list:
        hot_ids = materialize(hot_ids, "hot-accounts")
    is_hot = F.broadcast(hot_ids)
    conversions = converted_accounts(stg_plg)

    cold = stg_touches.join(is_hot, "account_id", "left_anti").join(conversions, "account_id")
    hot = spread_join(
        conversions.join(is_hot, "account_id", "left_semi"),
        stg_touches.join(is_hot, "account_id", "left_semi"),
        "account_id",
        params.hot_keys.pieces,
    )
    return _with_raw_decay(_paths(cold), params, exact), _with_raw_decay(_paths(hot), params, exact)


def touch_order(
    stg_touches: DataFrame,
    stg_plg: DataFrame,
    params: MeasurementParams = DEFAULTS,
    exact: bool = False,
) -> DataFrame:
    """Paths with ascending and descending order, path length and decay sum.

    The descending order is counted back from the path length, which saves the
    second sort; equal timestamps are ordered by touch id in both directions.
    Finding and numbering the hot accounts runs when this is called.
    """
    cold, hot = _routes(stg_touches, stg_plg, params, keep_list=True, exact=exact)
    numbered = distributed_row_number(
        hot, [F.col(c) for c in _ORDER], "touch_order_asc", partition_by=["account_id"]
    )
    # One row per hot account, so at most max_keys rows: safe to broadcast.
    totals = numbered.groupBy("account_id").agg(
        F.count("*").alias(_TOTAL), exact_sum(_RAW, _kind(exact)).alias(_SUM_RAW)
    )
    hot_ordered = numbered.join(F.broadcast(totals), "account_id")
    both = _ordered_in_account(cold, exact).unionByName(hot_ordered)
    return both.select(
        *_PATH,
        "touch_order_asc",
        (F.col(_TOTAL) - F.col("touch_order_asc") + 1).alias("touch_order_desc"),
        _TOTAL,
        _RAW,
        _SUM_RAW,
    )


def int_attribution_paths(
    stg_touches: DataFrame,
    stg_plg: DataFrame,
    params: MeasurementParams = DEFAULTS,
    exact: bool = False,
) -> DataFrame:
    """Grain: qualifying touch of a converted account.

    ``exact`` leaves decay and weights unrounded: rounded to four places, the linear
    weights of a path with more than 20,000 touches are all 0.
    """
    ordered = touch_order(stg_touches, stg_plg, params, exact)
    return ordered.select(
        *_PATH,
        "touch_order_asc",
        "touch_order_desc",
        _TOTAL,
        *_weights(F.col("touch_order_asc") == 1, F.col("touch_order_desc") == 1, exact),
    )


def _credits(weighted: DataFrame, exact: bool = False) -> DataFrame:
    """Sum weights per touch date and channel, rounded for publication."""
    # A cell's part of an exact weight is a sum itself, so it may exceed 1.
    kind_of, places = ("decimal(28,16)", 6) if exact else (WEIGHT, 2)
    sums = [
        round_n(exact_sum(f"{kind}_weight", kind_of), places).alias(f"mta_{kind}_conversions")
        for kind in _KINDS
    ]
    return weighted.groupBy(F.col("touch_date").alias("date_day"), "channel").agg(*sums)


def mta_from_paths(paths: DataFrame, exact: bool = False) -> DataFrame:
    """Credited conversions from stored paths.  Grain: date x channel."""
    return _credits(paths, exact)


def mta_daily(
    stg_touches: DataFrame,
    stg_plg: DataFrame,
    params: MeasurementParams = DEFAULTS,
    exact: bool = False,
) -> DataFrame:
    """Credited conversions straight from touches.  Grain: date x channel.

    Equal to :func:`mta_from_paths`, but no touch needs a row number.  Touches are first
    counted per (account, day, channel), map-side, with the first and last of each
    such cell; only cells meet the conversions and each other.  So an account with a third
    of all touches is spread over the tasks like any other, and what a window sees
    of it is at most its days times the channels.  ``exact`` sums unrounded weights and
    publishes six places: every conversion is credited in full, however long its path.
    """
    touch = F.struct("touch_timestamp", "touch_id")
    cells = stg_touches.groupBy("account_id", "touch_date", "channel").agg(
        F.count("*").alias("_n"), F.min(touch).alias("_min"), F.max(touch).alias("_max")
    )
    # Accounts that repeat (see the uniqueness check) have one path per row.
    conversions = converted_accounts(stg_plg)
    conversions = conversions.groupBy(*conversions.columns).agg(F.count("*").alias("_rows"))

    def end(cell: str) -> Column:
        """The cell's first or last touch in the order of :data:`_ORDER`."""
        return F.struct(F.col(cell), *_ORDER[2:])

    joined = cells.join(conversions, "account_id").where("touch_date <= pro_upgrade_date")
    counted = joined.withColumn("_n", F.col("_n") * F.col("_rows")).withColumns(
        {"_min": end("_min"), "_max": end("_max")}
    )
    account = Window.partitionBy("account_id")
    raw = F.col(_RAW).cast(_kind(exact))
    totals = _with_raw_decay(counted, params, exact).select(
        "*",
        F.sum("_n").over(account).alias(_TOTAL),
        F.sum(raw * F.col("_n")).over(account).cast("double").alias(_SUM_RAW),
        F.col("_min").eqNullSafe(F.min("_min").over(account)).alias("_first"),
        F.col("_max").eqNullSafe(F.max("_max").over(account)).alias("_last"),
    )
    per_touch = totals.select(
        "touch_date", "channel", "_n", *_weights(F.col("_first"), F.col("_last"), exact)
    )
    shares = [
        (F.col(f"{k}_weight").cast(_kind(exact)) * F.col("_n")).cast("double").alias(f"{k}_weight")
        for k in ("linear", "time_decay")
    ]
    per_cell = per_touch.select(
        "touch_date", "channel", "first_touch_weight", "last_touch_weight", *shares
    )
    return _credits(per_cell, exact)
