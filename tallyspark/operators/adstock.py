"""Media-mix response: carry-over, saturation and the response curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.scalar import exact_sum, hill, round_n
from tallyspark.params import DEFAULTS, RESPONSE_GRID, MeasurementParams


def daily_channel_spend(stg_spend: DataFrame) -> DataFrame:
    """Spend and volumes.  Grain: date x channel.

    Everything with a window downstream starts here, so windows see days x
    channels rows however large the spend log is.
    """
    return stg_spend.groupBy("spend_date", "channel").agg(
        exact_sum("spend_usd").alias("spend_usd"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum("platform_conversions").alias("platform_conversions"),
    )


def _carried(k: int, calendar: bool) -> Column:
    by_channel = Window.partitionBy("channel")
    if not calendar:
        earlier = F.lag("spend_usd", k).over(by_channel.orderBy("spend_date"))
    else:
        day = F.unix_date("spend_date").cast("long")
        earlier = F.sum("spend_usd").over(by_channel.orderBy(day).rangeBetween(-k, -k))
    return F.coalesce(earlier, F.lit(0.0))


def adstock_lags(
    panel: DataFrame, params: MeasurementParams = DEFAULTS, calendar: bool = False
) -> DataFrame:
    """Add ``lag1..lagN``: spend of the N previous rows of the channel, 0 if none.

    ``calendar=True`` looks N *days* back instead, which differs where a day is
    missing from the panel.
    """
    ks = range(1, len(params.adstock_weights))
    return panel.select("*", *(_carried(k, calendar).alias(f"lag{k}") for k in ks))


def adstock(
    panel: DataFrame, params: MeasurementParams = DEFAULTS, calendar: bool = False
) -> DataFrame:
    """Add ``spend_adstocked``: today's spend plus weighted carry-over."""
    first, *rest = params.adstock_weights
    total = F.col("spend_usd") if first == 1.0 else F.lit(first) * F.col("spend_usd")
    for k, weight in enumerate(rest, start=1):
        total = total + F.lit(weight) * F.col(f"lag{k}")
    return adstock_lags(panel, params, calendar).select(
        *panel.columns, round_n(total, 2).alias("spend_adstocked")
    )


def saturate(adstocked: DataFrame, params: MeasurementParams = DEFAULTS) -> DataFrame:
    """Add the saturation index and the conversions it stands for."""
    response = hill("spend_adstocked", params.half_saturation)
    return adstocked.select(
        "*",
        round_n(response, 4).alias("saturation_index"),
        round_n(response * params.max_daily_conversions, 1).alias("mmm_estimated_conversions"),
    )


def int_adstock_and_saturation(
    stg_spend: DataFrame, params: MeasurementParams = DEFAULTS, calendar: bool = False
) -> DataFrame:
    """Grain: date x channel."""
    return saturate(adstock(daily_channel_spend(stg_spend), params, calendar), params)


def response_curve(
    curves: DataFrame,
    grid: Sequence[float] = RESPONSE_GRID,
    params: MeasurementParams = DEFAULTS,
) -> DataFrame:
    """Evaluate the saturation curve of every row of ``curves`` over a spend grid.

    ``curves`` may carry its own ``half_saturation``.  Conversions come from the
    rounded index here, unlike in the daily model.
    """
    if "half_saturation" not in curves.columns:
        curves = curves.withColumn("half_saturation", F.lit(params.half_saturation))
    points = F.array(*(F.lit(float(g)) for g in grid))
    return (
        curves.select("*", F.explode(points).alias("spend_usd"))
        .withColumn("saturation_index", round_n(hill("spend_usd", F.col("half_saturation")), 4))
        .withColumn(
            "estimated_conversions",
            round_n(F.col("saturation_index") * params.max_daily_conversions, 1),
        )
    )
