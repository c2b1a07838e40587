"""What the dashboard reads: summaries, sorted extracts and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.scalar import (
    channel_label,
    dollars,
    exact_sum,
    round_n,
    safe_ratio,
    signed_percent,
    week_label,
)
from tallyspark.params import DEFAULTS, MeasurementParams
from tallyspark.plans.marts import platform_bias

_MODELLED = "mmm_estimated_incremental_conversions"
_CLAIMED = "platform_reported_conversions"


def kpi_summary(triangulation: DataFrame, params: MeasurementParams = DEFAULTS) -> DataFrame:
    """Eight headline figures, one row; ratios are ratios of totals."""
    totals = triangulation.agg(
        exact_sum("spend_usd").alias("spend"),
        F.sum(_CLAIMED).alias("claimed"),
        exact_sum(_MODELLED).alias("modelled"),
    )
    incremental = safe_ratio("spend", "modelled")
    return totals.select(
        round_n("spend", 2).alias("total_spend"),
        round_n("claimed", 0).alias("total_platform_conversions"),
        round_n("modelled", 1).alias("total_causal_conversions"),
        round_n(platform_bias("claimed", "modelled"), 1).alias("platform_bias_pct"),
        round_n(safe_ratio("spend", "claimed"), 2).alias("blended_cac"),
        round_n(incremental, 2).alias("incremental_cac"),
        round_n(
            safe_ratio(F.col("modelled") * params.value_per_conversion, "spend"), 2
        ).alias("marginal_roas"),
        round_n(incremental / params.monthly_revenue_per_user, 1).alias("payback_months"),
    )


def channel_totals(efficiency: DataFrame) -> DataFrame:
    """Totals per channel, largest spend first; CPC and CTR are means of daily ratios."""

    def mean(column: str):
        return safe_ratio(exact_sum(column), F.count(column))

    spend = exact_sum("spend_usd")
    upgrades = F.sum("total_pro_upgrades")
    return (
        efficiency.groupBy("channel")
        .agg(
            round_n(spend, 2).alias("spend_usd"),
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("clicks"),
            F.sum("total_signups").alias("total_signups"),
            upgrades.alias("total_pro_upgrades"),
            round_n(safe_ratio(spend, upgrades), 2).alias("blended_cac"),
            round_n(mean("cpc_usd"), 2).alias("avg_cpc"),
            round_n(mean("ctr_pct"), 3).alias("avg_ctr"),
        )
        .orderBy(F.col("spend_usd").desc_nulls_last(), F.asc_nulls_last("channel"))
    )


def export_triangulation_daily(triangulation: DataFrame) -> DataFrame:
    """Daily extract, newest day and largest spend first."""
    return triangulation.select(
        F.col("date_day").cast("string").alias("date_day"),
        "channel",
        round_n("spend_usd", 2).alias("spend_usd"),
        _CLAIMED,
        "mta_first_touch_conversions",
        "mta_last_touch_conversions",
        _MODELLED,
        "geo_lift_conversions",
        "platform_overreporting_bias_pct",
        "incremental_cac_usd",
        "incremental_roas",
    ).orderBy(
        F.desc_nulls_last("date_day"), F.desc_nulls_last("spend_usd"), F.asc_nulls_last("channel")
    )


def export_cohorts(cohorts: DataFrame) -> DataFrame:
    """Cohorts, newest week first; channels of a week in name order."""
    return cohorts.withColumn(
        "cohort_week", F.date_format("cohort_week", "yyyy-MM-dd HH:mm:ss")
    ).orderBy(F.desc_nulls_last("cohort_week"), F.asc_nulls_last("channel"))


def recent_cohorts(cohort_export: DataFrame, rows: int = 8) -> DataFrame:
    """The newest rows of the cohort export, oldest of them first, for the chart."""
    newest = cohort_export.orderBy(
        F.desc_nulls_last("cohort_week"), F.asc_nulls_last("channel")
    ).limit(rows)
    return newest.select(
        week_label("cohort_week").alias("week"),
        "channel",
        "day_7_activation_rate_pct",
        "day_30_retention_rate_pct",
        "pro_conversion_rate_pct",
    ).orderBy("week", F.desc("channel"))


def triangulation_channel_rollup(triangulation: DataFrame) -> DataFrame:
    """Four conversion counts per channel, NULL as 0; the modelled one is whole."""

    def total(column: str):
        return exact_sum(F.coalesce(column, F.lit(0)))

    return triangulation.groupBy("channel").agg(
        total(_CLAIMED).alias("platform_total"),
        total("mta_first_touch_conversions").alias("first_touch_total"),
        total("mta_last_touch_conversions").alias("last_touch_total"),
        round_n(total(_MODELLED), 0).alias("mmm_total"),
    )


def explorer_rows(
    triangulation_export: DataFrame, channel: str = "all", rows: int = 50
) -> DataFrame:
    """The first rows of the daily extract, of one channel or of all."""
    chosen = triangulation_export
    if channel != "all":
        chosen = chosen.where(F.col("channel") == channel)
    return chosen.orderBy(
        F.desc_nulls_last("date_day"), F.desc_nulls_last("spend_usd"), F.asc("channel")
    ).limit(rows)


def explorer_labels(triangulation_export: DataFrame) -> DataFrame:
    """The extract as display text."""
    return triangulation_export.select(
        "date_day",
        "channel",
        channel_label("channel").alias("channel_label"),
        dollars("spend_usd").alias("spend_label"),
        signed_percent("platform_overreporting_bias_pct").alias("bias_label"),
        signed_percent(F.col("geo_lift_conversions")).alias("lift_label"),
    )


def latest_snapshot(snapshots: DataFrame, time_column: str = "fetched_at") -> DataFrame:
    """The newest row of a snapshot table; of equally new ones the smallest by its columns."""
    rest = [F.asc_nulls_last(c) for c in snapshots.columns if c != time_column]
    return snapshots.orderBy(F.desc_nulls_last(time_column), *rest).limit(1)


def top_stories(buzz: DataFrame, rows: int = 5) -> DataFrame:
    """Stories with the most points; equal points in title order."""
    return (
        buzz.select("title", "points", "num_comments", "created_at")
        .orderBy(F.desc_nulls_last("points"), F.asc_nulls_last("title"))
        .limit(rows)
    )


def fx_extract(raw_fx: DataFrame) -> DataFrame:
    return raw_fx.select("quote_currency", "rate")
