"""Marts: what analysts read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import params as P
from tallyspark.functions.scalar import count_where, exact_sum, round_n, safe_ratio
from tallyspark.operators.adstock import daily_channel_spend
from tallyspark.params import DEFAULTS, MeasurementParams

_DAY_CHANNEL = ["date_day", "channel"]


def platform_bias(platform: Column | str, modelled: Column | str) -> Column:
    """How far platform claims exceed the model, in percent; NULL if it says 0."""
    platform = F.col(platform) if isinstance(platform, str) else platform
    modelled = F.col(modelled) if isinstance(modelled, str) else modelled
    return safe_ratio(platform - modelled, modelled) * 100


def fct_marketing_triangulation_daily(
    mmm: DataFrame, mta: DataFrame, geo: DataFrame, params: MeasurementParams = DEFAULTS
) -> DataFrame:
    """Model, touch credit and geo lift side by side.  Grain: date x channel.

    The spend panel is the spine: credit on a day without spend is not shown.
    All three inputs are already grouped by the join keys, so the joins reuse
    their partitioning.
    """
    spine = mmm.withColumnRenamed("spend_date", "date_day")
    joined = spine.join(mta, _DAY_CHANNEL, "left").join(geo, _DAY_CHANNEL, "left")
    modelled = F.col("mmm_estimated_conversions")
    claimed = F.col("platform_conversions")
    credits = [
        f"mta_{kind}_conversions" for kind in ("first_touch", "last_touch", "linear", "time_decay")
    ]
    return joined.select(
        *_DAY_CHANNEL,
        "spend_usd",
        "impressions",
        "clicks",
        claimed.alias("platform_reported_conversions"),
        *(F.coalesce(c, F.lit(0.0)).alias(c) for c in credits),
        modelled.alias("mmm_estimated_incremental_conversions"),
        F.coalesce("geo_lift_conversions", F.lit(0).cast("long")).alias("geo_lift_conversions"),
        round_n(platform_bias(claimed, modelled), 2).alias("platform_overreporting_bias_pct"),
        round_n(safe_ratio("spend_usd", claimed), 2).alias("blended_cac_usd"),
        round_n(safe_ratio("spend_usd", modelled), 2).alias("incremental_cac_usd"),
        round_n(safe_ratio(modelled * params.value_per_conversion, "spend_usd"), 2).alias(
            "incremental_roas"
        ),
    )


def signups_daily(stg_plg: DataFrame) -> DataFrame:
    """Signups, later upgrades and revenue by signup date.  Grain: date x channel."""
    return stg_plg.groupBy(F.col("signup_date").alias("date_day"), "channel").agg(
        F.count("*").alias("total_signups"),
        count_where(F.col("is_pro_upgrade")).alias("total_pro_upgrades"),
        exact_sum("monthly_invoice_usd").alias("total_revenue_usd"),
    )


def fct_channel_efficiency_daily(
    stg_spend: DataFrame, stg_plg: DataFrame, params: MeasurementParams = DEFAULTS
) -> DataFrame:
    """Unit cost per day and channel.  Grain: date x channel.

    ``blended_cac_usd`` is spend per *upgrade* here and spend per *platform
    claim* in the triangulation mart; both names are established.
    """
    spend = daily_channel_spend(stg_spend).withColumnRenamed("spend_date", "date_day")
    joined = spend.join(signups_daily(stg_plg), _DAY_CHANNEL, "left")
    cac = safe_ratio("spend_usd", "total_pro_upgrades")
    none = F.lit(0).cast("long")
    return joined.select(
        *spend.columns,
        round_n(safe_ratio("spend_usd", "clicks"), 2).alias("cpc_usd"),
        round_n(safe_ratio("clicks", "impressions") * 100, 4).alias("ctr_pct"),
        F.coalesce("total_signups", none).alias("total_signups"),
        F.coalesce("total_pro_upgrades", none).alias("total_pro_upgrades"),
        F.coalesce("total_revenue_usd", F.lit(0.0)).alias("total_revenue_usd"),
        round_n(cac, 2).alias("blended_cac_usd"),
        round_n(cac / params.monthly_revenue_per_user, 1).alias("payback_period_months"),
    )


def fct_developer_cohort_retention(
    stg_plg: DataFrame, params: MeasurementParams = DEFAULTS
) -> DataFrame:
    """Weekly cohorts (Monday start).  Grain: week x channel.

    "Active" is a usage threshold, not a dated observation.
    """
    week = F.trunc("signup_date", "week").cast("timestamp_ntz").alias("cohort_week")
    hours = F.col("compute_hours")
    cohorts = stg_plg.groupBy(week, "channel").agg(
        F.count("*").alias("total_cohort_signups"),
        count_where(hours > params.week_active_hours).alias("day_7_active_count"),
        count_where(hours > params.month_active_hours).alias("day_30_active_count"),
        count_where(F.col("is_pro_upgrade")).alias("pro_upgrade_count"),
        exact_sum("monthly_invoice_usd").alias("total_mrr_usd"),
    )
    rates = {
        "day_7_activation_rate_pct": "day_7_active_count",
        "day_30_retention_rate_pct": "day_30_active_count",
        "pro_conversion_rate_pct": "pro_upgrade_count",
    }
    return cohorts.select(
        "*",
        *(
            round_n(safe_ratio(count, "total_cohort_signups") * 100, 2).alias(rate)
            for rate, count in rates.items()
        ),
    )


def dim_campaigns(stg_touches: DataFrame, params: MeasurementParams = DEFAULTS) -> DataFrame:
    """Campaigns with channel, category and persona.  Grain: campaign.

    Touches are reduced to distinct (campaign, channel) pairs before the
    minimum is taken: that part hashes without sorting and shrinks map-side.
    """
    pairs = stg_touches.select("campaign_id", "channel").distinct()
    campaigns = pairs.groupBy("campaign_id").agg(F.min("channel").alias("channel"))
    category = F.lit(P.OTHER_CHANNEL_CATEGORY)
    for name, value in params.channel_categories.items():
        category = F.when(F.col("channel") == name, value).otherwise(category)
    persona = F.lit(P.OTHER_PERSONA)
    for value, ids in params.campaign_personas.items():
        persona = F.when(F.col("campaign_id").isin(*ids), value).otherwise(persona)
    return campaigns.select(
        "*",
        category.alias("channel_category"),
        persona.alias("target_developer_persona"),
    )


def dim_developer_projects(lifecycle: DataFrame) -> DataFrame:
    """Projects with their lifecycle states.  Grain: account x project."""
    left_out = {"project_id", "account_id", "time_to_first_query_min"}
    return lifecycle.select(
        "project_id", "account_id", *(c for c in lifecycle.columns if c not in left_out)
    )
