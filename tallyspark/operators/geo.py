"""Geo experiment arms and lift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.scalar import count_where
from tallyspark.params import DEFAULTS, MeasurementParams


def experiment_arm(region: str, params: MeasurementParams = DEFAULTS) -> Column:
    """Treatment, control, or holdout for any other (also unknown) region."""
    return (
        F.when(F.col(region).isin(*params.treatment_regions), "treatment")
        .when(F.col(region).isin(*params.control_regions), "control")
        .otherwise("holdout")
    )


def int_geo_experiment_clusters(
    stg_plg: DataFrame, params: MeasurementParams = DEFAULTS
) -> DataFrame:
    """Grain: signup date x channel x region."""
    arm = experiment_arm("region", params).alias("experiment_cohort")
    return stg_plg.groupBy("signup_date", "channel", "region", arm).agg(
        F.count("*").alias("total_signups"),
        count_where(F.col("is_holdout")).alias("holdout_signups"),
        count_where(F.col("is_pro_upgrade")).alias("pro_upgrades"),
    )


def _lift(treated: Column, control: Column) -> list[Column]:
    return [
        treated.alias("treatment_conversions"),
        control.alias("control_conversions"),
        F.greatest(F.lit(0).cast("long"), treated - control).alias("geo_lift_conversions"),
    ]


def geo_lift_daily(stg_plg: DataFrame, params: MeasurementParams = DEFAULTS) -> DataFrame:
    """Treatment minus control upgrades, never below 0.  Grain: signup date x channel.

    Straight from accounts in one aggregation: sums over regions compose, so the
    regional model need not be shuffled first.
    """
    arm = experiment_arm("region", params)
    upgraded = F.col("is_pro_upgrade")
    return (
        stg_plg.groupBy(F.col("signup_date").alias("date_day"), "channel")
        .agg(
            count_where((arm == "treatment") & upgraded).alias("t"),
            count_where((arm == "control") & upgraded).alias("c"),
        )
        .select("date_day", "channel", *_lift(F.col("t"), F.col("c")))
    )


def geo_lift_from_clusters(clusters: DataFrame) -> DataFrame:
    """The same from the regional model, for users who already have it stored."""
    upgrades = F.col("pro_upgrades")
    arm = F.col("experiment_cohort")
    return (
        clusters.groupBy(F.col("signup_date").alias("date_day"), "channel")
        .agg(
            F.sum(F.when(arm == "treatment", upgrades).otherwise(0)).alias("t"),
            F.sum(F.when(arm == "control", upgrades).otherwise(0)).alias("c"),
        )
        .select("date_day", "channel", *_lift(F.col("t"), F.col("c")))
    )
