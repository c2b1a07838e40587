"""Lifecycle states of accounts and their projects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import params as P
from tallyspark.params import DEFAULTS, MeasurementParams


def feature_adoption_tier() -> Column:
    """Highest tier whose features are in use; without a project the lowest."""
    auth, storage = F.col("has_auth"), F.col("has_storage")
    return (
        F.when(F.col("has_pgvector"), P.TIER_VECTOR)
        .when(auth & storage & F.col("has_edge_functions"), P.TIER_FULL_STACK)
        .when(auth | storage, P.TIER_CORE)
        .otherwise(P.TIER_RAW)
    )


def activation_speed(params: MeasurementParams = DEFAULTS) -> Column:
    minutes = F.col("time_to_first_query_min")
    return (
        F.when(minutes <= params.rapid_minutes, P.SPEED_RAPID)
        .when(minutes <= params.standard_minutes, P.SPEED_STANDARD)
        .otherwise(P.SPEED_SLOW)
    )


def usage_tier(params: MeasurementParams = DEFAULTS) -> Column:
    hours, size = F.col("compute_hours"), F.col("db_size_mb")
    high = (hours > params.high_compute_hours) & (size > params.high_db_mb)
    moderate = (hours > params.moderate_compute_hours) | (size > params.moderate_db_mb)
    return F.when(high, P.USAGE_HIGH).when(moderate, P.USAGE_MODERATE).otherwise(P.USAGE_LIGHT)


def days_to_upgrade() -> Column:
    days = F.date_diff(F.col("pro_upgrade_date"), F.col("signup_date"))
    return F.when(F.col("is_pro_upgrade"), days.cast("long"))


def int_developer_lifecycle_states(
    stg_plg: DataFrame, params: MeasurementParams = DEFAULTS
) -> DataFrame:
    """Row-wise, no shuffle of its own.  Grain: account x project."""
    return stg_plg.select(
        "account_id",
        "project_id",
        "signup_date",
        "channel",
        "region",
        "signup_method",
        "is_holdout",
        "provisioned_at",
        "has_auth",
        "has_storage",
        "has_edge_functions",
        "has_pgvector",
        feature_adoption_tier().alias("feature_adoption_tier"),
        "time_to_first_query_min",
        activation_speed(params).alias("activation_speed"),
        "compute_hours",
        "db_size_mb",
        "egress_gb",
        usage_tier(params).alias("usage_tier"),
        "is_pro_upgrade",
        "pro_upgrade_date",
        days_to_upgrade().alias("days_to_upgrade"),
        "monthly_invoice_usd",
    )
