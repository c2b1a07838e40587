"""Staging models: one input table each, renamed and typed.

Whole-number columns are 64 bit: daily totals of a large log pass 2^31.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.scalar import round_n, safe_ratio, whole_number
from tallyspark.operators.ranking import distributed_row_number
from tallyspark.params import DEFAULTS, MeasurementParams


def stg_marketing_ad_spend(raw_spend: DataFrame) -> DataFrame:
    """Grain: date x channel x region."""
    return raw_spend.select(
        F.col("date").cast("date").alias("spend_date"),
        "channel",
        "region",
        F.col("spend").cast("double").alias("spend_usd"),
        whole_number(raw_spend, "impressions").alias("impressions"),
        whole_number(raw_spend, "clicks").alias("clicks"),
        whole_number(raw_spend, "platform_reported_conversions").alias("platform_conversions"),
        round_n(safe_ratio("spend", "clicks"), 2).alias("cpc_usd"),
        round_n(safe_ratio("clicks", "impressions") * 100, 4).alias("ctr_pct"),
    )


def stg_developer_plg_events(
    raw_accounts: DataFrame,
    raw_projects: DataFrame,
    params: MeasurementParams = DEFAULTS,
) -> DataFrame:
    """Every account with its project (NULLs without one).  Grain: account x project.

    An inner join plus the accounts without a project: Spark may split a heavy
    account on either side of an inner join at run time, which it cannot do for the
    right side of a left join.
    """
    accounts = raw_accounts.select(
        "account_id",
        F.col("signup_date").cast("date").alias("signup_date"),
        "channel",
        "region",
        F.col("is_holdout").cast("boolean").alias("is_holdout"),
        "signup_method",
    )
    flags = ["has_auth", "has_storage", "has_edge_functions", "has_pgvector"]
    measures = ["time_to_first_query_min", "compute_hours", "db_size_mb", "egress_gb"]
    projects = raw_projects.select(
        "account_id",
        "project_id",
        F.col("provisioned_at").cast("date").alias("provisioned_at"),
        *(F.col(c).cast("boolean").alias(c) for c in flags),
        *(F.col(c).cast("double").alias(c) for c in measures),
        F.col("is_pro_upgrade").cast("boolean").alias("is_pro_upgrade"),
        F.col("pro_upgrade_date").cast("date").alias("pro_upgrade_date"),
        F.col("monthly_invoice_usd").cast("double").alias("monthly_invoice_usd"),
    )
    matched = accounts.join(projects, "account_id")
    alone = accounts.join(projects.select("account_id").distinct(), "account_id", "left_anti")
    joined = matched.unionByName(alone, allowMissingColumns=True)
    return joined.select(
        "account_id",
        "project_id",
        *[c for c in accounts.columns if c != "account_id"],
        *[c for c in projects.columns if c not in ("account_id", "project_id")],
    )


def stg_touchpoints(raw_touchpoints: DataFrame) -> DataFrame:
    """Grain: touch."""
    stamp = F.col("touch_timestamp").cast("timestamp_ntz")
    return raw_touchpoints.select(
        "account_id",
        "touch_id",
        stamp.alias("touch_timestamp"),
        stamp.cast("date").alias("touch_date"),
        "channel",
        "campaign_id",
    )


def stg_fx_rates(raw_fx: DataFrame, home_currency: str = "USD") -> DataFrame:
    """Quoted rates plus the multiplier that turns the quote into home currency."""
    rate = F.col("rate").cast("double")
    return raw_fx.select(
        "base_currency",
        "quote_currency",
        rate.alias("exchange_rate"),
        F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"),
        F.when(F.col("quote_currency") == home_currency, F.lit(1.0))
        .otherwise(safe_ratio(F.lit(1.0), rate))
        .alias("rate_to_usd"),
    )


def stg_github_telemetry(raw_repo: DataFrame, repo_name: str) -> DataFrame:
    """Repository counters under one constant repository name.  Grain: snapshot."""
    return raw_repo.select(
        F.lit(repo_name).alias("repo_name"),
        *(
            whole_number(raw_repo, c).alias(f"{c}_count")
            for c in ("stars", "forks", "open_issues", "watchers")
        ),
        F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"),
    )


def buzz_scored(raw_buzz: DataFrame) -> DataFrame:
    """Story columns with the weighted score, without the running number."""
    points = F.col("points").cast("double")
    comments = F.col("num_comments").cast("double")
    return raw_buzz.select(
        "title",
        whole_number(raw_buzz, "points").alias("points"),
        whole_number(raw_buzz, "num_comments").alias("num_comments"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        round_n(points * 1.5 + comments * 2.0, 2).alias("buzz_score"),
    )


def stg_hackernews_buzz(raw_buzz: DataFrame) -> DataFrame:
    """Stories numbered from the newest; equal times are ordered by title."""
    ranked = distributed_row_number(
        buzz_scored(raw_buzz),
        [F.col("created_at").desc_nulls_last(), F.col("title").asc_nulls_last()],
        "story_id",
    )
    return ranked.select(
        "story_id", "title", "points", "num_comments", "created_at", "buzz_score"
    )
