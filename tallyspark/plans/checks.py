"""The checks that belong to the models, and their report."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyspark.operators import quality
from tallyspark.plans.models import MeasurementModels

NOT_NULL = {
    "stg_github_telemetry": ["repo_name", "stars_count"],
    "stg_marketing_ad_spend": ["spend_date", "spend_usd"],
    "stg_developer_plg_events": ["account_id"],
    "fct_marketing_triangulation_daily": ["date_day", "channel"],
    "dim_campaigns": ["campaign_id"],
    "dim_developer_projects": ["project_id"],
}
NON_NEGATIVE = {
    "stg_github_telemetry": ["stars_count"],
    "stg_hackernews_buzz": ["points"],
    "stg_marketing_ad_spend": ["spend_usd"],
    "fct_marketing_triangulation_daily": ["spend_usd"],
    "fct_channel_efficiency_daily": ["spend_usd"],
}
UNIQUE = {"stg_developer_plg_events": "account_id", "dim_campaigns": "campaign_id"}
GRAIN = {
    "fct_channel_efficiency_daily": ["channel", "date_day"],
    "fct_marketing_triangulation_daily": ["channel", "date_day"],
}


# Models that several checks read; those of a group do not depend on one another.
SHARED = (
    (
        "stg_marketing_ad_spend",
        "stg_developer_plg_events",
        "stg_github_telemetry",
        "stg_hackernews_buzz",
        "dim_campaigns",
    ),
    (
        "dim_developer_projects",
        "fct_channel_efficiency_daily",
        "fct_marketing_triangulation_daily",
    ),
)


def _broken(name: str) -> dict[str, Column]:
    """The conditions under which a row of a model breaks a null or sign check."""
    broken = {f"{name}.{c} not null": F.col(c).isNull() for c in NOT_NULL.get(name, [])}
    return broken | {f"{name}.{c} non-negative": F.col(c) < 0 for c in NON_NEGATIVE.get(name, [])}


def column_checks(models: MeasurementModels) -> list[DataFrame]:
    """Null and sign checks: one pass over each model, whatever the number of columns."""
    return [
        quality.row_checks(getattr(models, name), _broken(name))
        for name in dict.fromkeys([*NOT_NULL, *NON_NEGATIVE])
    ]


def store_observed(models: MeasurementModels, folder: str, groups=SHARED, at_a_time: int = 4) -> DataFrame:
    """Store models and count what breaks their null and sign checks in the same pass.

    One row per check, like :func:`column_checks`; the counts are taken while the rows are
    written, so no table is read for them.  Later checks read the stored tables.  The
    models of a group are stored side by side, so that small ones do not wait for the cluster.
    """

    def store(name: str) -> list[tuple[str, int]]:
        broken = _broken(name)
        if not broken:
            models.store(folder, name)
            return []
        seen = Observation(f"{name} checks")
        counted = [F.count_if(condition).alias(str(i)) for i, condition in enumerate(broken.values())]
        models.__dict__[name] = getattr(models, name).observe(seen, *counted)
        models.store(folder, name)
        return [(check, seen.get[str(i)]) for i, check in enumerate(broken)]

    counts = []
    with ThreadPoolExecutor(at_a_time) as pool:
        for names in groups:
            for found in pool.map(store, names):
                counts += found
    spark = models.stg_marketing_ad_spend.sparkSession
    return spark.createDataFrame(counts, "check_name string, n_violations long")


def observed_report(models: MeasurementModels, folder: str) -> DataFrame:
    """The rows of :func:`report`, each model computed once: stored, and checked on the way."""
    columns = store_observed(models, folder)
    return quality.report([columns, *key_checks(models), *reconciliation_checks(models)])


def key_checks(models: MeasurementModels) -> list[DataFrame]:
    """Uniqueness of keys and grains."""
    keys = [
        quality.counted(f"{name}.{key} unique", quality.unique(getattr(models, name), key))
        for name, key in UNIQUE.items()
    ]
    grains = [
        quality.counted(f"{name} grain", quality.unique_grain(getattr(models, name), columns))
        for name, columns in GRAIN.items()
    ]
    return keys + grains


def reconciliation_checks(models: MeasurementModels) -> list[DataFrame]:
    """Totals that must agree: attribution weights, and spend from raw to mart."""
    raw, staged = models.raw.marketing_spend, models.stg_marketing_ad_spend
    mart = models.fct_channel_efficiency_daily
    return [
        quality.counted(
            "attribution weights sum to one",
            quality.weight_violations(models.int_attribution_paths),
        ),
        quality.counted(
            "raw spend equals staging",
            quality.drift_violations(raw, "spend", staged, "spend_usd"),
        ),
        quality.counted(
            "staging spend equals mart",
            quality.drift_violations(staged, "spend_usd", mart, "spend_usd"),
        ),
    ]


def report(models: MeasurementModels) -> DataFrame:
    """All checks as rows ``check_name, n_violations, passed``."""
    return quality.report(
        column_checks(models) + key_checks(models) + reconciliation_checks(models)
    )
