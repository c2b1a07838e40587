"""All models of the measurement graph, from raw tables to marts.

Nothing here executes: every attribute is a DataFrame built from the ones it
depends on.  Spark runs work only when one of them is written or collected.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tallyspark.operators import adstock, attribution, geo, lifecycle, staging
from tallyspark.params import DEFAULTS, MeasurementParams
from tallyspark.plans import exports, marts
from tallyspark.sources.files import scan_csv
from tallyspark.sources.schemas import RAW_SCHEMAS
from tallyspark.sources.versions import VersionedTable

VIEWS = (
    "stg_marketing_ad_spend",
    "stg_developer_plg_events",
    "stg_touchpoints",
    "stg_fx_rates",
    "stg_github_telemetry",
    "stg_hackernews_buzz",
    "int_adstock_and_saturation",
    "int_attribution_paths",
    "int_geo_experiment_clusters",
    "int_developer_lifecycle_states",
)
MARTS = (
    "fct_marketing_triangulation_daily",
    "fct_channel_efficiency_daily",
    "fct_developer_cohort_retention",
    "dim_campaigns",
    "dim_developer_projects",
)


@dataclass(frozen=True)
class RawTables:
    """The landed inputs; leave out what the wanted models do not need."""

    marketing_spend: DataFrame | None = None
    developer_accounts: DataFrame | None = None
    project_telemetry: DataFrame | None = None
    touchpoints: DataFrame | None = None
    fx_rates: DataFrame | None = None
    github_telemetry: DataFrame | None = None
    hackernews_buzz: DataFrame | None = None

    @classmethod
    def from_csv(cls, spark: SparkSession, folder: str) -> RawTables:
        """The seven landed files of a folder, typed."""
        return cls(
            **{
                name.removeprefix("raw_"): scan_csv(spark, f"{folder}/{name}.csv", schema)
                for name, schema in RAW_SCHEMAS.items()
            }
        )


class MeasurementModels:
    """Lazily composed models over one set of raw tables."""

    def __init__(
        self,
        raw,  # RawTables, or any object with its attributes
        params: MeasurementParams = DEFAULTS,
        repo_name: str = "owner/repository",
    ):
        self.raw = raw
        self.params = params
        self.repo_name = repo_name

    def store(self, folder: str, *names: str) -> MeasurementModels:
        """Publish models as tables (full refresh) and go on from the stored rows.

        Whatever depends on a stored model reads its table instead of computing
        it again, so store what several later steps share.  Readers of a table
        (:meth:`stored`) see the version before until the new one is complete.
        """
        for name in names or MARTS:
            df = getattr(self, name)
            self.__dict__[name] = VersionedTable(df.sparkSession, f"{folder}/{name}").publish(df)
        return self

    @staticmethod
    def stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
        """The newest published version of a stored model."""
        return VersionedTable(spark, f"{folder}/{name}").read()

    def register_views(self, *names: str) -> None:
        """Make models queryable by name in SQL; nothing is computed."""
        for name in names or VIEWS:
            getattr(self, name).createOrReplaceTempView(name)

    # staging
    @cached_property
    def stg_marketing_ad_spend(self) -> DataFrame:
        return staging.stg_marketing_ad_spend(self.raw.marketing_spend)

    @cached_property
    def stg_developer_plg_events(self) -> DataFrame:
        return staging.stg_developer_plg_events(
            self.raw.developer_accounts, self.raw.project_telemetry, self.params
        )

    @cached_property
    def stg_touchpoints(self) -> DataFrame:
        return staging.stg_touchpoints(self.raw.touchpoints)

    @cached_property
    def stg_fx_rates(self) -> DataFrame:
        return staging.stg_fx_rates(self.raw.fx_rates)

    @cached_property
    def stg_github_telemetry(self) -> DataFrame:
        return staging.stg_github_telemetry(self.raw.github_telemetry, self.repo_name)

    @cached_property
    def stg_hackernews_buzz(self) -> DataFrame:
        return staging.stg_hackernews_buzz(self.raw.hackernews_buzz)

    # intermediate
    @cached_property
    def int_adstock_and_saturation(self) -> DataFrame:
        return adstock.int_adstock_and_saturation(self.stg_marketing_ad_spend, self.params)

    @cached_property
    def int_attribution_paths(self) -> DataFrame:
        return attribution.int_attribution_paths(
            self.stg_touchpoints, self.stg_developer_plg_events, self.params
        )

    @cached_property
    def mta_daily(self) -> DataFrame:
        return attribution.mta_daily(
            self.stg_touchpoints, self.stg_developer_plg_events, self.params
        )

    @cached_property
    def int_geo_experiment_clusters(self) -> DataFrame:
        return geo.int_geo_experiment_clusters(self.stg_developer_plg_events, self.params)

    @cached_property
    def geo_lift_daily(self) -> DataFrame:
        return geo.geo_lift_daily(self.stg_developer_plg_events, self.params)

    @cached_property
    def int_developer_lifecycle_states(self) -> DataFrame:
        return lifecycle.int_developer_lifecycle_states(
            self.stg_developer_plg_events, self.params
        )

    # marts
    @cached_property
    def fct_marketing_triangulation_daily(self) -> DataFrame:
        return marts.fct_marketing_triangulation_daily(
            self.int_adstock_and_saturation, self.mta_daily, self.geo_lift_daily, self.params
        )

    @cached_property
    def fct_channel_efficiency_daily(self) -> DataFrame:
        return marts.fct_channel_efficiency_daily(
            self.stg_marketing_ad_spend, self.stg_developer_plg_events, self.params
        )

    @cached_property
    def fct_developer_cohort_retention(self) -> DataFrame:
        return marts.fct_developer_cohort_retention(self.stg_developer_plg_events, self.params)

    @cached_property
    def dim_campaigns(self) -> DataFrame:
        return marts.dim_campaigns(self.stg_touchpoints, self.params)

    @cached_property
    def dim_developer_projects(self) -> DataFrame:
        return marts.dim_developer_projects(self.int_developer_lifecycle_states)

    # exports
    @cached_property
    def kpi_summary(self) -> DataFrame:
        return exports.kpi_summary(self.fct_marketing_triangulation_daily, self.params)

    @cached_property
    def channel_totals(self) -> DataFrame:
        return exports.channel_totals(self.fct_channel_efficiency_daily)

    @cached_property
    def export_triangulation_daily(self) -> DataFrame:
        return exports.export_triangulation_daily(self.fct_marketing_triangulation_daily)

    @cached_property
    def export_cohorts(self) -> DataFrame:
        return exports.export_cohorts(self.fct_developer_cohort_retention)
