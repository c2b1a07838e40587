"""Raw marketing tables derived from the benchmark tables, at any scale.

Two worlds: *events* (dense daily panel, exact timestamps) and *orders* (sparse
panel over years, larger volume).  A single user or customer may own a large
part of the log, so the logs are always reduced per (key, day, type) - combined
map-side - before they meet the customer table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.scalar import MONEY
from tallyspark.params import MeasurementParams
from tallyspark.plans.models import MeasurementModels

REPO = "owner/repository"
_REGION_ARMS = {
    "treatment_regions": ("AMERICA", "EUROPE"),
    "control_regions": ("AFRICA", "ASIA"),
}
EVENT_TYPES = ("click", "view", "purchase", "signup", "error")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
EVENT_PARAMS = MeasurementParams(
    **_REGION_ARMS,
    channel_categories={
        "click": "Paid Inbound",
        "view": "Paid Outbound",
        "purchase": "Influencer & Media",
        "signup": "Developer Relations",
    },
)
# Orders are larger and older than ad spend: other half-saturation, slower decay.
ORDER_PARAMS = MeasurementParams(
    **_REGION_ARMS,
    half_saturation=300_000.0,
    decay_per_day=0.001,
    channel_categories={
        "1-URGENT": "Paid Inbound",
        "2-HIGH": "Paid Outbound",
        "3-MEDIUM": "Influencer & Media",
        "4-NOT SPECIFIED": "Developer Relations",
    },
)


class Tables:
    """The benchmark tables of one folder; each is opened once."""

    def __init__(self, spark: SparkSession, sf: str):
        self._spark, self._sf = spark, sf
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._spark.read.parquet(f"{self._sf}/{name}.parquet")
        return self._open[name]

    @cached_property
    def regions(self) -> DataFrame:
        """user -> region, one row per customer."""
        customer = self["customer"].select(F.col("c_custkey").alias("user_id"), "c_nationkey")
        nation = self["nation"].select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
        region = self["region"].select(
            F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region")
        )
        return customer.join(nation.join(region, "n_regionkey"), "c_nationkey").select(
            "user_id", "region"
        )


def campaign(number: Column) -> Column:
    return F.concat(F.lit("camp_"), F.lpad((number % 20 + 1).cast("string"), 3, "0"))


def _first_of(kind: str, values: tuple[str, ...], by: str) -> tuple[list[Column], Column]:
    """The value of ``kind`` in the row with the smallest ``by``, per group.

    Returns the aggregates to compute and the expression over them.  One minimum
    per known value keeps numbers only in the aggregation buffer, so Spark can
    hash; a ``min_by`` of text would make it sort the log first.
    """
    minima = [F.min(F.when(F.col(kind) == v, F.col(by))).alias(f"_first{i}") for i, v in enumerate(values)]
    least = F.least(*(F.col(f"_first{i}") for i in range(len(values))))
    first = F.lit(None).cast("string")
    for i, v in enumerate(values):
        first = F.when(F.col(f"_first{i}") == least, v).otherwise(first)
    return minima, first


def _account_columns() -> list[Column]:
    user = F.col("user_id")
    return [
        user.cast("string").alias("account_id"),
        F.col("signup_date"),
        F.col("channel"),
        F.col("region"),
        (user % 10 == 0).alias("is_holdout"),
        F.when(user % 2 == 0, "github_oauth").otherwise("email").alias("signup_method"),
    ]


class EventTables:
    """Raw tables from the event log."""

    def __init__(self, spark: SparkSession, sf: str):
        self.tables = Tables(spark, sf)

    @cached_property
    def events(self) -> DataFrame:
        return self.tables["events"].select(
            "event_id",
            "ts",
            "user_id",
            "event_type",
            "value",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            F.col("ts").cast("date").alias("d"),
        )

    @cached_property
    def marketing_spend(self) -> DataFrame:
        cells = self.events.groupBy("user_id", "d", "event_type").agg(
            F.sum(F.col("value").cast(MONEY)).alias("v"),
            F.sum("k").alias("k"),
            F.count("*").alias("n"),
        )
        n, k = F.sum("n"), F.sum("k")
        return (
            cells.join(self.tables.regions, "user_id")
            .groupBy(F.col("d").alias("date"), F.col("event_type").alias("channel"), "region")
            .agg(
                F.sum("v").cast("double").alias("spend"),
                ((k + n * 20) * 10).alias("impressions"),
                (k + n).alias("clicks"),
                n.alias("platform_reported_conversions"),
            )
        )

    @cached_property
    def _users(self) -> DataFrame:
        """One row per user, in a single hash aggregation of the log."""
        value, kind, day = F.col("value"), F.col("event_type"), F.col("d")

        def of(event_type: str) -> Column:
            return F.when(kind == event_type, value)

        minima, channel = _first_of("event_type", EVENT_TYPES, "event_id")
        qualified = (kind == "signup") & (F.col("k") >= 80)
        return (
            self.events.groupBy("user_id")
            .agg(
                *minima,
                F.coalesce(F.min(F.when(qualified, day)), F.max(day)).alias("signup_date"),
                F.max(of("click")).alias("top_click"),
                F.max(of("view")).alias("top_view"),
                F.max(of("error")).alias("top_error"),
                F.max(of("signup")).alias("top_signup"),
                F.min(value).alias("low"),
                F.sum(of("view").cast(MONEY)).cast("double").alias("views"),
                F.sum(of("error").cast(MONEY)).cast("double").alias("errors"),
                F.sum("k").alias("k"),
            )
            .withColumn("channel", channel)
        )

    @cached_property
    def developer_accounts(self) -> DataFrame:
        return self._users.join(self.tables.regions, "user_id").select(*_account_columns())

    @cached_property
    def project_telemetry(self) -> DataFrame:
        """Users with a click worth more than 100 have a project; the others have none."""
        users = self._users.where("top_click > 100")
        bought = (
            self.events.where((F.col("event_type") == "purchase") & (F.col("value") > 100))
            .groupBy("user_id", "d")
            .agg(F.min("event_id").alias("id"), F.min_by("value", "event_id").alias("paid"))
        )
        upgrades = (
            bought.join(users.select("user_id", "signup_date"), "user_id")
            .where("d >= signup_date")
            .groupBy("user_id")
            .agg(F.min("d").alias("pro_upgrade_date"), F.min_by("paid", "id").alias("paid"))
        )
        upgraded = F.col("pro_upgrade_date").isNotNull()
        return users.join(upgrades, "user_id", "left").select(
            F.concat(F.lit("proj_"), F.col("user_id").cast("string")).alias("project_id"),
            F.col("user_id").cast("string").alias("account_id"),
            F.col("signup_date").alias("provisioned_at"),
            (F.col("top_click") > 150).alias("has_auth"),
            (F.col("top_view") > 150).alias("has_storage"),
            (F.col("top_error") > 150).alias("has_edge_functions"),
            (F.col("top_signup") > 200).alias("has_pgvector"),
            (F.col("low") * 20).alias("time_to_first_query_min"),
            (F.col("views") / 8).alias("compute_hours"),
            F.col("errors").alias("db_size_mb"),
            (F.col("k") / 100.0).cast("double").alias("egress_gb"),
            upgraded.alias("is_pro_upgrade"),
            "pro_upgrade_date",
            F.when(upgraded, F.col("paid")).otherwise(0.0).alias("monthly_invoice_usd"),
        )

    @cached_property
    def touchpoints(self) -> DataFrame:
        return self.events.select(
            F.col("user_id").cast("string").alias("account_id"),
            F.col("event_id").cast("string").alias("touch_id"),
            F.col("ts").alias("touch_timestamp"),
            F.col("event_type").alias("channel"),
            campaign(F.col("k")).alias("campaign_id"),
        )

    @cached_property
    def github_telemetry(self) -> DataFrame:
        """One snapshot a day: counters are that day's events by type."""

        def n(event_type: str) -> Column:
            return F.count(F.when(F.col("event_type") == event_type, 1))

        return (
            self.events.groupBy("d")
            .agg(
                n("view").alias("stars"),
                n("click").alias("forks"),
                n("error").alias("open_issues"),
                n("signup").alias("watchers"),
                F.max("ts").alias("fetched_at"),
            )
            .drop("d")
        )

    @cached_property
    def hackernews_buzz(self) -> DataFrame:
        """One story per user."""
        kind = F.col("event_type")
        return (
            self.events.groupBy("user_id")
            .agg(
                F.count(F.when(kind == "click", 1)).alias("points"),
                F.count(F.when(kind == "view", 1)).alias("num_comments"),
                F.max("ts").alias("created_at"),
            )
            .select(
                F.concat(F.lit("story of user "), F.col("user_id").cast("string")).alias("title"),
                "points",
                "num_comments",
                "created_at",
            )
        )


class OrderTables:
    """Raw tables from the order log."""

    def __init__(self, spark: SparkSession, sf: str):
        self.tables = Tables(spark, sf)

    @cached_property
    def orders(self) -> DataFrame:
        return self.tables["orders"].select(
            "o_orderkey",
            F.col("o_custkey").alias("user_id"),
            "o_orderstatus",
            "o_totalprice",
            "o_orderdate",
            "o_orderpriority",
            F.col("o_orderdate").cast("date").alias("d"),
        )

    @cached_property
    def marketing_spend(self) -> DataFrame:
        lines = (
            self.tables["lineitem"]
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.sum("l_quantity").cast("long").alias("q"), F.count("*").alias("n"))
        )
        cells = (
            self.orders.join(lines, "o_orderkey", "left")
            .groupBy("user_id", "d", "o_orderpriority")
            .agg(
                F.sum(F.col("o_totalprice").cast(MONEY)).alias("v"),
                F.sum("q").alias("q"),
                F.sum("n").alias("n"),
                F.count("*").alias("orders"),
            )
        )
        return (
            cells.join(self.tables.regions, "user_id")
            .groupBy(F.col("d").alias("date"), F.col("o_orderpriority").alias("channel"), "region")
            .agg(
                F.sum("v").cast("double").alias("spend"),
                F.sum("q").alias("impressions"),
                F.sum("n").alias("clicks"),
                F.sum("orders").alias("platform_reported_conversions"),
            )
        )

    @cached_property
    def _customers(self) -> DataFrame:
        """One row per customer, in a single hash aggregation of the log."""
        upgrades = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
        minima, channel = _first_of("o_orderpriority", PRIORITIES, "o_orderkey")
        return (
            self.orders.groupBy("user_id")
            .agg(
                *minima,
                F.min("d").alias("signup_date"),
                F.max(F.when(upgrades, F.col("d"))).alias("pro_upgrade_date"),
                F.count("*").alias("n"),
                F.sum(F.col("o_totalprice").cast(MONEY)).cast("double").alias("v"),
            )
            .withColumn("channel", channel)
        )

    @cached_property
    def developer_accounts(self) -> DataFrame:
        return self._customers.join(self.tables.regions, "user_id").select(*_account_columns())

    @cached_property
    def project_telemetry(self) -> DataFrame:
        """Customers with more than two orders have a project."""
        upgraded = F.col("pro_upgrade_date").isNotNull()
        n = F.col("n")
        return self._customers.where("n > 2").select(
            F.concat(F.lit("proj_"), F.col("user_id").cast("string")).alias("project_id"),
            F.col("user_id").cast("string").alias("account_id"),
            F.col("signup_date").alias("provisioned_at"),
            (n > 6).alias("has_auth"),
            (n > 9).alias("has_storage"),
            (n > 12).alias("has_edge_functions"),
            (n > 16).alias("has_pgvector"),
            (n * 5.0).cast("double").alias("time_to_first_query_min"),
            (F.col("v") / 50000).alias("compute_hours"),
            (F.col("v") / 10000).alias("db_size_mb"),
            (n / 4.0).cast("double").alias("egress_gb"),
            upgraded.alias("is_pro_upgrade"),
            "pro_upgrade_date",
            F.when(upgraded, n * 25.0).otherwise(0.0).cast("double").alias("monthly_invoice_usd"),
        )

    @cached_property
    def touchpoints(self) -> DataFrame:
        return self.orders.select(
            F.col("user_id").cast("string").alias("account_id"),
            F.col("o_orderkey").cast("string").alias("touch_id"),
            F.col("o_orderdate").alias("touch_timestamp"),
            F.col("o_orderpriority").alias("channel"),
            campaign(F.col("o_orderkey")).alias("campaign_id"),
        )

    @cached_property
    def fx_rates(self) -> DataFrame:
        """Daily quotes per market segment: the share of open orders, which is often 0."""
        segment = self.tables["customer"].select(
            F.col("c_custkey").alias("user_id"), F.substring("c_mktsegment", 1, 3).alias("segment")
        )
        per_customer = self.orders.groupBy("user_id", "d").agg(
            F.count(F.when(F.col("o_orderstatus") == "O", 1)).alias("open"),
            F.count("*").alias("n"),
        )
        quote = F.when(F.col("segment") == "BUI", "USD").otherwise(F.col("segment"))
        return (
            per_customer.join(segment, "user_id")
            .groupBy("segment", "d")
            .agg((F.sum("open") / F.sum("n")).alias("rate"))
            .select(
                F.lit("USD").alias("base_currency"),
                quote.alias("quote_currency"),
                "rate",
                F.col("d").cast("timestamp_ntz").alias("fetched_at"),
            )
        )


def event_world(spark: SparkSession, sf: str) -> MeasurementModels:
    return MeasurementModels(EventTables(spark, sf), EVENT_PARAMS, REPO)


def order_world(spark: SparkSession, sf: str) -> MeasurementModels:
    return MeasurementModels(OrderTables(spark, sf), ORDER_PARAMS, REPO)
