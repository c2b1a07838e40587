"""Geo, lifecycle, marts and exports on small hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import geo, lifecycle, staging
from tallyspark.params import DEFAULTS
from tallyspark.plans import exports, marts
from tallyspark.sources.schemas import DEVELOPER_ACCOUNTS, PROJECT_TELEMETRY

SUNDAY, MONDAY = dt.date(2026, 3, 1), dt.date(2026, 3, 2)


def account(i, region="US-East", day=MONDAY, channel="c", holdout=False):
    return (f"a{i}", day, channel, region, holdout, "email")


def project(i, auth=False, storage=False, edge=False, vector=False, minutes=10.0, hours=0.0,
            mb=0.0, pro=False, invoice=0.0, suffix=""):
    when = MONDAY + dt.timedelta(days=4) if pro else None
    return (f"p{i}{suffix}", f"a{i}", MONDAY, auth, storage, edge, vector, minutes, hours, mb,
            1.0, pro, when, invoice)


@pytest.fixture
def plg(spark):
    def build(accounts, projects):
        return staging.stg_developer_plg_events(
            spark.createDataFrame(accounts, DEVELOPER_ACCOUNTS),
            spark.createDataFrame(projects, PROJECT_TELEMETRY),
        )

    return build


def test_account_without_project_falls_to_the_lowest_tiers(plg, rows):
    states = lifecycle.int_developer_lifecycle_states(plg([account(1)], []))
    assert rows(
        states, "project_id", "feature_adoption_tier", "activation_speed", "usage_tier",
        "is_pro_upgrade", "days_to_upgrade",
    ) == [(None, "Raw Postgres DB", "Slow / Lagged (>60m)", "Light Evaluation", None, None)]


def test_two_projects_multiply_the_account(plg, rows):
    df = plg([account(1)], [project(1), project(1, suffix="x")])
    assert rows(df, "project_id") == [("p1",), ("p1x",)]


def test_tiers(plg, rows):
    cases = [
        (project(1, vector=True, auth=True), "AI Vector Platform"),
        (project(2, auth=True, storage=True, edge=True), "Full Stack BaaS"),
        (project(3, storage=True, edge=True), "Core Features"),
        (project(4, edge=True), "Raw Postgres DB"),
    ]
    states = lifecycle.int_developer_lifecycle_states(
        plg([account(i) for i in range(1, 5)], [c[0] for c in cases])
    )
    assert [r[1] for r in rows(states, "account_id", "feature_adoption_tier")] == [c[1] for c in cases]


@pytest.mark.parametrize(
    "kw, column, want",
    [
        ({"minutes": 15.0}, "activation_speed", "Rapid Activation (<15m)"),
        ({"minutes": 60.0}, "activation_speed", "Standard Activation (15-60m)"),
        ({"minutes": 60.1}, "activation_speed", "Slow / Lagged (>60m)"),
        ({"hours": 101.0, "mb": 501.0}, "usage_tier", "High Consumption"),
        ({"hours": 101.0, "mb": 500.0}, "usage_tier", "Moderate Consumption"),
        ({"hours": 20.0, "mb": 50.0}, "usage_tier", "Light Evaluation"),
        ({"pro": True}, "days_to_upgrade", 4),
    ],
)
def test_thresholds(plg, rows, kw, column, want):
    states = lifecycle.int_developer_lifecycle_states(plg([account(1)], [project(1, **kw)]))
    assert rows(states, column) == [(want,)]


def test_arms_and_lift(plg, rows):
    regions = ["US-East", "EU-Central", "US-West", "APAC-SG", "LATAM", None, "US-East"]
    accounts = [account(i, r, holdout=r is None) for i, r in enumerate(regions)]
    df = plg(accounts, [project(i, pro=True) for i in range(7)])
    clusters = geo.int_geo_experiment_clusters(df)
    arms = dict(rows(clusters.select("region", "experiment_cohort").distinct()))
    assert arms == {
        "US-East": "treatment", "EU-Central": "treatment", "US-West": "control",
        "APAC-SG": "control", "LATAM": "holdout", None: "holdout",
    }
    assert rows(geo.geo_lift_daily(df)) == [(MONDAY, "c", 3, 2, 1)]
    assert rows(geo.geo_lift_from_clusters(clusters)) == [(MONDAY, "c", 3, 2, 1)]
    assert rows(clusters.agg(F.sum("holdout_signups"))) == [(1,)]


def test_lift_is_never_negative(plg, rows):
    df = plg([account(1, "US-West")], [project(1, pro=True)])
    assert rows(geo.geo_lift_daily(df)) == [(MONDAY, "c", 0, 1, 0)]


def test_cohort_week_starts_on_monday(plg, rows):
    accounts = [account(1, day=SUNDAY), account(2, day=MONDAY), account(3, day=MONDAY)]
    projects = [project(1, hours=5.0), project(2, hours=20.5, pro=True, invoice=40.0)]
    got = rows(marts.fct_developer_cohort_retention(plg(accounts, projects)))
    week = dt.datetime(2026, 2, 23), dt.datetime(2026, 3, 2)
    assert got == [
        (week[0], "c", 1, 0, 0, 0, 0.0, 0.0, 0.0, 0.0),
        (week[1], "c", 2, 1, 1, 1, 40.0, 50.0, 50.0, 50.0),
    ]


def spend(spark, data):
    return spark.createDataFrame(
        data,
        "spend_date date, channel string, region string, spend_usd double, impressions long, "
        "clicks long, platform_conversions long, cpc_usd double, ctr_pct double",
    )


def test_efficiency_keeps_spend_days_only(spark, plg, rows):
    df = plg(
        [account(1), account(2, channel="no spend")],
        [project(1, pro=True, invoice=60.0), project(2, pro=True)],
    )
    s = spend(
        spark,
        [(MONDAY, "c", "x", 100.0, 1000, 10, 3, None, None), (SUNDAY, "c", "x", 5.0, 0, 0, 0, None, None)],
    )
    assert rows(marts.fct_channel_efficiency_daily(s, df)) == [
        (SUNDAY, "c", 5.0, 0, 0, 0, None, None, 0, 0, 0.0, None, None),
        (MONDAY, "c", 100.0, 1000, 10, 3, 10.0, 1.0, 1, 1, 60.0, 100.0, 4.0),
    ]


MMM = (
    "spend_date date, channel string, spend_usd double, impressions long, clicks long, "
    "platform_conversions long, spend_adstocked double, saturation_index double, "
    "mmm_estimated_conversions double"
)
MTA = (
    "date_day date, channel string, mta_first_touch_conversions double, "
    "mta_last_touch_conversions double, mta_linear_conversions double, "
    "mta_time_decay_conversions double"
)
GEO = (
    "date_day date, channel string, treatment_conversions long, control_conversions long, "
    "geo_lift_conversions long"
)


@pytest.fixture
def triangulation(spark):
    mmm = spark.createDataFrame(
        [
            (MONDAY, "paid_search", 2174.09, 9, 9, 241, 1.0, 0.1, 30.2),
            (MONDAY, "paid_social", 1468.07, 9, 9, 180, 1.0, 0.1, 25.6),
            (SUNDAY, "paid_search", 0.0, 9, 9, 0, 0.0, 0.0, 0.0),
        ],
        MMM,
    )
    mta = spark.createDataFrame(
        [(MONDAY, "paid_search", 1.0, 2.0, 1.5, 1.25), (MONDAY, "no spend", 9.0, 9.0, 9.0, 9.0)], MTA
    )
    return marts.fct_marketing_triangulation_daily(mmm, mta, spark.createDataFrame([], GEO))


def test_published_daily_rows(triangulation, rows):
    """Inputs and outputs of two published rows, and a day without anything."""
    got = rows(
        triangulation, "date_day", "channel", "platform_overreporting_bias_pct",
        "incremental_cac_usd", "incremental_roas", "mta_last_touch_conversions",
        "geo_lift_conversions", "blended_cac_usd",
    )
    assert got == [
        (SUNDAY, "paid_search", None, None, None, 0.0, 0, None),
        (MONDAY, "paid_search", 698.01, 71.99, 2.08, 2.0, 0, 9.02),
        (MONDAY, "paid_social", 603.13, 57.35, 2.62, 0.0, 0, 8.16),
    ]


def test_summary_is_a_ratio_of_totals(triangulation, rows):
    spend_total, claimed, modelled = 2174.09 + 1468.07, 421, 55.8
    assert rows(exports.kpi_summary(triangulation)) == [
        (
            round(spend_total, 2), 421.0, modelled, round((claimed - modelled) / modelled * 100, 1),
            round(spend_total / claimed, 2), round(spend_total / modelled, 2),
            round(modelled * 150 / spend_total, 2), round(spend_total / modelled / 25, 1),
        )
    ]


def test_explorer_order_filter_and_limit(triangulation, rows):
    daily = exports.export_triangulation_daily(triangulation)
    every = rows(exports.explorer_rows(daily), "date_day", "channel", ordered=True)
    assert every == [
        ("2026-03-02", "paid_search"), ("2026-03-02", "paid_social"), ("2026-03-01", "paid_search"),
    ]
    assert rows(exports.explorer_rows(daily, "paid_social"), "channel") == [("paid_social",)]
    assert len(rows(exports.explorer_rows(daily, rows=2))) == 2


def test_channel_rollup_rounds_the_model(triangulation, rows):
    assert rows(exports.triangulation_channel_rollup(triangulation)) == [
        ("paid_search", 241.0, 1.0, 2.0, 30.0), ("paid_social", 180.0, 0.0, 0.0, 26.0),
    ]


def test_recent_cohorts_are_rows_not_weeks(spark, rows):
    data = [(f"2026-01-{d:02} 00:00:00", c, 1.0, 2.0, 3.0) for d in (5, 12, 19) for c in "abcd"]
    df = spark.createDataFrame(
        data,
        "cohort_week string, channel string, day_7_activation_rate_pct double, "
        "day_30_retention_rate_pct double, pro_conversion_rate_pct double",
    )
    got = rows(exports.recent_cohorts(df), "week", "channel", ordered=True)
    assert got == [("2026-01-12", c) for c in "dcba"] + [("2026-01-19", c) for c in "dcba"]


def test_campaign_takes_first_channel_by_name(spark, rows):
    df = spark.createDataFrame(
        [("camp_001", "paid_social"), ("camp_001", "community_events"), ("camp_004", "paid_search"),
         ("camp_020", "organic_direct")],
        "campaign_id string, channel string",
    )
    assert rows(marts.dim_campaigns(df)) == [
        ("camp_001", "community_events", "Developer Relations", "Indie Hacker & Solopreneur"),
        ("camp_004", "paid_search", "Paid Inbound", "Fast-Growing Startup Lead"),
        ("camp_020", "organic_direct", "Organic & Viral", "Enterprise Architect"),
    ]


def test_fx_multiplier(spark, rows):
    df = spark.createDataFrame(
        [("USD", "EUR", 0.5), ("USD", "USD", 3.0), ("USD", "IDR", 0.0), ("USD", "CAD", None)],
        "base_currency string, quote_currency string, rate double",
    ).withColumn("fetched_at", F.lit("2026-09-15T04:30:37.764564"))
    got = {r.quote_currency: r.rate_to_usd for r in staging.stg_fx_rates(df).collect()}
    assert got == {"EUR": 2.0, "USD": 1.0, "IDR": None, "CAD": None}


def test_defaults_are_the_documented_constants():
    assert DEFAULTS.adstock_weights == (1.0, 0.70, 0.49, 0.343, 0.24)
    assert (DEFAULTS.half_saturation, DEFAULTS.max_daily_conversions) == (2500.0, 35.0)
    assert (DEFAULTS.value_per_conversion, DEFAULTS.monthly_revenue_per_user) == (150.0, 25.0)
