import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import adstock as A
from tallyspark.operators.staging import stg_marketing_ad_spend
from tallyspark.sources.schemas import MARKETING_SPEND

DAY = dt.date(2026, 1, 1)


def panel(spark, days_spend, channel="c"):
    data = [(DAY + dt.timedelta(days=d), channel, float(s), 10, 5, 2) for d, s in days_spend]
    return spark.createDataFrame(
        data,
        "spend_date date, channel string, spend_usd double, impressions long, clicks long, "
        "platform_conversions long",
    )


def adstocked(df, **kw):
    return [r[0] for r in A.adstock(df, **kw).orderBy("spend_date").select("spend_adstocked").collect()]


def test_start_of_a_series(spark):
    df = panel(spark, [(i, s) for i, s in enumerate([100, 0, 0, 0, 0, 0])])
    assert adstocked(df) == [100.0, 70.0, 49.0, 34.3, 24.0, 0.0]


def test_gap_by_row_and_by_calendar(spark):
    df = panel(spark, [(1, 100), (3, 0)])
    assert adstocked(df) == [100.0, 70.0]
    assert adstocked(df, calendar=True) == [100.0, 49.0]


def test_channels_do_not_mix(spark):
    df = panel(spark, [(0, 100), (1, 0)]).unionByName(panel(spark, [(0, 7), (1, 0)], "d"))
    got = {(r.channel, r.spend_date.day): r.spend_adstocked for r in A.adstock(df).collect()}
    assert got == {("c", 1): 100.0, ("c", 2): 70.0, ("d", 1): 7.0, ("d", 2): 4.9}


def test_regions_are_added_up_and_ratios_guarded(spark):
    raw = spark.createDataFrame(
        [(DAY, "c", "x", 10.5, 100, 0, 1), (DAY, "c", "y", 4.5, 0, 3, 2)], MARKETING_SPEND
    )
    staged = stg_marketing_ad_spend(raw)
    got = {r.region: (r.cpc_usd, r.ctr_pct) for r in staged.collect()}
    assert got == {"x": (None, 0.0), "y": (1.5, None)}
    assert [tuple(r) for r in A.daily_channel_spend(staged).collect()] == [
        (DAY, "c", 15.0, 100, 3, 3)
    ]


def test_published_response_curve(spark):
    """Three of the published curve points."""
    curve = A.response_curve(spark.range(1))
    got = {r.spend_usd: (r.saturation_index, r.estimated_conversions) for r in curve.collect()}
    assert len(got) == 12
    assert got[200.0] == (0.0064, 0.2)
    assert got[1500.0] == (0.2647, 9.3)
    assert got[2500.0] == (0.5, 17.5)


def test_index_in_unit_interval_and_carry_over_adds(spark):
    df = panel(spark, [(i, (i * 37) % 11 * 100) for i in range(60)])
    out = A.saturate(A.adstock(df))
    bad = out.where(
        (F.col("saturation_index") < 0)
        | (F.col("saturation_index") > 1)
        | (F.col("spend_adstocked") < F.col("spend_usd"))
    )
    assert bad.count() == 0
    ordered = [r[0] for r in out.orderBy("spend_adstocked").select("saturation_index").collect()]
    assert ordered == sorted(ordered)


@pytest.mark.parametrize("weights, want", [((1.0,), [100.0, 0.0]), ((0.5, 0.25), [50.0, 25.0])])
def test_other_weights(spark, weights, want):
    from dataclasses import replace

    from tallyspark.params import DEFAULTS

    df = panel(spark, [(0, 100), (1, 0)])
    assert adstocked(df, params=replace(DEFAULTS, adstock_weights=weights)) == want
