import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.functions import scalar as S


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()[0]


@pytest.mark.parametrize(
    "value, digits, want",
    [(1.005, 2, 1.0), (2.675, 2, 2.68), (54.675, 2, 54.68), (-2.5, 0, -3.0), (2.5, 0, 3.0), (0.125, 2, 0.13)],
)
def test_round_on_ties(spark, value, digits, want):
    scaled = duckdb.execute("select round(?::double, ?::int)", [value, digits]).fetchone()[0]
    assert one(spark, S.round_n(F.lit(value), digits)) == scaled
    assert scaled == pytest.approx(want)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-1e7, 1e7), min_size=1, max_size=200), st.integers(0, 4))
def test_round_equals_second_engine(spark, values, digits):
    got = [
        r[0]
        for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
        .orderBy("i")
        .select(S.round_n("v", digits))
        .collect()
    ]
    want = [
        r[0]
        for r in duckdb.execute(
            "select round(unnest(?::double[]), ?::int)", [values, digits]
        ).fetchall()
    ]
    assert got == want


def test_safe_ratio_is_null_not_error(spark):
    assert one(spark, S.safe_ratio(F.lit(1.0), F.lit(0))) is None
    assert one(spark, S.safe_ratio(F.lit(1.0), F.lit(None).cast("int"))) is None
    assert one(spark, S.safe_ratio(F.lit(None).cast("double"), F.lit(2))) is None
    assert one(spark, S.safe_ratio(F.lit(3), F.lit(2))) == 1.5


def test_exact_sum_ignores_order(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(0.7,)] * 3, "v double").repartition(5)
    assert df.agg(S.exact_sum("v")).first()[0] == 3.1
    assert df.where("v > 9").agg(S.exact_sum("v")).first()[0] is None


@pytest.mark.parametrize("spend, want", [(0.0, 0.0), (2500.0, 0.5), (10000.0, 0.9412)])
def test_hill(spark, spend, want):
    assert one(spark, S.round_n(S.hill(F.lit(spend), 2500.0), 4)) == want


def test_decay_never_above_one(spark):
    assert one(spark, S.decay(F.lit(-3), 0.05)) == 1.0
    assert one(spark, S.round_n(S.decay(F.lit(10), 0.05), 4)) == 0.6065


@pytest.mark.parametrize(
    "kind, values, want",
    [
        ("string", ["2.5", "12.7", "-2.5", "7", None], [3, 13, -3, 7, None]),
        ("double", [2.5, 3.5, -2.5, 7.0, None], [2, 4, -2, 7, None]),
        ("bigint", [2**53 + 1, None], [2**53 + 1, None]),
    ],
)
def test_whole_numbers_round(spark, kind, values, want):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    got = df.orderBy("i").select(S.whole_number(df, "v").alias("v")).collect()
    assert [r.v for r in got] == want
    cast = duckdb.execute(f"select unnest(?::{kind.replace('string', 'varchar')}[])::bigint", [values])
    assert [r[0] for r in cast.fetchall()] == want


def test_labels(spark):
    assert one(spark, S.channel_label(F.lit("paid_social_x"))) == "paid social_x"
    assert one(spark, S.channel_label(F.lit("direct"))) == "direct"
    assert one(spark, S.week_label(F.lit("2026-09-14 00:00:00"))) == "2026-09-14"
    assert one(spark, S.signed_percent(F.lit(608.3))) == "+608.3%"
    assert one(spark, S.signed_percent(F.lit(-2.5))) == "-2.5%"
    assert one(spark, S.dollars(F.lit(1234.5))) == "$1234.50"


def test_large_and_small_amounts(spark):
    df = spark.createDataFrame([(2e12,)] * 3 + [(4e-7,)] * 1000, "x double")
    big = df.where("x > 1").select(S.exact_sum("x")).first()[0]
    small = df.where("x < 1").select(S.exact_sum("x")).first()[0]
    assert big == 6e12 and small == pytest.approx(4e-4, rel=1e-12)


def test_rounding_of_values_without_a_fraction(spark):
    df = spark.createDataFrame([(1e17,), (-3e250,), (float("inf"),), (2.0**53 + 2,), (1234567.885,)], "x double")
    got = [r[0] for r in df.select(S.round_n("x", 4)).collect()]
    assert got == [1e17, -3e250, float("inf"), 2.0**53 + 2, 1234567.885]
