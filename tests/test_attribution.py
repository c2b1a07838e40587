import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import attribution as A
from tallyspark.operators import quality
from tallyspark.params import DEFAULTS, HotKeyPolicy

T0 = dt.datetime(2026, 1, 1, 12)
TOUCH = (
    "account_id string, touch_id string, touch_timestamp timestamp_ntz, touch_date date, "
    "channel string, campaign_id string"
)
PLG = "account_id string, is_pro_upgrade boolean, pro_upgrade_date date, monthly_invoice_usd double"
ALL_HOT = replace(DEFAULTS, hot_keys=HotKeyPolicy(min_rows=1, pieces=4))
SOME_HOT = replace(DEFAULTS, hot_keys=HotKeyPolicy(min_rows=6, max_keys=3, pieces=5))


def touches(spark, data):
    full = [
        (a, t, T0 + dt.timedelta(days=d), (T0 + dt.timedelta(days=d)).date(), c, "camp_001")
        for a, t, d, c in data
    ]
    return spark.createDataFrame(full, TOUCH)


def accounts(spark, data):
    full = [
        (a, pro, None if d is None else (T0 + dt.timedelta(days=d)).date(), 30.0)
        for a, pro, d in data
    ]
    return spark.createDataFrame(full, PLG)


WEIGHTS = ["first_touch_weight", "last_touch_weight", "linear_weight", "time_decay_weight"]


@pytest.fixture(params=[DEFAULTS, ALL_HOT, SOME_HOT], ids=["ordinary", "all hot", "some hot"])
def params(request):
    return request.param


def paths(spark, params, touch_data, account_data):
    df = A.int_attribution_paths(touches(spark, touch_data), accounts(spark, account_data), params)
    return {r.touch_id: r for r in df.collect()}


def test_one_touch_gets_everything(spark, params):
    got = paths(spark, params, [("a", "1", 0, "x")], [("a", True, 0)])
    assert [got["1"][w] for w in WEIGHTS] == [1.0, 1.0, 1.0, 1.0]


def test_touch_on_the_day_counts_and_later_does_not(spark, params):
    data = [("a", "1", 3, "x"), ("a", "2", 4, "x"), ("b", "3", 0, "x"), ("c", "4", 9, "x")]
    got = paths(spark, params, data, [("a", True, 3), ("b", False, None), ("c", True, 2)])
    assert list(got) == ["1"]


def test_three_touches(spark, params):
    data = [("a", "1", 0, "x"), ("a", "2", 5, "y"), ("a", "3", 10, "x")]
    got = paths(spark, params, data, [("a", True, 10)])
    assert [got[t].linear_weight for t in "123"] == [0.3333] * 3
    assert [got[t].touch_order_asc for t in "123"] == [1, 2, 3]
    assert [got[t].touch_order_desc for t in "123"] == [3, 2, 1]
    raw = [0.6065, 0.7788, 1.0]
    assert [got[t].time_decay_weight for t in "123"] == [round(x / sum(raw), 4) for x in raw]


def test_equal_times_go_by_id(spark, params):
    data = [("a", t, 0, "x") for t in "312"]
    got = paths(spark, params, data, [("a", True, 0)])
    assert [got[t].touch_order_asc for t in "123"] == [1, 2, 3]
    assert got["1"].first_touch_weight == 1.0 and got["3"].last_touch_weight == 1.0


def test_decay_of_an_old_path_vanishes(spark, params):
    got = paths(spark, params, [("a", "1", 0, "x")], [("a", True, 200)])
    assert got["1"].time_decay_weight is None and got["1"].linear_weight == 1.0


def test_long_path_drifts_from_one(spark, params):
    got = paths(spark, params, [("a", f"{i:02}", i, "x") for i in range(30)], [("a", True, 40)])
    assert sum(r.linear_weight for r in got.values()) == pytest.approx(0.999)


def random_log(seed, accounts=40, touches=600):
    rnd = random.Random(seed)
    log = []
    for i in range(touches):
        # account 0 owns a third of all touches, half of them at one instant
        a = 0 if rnd.random() < 0.33 else rnd.randrange(accounts)
        day = 5 if a == 0 and rnd.random() < 0.5 else rnd.randrange(60)
        log.append((f"a{a}", f"t{i:04}", day, rnd.choice("xyz")))
    return log, [(f"a{i}", rnd.random() < 0.6 or i == 0, rnd.randrange(30, 70)) for i in range(accounts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_all_routes_agree(spark, rows, seed):
    log, owners = random_log(seed)
    t, p = touches(spark, log).repartition(6), accounts(spark, owners)
    want_paths = rows(A.int_attribution_paths(t, p))
    want_mart = rows(A.mta_daily(t, p))
    assert want_mart == rows(A.mta_from_paths(A.int_attribution_paths(t, p)))
    columns = A.int_attribution_paths(t, p).columns
    for other in (ALL_HOT, SOME_HOT):
        assert rows(A.int_attribution_paths(t, p, other), *columns) == want_paths
        assert rows(A.mta_daily(t, p, other)) == want_mart
        assert rows(A.touches_before_conversion(t, p, other)) == rows(
            A.touches_before_conversion(t, p)
        )


def test_repeated_copies_of_a_touch_are_credited_once(spark, rows):
    log = [("a", "1", 0, "x")] * 5 + [("a", "2", 1, "y")] * 3
    t, p = touches(spark, log), accounts(spark, [("a", True, 2)])
    want = rows(A.mta_daily(t, p))
    # identical rows: which copy comes first is open, its day and channel are not
    assert rows(A.mta_daily(t, p), "channel", "mta_linear_conversions") == [("x", 0.63), ("y", 0.38)]
    totals = A.mta_daily(t, p, ALL_HOT).agg(
        F.sum("mta_first_touch_conversions"), F.sum("mta_last_touch_conversions")
    )
    assert rows(totals) == [(1.0, 1.0)]
    assert rows(A.mta_daily(t, p, ALL_HOT)) == want


def test_exact_credits_of_a_path_of_30000_touches(spark, params):
    ids = spark.range(30_000).selectExpr(
        "'a' as account_id", "lpad(cast(id as string), 6, '0') as touch_id",
        "timestamp_ntz'2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id) as touch_timestamp",
        "'x' as channel", "'camp_001' as campaign_id",
    )
    log = ids.select("*", F.col("touch_timestamp").cast("date").alias("touch_date"))
    plg = accounts(spark, [("a", True, 30)])
    got = A.mta_daily(log, plg, params, exact=True).collect()
    for kind in ("first_touch", "last_touch", "linear", "time_decay"):
        assert sum(r[f"mta_{kind}_conversions"] for r in got) == pytest.approx(1.0, abs=1e-4)
    # Published weights have four places: the linear ones of such a path are all 0.
    assert sum(r.mta_linear_conversions for r in A.mta_daily(log, plg, params).collect()) == 0.0


def test_exact_paths_sum_to_one(spark, params):
    data = [("a", str(i), i % 7, "x") for i in range(7)] + [("b", f"b{i}", i % 3, "y") for i in range(3)]
    df = A.int_attribution_paths(
        touches(spark, data), accounts(spark, [("a", True, 9), ("b", True, 9)]), params, exact=True
    )
    assert quality.exact_weight_violations(df).count() == 0
    assert tuple(quality.weight_summary(df).first()) == (2, 0, True)
    assert tuple(quality.weight_summary(df.where("false")).first()) == (0, 0, False)
    # Seven times 0.1429 is 1.0003: the published weights are off by rounding alone.
    assert quality.exact_weight_violations(
        A.int_attribution_paths(touches(spark, data), accounts(spark, [("a", True, 9)]), params)
    ).count() == 1
