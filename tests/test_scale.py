"""Balance, plans and lineage: properties that matter when the data is large."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallyspark.operators import skew
from tallyspark.operators.ranking import distributed_row_number
from tallyspark.params import HotKeyPolicy
from tallyspark.queries import inputs
from tallyspark.session import CHECKPOINT_KEY, materialize, shared_folder

SF = "/root/testdata/sf0.001"
POLICY = HotKeyPolicy(min_rows=1000, max_keys=10, pieces=64)


@pytest.fixture
def skewed(spark):
    """30,000 rows of which a third belong to key 0 - and are all identical."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 0).otherwise(n % 500 + 1)
    value = F.when(n % 3 == 0, F.lit(0)).otherwise(n)
    return spark.range(0, 30_000, 1, 8).select(key.alias("k"), value.alias("v"))


@pytest.fixture
def no_coalesce(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_are_bounded_and_exact(skewed, rows):
    assert rows(skew.hot_keys(skewed, "k", POLICY)) == [(0,)]
    few = HotKeyPolicy(min_rows=1, max_keys=3)
    assert len(rows(skew.hot_keys(skewed, "k", few))) == 3


def largest_task(df):
    sizes = df.groupBy(F.spark_partition_id()).count()
    return sizes.agg(F.max("count")).first()[0]


def test_hot_key_does_not_fill_one_task(spark, skewed, no_coalesce):
    left = spark.range(600).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    plain = left.join(skewed, "k", "left")
    spread = skew.spread_join(left, skewed, "k", 64)
    assert largest_task(plain) > 10_000
    assert largest_task(spread) < 8_000


def test_spread_join_equals_a_plain_join(spark, skewed, rows):
    left = spark.range(600).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    inner = rows(left.join(skewed, "k"), "k", "w", "v")
    assert rows(skew.spread_join(left, skewed, "k", 7), "k", "w", "v") == inner


@pytest.mark.parametrize("ascending", [True, False])
def test_distributed_row_number_equals_window(spark, rows, ascending):
    rnd = random.Random(3)
    data = [(i, rnd.choice([5, 5, 5, None, rnd.randrange(50)]), i % 3) for i in range(2000)]
    df = spark.createDataFrame(data, "id int, t int, g int").repartition(7)
    t = F.col("t").asc_nulls_last() if ascending else F.col("t").desc_nulls_last()
    order = [t, F.col("id")]
    window = F.row_number().over(Window.orderBy(*order)).cast("long")
    assert rows(distributed_row_number(df, order, "n")) == rows(df.withColumn("n", window))
    per_group = F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("long")
    assert rows(distributed_row_number(df, order, "n", ["g"])) == rows(df.withColumn("n", per_group))


def test_row_number_of_nothing(spark, rows):
    empty = spark.range(0)
    assert rows(distributed_row_number(empty, [F.col("id")], "n")) == []


def test_shared_folder_is_the_named_one(spark):
    base = spark.conf.get(CHECKPOINT_KEY)
    assert shared_folder(spark, "x").startswith(base)
    assert shared_folder(spark, "x") != shared_folder(spark, "x")
    df = materialize(spark.range(5), "t")
    assert df.count() == 5 and base in df.inputFiles()[0]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    "stg_developer_plg_events", "mta_daily", "fct_marketing_triangulation_daily_orders",
    "fct_channel_efficiency_daily", "fct_developer_cohort_retention", "dim_campaigns",
    "int_developer_lifecycle_states", "kpi_summary", "adstock_calendar_orders",
    "src_json_map_required", "dq_spend_drift", "fallback_if_empty", "global_rank_distributed",
]


@pytest.mark.parametrize("name", LAZY)
def test_plans_have_no_python_and_no_product(spark, name):
    plan = physical(contract.queries()[name](spark, SF))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|InPandas", plan)


def test_scan_reads_only_what_the_query_needs(spark):
    plan = physical(contract.queries()["daily_channel_spend_orders"](spark, SF))
    lineitem = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in lineitem


def test_filter_reaches_the_scan(spark):
    plan = physical(contract.queries()["dq_non_negative"](spark, SF))
    assert "LessThan(c_acctbal,0.0)" in plan


def test_cold_attribution_shuffles_touches_once(spark):
    """One exchange by account between the touch scan and the final sums."""
    w = inputs.order_world(spark, SF)
    plan = physical(w.int_attribution_paths)
    cold = plan[: plan.index("LeftAnti")]
    assert len(re.findall(r"Exchange hashpartitioning\(account_id", cold)) <= 1
    assert cold.count("Sort [account_id") <= 2
