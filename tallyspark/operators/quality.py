"""Data checks.  Each returns the offending rows, so no rows means passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.scalar import EXACT_WEIGHT, MONEY, exact_sum


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def non_negative(df: DataFrame, column: str) -> DataFrame:
    """Negative values of the column, as ``tested_value``; NULL passes."""
    return df.where(F.col(column) < 0).select(F.col(column).alias("tested_value"))


def unique_grain(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column combinations that occur more than once, with their ``row_count``."""
    return df.groupBy(*columns).agg(F.count("*").alias("row_count")).where("row_count > 1")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated values of one column; NULLs are not compared."""
    return unique_grain(df.where(F.col(column).isNotNull()), [column])


def weight_violations(paths: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Accounts whose first-, last- or linear-touch weights do not add up to 1."""
    kinds = ("first_touch", "last_touch", "linear")
    sums = paths.groupBy("account_id").agg(
        *(
            F.sum(F.col(f"{k}_weight").cast("decimal(18,4)")).cast("double").alias(f"total_{k}_weight")
            for k in kinds
        )
    )
    low, high = 1.0 - tolerance, 1.0 + tolerance
    linear = F.col("total_linear_weight")
    return sums.where(
        (F.abs(F.col("total_first_touch_weight") - 1.0) > tolerance)
        | (F.abs(F.col("total_last_touch_weight") - 1.0) > tolerance)
        | (linear < low)
        | (linear > high)
    )


def exact_weight_sums(paths: DataFrame) -> DataFrame:
    """Per account the sums of all four unrounded weights."""
    kinds = ("first_touch", "last_touch", "linear", "time_decay")
    sums = [exact_sum(f"{k}_weight", EXACT_WEIGHT).alias(f"total_{k}_weight") for k in kinds]
    return paths.groupBy("account_id").agg(*sums)


def exact_weight_violations(paths: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Accounts where any of the four unrounded weights does not add up to 1."""
    sums = exact_weight_sums(paths)
    off = [F.abs(F.col(c) - 1.0) > tolerance for c in sums.columns if c != "account_id"]
    return sums.where(reduce(Column.__or__, off))


def weight_summary(paths: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """One row: accounts checked, accounts off, passed.  No account at all fails."""
    sums = exact_weight_sums(paths)
    off = reduce(
        Column.__or__, [F.abs(F.col(c) - 1.0) > tolerance for c in sums.columns if c != "account_id"]
    )
    return sums.agg(F.count("*").alias("n_checked"), F.count_if(off).alias("n_violations")).withColumn(
        "passed", (F.col("n_checked") > 0) & (F.col("n_violations") == 0)
    )


def total_drift(
    left: DataFrame, left_column: str, right: DataFrame, right_column: str, name: str
) -> DataFrame:
    """One row: the absolute difference of two column totals (empty input counts 0).

    Both inputs are summed in one aggregation over their union, so neither a
    join of the two totals nor a second pass is needed.
    """
    amount, sign = F.col("amount"), F.col("sign")
    signed = left.select(F.col(left_column).cast(MONEY).alias("amount"), F.lit(1).alias("sign"))
    signed = signed.unionByName(
        right.select(F.col(right_column).cast(MONEY).alias("amount"), F.lit(-1).alias("sign"))
    )
    total = F.sum(F.when(sign == 1, amount).otherwise(-amount))
    return signed.agg(F.abs(F.coalesce(total, F.lit(0))).cast("double").alias(name))


def drift_violations(
    left: DataFrame,
    left_column: str,
    right: DataFrame,
    right_column: str,
    tolerance: float = 0.01,
) -> DataFrame:
    drift = total_drift(left, left_column, right, right_column, "spend_drift")
    return drift.where(F.col("spend_drift") >= tolerance)


def row_counts(sources: Mapping[str, DataFrame]) -> DataFrame:
    """One row per source: how many rows, and whether there are any."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("source"), "n_rows")
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, counts).withColumn("passed", F.col("n_rows") > 0)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Is there a table or view of that name in the session's catalog?"""
    return spark.catalog.tableExists(name)


def tables_present(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """One row per required table or view: does it exist, and how many rows has it?"""
    rows = []
    for name in names:
        if table_exists(spark, name):
            counted_rows = spark.table(name).agg(F.count("*").alias("n_rows"))
            rows.append(counted_rows.select(F.lit(name).alias("source"), F.lit(True).alias("present"), "n_rows"))
        else:
            rows.append(spark.createDataFrame([(name, False, 0)], "source string, present boolean, n_rows long"))
    return reduce(DataFrame.unionByName, rows).withColumn("passed", F.col("present") & (F.col("n_rows") > 0))


def files_present(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """One row per required file name: is it in the folder?  Only lists, reads nothing."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*").load(folder)
    found = listing.select(F.element_at(F.split("path", "/"), -1).alias("file")).distinct()
    wanted = spark.createDataFrame([(n,) for n in names], "file string")
    return wanted.join(found.withColumn("present", F.lit(True)), "file", "left").select(
        "file", F.coalesce("present", F.lit(False)).alias("present")
    )


def row_checks(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Count the rows that break each condition, all conditions in one pass."""
    broken = [F.count(F.when(condition, 1)).alias(str(i)) for i, condition in enumerate(checks.values())]
    rows = F.array(
        *(
            F.struct(F.lit(name).alias("check_name"), F.col(str(i)).alias("n_violations"))
            for i, name in enumerate(checks)
        )
    )
    return df.agg(*broken).select(F.inline(rows))


def counted(name: str, violations: DataFrame) -> DataFrame:
    """One row: how many violating rows a check returned."""
    return violations.agg(F.count("*").alias("n_violations")).select(
        F.lit(name).alias("check_name"), "n_violations"
    )


def report(results: Sequence[DataFrame]) -> DataFrame:
    """Results of :func:`row_checks` and :func:`counted` as ``check_name, n_violations, passed``."""
    return reduce(DataFrame.unionByName, results).withColumn("passed", F.col("n_violations") == 0)
