"""Spend in one currency, by the exchange rate of its day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.scalar import round_n
from tallyspark.operators.asof import asof_join


def spend_normalised(spend: DataFrame, rates: DataFrame, home_currency: str = "USD") -> DataFrame:
    """``spend`` with ``rate_to_usd``, ``rate_fetched_at`` and ``spend_home``.

    ``spend`` has date, currency and spend; ``rates`` is the staged rate table.  A row takes
    the latest usable quote of its currency fetched on its day or before (a quote of 0 is
    not usable); spend in the home currency needs none.  Without a quote the
    result is null, never the unconverted amount.
    """
    usable = rates.where("rate_to_usd is not null").select(
        F.col("quote_currency").alias("currency"),
        F.col("fetched_at").cast("date").alias("_day"),
        "fetched_at",
        "rate_to_usd",
    )
    # The last quote of a day counts for the whole day.
    per_day = usable.groupBy("currency", "_day").agg(F.max(F.struct("fetched_at", "rate_to_usd")).alias("q")).select(
        "currency", "_day", F.col("q.rate_to_usd").alias("rate_to_usd"), F.col("q.fetched_at").alias("rate_fetched_at")
    )
    joined = asof_join(
        spend, per_day, ["currency"], F.col("date").cast("timestamp_ntz"), F.col("_day").cast("timestamp_ntz"),
        ["rate_to_usd", "rate_fetched_at"], bucket="month",
    )
    is_home = F.col("currency") == home_currency
    rate = F.when(is_home, F.lit(1.0)).otherwise(F.col("rate_to_usd"))
    fetched = F.when(~F.coalesce(is_home, F.lit(False)), F.col("rate_fetched_at"))
    return joined.withColumn("rate_to_usd", rate).withColumn("rate_fetched_at", fetched).withColumn(
        "spend_home", round_n(F.col("spend") * F.col("rate_to_usd"), 2)
    )
