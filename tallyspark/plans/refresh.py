"""Refresh of stored daily marts after some input rows changed.

Only days that can differ are computed again: the *dirty* days.

* A changed day of spend reaches the days of its channel whose carry-over draws on it: the
  next four rows of the panel, however far apart they lie.
* A changed touch, account or project reaches every day on which the account has a
  touch, because a path shares its credit out anew; and the account's signup day.

The inputs are cut down to what dirty days draw on before any mart is computed: the
rows of the panel they look back at, the whole paths of accounts that have a touch on
them, and the accounts that signed up on them.  What reaches the driver is the list of dirty days.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.params import MeasurementParams
from tallyspark.plans.models import MeasurementModels, RawTables
from tallyspark.session import materialize
from tallyspark.sources.versions import VersionedTable

DAILY_MARTS = ("fct_marketing_triangulation_daily", "fct_channel_efficiency_daily")
DAY = "date_day"


@dataclass(frozen=True)
class Changes:
    """Rows that came, went or changed, in their old and in their new form.

    Columns that are read: spend date and channel; accounts account_id and signup_date;
    projects account_id; touches account_id and touch_timestamp.
    """

    marketing_spend: DataFrame | None = None
    developer_accounts: DataFrame | None = None
    project_telemetry: DataFrame | None = None
    touchpoints: DataFrame | None = None


def _panel(spend: DataFrame) -> DataFrame:
    return spend.select(F.col("date").cast("date").alias("day"), "channel").distinct()


def _spend_days(spend: DataFrame, changed: DataFrame, params: MeasurementParams) -> DataFrame:
    """Days whose carry-over may differ: those a changed day of the channel lies behind."""
    reach = len(params.adstock_weights) - 1
    by_day = Window.partitionBy("channel").orderBy("day")
    # The panel has days times channels rows.  A day draws on itself and the rows before.
    draws = _panel(spend).withColumn("since", F.lag("day", reach).over(by_day)).withColumn("in_panel", F.lit(True))
    marks = _panel(changed).withColumn("changed", F.col("day"))
    both = draws.unionByName(marks, allowMissingColumns=True)
    last = F.max("changed").over(by_day.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    reached = both.withColumn("last", last).where("in_panel and last >= coalesce(since, last)")
    return reached.select("day").unionByName(marks.select("day"))


def _upgraded(projects: DataFrame) -> DataFrame:
    return projects.where(F.col("is_pro_upgrade").cast("boolean")).select("account_id").distinct()


def _touch_days(touches: DataFrame) -> DataFrame:
    return touches.select(F.col("touch_timestamp").cast("date").alias("day"))


def dirty_days(raw: RawTables, changes: Changes, params: MeasurementParams) -> DataFrame:
    """The days (``date_day``) on which a daily mart may differ; ``raw`` is the new state."""
    days, accounts = [], []
    if changes.marketing_spend is not None:
        days.append(_spend_days(raw.marketing_spend, changes.marketing_spend, params))
    if changes.developer_accounts is not None:
        days.append(changes.developer_accounts.select(F.col("signup_date").cast("date").alias("day")))
        accounts.append(changes.developer_accounts.select("account_id"))
    if changes.project_telemetry is not None:
        of = changes.project_telemetry.select("account_id").distinct()
        signups = raw.developer_accounts.join(of, "account_id", "left_semi")
        days.append(signups.select(F.col("signup_date").cast("date").alias("day")))
        accounts.append(of)
    if changes.touchpoints is not None:
        # Touches of accounts that never upgraded earn no credit.
        credited = changes.touchpoints.join(_upgraded(raw.project_telemetry), "account_id", "left_semi")
        days.append(_touch_days(credited))
        accounts.append(credited.select("account_id"))
    if accounts:
        affected = reduce(DataFrame.unionByName, accounts).distinct()
        days.append(_touch_days(raw.touchpoints.join(affected, "account_id", "left_semi")))
    if not days:
        raise ValueError("no changes given")
    return reduce(DataFrame.unionByName, days).where("day is not null").select(F.col("day").alias(DAY)).distinct()


def restricted(models: MeasurementModels, days: DataFrame) -> MeasurementModels:
    """Models over the inputs that ``days`` draw on; right for these days only."""
    raw, params = models.raw, models.params
    reach = len(params.adstock_weights) - 1
    day = days.select(F.col(DAY).alias("day"), F.lit(True).alias("dirty"))
    ahead = Window.partitionBy("channel").orderBy("day").rowsBetween(0, reach)
    needed = (
        _panel(raw.marketing_spend)
        .join(day, "day", "left")
        .withColumn("needed", F.max(F.coalesce("dirty", F.lit(False))).over(ahead))
        .where("needed")
        .select(F.col("day").alias("date"), "channel")
    )
    spend = raw.marketing_spend.withColumn("date", F.col("date").cast("date"))
    touched = raw.touchpoints.withColumn("day", F.col("touch_timestamp").cast("date")).join(day, "day", "left_semi")
    paths = touched.select("account_id").distinct().join(_upgraded(raw.project_telemetry), "account_id", "left_semi")
    signed = raw.developer_accounts.withColumn("day", F.col("signup_date").cast("date")).join(day, "day", "left_semi")
    accounts = paths.unionByName(signed.select("account_id")).distinct()
    return MeasurementModels(
        RawTables(
            marketing_spend=spend.join(needed, ["date", "channel"], "left_semi").select(*raw.marketing_spend.columns),
            developer_accounts=raw.developer_accounts.join(accounts, "account_id", "left_semi"),
            project_telemetry=raw.project_telemetry.join(accounts, "account_id", "left_semi"),
            touchpoints=raw.touchpoints.join(paths, "account_id", "left_semi"),
        ),
        params,
        models.repo_name,
    )


def daily_table(spark: SparkSession, folder: str, name: str) -> VersionedTable:
    return VersionedTable(spark, f"{folder}/{name}", DAY)


def publish(models: MeasurementModels, folder: str, *names: str) -> None:
    """Full refresh of the daily marts, each published in one step."""
    for name in names or DAILY_MARTS:
        df = getattr(models, name)
        daily_table(df.sparkSession, folder, name).publish(df)


def refresh(models: MeasurementModels, changes: Changes, folder: str, *names: str) -> list:
    """Bring the stored daily marts to the state of ``models`` (over the new inputs).

    Returns the dirty days.  Partitions of other days keep their files; every mart changes
    in one step.
    """
    days = materialize(dirty_days(models.raw, changes, models.params), "dirty-days")
    # As many as there are days in the data.
    found = sorted(r[0] for r in days.collect())
    if not found:
        return found
    part = restricted(models, days)
    for name in names or DAILY_MARTS:
        rows = getattr(part, name).join(days, DAY, "left_semi")
        daily_table(days.sparkSession, folder, name).replace(rows, found)
    return found
