"""Where the credit of upgrades goes: what the marts show, what they leave out, and why."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL = ["date_day", "channel"]
SHOWN, NO_SPEND, NO_TOUCH = "shown", "no spend on that day", "no touch before the upgrade"


def _first_touches(stg_touches: DataFrame, stg_plg: DataFrame) -> DataFrame:
    """One row an upgrade: the day and channel of its first touch, null without one.

    Touches are reduced to one per (account, day) map-side before they meet the upgrades.
    """
    upgrades = stg_plg.where(F.col("is_pro_upgrade")).groupBy(
        "account_id", F.col("pro_upgrade_date"), F.col("channel").alias("account_channel")
    ).agg(F.count("*").alias("n_upgrades"))
    daily = stg_touches.groupBy("account_id", "touch_date").agg(
        F.min(F.struct("touch_timestamp", "touch_id", "channel")).alias("first")
    )
    # The first touch of an account is the same for all its upgrades that it precedes.
    first = daily.groupBy("account_id").agg(F.min("first").alias("first"))
    joined = upgrades.join(first, "account_id", "left")
    credited = F.col("first").isNotNull() & (F.col("first.touch_timestamp").cast("date") <= F.col("pro_upgrade_date"))
    return joined.select(
        "n_upgrades",
        "pro_upgrade_date",
        "account_channel",
        F.when(credited, F.col("first.touch_timestamp").cast("date")).alias("touch_day"),
        F.when(credited, F.col("first.channel")).alias("touch_channel"),
    )


def credit_ledger(spend_panel: DataFrame, stg_touches: DataFrame, stg_plg: DataFrame, geo_lift: DataFrame) -> DataFrame:
    """Every cell (day, channel) that spend, credit, lost upgrades or geo lift falls in.

    Columns: date_day, channel, spend_usd (null: no spend), first_touch_credit, shown_credit,
    lost_credit, untouched_upgrades, geo_lift_conversions, reason.  Credit of a cell
    without spend is lost, because the daily mart has only days with spend; an upgrade
    without a touch up to its day earns no credit at all and stands at its own day and its
    account's channel.  Credits shown, credits lost and untouched upgrades add up to the upgrades.

    The four inputs are aligned by one aggregation over their union: a full outer
    join on the cell without joining.
    """
    firsts = _first_touches(stg_touches, stg_plg)
    touched = firsts.where("touch_day is not null").select(
        F.col("touch_day").alias("date_day"), F.col("touch_channel").alias("channel"), F.col("n_upgrades").alias("credit")
    )
    untouched = firsts.where("touch_day is null").select(
        F.col("pro_upgrade_date").alias("date_day"), F.col("account_channel").alias("channel"), F.col("n_upgrades").alias("untouched")
    )
    spend = spend_panel.select(F.col("spend_date").alias("date_day"), "channel", "spend_usd", F.lit(1).alias("has_spend"))
    lift = geo_lift.where("geo_lift_conversions > 0").select(*CELL, F.col("geo_lift_conversions").alias("lift"))
    parts = [spend, touched, untouched, lift]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    cells = union.groupBy(*CELL).agg(
        F.max("spend_usd").alias("spend_usd"), total("has_spend"), total("credit"), total("untouched"), total("lift")
    )
    shown = F.when(F.col("has_spend") > 0, F.col("credit")).otherwise(F.lit(0).cast("long"))
    lost = F.col("credit") - shown
    reason = F.concat_ws(
        "; ",
        F.when(shown > 0, SHOWN),
        F.when(lost > 0, NO_SPEND),
        F.when(F.col("untouched") > 0, NO_TOUCH),
    )
    return cells.select(
        *CELL,
        "spend_usd",
        F.col("credit").alias("first_touch_credit"),
        shown.alias("shown_credit"),
        lost.alias("lost_credit"),
        F.col("untouched").alias("untouched_upgrades"),
        F.col("lift").alias("geo_lift_conversions"),
        reason.alias("reason"),
    )


def ledger_totals(ledger: DataFrame) -> DataFrame:
    """One row: upgrades, and the parts they fall into."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return ledger.agg(
        (total("first_touch_credit") + total("untouched_upgrades")).alias("upgrades"),
        total("shown_credit").alias("shown"),
        total("lost_credit").alias("lost_without_spend"),
        total("untouched_upgrades").alias("lost_without_touch"),
    )
