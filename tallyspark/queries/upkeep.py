"""Queries that keep stored results right: checked input, refresh, ids, ledger, rates."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import compare_tables, ledger, quality, stable_ids
from tallyspark.operators.adstock import daily_channel_spend
from tallyspark.operators.currency import spend_normalised as normalised
from tallyspark.plans import exports, marts, refresh
from tallyspark.plans.models import MeasurementModels
from tallyspark.queries import inputs
from tallyspark.queries.registry import QUERIES, Query, query
from tallyspark.session import materialize, shared_folder
from tallyspark.sources import files
from tallyspark.sources.versions import VersionedTable

# ------------------------------------------------------------ rows set aside

_ORDER_LINES = "o_orderkey bigint, o_custkey bigint, o_orderdate date, o_totalprice double, o_orderpriority string"
_DIRTY_SQL = """
    select o_orderkey::varchar as o_orderkey, if(o_custkey % 31 = 0, '', o_custkey::varchar) as o_custkey,
           if(o_orderkey % 17 = 0, 'n/a', strftime(o_orderdate, '%Y-%m-%d')) as o_orderdate,
           case when o_orderkey % 13 = 0 then 'dear, "very"' when o_orderkey % 7 = 0 then ''
                else cast(o_orderkey % 1000 as varchar) || '.5' end as o_totalprice,
           o_orderpriority, o_orderkey % 29 = 0 as torn
    from orders
"""


def _dirty_orders(spark: SparkSession, sf: str) -> str:
    """Orders as delimited lines with faults: bad dates and prices, no customer, torn lines."""
    key = F.col("o_orderkey")
    rows = inputs.Tables(spark, sf)["orders"].select(
        key.cast("string").alias("o_orderkey"),
        F.when(F.col("o_custkey") % 31 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(key % 17 == 0, "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"),
        F.when(key % 13 == 0, '"dear, ""very""' + '"')
        .when(key % 7 == 0, "")
        .otherwise(F.concat((key % 1000).cast("string"), F.lit(".5")))
        .alias("o_totalprice"),
        "o_orderpriority",
    )
    line = F.when(key % 29 == 0, F.concat_ws(",", "o_orderkey", "o_custkey", F.lit("torn"))).otherwise(F.concat_ws(",", *rows.columns))
    path = shared_folder(spark, "dirty-orders")
    rows.select(line.alias("value")).write.text(path)
    return path


def _checked_orders(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    path = _dirty_orders(spark, sf)
    return files.scan_csv_checked(spark, path, _ORDER_LINES, required=["o_custkey"], header=False)


@query(
    "src_csv_rejected",
    f"""
    with dirty_lines as ({_DIRTY_SQL}),
    faults as (
        select *, null as "column", 'wrong number of fields' as reason from dirty_lines where torn
        union all select *, 'o_custkey', 'missing' from dirty_lines where not torn and o_custkey = ''
        union all select *, 'o_orderdate', 'not a date' from dirty_lines where not torn and o_orderdate = 'n/a'
        union all select *, 'o_totalprice', 'not a double' from dirty_lines where not torn and o_totalprice like 'dear%')
    select if(torn, o_orderkey || ',' || o_custkey || ',torn',
              o_orderkey || ',' || o_custkey || ',' || o_orderdate || ','
              || if(o_totalprice like 'dear%', '"dear, ""very""' || '"', o_totalprice) || ',' || o_orderpriority) as record,
           "column", reason
    from faults
    """,
)
def src_csv_rejected(spark, sf):
    return _checked_orders(spark, sf)[1]


@query(
    "src_csv_accepted",
    f"""
    with dirty_lines as ({_DIRTY_SQL})
    select o_orderkey::bigint as o_orderkey, o_custkey::bigint as o_custkey, o_orderdate::date as o_orderdate,
           nullif(o_totalprice, '')::double as o_totalprice, o_orderpriority
    from dirty_lines
    where not torn and o_custkey <> '' and o_orderdate <> 'n/a' and o_totalprice not like 'dear%'
    """,
)
def src_csv_accepted(spark, sf):
    return _checked_orders(spark, sf)[0]


@query("src_csv_sniffed", "select d as column0, event_type as column1, value as column2, k as column3 from ev")
def src_csv_sniffed(spark, sf):
    """Semicolons, single quotes, no header: nothing of it is told to the scan."""
    events = inputs.EventTables(spark, sf).events
    path = shared_folder(spark, "unknown-dialect")
    events.select("d", F.concat(F.lit("'"), "event_type", F.lit("'")).alias("t"), "value", "k").write.options(
        sep=";", quote="", header="false"
    ).csv(path)
    return files.scan_sniffed_csv(spark, path)


# ------------------------------------------------------------ refresh after changes


class EarlierEvents(inputs.EventTables):
    """The event world some time ago: spend, upgrades and touches that came later are missing."""

    late_spend = "dayofmonth(date) = 7 and channel = 'click'"
    raised_spend = "dayofmonth(date) = 19 and region = 'ASIA'"
    late_upgrade = "cast(account_id as long) % 97 = 5"
    late_touch = "cast(touch_id as long) % 997 = 3"

    @cached_property
    def marketing_spend(self) -> DataFrame:
        now = inputs.EventTables.marketing_spend.func(self)
        spend = F.when(F.expr(self.raised_spend), F.round(F.col("spend") / 2, 2)).otherwise(F.col("spend"))
        return now.where(~F.expr(self.late_spend)).withColumn("spend", spend)

    @cached_property
    def project_telemetry(self) -> DataFrame:
        now = inputs.EventTables.project_telemetry.func(self)
        late = F.expr(self.late_upgrade)
        return now.withColumns(
            {
                "is_pro_upgrade": F.col("is_pro_upgrade") & ~late,
                "pro_upgrade_date": F.when(~late, F.col("pro_upgrade_date")),
                "monthly_invoice_usd": F.when(late, 0.0).otherwise(F.col("monthly_invoice_usd")),
            }
        )

    @cached_property
    def touchpoints(self) -> DataFrame:
        return inputs.EventTables.touchpoints.func(self).where(~F.expr(self.late_touch))


def _refreshed(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Publish a mart of the earlier state, then refresh it for what changed since."""
    before = MeasurementModels(EarlierEvents(spark, sf), inputs.EVENT_PARAMS, inputs.REPO)
    now = inputs.event_world(spark, sf)
    folder = shared_folder(spark, "refreshed-marts")
    refresh.publish(before, folder, name)
    raw, late = now.raw, EarlierEvents
    changes = refresh.Changes(
        marketing_spend=raw.marketing_spend.where(f"({late.late_spend}) or ({late.raised_spend})"),
        project_telemetry=raw.project_telemetry.where(late.late_upgrade),
        touchpoints=raw.touchpoints.where(late.late_touch),
    )
    refresh.refresh(now, changes, folder, name)
    return refresh.daily_table(spark, folder, name).read()


@query("mart_incremental_refresh", "from e_tri")
def mart_incremental_refresh(spark, sf):
    return _refreshed(spark, sf, "fct_marketing_triangulation_daily")


@query("mart_incremental_efficiency", "from e_efficiency")
def mart_incremental_efficiency(spark, sf):
    return _refreshed(spark, sf, "fct_channel_efficiency_daily")


@query("mart_published_versions", "select 1 as version, * from e_signups union all select 2, * from e_signups where total_signups > 1")
def mart_published_versions(spark, sf):
    """A table rebuilt from itself: the version before stays readable."""
    table = VersionedTable(spark, shared_folder(spark, "versions"))
    first = table.publish(marts.signups_daily(inputs.event_world(spark, sf).stg_developer_plg_events))
    table.publish(first.where("total_signups > 1"))
    parts = [table.read(v).select(F.lit(v).alias("version"), "*") for v in table.versions()]
    return parts[0].unionByName(parts[1])


# ------------------------------------------------------------ rates, ids, credit


def _spend_in_currencies(spark: SparkSession, sf: str) -> DataFrame:
    """Order spend per day and market segment, in the segment's currency."""
    tables = inputs.OrderTables(spark, sf)
    segment = tables.tables["customer"].select(F.col("c_custkey").alias("user_id"), F.substring("c_mktsegment", 1, 3).alias("segment"))
    cells = tables.orders.groupBy("user_id", "d").agg(F.sum(F.col("o_totalprice").cast("decimal(28,9)")).alias("v"))
    code = F.when(F.col("segment") == "BUI", "USD").when(F.col("segment") == "FUR", "XXX").otherwise(F.col("segment"))
    per_day = cells.join(segment, "user_id").groupBy(F.col("d").alias("date"), code.alias("currency"))
    return per_day.agg(F.sum("v").cast("double").alias("spend"))


@query(
    "spend_normalised",
    """
    with spend as (
        select d as date, case left(c_mktsegment, 3) when 'BUI' then 'USD' when 'FUR' then 'XXX'
                   else left(c_mktsegment, 3) end as currency,
               sum(o_totalprice::decimal(38,8))::double as spend
        from ord join people using (user_id) group by all),
    quotes as (select quote_currency as currency, fetched_at, 1 / rate as rate_to_usd from fx
               where rate > 0 and dayofyear(fetched_at) % 3 = 0),
    met as (
        select s.*, if(s.currency = 'USD', 1, q.rate_to_usd) as rate_to_usd,
               if(s.currency = 'USD', null, q.fetched_at) as rate_fetched_at
        from spend s asof left join quotes q on q.currency = s.currency and q.fetched_at <= s.date)
    select *, round(spend * rate_to_usd, 2) as spend_home from met
    """,
)
def spend_normalised(spark, sf):
    """Quotes exist on every third day only; one currency has none at all."""
    rates = inputs.order_world(spark, sf).stg_fx_rates.where(F.dayofyear("fetched_at") % 3 == 0)
    return normalised(_spend_in_currencies(spark, sf), rates)


@query(
    "stable_story_ids",
    """
    with loads as (select *, dayofmonth(created_at) % 2 = 0 as early from e_buzz),
    first as (select title, row_number() over (order by created_at, title) as story_id from loads where early)
    from first
    union all
    select title, (select count(*) from first) + row_number() over (order by created_at, title)
    from loads where not early
    """,
)
def stable_story_ids(spark, sf):
    """Two loads, the second with all stories: those of the first keep their numbers."""
    stories = inputs.EventTables(spark, sf).hackernews_buzz
    table = VersionedTable(spark, shared_folder(spark, "story-ids"))
    early = stories.where(F.dayofmonth("created_at") % 2 == 0)
    first = table.publish(stable_ids.with_new_keys(None, early, "title", [F.col("created_at")], "story_id"))
    return table.publish(stable_ids.with_new_keys(first, stories, "title", [F.col("created_at")], "story_id"))


_LEDGER = """
    ups as (select account_id, pro_upgrade_date, channel, count(*) as n from o_plg where is_pro_upgrade group by all),
    firsts as (select account_id, arg_min(touch_date, (touch_timestamp, touch_id)) as day,
                      arg_min(channel, (touch_timestamp, touch_id)) as channel from o_stg_touch group by 1),
    met as (select n, if(day <= pro_upgrade_date, day, null) as day, firsts.channel, pro_upgrade_date, ups.channel as own
            from ups left join firsts using (account_id)),
    credit as (select day as date_day, channel, sum(n)::bigint as credit from met where day is not null group by all),
    untouched as (select pro_upgrade_date as date_day, own as channel, sum(n)::bigint as untouched from met where day is null group by all),
    lift as (select date_day, channel, geo_lift_conversions as lift from o_lift where geo_lift_conversions > 0),
    panel as (select spend_date as date_day, channel, spend_usd from o_panel where dayofmonth(spend_date) % 5 <> 0),
    cells as (select date_day, channel, spend_usd, coalesce(credit, 0) as credit, coalesce(untouched, 0) as untouched,
                     coalesce(lift, 0) as lift, if(spend_usd is null, 0, coalesce(credit, 0)) as shown
              from panel full join credit using (date_day, channel) full join untouched using (date_day, channel)
              full join lift using (date_day, channel)),
    ledger as (select date_day, channel, spend_usd, credit as first_touch_credit, shown as shown_credit,
                      credit - shown as lost_credit, untouched as untouched_upgrades, lift as geo_lift_conversions,
                      concat_ws('; ', if(shown > 0, 'shown', null), if(credit > shown, 'no spend on that day', null),
                                if(untouched > 0, 'no touch before the upgrade', null)) as reason
               from cells)
"""


def _ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Every fifth day has no spend: credit of touches on such days is lost."""
    w = inputs.order_world(spark, sf)
    panel = daily_channel_spend(w.stg_marketing_ad_spend).where(F.dayofmonth("spend_date") % 5 != 0)
    return ledger.credit_ledger(panel, w.stg_touchpoints, w.stg_developer_plg_events, w.geo_lift_daily)


@query("credit_ledger", f"with {_LEDGER} select * from ledger")
def credit_ledger(spark, sf):
    return _ledger(spark, sf)


@query(
    "credit_ledger_totals",
    f"""
    with {_LEDGER}
    select (select sum(n) from ups)::bigint as upgrades, sum(shown_credit)::bigint as shown,
           sum(lost_credit)::bigint as lost_without_spend, sum(untouched_upgrades)::bigint as lost_without_touch
    from ledger
    """,
)
def credit_ledger_totals(spark, sf):
    return ledger.ledger_totals(materialize(_ledger(spark, sf), "ledger"))


# ------------------------------------------------------------ drift, document


@query(
    "dq_drift_keys",
    """
    with good as (select date, channel, region, spend, clicks from e_spend),
    bad as (
        select date, channel, region, spend + if(dayofmonth(date) = 3 and region = 'ASIA', 0.5, 0) as spend, clicks
        from good where not (dayofmonth(date) = 5 and channel = 'view')
        union all select * from good where dayofmonth(date) = 9 and region = 'EUROPE')
    select date, channel, region, sum(greatest(n, 0))::bigint as left_only, sum(greatest(-n, 0))::bigint as right_only
    from (select date, channel, region, spend, clicks, sum(s) as n
          from (select *, 1 as s from good union all select *, -1 from bad) group by all having sum(s) <> 0)
    group by all
    """,
)
def dq_drift_keys(spark, sf):
    """Raw spend against a copy with changed, missing and repeated rows."""
    columns = ["date", "channel", "region", "spend", "clicks"]
    good = inputs.EventTables(spark, sf).marketing_spend.select(*columns)
    raised = F.expr("dayofmonth(date) = 3 and region = 'ASIA'")
    bad = good.where("not (dayofmonth(date) = 5 and channel = 'view')").withColumn(
        "spend", F.col("spend") + F.when(raised, 0.5).otherwise(0.0)
    )
    bad = bad.unionByName(good.where("dayofmonth(date) = 9 and region = 'EUROPE'"))
    return compare_tables.differing_keys(good, bad, columns[:3])


def export_payload_document(spark, sf):
    """The whole payload as one document in parts; its largest section read back."""
    w = inputs.event_world(spark, sf)
    w.store(shared_folder(spark, "marts"), "stg_developer_plg_events", "fct_marketing_triangulation_daily")
    daily = w.export_triangulation_daily
    everything = lambda df: (df, [F.col(c) for c in df.columns])
    sections = {
        "kpi_summary": everything(w.kpi_summary),
        "channel_totals": everything(w.channel_totals),
        "retention_cohorts": everything(w.export_cohorts),
        "triangulation_daily": everything(daily),
        "github": everything(exports.latest_snapshot(w.raw.github_telemetry)),
        "hackernews_top5": everything(exports.top_stories(w.raw.hackernews_buzz)),
        "fx_rates": everything(exports.fx_extract(inputs.OrderTables(spark, sf).fx_rates)),
    }
    folder = shared_folder(spark, "document")
    files.write_json_document(spark, sections, folder, {"live_telemetry": True})
    return files.read_document_section(spark, folder, list(sections).index("triangulation_daily") + 1, daily.schema)


@query(
    "dq_tables_present",
    """
    select 'stg_touchpoints' as source, true as present, count(*) as n_rows, count(*) > 0 as passed from e_stg_touch
    union all select 'int_developer_lifecycle_states', true, count(*), count(*) > 0 from e_life
    union all select 'no_such_model', false, 0, false
    """,
)
def dq_tables_present(spark, sf):
    """Views of the models by name; one that is asked for does not exist."""
    names = ["stg_touchpoints", "int_developer_lifecycle_states"]
    inputs.event_world(spark, sf).register_views(*names)
    return quality.tables_present(spark, [*names, "no_such_model"])


# The same rows as the sections written on their own.
QUERIES["export_payload_document"] = Query(export_payload_document, QUERIES["export_payload_json"].sql)
