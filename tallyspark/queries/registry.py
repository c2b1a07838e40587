"""Every query: a Spark function over ``(spark, sf_dir)`` and the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.scalar import exact_sum, hill, round_n, safe_ratio
from tallyspark.operators import adstock as ads
from tallyspark.operators import attribution as att
from tallyspark.operators import geo, quality, staging
from tallyspark.operators.ranking import distributed_row_number
from tallyspark.params import RESPONSE_GRID, HotKeyPolicy
from tallyspark.plans import checks, exports, marts
from tallyspark.queries import inputs
from tallyspark.queries.sql import with_tables
from tallyspark.session import shared_folder
from tallyspark.sources import api, files, schemas

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: QueryFn
    sql: str


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = Query(fn, with_tables(sql))
        return fn

    return register


def model(name: str, attribute: str, sql: str, world=inputs.event_world) -> None:
    """Register a query that is one attribute of a world's models."""
    QUERIES[name] = Query(lambda spark, sf: getattr(world(spark, sf), attribute), with_tables(sql))


# ------------------------------------------------------------ staging models

model("stg_marketing_ad_spend", "stg_marketing_ad_spend", "from e_stg_spend")
model("stg_marketing_ad_spend_orders", "stg_marketing_ad_spend", "from o_stg_spend", inputs.order_world)
model("stg_developer_plg_events", "stg_developer_plg_events", "from e_plg")
model("stg_developer_plg_events_orders", "stg_developer_plg_events", "from o_plg", inputs.order_world)
model("stg_touchpoints", "stg_touchpoints", "from e_stg_touch")
model(
    "stg_fx_rates",
    "stg_fx_rates",
    """
    select base_currency, quote_currency, rate as exchange_rate, fetched_at,
           case when quote_currency = 'USD' then 1 when rate > 0 then 1 / rate end as rate_to_usd
    from fx
    """,
    inputs.order_world,
)
model(
    "stg_github_telemetry",
    "stg_github_telemetry",
    f"""
    select '{inputs.REPO}' as repo_name, stars as stars_count, forks as forks_count,
           open_issues as open_issues_count, watchers as watchers_count, fetched_at
    from e_repo
    """,
)
model(
    "stg_hackernews_buzz",
    "stg_hackernews_buzz",
    """
    select row_number() over (order by created_at desc, title) as story_id, *,
           round(points * 1.5::double + num_comments * 2::double, 2) as buzz_score
    from e_buzz
    """,
)


@query(
    "stg_buzz_score",
    "select *, round(points * 1.5::double + num_comments * 2, 2) as buzz_score from e_buzz",
)
def stg_buzz_score(spark, sf):
    return staging.buzz_scored(inputs.EventTables(spark, sf).hackernews_buzz)


# ------------------------------------------------------------ adstock and saturation


@query("daily_channel_spend", "from e_panel")
def daily_channel_spend(spark, sf):
    return ads.daily_channel_spend(inputs.event_world(spark, sf).stg_marketing_ad_spend)


@query("daily_channel_spend_orders", "from o_panel")
def daily_channel_spend_orders(spark, sf):
    return ads.daily_channel_spend(inputs.order_world(spark, sf).stg_marketing_ad_spend)


@query("adstock_lags", "from e_lags")
def adstock_lags(spark, sf):
    return ads.adstock_lags(daily_channel_spend(spark, sf))


@query("adstock", "from e_adstock")
def adstock(spark, sf):
    return ads.adstock(daily_channel_spend(spark, sf))


@query("adstock_orders", "from o_adstock")
def adstock_orders(spark, sf):
    return ads.adstock(daily_channel_spend_orders(spark, sf))


@query(
    "adstock_calendar_orders",
    """
    select p.spend_date, p.channel, p.spend_usd, p.impressions, p.clicks, p.platform_conversions,
           round(p.spend_usd + 0.7::double * ifnull(a.spend_usd, 0)
                 + 0.49::double * ifnull(b.spend_usd, 0) + 0.343::double * ifnull(c.spend_usd, 0)
                 + 0.24::double * ifnull(d.spend_usd, 0), 2) as spend_adstocked
    from o_panel p
    left join o_panel a on a.channel = p.channel and a.spend_date = p.spend_date - 1
    left join o_panel b on b.channel = p.channel and b.spend_date = p.spend_date - 2
    left join o_panel c on c.channel = p.channel and c.spend_date = p.spend_date - 3
    left join o_panel d on d.channel = p.channel and d.spend_date = p.spend_date - 4
    """,
)
def adstock_calendar_orders(spark, sf):
    return ads.adstock(daily_channel_spend_orders(spark, sf), calendar=True)


@query("hill_saturation", "select spend_date, channel, spend_adstocked, round(response, 4) as saturation_index from e_response")
def hill_saturation(spark, sf):
    return adstock(spark, sf).select(
        "spend_date",
        "channel",
        "spend_adstocked",
        round_n(hill("spend_adstocked", inputs.EVENT_PARAMS.half_saturation), 4).alias(
            "saturation_index"
        ),
    )


model("int_adstock_and_saturation", "int_adstock_and_saturation", "from e_mmm")
model("int_adstock_and_saturation_orders", "int_adstock_and_saturation", "from o_mmm", inputs.order_world)


@query(
    "saturation_curve",
    """
    select channel, half_saturation, spend_usd,
           round(spend_usd * spend_usd / (half_saturation * half_saturation
                 + spend_usd * spend_usd), 4) as saturation_index,
           round(round(spend_usd * spend_usd / (half_saturation * half_saturation
                 + spend_usd * spend_usd), 4) * 35, 1) as estimated_conversions
    from (
        select channel,
               round(sum(spend_adstocked::decimal(38,8))::double / count(*), 2) as half_saturation,
               unnest([200, 500, 1000, 1500, 2000, 2500, 3000, 4000, 5000, 6500, 8000, 10000])::double
                   as spend_usd
        from e_adstock group by channel)
    """,
)
def saturation_curve(spark, sf):
    """Response curves of the channels, each with its mean adstocked spend as K."""
    mean = safe_ratio(exact_sum("spend_adstocked"), F.count("*"))
    curves = adstock(spark, sf).groupBy("channel").agg(round_n(mean, 2).alias("half_saturation"))
    return ads.response_curve(curves)


@query(
    "saturation_curve_reference",
    """
    select spend_usd, saturation_index, round(saturation_index * 35, 1) as estimated_conversions,
           (select count(*) from o_adstock as day where day.spend_adstocked <= curve.spend_usd) as days_up_to
    from (select g::double as spend_usd,
                 round(g::double * g / (2500.0 * 2500 + g::double * g), 4) as saturation_index
          from (select unnest([200, 500, 1000, 1500, 2000, 2500, 3000, 4000, 5000, 6500, 8000, 10000]) as g)) as curve
    """,
)
def saturation_curve_reference(spark, sf):
    """The published curve (K = 2500, 12 points), and how many days lie up to each point."""
    one = spark.range(1).select()
    points = ads.response_curve(one).drop("half_saturation")
    days = inputs.order_world(spark, sf).int_adstock_and_saturation.select("spend_adstocked")
    grid = F.array(*[F.lit(float(g)) for g in RESPONSE_GRID])
    reached = (
        days.select(F.explode(F.filter(grid, lambda g: F.col("spend_adstocked") <= g)).alias("spend_usd"))
        .groupBy("spend_usd")
        .agg(F.count("*").alias("days_up_to"))
    )
    return points.join(reached, "spend_usd", "left").withColumn(
        "days_up_to", F.coalesce("days_up_to", F.lit(0).cast("long"))
    )


# ------------------------------------------------------------ attribution

_PATH = (
    "account_id, touch_id, touch_timestamp, touch_date, channel, campaign_id, "
    "pro_upgrade_date, monthly_invoice_usd"
)


@query(
    "converted_accounts",
    "select account_id, pro_upgrade_date, monthly_invoice_usd from e_plg where is_pro_upgrade",
)
def converted_accounts(spark, sf):
    return att.converted_accounts(inputs.event_world(spark, sf).stg_developer_plg_events)


@query("touches_before_conversion", f"select {_PATH} from e_path")
def touches_before_conversion(spark, sf):
    w = inputs.event_world(spark, sf)
    return att.touches_before_conversion(w.stg_touchpoints, w.stg_developer_plg_events, w.params)


def _ordered(w) -> DataFrame:
    return att.touch_order(w.stg_touchpoints, w.stg_developer_plg_events, w.params)


@query(
    "touch_order",
    "select account_id, touch_id, touch_order_asc, touch_order_desc, total_touches from e_order",
)
def touch_order(spark, sf):
    return _ordered(inputs.event_world(spark, sf)).select(
        "account_id", "touch_id", "touch_order_asc", "touch_order_desc", "total_touches"
    )


@query(
    "time_decay_normalize",
    """
    select account_id, touch_id, time_decay_raw, sum_decay_raw,
           round(time_decay_raw / nullif(sum_decay_raw, 0), 4) as time_decay_weight
    from e_order
    """,
)
def time_decay_normalize(spark, sf):
    return _ordered(inputs.event_world(spark, sf)).select(
        "account_id",
        "touch_id",
        "time_decay_raw",
        "sum_decay_raw",
        round_n(safe_ratio("time_decay_raw", "sum_decay_raw"), 4).alias("time_decay_weight"),
    )


model("int_attribution_paths", "int_attribution_paths", "from e_attribution")
model("int_attribution_paths_orders", "int_attribution_paths", "from o_attribution", inputs.order_world)
model("mta_daily", "mta_daily", "from e_mta")
model("mta_daily_orders", "mta_daily", "from o_mta", inputs.order_world)



_MTA_EXACT = "select touch_date as date_day, channel, {} from e_exact group by all".format(
    ", ".join(
        f"round(fsum({k}_weight), 6) as mta_{k}_conversions"
        for k in ("first_touch", "last_touch", "linear", "time_decay")
    )
)


@query("mta_daily_exact", _MTA_EXACT)
def mta_daily_exact(spark, sf):
    """Credits from unrounded weights: nothing is lost on long paths."""
    w = inputs.event_world(spark, sf)
    return att.mta_daily(w.stg_touchpoints, w.stg_developer_plg_events, w.params, exact=True)


@query("mta_daily_exact_hot", _MTA_EXACT)
def mta_daily_exact_hot(spark, sf):
    w = _hot_world(spark, sf)
    return att.mta_daily(w.stg_touchpoints, w.stg_developer_plg_events, w.params, exact=True)


# The same models with a policy that treats many accounts as hot, so that the
# second route carries rows at any scale.
_EAGER_HOT = HotKeyPolicy(min_rows=70, pieces=8)


def _hot_world(spark, sf):
    w = inputs.event_world(spark, sf)
    return type(w)(w.raw, replace(w.params, hot_keys=_EAGER_HOT), w.repo_name)


model("int_attribution_paths_hot", "int_attribution_paths", "from e_attribution", _hot_world)
model("mta_daily_hot", "mta_daily", "from e_mta", _hot_world)

# ------------------------------------------------------------ geo and lifecycle

model("int_geo_experiment_clusters", "int_geo_experiment_clusters", "from e_geo")
model("geo_lift_daily", "geo_lift_daily", "from e_lift")


@query("geo_lift_two_level", "from o_lift")
def geo_lift_two_level(spark, sf):
    return geo.geo_lift_from_clusters(inputs.order_world(spark, sf).int_geo_experiment_clusters)


model("int_developer_lifecycle_states", "int_developer_lifecycle_states", "from e_life")
model("int_developer_lifecycle_states_orders", "int_developer_lifecycle_states", "from o_life", inputs.order_world)

# ------------------------------------------------------------ marts

model("fct_marketing_triangulation_daily", "fct_marketing_triangulation_daily", "from e_tri")
model("fct_marketing_triangulation_daily_orders", "fct_marketing_triangulation_daily", "from o_tri", inputs.order_world)
model("fct_channel_efficiency_daily", "fct_channel_efficiency_daily", "from e_efficiency")
model("fct_channel_efficiency_daily_orders", "fct_channel_efficiency_daily", "from o_efficiency", inputs.order_world)
model("fct_developer_cohort_retention", "fct_developer_cohort_retention", "from e_cohorts")
model("fct_developer_cohort_retention_orders", "fct_developer_cohort_retention", "from o_cohorts", inputs.order_world)
model("dim_campaigns", "dim_campaigns", "from e_campaigns")
model("dim_campaigns_orders", "dim_campaigns", "from o_campaigns", inputs.order_world)
model("dim_developer_projects", "dim_developer_projects", "select * exclude (time_to_first_query_min) from e_life")


@query("signups_daily", "from e_signups")
def signups_daily(spark, sf):
    return marts.signups_daily(inputs.event_world(spark, sf).stg_developer_plg_events)


@query(
    "platform_bias",
    """
    select spend_date, channel, platform_conversions, mmm_estimated_conversions,
           if(mmm_estimated_conversions = 0, null, round((platform_conversions
              - mmm_estimated_conversions) / mmm_estimated_conversions * 100, 2)) as bias_pct
    from o_mmm
    """,
)
def platform_bias(spark, sf):
    bias = marts.platform_bias("platform_conversions", "mmm_estimated_conversions")
    return inputs.order_world(spark, sf).int_adstock_and_saturation.select(
        "spend_date",
        "channel",
        "platform_conversions",
        "mmm_estimated_conversions",
        round_n(bias, 2).alias("bias_pct"),
    )


@query(
    "ratio_cpc_ctr",
    """
    select l_orderkey, l_linenumber,
           if(l_discount = 0, null, round(l_extendedprice / l_discount, 2)) as cpc_usd,
           if(l_quantity = 0, null, round(l_tax / l_quantity * 100, 4)) as ctr_pct
    from lineitem
    """,
)
def ratio_cpc_ctr(spark, sf):
    return inputs.Tables(spark, sf)["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        round_n(safe_ratio("l_extendedprice", "l_discount"), 2).alias("cpc_usd"),
        round_n(safe_ratio("l_tax", "l_quantity") * 100, 4).alias("ctr_pct"),
    )


# ------------------------------------------------------------ exports

_KPI = """
    select round(s, 2) as total_spend, round(p, 0) as total_platform_conversions,
           round(c, 1) as total_causal_conversions, round((p - c) / c * 100, 1) as platform_bias_pct,
           round(s / p, 2) as blended_cac, round(s / c, 2) as incremental_cac,
           round(c * 150 / s, 2) as marginal_roas, round(s / c / 25, 1) as payback_months
    from (select sum(spend_usd::decimal(38,8))::double as s,
                 sum(platform_reported_conversions)::double as p,
                 sum(mmm_estimated_incremental_conversions::decimal(38,8))::double as c
          from {w}_tri)
"""
_CHANNELS = """
    select channel, round(s, 2) as spend_usd, i as impressions, k as clicks, n as total_signups,
           u as total_pro_upgrades, if(u = 0, null, round(s / u, 2)) as blended_cac,
           round(cpc, 2) as avg_cpc, round(ctr, 3) as avg_ctr
    from (select channel, sum(spend_usd::decimal(38,8))::double as s, sum(impressions)::bigint as i,
                 sum(clicks)::bigint as k, sum(total_signups)::bigint as n,
                 sum(total_pro_upgrades)::bigint as u,
                 sum(cpc_usd::decimal(38,8))::double / count(cpc_usd) as cpc,
                 sum(ctr_pct::decimal(38,8))::double / count(ctr_pct) as ctr
          from {w}_efficiency group by channel)
"""
_DAILY = """
    select date_day::varchar as date_day, channel, round(spend_usd, 2) as spend_usd,
           platform_reported_conversions, mta_first_touch_conversions,
           mta_last_touch_conversions, mmm_estimated_incremental_conversions,
           geo_lift_conversions, platform_overreporting_bias_pct, incremental_cac_usd,
           incremental_roas
    from e_tri
"""
_COHORTS = """
    select * replace (strftime(cohort_week, '%Y-%m-%d %H:%M:%S') as cohort_week) from {w}_cohorts
"""

model("kpi_summary", "kpi_summary", _KPI.format(w="e"))
model("kpi_summary_orders", "kpi_summary", _KPI.format(w="o"), inputs.order_world)
model("channel_totals", "channel_totals", _CHANNELS.format(w="e"))
model("channel_totals_orders", "channel_totals", _CHANNELS.format(w="o"), inputs.order_world)
model("export_triangulation_daily", "export_triangulation_daily", _DAILY)
model("export_cohorts", "export_cohorts", _COHORTS.format(w="e"))


@query(
    "triangulation_channel_rollup",
    """
    select channel, sum(platform_reported_conversions)::double as platform_total,
           sum(mta_first_touch_conversions::decimal(38,8))::double as first_touch_total,
           sum(mta_last_touch_conversions::decimal(38,8))::double as last_touch_total,
           round(sum(mmm_estimated_incremental_conversions::decimal(38,8))::double, 0) as mmm_total
    from e_tri group by channel
    """,
)
def triangulation_channel_rollup(spark, sf):
    return exports.triangulation_channel_rollup(
        inputs.event_world(spark, sf).fct_marketing_triangulation_daily
    )


@query(
    "explorer_filtered_top50",
    f"from ({_DAILY}) where channel = 'view' order by date_day desc, spend_usd desc limit 50",
)
def explorer_filtered_top50(spark, sf):
    return exports.explorer_rows(inputs.event_world(spark, sf).export_triangulation_daily, "view")


@query(
    "explorer_all_top50",
    f"from ({_DAILY}) order by date_day desc, spend_usd desc, channel limit 50",
)
def explorer_all_top50(spark, sf):
    return exports.explorer_rows(inputs.event_world(spark, sf).export_triangulation_daily)


@query(
    "recent_cohorts",
    """
    select cohort_week::date::varchar as week, channel, day_7_activation_rate_pct,
           day_30_retention_rate_pct, pro_conversion_rate_pct
    from e_cohorts order by cohort_week desc, channel limit 8
    """,
)
def recent_cohorts(spark, sf):
    return exports.recent_cohorts(inputs.event_world(spark, sf).export_cohorts)


@query(
    "label_format",
    f"""
    select date_day, 'paid_' || channel || '_ads' as channel,
           'paid ' || channel || '_ads' as channel_label,
           '$' || printf('%.2f', spend_usd) as spend_label,
           if(platform_overreporting_bias_pct > 0, '+', '') || platform_overreporting_bias_pct || '%'
               as bias_label,
           if(geo_lift_conversions > 0, '+', '') || geo_lift_conversions || '%' as lift_label
    from ({_DAILY})
    """,
)
def label_format(spark, sf):
    """Channels get two underscores: only the first becomes a space."""
    daily = inputs.event_world(spark, sf).export_triangulation_daily
    named = F.concat(F.lit("paid_"), F.col("channel"), F.lit("_ads"))
    return exports.explorer_labels(daily.withColumn("channel", named))


@query("latest_snapshot_row", "from e_repo order by fetched_at desc, columns(* exclude (fetched_at)) limit 1")
def latest_snapshot_row(spark, sf):
    return exports.latest_snapshot(inputs.EventTables(spark, sf).github_telemetry)


@query("buzz_top5", "from e_buzz order by points desc, title limit 5")
def buzz_top5(spark, sf):
    return exports.top_stories(inputs.EventTables(spark, sf).hackernews_buzz)


@query("fx_extract", "select quote_currency, rate from fx")
def fx_extract(spark, sf):
    return exports.fx_extract(inputs.OrderTables(spark, sf).fx_rates)


@query(
    "global_rank_distributed",
    "select event_id, ts, row_number() over (order by ts desc, event_id) as story_id from events",
)
def global_rank_distributed(spark, sf):
    rows = inputs.Tables(spark, sf)["events"].select("event_id", "ts")
    return distributed_row_number(
        rows, [F.col("ts").desc_nulls_last(), F.col("event_id").asc()], "story_id"
    )


# ------------------------------------------------------------ sources and sinks


@query(
    "src_csv_scan",
    "select account_id, touch_id, touch_timestamp, channel, campaign_id from e_touches",
)
def src_csv_scan(spark, sf):
    path = shared_folder(spark, "csv-touches")
    files.write_csv(inputs.EventTables(spark, sf).touchpoints, path)
    return files.scan_csv(spark, path, schemas.TOUCHPOINTS)


@query("src_csv_quoted", "select doc_id, text, lang, source from documents")
def src_csv_quoted(spark, sf):
    """Whole texts with commas, quotes and line breaks through a delimited file."""
    path = shared_folder(spark, "csv-texts")
    files.write_csv(
        inputs.Tables(spark, sf)["documents"].select("doc_id", "text", "lang", "source"), path
    )
    schema = "doc_id bigint, text string, lang string, source string"
    return files.scan_csv(spark, path, schema, multi_line=True)


@query("src_csv_infer", "from e_spend")
def src_csv_infer(spark, sf):
    path = shared_folder(spark, "csv-spend")
    files.write_csv(inputs.EventTables(spark, sf).marketing_spend, path)
    return files.infer_csv(spark, path)


@query(
    "src_json_defaults",
    """
    select event_id, user_id as stars, if(event_type = 'click', k, 4500)::bigint as forks,
           if(event_type = 'error', k, 120)::bigint as open_issues, 1800::bigint as watchers
    from ev
    """,
)
def src_json_defaults(spark, sf):
    def only(event_type: str):
        return F.when(F.col("event_type") == event_type, F.col("k"))

    document = F.to_json(
        F.struct(
            F.col("user_id").alias("stargazers_count"),
            only("click").alias("forks_count"),
            only("error").alias("open_issues_count"),
        )
    )
    docs = inputs.EventTables(spark, sf).events.select("event_id", document.alias("doc"))
    return api.object_rows(docs, "doc", keep=["event_id"])


@query(
    "src_json_explode_topn",
    """
    select doc_id, (pos - 1)::bigint as position, words[pos] as title,
           if(length(words[pos]) > 3, length(words[pos]), 0)::bigint as points,
           0::bigint as num_comments, lang as created_at
    from (select doc_id, lang, words, unnest(range(1, least(len(words), 20) + 1)) as pos
          from (select doc_id, lang, string_split(text, ' ') as words from documents))
    """,
)
def src_json_explode_topn(spark, sf):
    """Each document as an API answer: its words are the hits, short ones lack points."""
    hits = F.transform(
        F.split("text", " "),
        lambda w: F.struct(
            w.alias("title"),
            F.when(F.length(w) > 3, F.length(w)).alias("points"),
            F.col("lang").alias("created_at"),
        ),
    )
    docs = inputs.Tables(spark, sf)["documents"].select(
        "doc_id", F.to_json(F.struct(hits.alias("hits"))).alias("doc")
    )
    rows = api.list_rows(docs, "doc", keep=["doc_id"])
    return rows.withColumn("position", F.col("position").cast("long"))


@query(
    "src_json_explode_all",
    """
    select doc_id, (pos - 1)::bigint as position, words[pos] as title, length(words[pos]) as points,
           0::bigint as num_comments, lang as created_at
    from (select doc_id, lang, words, unnest(range(1, len(words) + 1)) as pos
          from (select doc_id, lang, string_split(text, ' ') as words from documents))
    """,
)
def src_json_explode_all(spark, sf):
    """Whole lists: every word of every document is an entry."""
    hits = F.transform(
        F.split("text", " "),
        lambda w: F.struct(w.alias("title"), F.length(w).alias("points"), F.col("lang").alias("created_at")),
    )
    docs = inputs.Tables(spark, sf)["documents"].select(
        "doc_id", F.to_json(F.struct(hits.alias("hits"))).alias("doc")
    )
    rows = api.list_rows(docs, "doc", first=None, keep=["doc_id"])
    return rows.withColumn("position", F.col("position").cast("long"))


def _feed_answers(spark, sf) -> DataFrame:
    """Events as API answers: some broken, some missing, some of the wrong kind."""
    kind = F.col("event_type")
    good = F.to_json(F.struct(F.col("user_id").alias("stargazers_count"), F.array(F.lit(5)).alias("hits")))
    doc = (
        F.when(kind == "error", F.concat(F.lit("{broken "), F.col("event_id").cast("string")))
        .when(kind == "signup", F.lit(None).cast("string"))
        .when(kind == "view", F.lit("[1]"))
        .when(kind == "purchase", F.lit('{"hits": 7}'))
        .otherwise(good)
    )
    return inputs.Tables(spark, sf)["events"].select("event_id", doc.alias("doc"))


@query(
    "src_json_fallback",
    """
    select event_id,
           if(event_type in ('error', 'signup', 'view', 'purchase'), 72000, user_id)::bigint as stars,
           4500::bigint as forks, 120::bigint as open_issues, 1800::bigint as watchers
    from events
    """,
)
def src_json_fallback(spark, sf):
    """Every document gives a row: what cannot be read gives the defaults."""
    return api.object_rows(_feed_answers(spark, sf), "doc", keep=["event_id"], fallback=True)


@query(
    "src_json_rejected",
    """
    select event_id, case event_type when 'error' then '{broken ' || event_id
                     when 'view' then '[1]' when 'purchase' then '{"hits": 7}' end as document,
           case event_type when 'error' then 'not JSON' when 'signup' then 'missing'
                when 'view' then 'not an object' else 'no list' end as reason
    from events where event_type in ('error', 'signup', 'view', 'purchase')
    """,
)
def src_json_rejected(spark, sf):
    return api.rejected_documents(_feed_answers(spark, sf), "doc", member="hits", keep=["event_id"])


_RATES = """
    select o_orderkey, o_totalprice as eur, o_totalprice / 2 as gbp, o_orderstatus = 'O' as is_open
    from orders
"""


def _rate_documents(spark, sf) -> DataFrame:
    price = F.col("o_totalprice")
    rates = F.struct(
        price.alias("EUR"), F.when(F.col("o_orderstatus") == "O", price / 2).alias("GBP")
    )
    return inputs.Tables(spark, sf)["orders"].select(
        "o_orderkey", F.to_json(F.struct(rates.alias("rates"))).alias("doc")
    )


@query(
    "src_json_map_rows",
    f"""
    select o_orderkey, 'USD' as base_currency, 'EUR' as quote_currency, eur as rate from ({_RATES})
    union all
    select o_orderkey, 'USD', 'GBP', gbp from ({_RATES}) where is_open
    """,
)
def src_json_map_rows(spark, sf):
    return api.rate_rows(_rate_documents(spark, sf), "doc", keep=["o_orderkey"])


@query(
    "src_json_map_required",
    f"""
    select o_orderkey, 'USD' as base_currency, c as quote_currency,
           case when c = 'EUR' then eur when c = 'GBP' and is_open then gbp
                when c = 'GBP' then 0.79 when c = 'IDR' then 16250 else 1.36 end::double as rate
    from ({_RATES}), (select unnest(['EUR', 'GBP', 'IDR', 'CAD']) as c)
    """,
)
def src_json_map_required(spark, sf):
    required = {"EUR": 0.92, "GBP": 0.79, "IDR": 16250.0, "CAD": 1.36}
    return api.rate_rows(
        _rate_documents(spark, sf), "doc", keep=["o_orderkey"], required=required
    )


@query(
    "fill_required_members",
    """
    select n_name as member, count(c_custkey) as rich_customers
    from nation left join customer on c_nationkey = n_nationkey and c_acctbal > 9900
    group by n_name
    """,
)
def fill_required_members(spark, sf):
    tables = inputs.Tables(spark, sf)
    nation = tables["nation"].select("n_nationkey", F.col("n_name").alias("member"))
    rich = tables["customer"].where("c_acctbal > 9900")
    found = (
        rich.join(nation, rich.c_nationkey == nation.n_nationkey)
        .groupBy("member")
        .agg(F.count("*").alias("rich_customers"))
    )
    defaults = nation.select("member", F.lit(0).cast("long").alias("rich_customers"))
    return api.fill_required_members(found, "member", defaults)


@query(
    "fallback_if_empty",
    """
    select 'empty' as source, o_orderstatus, count(*) as n from orders group by 2
    union all
    select 'present', o_orderstatus, count(*) from orders where o_totalprice > 300000 group by 2
    """,
)
def fallback_if_empty(spark, sf):
    """A feed without rows is replaced, a feed with rows is not."""
    rows = inputs.Tables(spark, sf)["orders"]

    def feed(condition: str) -> DataFrame:
        return rows.where(condition).groupBy("o_orderstatus").agg(F.count("*").alias("n"))

    fallback = feed("true")
    parts = [
        api.fallback_if_empty(feed(condition), fallback).select(
            F.lit(name).alias("source"), "o_orderstatus", "n"
        )
        for name, condition in (("empty", "o_totalprice < 0"), ("present", "o_totalprice > 300000"))
    ]
    return parts[0].unionByName(parts[1])


@query("mart_materialize_roundtrip", "select * exclude (time_to_first_query_min) from e_life")
def mart_materialize_roundtrip(spark, sf):
    mart = inputs.event_world(spark, sf).dim_developer_projects
    path = shared_folder(spark, "mart-projects")
    files.write_table(mart, path, partition_by=["region"])
    return spark.read.schema(mart.schema).parquet(path)


@query("export_payload_json", _DAILY)
def export_payload_json(spark, sf):
    """Store the daily mart, write all sections of the payload, read the largest one back."""
    w = inputs.event_world(spark, sf)
    w.store(
        shared_folder(spark, "marts"),
        "stg_developer_plg_events",
        "fct_marketing_triangulation_daily",
    )
    sections = {
        "kpi_summary": w.kpi_summary,
        "channel_totals": w.channel_totals,
        "saturation_curve": saturation_curve(spark, sf),
        "retention_cohorts": w.export_cohorts,
        "triangulation_daily": w.export_triangulation_daily,
        "github": exports.latest_snapshot(w.raw.github_telemetry),
        "hackernews_top5": exports.top_stories(w.raw.hackernews_buzz),
        "fx_rates": exports.fx_extract(inputs.OrderTables(spark, sf).fx_rates),
    }
    folder = shared_folder(spark, "payload")
    files.write_json_sections(sections, folder)
    name = "triangulation_daily"
    return files.read_json_section(spark, folder, name, sections[name].schema)


# ------------------------------------------------------------ data quality


@query("dq_not_null", "select account_id, project_id from e_plg where project_id is null")
def dq_not_null(spark, sf):
    plg = inputs.event_world(spark, sf).stg_developer_plg_events
    return quality.not_null(plg, "project_id").select("account_id", "project_id")


@query(
    "dq_unique",
    "select account_id, count(*) as row_count from e_touches group by 1 having count(*) > 1",
)
def dq_unique(spark, sf):
    return quality.unique(inputs.event_world(spark, sf).stg_touchpoints, "account_id")


@query("dq_non_negative", "select c_acctbal as tested_value from customer where c_acctbal < 0")
def dq_non_negative(spark, sf):
    return quality.non_negative(inputs.Tables(spark, sf)["customer"], "c_acctbal")


@query(
    "dq_unique_grain",
    """
    select account_id, channel, touch_date, count(*) as row_count
    from e_stg_touch group by all having count(*) > 1
    """,
)
def dq_unique_grain(spark, sf):
    touches = inputs.event_world(spark, sf).stg_touchpoints
    return quality.unique_grain(touches, ["account_id", "channel", "touch_date"])


_WEIGHTS = """
    select * from (
        select account_id, sum(first_touch_weight::decimal(18,4))::double as total_first_touch_weight,
               sum(last_touch_weight::decimal(18,4))::double as total_last_touch_weight,
               sum(linear_weight::decimal(18,4))::double as total_linear_weight
        from e_attribution group by account_id)
    where abs(total_first_touch_weight - 1) > 0.001 or abs(total_last_touch_weight - 1) > 0.001
          or not total_linear_weight between 0.999 and 1.001
"""


@query("dq_attribution_violations", _WEIGHTS)
def dq_attribution_violations(spark, sf):
    return quality.weight_violations(inputs.event_world(spark, sf).int_attribution_paths)


_EXACT_SUMS = """
    select account_id, fsum(first_touch_weight) as f, fsum(last_touch_weight) as l,
           fsum(linear_weight) as n, fsum(time_decay_weight) as d
    from e_exact group by account_id
"""
_EXACT_OFF = "greatest(abs(f - 1), abs(l - 1), abs(n - 1), abs(d - 1)) > 1e-6"


@query(
    "dq_attribution_violations_exact",
    f"""
    select account_id, f as total_first_touch_weight, l as total_last_touch_weight,
           n as total_linear_weight, d as total_time_decay_weight
    from ({_EXACT_SUMS}) where {_EXACT_OFF}
    """,
)
def dq_attribution_violations_exact(spark, sf):
    """Sound data has no rows here: only rounding makes published weights miss 1."""
    return quality.exact_weight_violations(_exact_paths(spark, sf))


def _exact_paths(spark, sf):
    w = inputs.event_world(spark, sf)
    return att.int_attribution_paths(w.stg_touchpoints, w.stg_developer_plg_events, w.params, exact=True)


@query(
    "dq_attribution_summary",
    f"""
    select 'all' as scope, count(*) as n_checked, count(*) filter ({_EXACT_OFF}) as n_violations,
           count(*) > 0 and count(*) filter ({_EXACT_OFF}) = 0 as passed
    from ({_EXACT_SUMS})
    union all select 'none', 0, 0, false from (select count(*) from events)
    """,
)
def dq_attribution_summary(spark, sf):
    """How many accounts were checked; a check of nothing fails."""
    paths = _exact_paths(spark, sf)
    scopes = {"all": paths, "none": paths.where("account_id is null")}
    parts = [
        quality.weight_summary(df).select(F.lit(name).alias("scope"), "n_checked", "n_violations", "passed")
        for name, df in scopes.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "dq_spend_drift",
    """
    select abs((select sum(spend_usd::decimal(38,8)) from o_stg_spend)
               - (select sum(spend_usd::decimal(38,8)) from o_efficiency))::double as spend_drift
    """,
)
def dq_spend_drift(spark, sf):
    w = inputs.order_world(spark, sf)
    return quality.total_drift(
        w.stg_marketing_ad_spend, "spend_usd", w.fct_channel_efficiency_daily, "spend_usd", "spend_drift"
    )


@query(
    "dq_raw_staging_drift",
    """
    select abs((select sum(value::decimal(38,8)) from events)
               - (select sum(spend_usd::decimal(38,8)) from e_stg_spend))::double as spend_drift
    """,
)
def dq_raw_staging_drift(spark, sf):
    staged = inputs.event_world(spark, sf).stg_marketing_ad_spend
    raw = inputs.Tables(spark, sf)["events"]
    return quality.total_drift(raw, "value", staged, "spend_usd", "spend_drift")


@query(
    "dq_drift_violation",
    """
    select abs((select sum(o_totalprice::decimal(38,8)) from orders)
               - (select sum(l_extendedprice::decimal(38,8)) from lineitem))::double as spend_drift
    """,
)
def dq_drift_violation(spark, sf):
    """Two totals that do differ: the check must say by how much."""
    return quality.drift_violations(
        inputs.Tables(spark, sf)["orders"], "o_totalprice",
        inputs.Tables(spark, sf)["lineitem"], "l_extendedprice",
    )


_SOURCES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query(
    "dq_row_counts",
    " union all ".join(
        f"select '{t}' as source, count(*) as n_rows, count(*) > 0 as passed from {t}"
        for t in _SOURCES
    ),
)
def dq_row_counts(spark, sf):
    tables = inputs.Tables(spark, sf)
    return quality.row_counts({t: tables[t] for t in _SOURCES})


def _report_sql() -> str:
    sources = {
        "stg_github_telemetry": "select *, 1 as repo_name, stars as stars_count from e_repo",
        "stg_hackernews_buzz": "select *, 1 as story_id from e_buzz",
        "stg_marketing_ad_spend": "from e_stg_spend",
        "stg_developer_plg_events": "from e_plg",
        "fct_marketing_triangulation_daily": "from e_tri",
        "fct_channel_efficiency_daily": "from e_efficiency",
        "dim_campaigns": "from e_campaigns",
        "dim_developer_projects": "from e_life",
    }
    found = {
        f"{m}.{c} not null": f"from ({sources[m]}) where {c} is null"
        for m, columns in checks.NOT_NULL.items()
        for c in columns
    }
    found |= {
        f"{m}.{c} non-negative": f"from ({sources[m]}) where {c} < 0"
        for m, columns in checks.NON_NEGATIVE.items()
        for c in columns
    }
    groups = {f"{m}.{c} unique": (m, c) for m, c in checks.UNIQUE.items()}
    groups |= {f"{m} grain": (m, ", ".join(c)) for m, c in checks.GRAIN.items()}
    found |= {
        name: f"select 1 from ({sources[m]}) group by {by} having count(*) > 1"
        for name, (m, by) in groups.items()
    }
    total = "(select sum({}::decimal(38,8)) from {})"
    raw, staged = total.format("spend", "e_spend"), total.format("spend_usd", "e_stg_spend")
    mart = total.format("spend_usd", "e_efficiency")
    found["attribution weights sum to one"] = _WEIGHTS
    found["raw spend equals staging"] = f"select 1 where {raw} <> {staged}"
    found["staging spend equals mart"] = f"select 1 where {staged} <> {mart}"
    return " union all ".join(
        f"select '{name}' as check_name, count(*) as n_violations, count(*) = 0 as passed"
        f" from ({sql})"
        for name, sql in found.items()
    )


@query("dq_report", _report_sql())
def dq_report(spark, sf):
    """As a nightly run: models are stored and checked on the way, then compared."""
    return checks.observed_report(inputs.event_world(spark, sf), shared_folder(spark, "marts"))


# Registers its queries; it needs the names above.
from tallyspark.queries import upkeep  # noqa: E402, F401
