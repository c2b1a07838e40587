"""The SQL side of the comparison: common table expressions shared by the checks."""

from __future__ import annotations

import re

# In order: a later entry may use earlier ones.
_TABLES: dict[str, str] = {}


def _table(name: str, sql: str) -> None:
    _TABLES[name] = sql.strip()


def with_tables(query: str) -> str:
    """Prefix ``query`` with the shared expressions it needs, directly or not."""
    needed: set[str] = set()
    texts = [query]
    while texts:
        words = set(re.findall(r"\w+", texts.pop()))
        for name in words & _TABLES.keys() - needed:
            needed.add(name)
            texts.append(_TABLES[name])
    parts = [f"{name} as ({sql})" for name, sql in _TABLES.items() if name in needed]
    body = query.strip()
    if not parts:
        return body
    own = body[len("with "):] if body.startswith("with ") else None
    return "with " + ",\n".join(parts) + (",\n" + own if own else "\n" + body)


# ------------------------------------------------------------------ inputs

_table(
    "people",
    """
    select c_custkey as user_id, r_name as region, c_mktsegment
    from customer
    join nation on n_nationkey = c_nationkey
    join region on r_regionkey = n_regionkey
    """,
)
_table(
    "ev",
    """
    select event_id, ts, user_id, event_type, value, ts::date as d,
           json_extract_string(props, '$.k')::int as k
    from events
    """,
)
_table(
    "e_spend",
    """
    select d as date, event_type as channel, region,
           sum(value::decimal(38,8))::double as spend,
           (sum(k + 20) * 10)::bigint as impressions,
           sum(k + 1)::bigint as clicks,
           count(*) as platform_reported_conversions
    from ev join people using (user_id)
    group by all
    """,
)
_table(
    "e_signup",
    """
    select user_id,
           coalesce(min(d) filter (event_type = 'signup' and k >= 80), max(d)) as signup_date,
           arg_min(event_type, event_id) as channel
    from ev group by user_id
    """,
)
_table(
    "e_accounts",
    """
    select user_id::varchar as account_id, signup_date, channel, region,
           user_id % 10 = 0 as is_holdout,
           if(user_id % 2 = 0, 'github_oauth', 'email') as signup_method
    from e_signup join people using (user_id)
    """,
)
_table(
    "e_upgrade",
    """
    select user_id, min(d) as pro_upgrade_date, arg_min(value, event_id) as paid
    from ev join e_signup using (user_id)
    where event_type = 'purchase' and value > 100 and d >= signup_date
    group by user_id
    """,
)
_table(
    "e_usage",
    """
    select user_id,
           max(value) filter (event_type = 'click') as top_click,
           max(value) filter (event_type = 'view') as top_view,
           max(value) filter (event_type = 'error') as top_error,
           max(value) filter (event_type = 'signup') as top_signup,
           min(value) as low,
           (sum(value::decimal(38,8)) filter (event_type = 'view'))::double as views,
           (sum(value::decimal(38,8)) filter (event_type = 'error'))::double as errors,
           sum(k)::bigint as k
    from ev group by user_id
    having max(value) filter (event_type = 'click') > 100
    """,
)
_table(
    "e_projects",
    """
    select 'proj_' || user_id as project_id, user_id::varchar as account_id,
           signup_date as provisioned_at,
           top_click > 150 as has_auth, top_view > 150 as has_storage,
           top_error > 150 as has_edge_functions, top_signup > 200 as has_pgvector,
           low * 20 as time_to_first_query_min, views / 8 as compute_hours,
           errors as db_size_mb, k / 100.0::double as egress_gb,
           pro_upgrade_date is not null as is_pro_upgrade, pro_upgrade_date,
           coalesce(paid, 0.0::double) as monthly_invoice_usd
    from e_usage join e_signup using (user_id) left join e_upgrade using (user_id)
    """,
)
_table(
    "e_touches",
    """
    select user_id::varchar as account_id, event_id::varchar as touch_id,
           ts as touch_timestamp, event_type as channel,
           'camp_' || lpad((k % 20 + 1)::varchar, 3, '0') as campaign_id
    from ev
    """,
)
_table(
    "e_repo",
    """
    select count(*) filter (event_type = 'view') as stars,
           count(*) filter (event_type = 'click') as forks,
           count(*) filter (event_type = 'error') as open_issues,
           count(*) filter (event_type = 'signup') as watchers,
           max(ts) as fetched_at
    from ev group by d
    """,
)
_table(
    "e_buzz",
    """
    select 'story of user ' || user_id as title,
           count(*) filter (event_type = 'click') as points,
           count(*) filter (event_type = 'view') as num_comments,
           max(ts) as created_at
    from ev group by user_id
    """,
)
_table(
    "ord",
    """
    select *, o_custkey as user_id, o_orderdate::date as d,
           o_orderstatus = 'F' and o_orderpriority = '1-URGENT' as upgrades
    from orders
    """,
)
_table(
    "lines",
    "select l_orderkey, sum(l_quantity)::bigint as q, count(*) as n from lineitem group by 1",
)
_table(
    "o_spend",
    """
    select d as date, o_orderpriority as channel, region,
           sum(o_totalprice::decimal(38,8))::double as spend,
           sum(q)::bigint as impressions, sum(n)::bigint as clicks,
           count(*) as platform_reported_conversions
    from ord join people using (user_id) left join lines on l_orderkey = o_orderkey
    group by all
    """,
)
_table(
    "o_customer",
    """
    select user_id, min(d) as signup_date, arg_min(o_orderpriority, o_orderkey) as channel,
           max(d) filter (upgrades) as pro_upgrade_date, count(*) as n,
           sum(o_totalprice::decimal(38,8))::double as v
    from ord group by user_id
    """,
)
_table(
    "o_accounts",
    """
    select user_id::varchar as account_id, signup_date, channel, region,
           user_id % 10 = 0 as is_holdout,
           if(user_id % 2 = 0, 'github_oauth', 'email') as signup_method
    from o_customer join people using (user_id)
    """,
)
_table(
    "o_projects",
    """
    select 'proj_' || user_id as project_id, user_id::varchar as account_id,
           signup_date as provisioned_at,
           n > 6 as has_auth, n > 9 as has_storage, n > 12 as has_edge_functions,
           n > 16 as has_pgvector, (n * 5)::double as time_to_first_query_min,
           v / 50000 as compute_hours, v / 10000 as db_size_mb, n / 4.0::double as egress_gb,
           pro_upgrade_date is not null as is_pro_upgrade, pro_upgrade_date,
           if(pro_upgrade_date is null, 0, n * 25)::double as monthly_invoice_usd
    from o_customer where n > 2
    """,
)
_table(
    "o_touches",
    """
    select o_custkey::varchar as account_id, o_orderkey::varchar as touch_id,
           o_orderdate as touch_timestamp, o_orderpriority as channel,
           'camp_' || lpad((o_orderkey % 20 + 1)::varchar, 3, '0') as campaign_id
    from orders
    """,
)
_table(
    "fx",
    """
    select 'USD' as base_currency,
           if(c_mktsegment = 'BUILDING', 'USD', left(c_mktsegment, 3)) as quote_currency,
           count(*) filter (o_orderstatus = 'O') / count(*) as rate,
           d::timestamp as fetched_at
    from ord join people using (user_id)
    group by c_mktsegment, d
    """,
)

# ------------------------------------------------------------------ models


def _world(w: str, k: str, decay: str, categories: list[str]) -> None:
    """Staging to marts over the inputs of one world (name prefix ``w``)."""
    _table(
        f"{w}_stg_spend",
        f"""
        select date as spend_date, channel, region, spend as spend_usd, impressions, clicks,
               platform_reported_conversions as platform_conversions,
               round(spend / nullif(clicks, 0), 2) as cpc_usd,
               round(clicks / nullif(impressions, 0) * 100, 4) as ctr_pct
        from {w}_spend
        """,
    )
    _table(
        f"{w}_plg",
        f"""
        select account_id, project_id, signup_date, channel, region, is_holdout, signup_method,
               provisioned_at, has_auth, has_storage, has_edge_functions, has_pgvector,
               time_to_first_query_min, compute_hours, db_size_mb, egress_gb,
               is_pro_upgrade, pro_upgrade_date, monthly_invoice_usd
        from {w}_accounts left join {w}_projects using (account_id)
        """,
    )
    _table(f"{w}_stg_touch", f"select *, touch_timestamp::date as touch_date from {w}_touches")
    _table(
        f"{w}_panel",
        f"""
        select spend_date, channel, sum(spend_usd::decimal(38,8))::double as spend_usd,
               sum(impressions)::bigint as impressions, sum(clicks)::bigint as clicks,
               sum(platform_conversions)::bigint as platform_conversions
        from {w}_stg_spend group by all
        """,
    )
    # The previous rows of a channel as a list, newest last; absent ones read as NULL.
    _table(
        f"{w}_history",
        f"""
        select *, list(spend_usd) over (
                   partition by channel order by spend_date
                   rows between 4 preceding and current row) as h
        from {w}_panel
        """,
    )
    _table(
        f"{w}_lags",
        f"""
        select spend_date, channel, spend_usd, impressions, clicks, platform_conversions,
               ifnull(list_extract(h, -2), 0) as lag1, ifnull(list_extract(h, -3), 0) as lag2,
               ifnull(list_extract(h, -4), 0) as lag3, ifnull(list_extract(h, -5), 0) as lag4
        from {w}_history
        """,
    )
    _table(
        f"{w}_adstock",
        f"""
        select * exclude (lag1, lag2, lag3, lag4),
               round(spend_usd + 0.7::double * lag1 + 0.49::double * lag2
                     + 0.343::double * lag3 + 0.24::double * lag4, 2) as spend_adstocked
        from {w}_lags
        """,
    )
    _table(
        f"{w}_response",
        f"""
        select *, spend_adstocked * spend_adstocked
                  / ({k}::double * {k} + spend_adstocked * spend_adstocked) as response
        from {w}_adstock
        """,
    )
    _table(
        f"{w}_mmm",
        f"""
        select * exclude (response), round(response, 4) as saturation_index,
               round(response * 35, 1) as mmm_estimated_conversions
        from {w}_response
        """,
    )
    _table(
        f"{w}_path",
        f"""
        select t.account_id, touch_id, touch_timestamp, touch_date, t.channel, campaign_id,
               pro_upgrade_date, monthly_invoice_usd,
               round(exp(-{decay}::double * date_diff('day', touch_date, pro_upgrade_date)), 4)
                   as time_decay_raw
        from {w}_stg_touch t, {w}_plg p
        where p.account_id = t.account_id and is_pro_upgrade and touch_date <= pro_upgrade_date
        """,
    )
    _table(
        f"{w}_order",
        f"""
        select *, row_number() over (a order by touch_timestamp, touch_id) as touch_order_asc,
               row_number() over (a order by touch_timestamp desc, touch_id desc)
                   as touch_order_desc,
               count(*) over a as total_touches,
               (sum(time_decay_raw::decimal(18,4)) over a)::double as sum_decay_raw
        from {w}_path window a as (partition by account_id)
        """,
    )
    _table(
        f"{w}_attribution",
        f"""
        select * exclude (time_decay_raw, sum_decay_raw),
               (touch_order_asc = 1)::int::double as first_touch_weight,
               (touch_order_desc = 1)::int::double as last_touch_weight,
               round(1 / total_touches, 4) as linear_weight,
               round(time_decay_raw / nullif(sum_decay_raw, 0), 4) as time_decay_weight
        from {w}_order
        """,
    )
    _table(
        f"{w}_exact",
        f"""
        select account_id, touch_date, channel, first_touch_weight, last_touch_weight,
               1 / count(*) over a as linear_weight, raw / fsum(raw) over a as time_decay_weight
        from (select *, exp(-{decay}::double * date_diff('day', touch_date, pro_upgrade_date)) as raw
              from {w}_attribution)
        window a as (partition by account_id)
        """,
    )
    credit = ",".join(
        f"round(sum({c}_weight::decimal(18,4))::double, 2) as mta_{c}_conversions"
        for c in ("first_touch", "last_touch", "linear", "time_decay")
    )
    _table(
        f"{w}_mta",
        f"select touch_date as date_day, channel, {credit} from {w}_attribution group by all",
    )
    _table(
        f"{w}_geo",
        f"""
        select signup_date, channel, region,
               case region when 'AMERICA' then 'treatment' when 'EUROPE' then 'treatment'
                    when 'AFRICA' then 'control' when 'ASIA' then 'control'
                    else 'holdout' end as experiment_cohort,
               count(*) as total_signups,
               count(*) filter (is_holdout) as holdout_signups,
               count(*) filter (is_pro_upgrade) as pro_upgrades
        from {w}_plg group by all
        """,
    )
    _table(
        f"{w}_lift",
        f"""
        select date_day, channel, t as treatment_conversions, c as control_conversions,
               if(t > c, t - c, 0)::bigint as geo_lift_conversions
        from (
            select signup_date as date_day, channel,
                   coalesce(sum(pro_upgrades) filter (experiment_cohort = 'treatment'), 0)::bigint as t,
                   coalesce(sum(pro_upgrades) filter (experiment_cohort = 'control'), 0)::bigint as c
            from {w}_geo group by all)
        """,
    )
    _table(
        f"{w}_life",
        f"""
        select account_id, project_id, signup_date, channel, region, signup_method, is_holdout,
               provisioned_at, has_auth, has_storage, has_edge_functions, has_pgvector,
               if(has_pgvector, 'AI Vector Platform',
                  if(has_auth and has_storage and has_edge_functions, 'Full Stack BaaS',
                     if(has_auth or has_storage, 'Core Features', 'Raw Postgres DB')))
                   as feature_adoption_tier,
               time_to_first_query_min,
               if(time_to_first_query_min <= 15, 'Rapid Activation (<15m)',
                  if(time_to_first_query_min <= 60, 'Standard Activation (15-60m)',
                     'Slow / Lagged (>60m)')) as activation_speed,
               compute_hours, db_size_mb, egress_gb,
               if(compute_hours > 100 and db_size_mb > 500, 'High Consumption',
                  if(compute_hours > 20 or db_size_mb > 50, 'Moderate Consumption',
                     'Light Evaluation')) as usage_tier,
               is_pro_upgrade, pro_upgrade_date,
               if(is_pro_upgrade, date_diff('day', signup_date, pro_upgrade_date), null)
                   as days_to_upgrade,
               monthly_invoice_usd
        from {w}_plg
        """,
    )
    _table(
        f"{w}_tri",
        f"""
        select m.spend_date as date_day, m.channel, spend_usd, impressions, clicks,
               platform_conversions as platform_reported_conversions,
               ifnull(mta_first_touch_conversions, 0) as mta_first_touch_conversions,
               ifnull(mta_last_touch_conversions, 0) as mta_last_touch_conversions,
               ifnull(mta_linear_conversions, 0) as mta_linear_conversions,
               ifnull(mta_time_decay_conversions, 0) as mta_time_decay_conversions,
               mmm_estimated_conversions as mmm_estimated_incremental_conversions,
               ifnull(geo_lift_conversions, 0) as geo_lift_conversions,
               if(mmm_estimated_conversions = 0, null,
                  round((platform_conversions - mmm_estimated_conversions)
                        / mmm_estimated_conversions * 100, 2)) as platform_overreporting_bias_pct,
               if(platform_conversions = 0, null, round(spend_usd / platform_conversions, 2))
                   as blended_cac_usd,
               if(mmm_estimated_conversions = 0, null,
                  round(spend_usd / mmm_estimated_conversions, 2)) as incremental_cac_usd,
               if(spend_usd = 0, null, round(mmm_estimated_conversions * 150 / spend_usd, 2))
                   as incremental_roas
        from {w}_mmm m
        left join {w}_mta t on (t.date_day, t.channel) = (m.spend_date, m.channel)
        left join {w}_lift g on (g.date_day, g.channel) = (m.spend_date, m.channel)
        """,
    )
    _table(
        f"{w}_signups",
        f"""
        select signup_date as date_day, channel, count(*) as total_signups,
               count(*) filter (is_pro_upgrade) as total_pro_upgrades,
               sum(monthly_invoice_usd::decimal(38,8))::double as total_revenue_usd
        from {w}_plg group by all
        """,
    )
    _table(
        f"{w}_efficiency",
        f"""
        select spend_date as date_day, s.channel, spend_usd, impressions, clicks,
               platform_conversions,
               if(clicks = 0, null, round(spend_usd / clicks, 2)) as cpc_usd,
               if(impressions = 0, null, round(clicks / impressions * 100, 4)) as ctr_pct,
               ifnull(total_signups, 0) as total_signups,
               ifnull(total_pro_upgrades, 0) as total_pro_upgrades,
               ifnull(total_revenue_usd, 0) as total_revenue_usd,
               if(total_pro_upgrades > 0, round(spend_usd / total_pro_upgrades, 2), null)
                   as blended_cac_usd,
               if(total_pro_upgrades > 0, round(spend_usd / total_pro_upgrades / 25, 1), null)
                   as payback_period_months
        from {w}_panel s
        left join {w}_signups u on (u.date_day, u.channel) = (s.spend_date, s.channel)
        """,
    )
    _table(
        f"{w}_cohorts",
        f"""
        select *, round(day_7_active_count / total_cohort_signups * 100, 2)
                   as day_7_activation_rate_pct,
               round(day_30_active_count / total_cohort_signups * 100, 2)
                   as day_30_retention_rate_pct,
               round(pro_upgrade_count / total_cohort_signups * 100, 2) as pro_conversion_rate_pct
        from (
            select (signup_date - (isodow(signup_date) - 1)::int)::timestamp as cohort_week,
                   channel, count(*) as total_cohort_signups,
                   count(*) filter (compute_hours > 5) as day_7_active_count,
                   count(*) filter (compute_hours > 20) as day_30_active_count,
                   count(*) filter (is_pro_upgrade) as pro_upgrade_count,
                   sum(monthly_invoice_usd::decimal(38,8))::double as total_mrr_usd
            from {w}_plg group by all)
        """,
    )
    a, b, c, d = categories
    _table(
        f"{w}_campaigns",
        f"""
        select campaign_id, channel,
               case channel when '{a}' then 'Paid Inbound' when '{b}' then 'Paid Outbound'
                    when '{c}' then 'Influencer & Media' when '{d}' then 'Developer Relations'
                    else 'Organic & Viral' end as channel_category,
               case when campaign_id in ('camp_001', 'camp_002') then 'Indie Hacker & Solopreneur'
                    when campaign_id in ('camp_003', 'camp_004', 'camp_005')
                    then 'Fast-Growing Startup Lead'
                    else 'Enterprise Architect' end as target_developer_persona
        from (select campaign_id, min(channel) as channel from {w}_touches group by 1)
        """,
    )


_world("e", "2500", "0.05", ["click", "view", "purchase", "signup"])
_world("o", "300000", "0.001", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"])
