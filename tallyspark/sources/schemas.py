"""Column types of the landed tables, so that no scan has to guess them."""

from __future__ import annotations

MARKETING_SPEND = (
    "date date, channel string, region string, spend double, impressions bigint, "
    "clicks bigint, platform_reported_conversions bigint"
)
DEVELOPER_ACCOUNTS = (
    "account_id string, signup_date date, channel string, region string, "
    "is_holdout boolean, signup_method string"
)
PROJECT_TELEMETRY = (
    "project_id string, account_id string, provisioned_at date, has_auth boolean, "
    "has_storage boolean, has_edge_functions boolean, has_pgvector boolean, "
    "time_to_first_query_min double, compute_hours double, db_size_mb double, "
    "egress_gb double, is_pro_upgrade boolean, pro_upgrade_date date, "
    "monthly_invoice_usd double"
)
TOUCHPOINTS = (
    "account_id string, touch_id string, touch_timestamp timestamp_ntz, channel string, "
    "campaign_id string"
)
FX_RATES = "base_currency string, quote_currency string, rate double, fetched_at timestamp_ntz"
GITHUB_TELEMETRY = (
    "stars bigint, forks bigint, open_issues bigint, watchers bigint, fetched_at timestamp_ntz"
)
# The API writes a zone marker (...Z); it is dropped when the column is staged.
HACKERNEWS_BUZZ = "title string, points bigint, num_comments bigint, created_at string"

RAW_SCHEMAS = {
    "raw_marketing_spend": MARKETING_SPEND,
    "raw_developer_accounts": DEVELOPER_ACCOUNTS,
    "raw_project_telemetry": PROJECT_TELEMETRY,
    "raw_touchpoints": TOUCHPOINTS,
    "raw_fx_rates": FX_RATES,
    "raw_github_telemetry": GITHUB_TELEMETRY,
    "raw_hackernews_buzz": HACKERNEWS_BUZZ,
}
