"""Every number, label and list the models depend on, in one frozen place."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Results only agree with the measured system if these are equal.
# ---------------------------------------------------------------------------

ADSTOCK_WEIGHTS = (1.0, 0.70, 0.49, 0.343, 0.24)
RESPONSE_GRID = (200, 500, 1000, 1500, 2000, 2500, 3000, 4000, 5000, 6500, 8000, 10000)

TREATMENT_REGIONS = ("US-East", "EU-Central")
CONTROL_REGIONS = ("US-West", "APAC-SG")

CHANNEL_CATEGORIES = {
    "paid_search": "Paid Inbound",
    "paid_social": "Paid Outbound",
    "developer_sponsorship": "Influencer & Media",
    "community_events": "Developer Relations",
}
OTHER_CHANNEL_CATEGORY = "Organic & Viral"

CAMPAIGN_PERSONAS = {
    "Indie Hacker & Solopreneur": ("camp_001", "camp_002"),
    "Fast-Growing Startup Lead": ("camp_003", "camp_004", "camp_005"),
}
OTHER_PERSONA = "Enterprise Architect"

TIER_VECTOR = "AI Vector Platform"
TIER_FULL_STACK = "Full Stack BaaS"
TIER_CORE = "Core Features"
TIER_RAW = "Raw Postgres DB"

SPEED_RAPID = "Rapid Activation (<15m)"
SPEED_STANDARD = "Standard Activation (15-60m)"
SPEED_SLOW = "Slow / Lagged (>60m)"

USAGE_HIGH = "High Consumption"
USAGE_MODERATE = "Moderate Consumption"
USAGE_LIGHT = "Light Evaluation"

MAX_STORIES = 20


@dataclass(frozen=True)
class HotKeyPolicy:
    """When is a key "hot", and into how many pieces are its rows split.

    The ``max_keys`` heaviest keys with at least ``min_rows`` rows are hot.  The
    list has at most ``max_keys`` entries whatever the data looks like, so it may
    be broadcast; any key not in it holds less than ``1 / max_keys`` of the rows.
    """

    min_rows: int = 1_000_000
    max_keys: int = 10_000
    pieces: int = 256


@dataclass(frozen=True)
class MeasurementParams:
    """Model constants.  Change one with ``dataclasses.replace``."""

    adstock_weights: tuple[float, ...] = ADSTOCK_WEIGHTS
    half_saturation: float = 2500.0
    max_daily_conversions: float = 35.0
    decay_per_day: float = 0.05
    value_per_conversion: float = 150.0
    monthly_revenue_per_user: float = 25.0

    treatment_regions: tuple[str, ...] = TREATMENT_REGIONS
    control_regions: tuple[str, ...] = CONTROL_REGIONS

    rapid_minutes: float = 15
    standard_minutes: float = 60
    high_compute_hours: float = 100
    high_db_mb: float = 500
    moderate_compute_hours: float = 20
    moderate_db_mb: float = 50
    week_active_hours: float = 5
    month_active_hours: float = 20

    channel_categories: dict[str, str] = field(default_factory=lambda: dict(CHANNEL_CATEGORIES))
    campaign_personas: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: dict(CAMPAIGN_PERSONAS)
    )

    hot_keys: HotKeyPolicy = HotKeyPolicy()


DEFAULTS = MeasurementParams()
