"""Raw table layouts and the fixed values of the domain."""

from __future__ import annotations

from pyspark.sql import types as T

DATE = "date"
AD_SET = "ad_set_id"
KEYS = [DATE, AD_SET]

PERFORMANCE = "meta_campaign_performance"
BUDGET = "budget_pacing"
CONVERSIONS = "conversion_events"
AUDIENCE = "audience_segments"

# Column order of the four raw files and the type each column is cast to.
# Column names and types of the raw files.
RAW_TYPES: dict[str, dict[str, str]] = {
    PERFORMANCE: {
        "date": "string",
        "ad_set_id": "string",
        "ad_set_name": "string",
        "impressions": "bigint",
        "clicks": "bigint",
        "spend": "double",
        "ctr": "double",
        "cpm": "double",
        "frequency": "double",
    },
    BUDGET: {
        "date": "string",
        "ad_set_id": "string",
        "planned_spend": "double",
        "actual_spend": "double",
        "budget_utilization": "double",
        "pacing_status": "string",
    },
    CONVERSIONS: {
        "conversion_id": "string",
        "date": "string",
        "ad_set_id": "string",
        "conversion_type": "string",
        "value": "double",
        "attribution_window": "string",
        "user_segment": "string",
    },
    AUDIENCE: {
        "ad_set_id": "string",
        "ad_set_name": "string",
        "target_age": "string",
        "target_interests": "string",
        "lookalike_source": "string",
        "daily_budget": "double",
    },
}

# They must equal the published definitions for results to agree.
DAY_FIRST = "d/M/yyyy"
BOOKING = "booking_completed"
SOFT_CONVERSIONS = [
    "event_registration",
    "newsletter_signup",
    "hotel_inquiry",
    "flight_search",
    "destination_guide_download",
]
PACING_STATUSES = ["under_pacing", "on_pace", "over_pacing"]
UNKNOWN = "unknown"
PACING_BANDS = ["under", "on", "over"]
UNDER_BELOW = 0.9
ON_UP_TO = 1.1
MIN_IMPRESSIONS = 5000
FORWARD_DAYS = 7
MA_WINDOW = 7
SEED = 42

BOOKINGS_FEATURES = [
    "impressions",
    "clicks",
    "spend",
    "ctr",
    "cpm",
    "frequency",
    "planned_spend",
    "actual_spend",
    "budget_utilization",
    "pacing_status_idx",
    "soft_conversions",
    "revenue",
]
UNDER_PACING_FEATURES = [
    "impressions",
    "clicks",
    "spend",
    "ctr",
    "cpm",
    "frequency",
    "soft_conversions",
    "revenue",
]
NEXT_DAY_RISK_FEATURES = [
    "ctr",
    "conv_7d",
    "clicks",
    "impressions",
    "spend",
    "aud_daily_budget",
    "pacing_ratio",
]
# Columns of the training table that look past the row's own day.
FORWARD_LOOKING = ["conv_7d", "conv_next7d_rate", "conv_next7d_label"]
FORWARD_PREFIX = "next_"


def raw_schema(table: str) -> T.StructType:
    """All-text schema: every column is read as text and cast afterwards."""
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_TYPES[table]])


def typed_schema(table: str) -> T.StructType:
    """Schema of the table once its casts are applied."""
    ddl = ", ".join(f"`{c}` {t}" for c, t in RAW_TYPES[table].items())
    return T.StructType.fromDDL(ddl)
