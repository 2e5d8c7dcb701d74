"""Fixed schemas of every layer, business keys and value domains."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TS, DT, B, BIN = T.TimestampType(), T.DateType(), T.BooleanType(), T.BinaryType()


def _struct(*fields: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    out = []
    for f in fields:
        name, dtype = f[0], f[1]
        nullable = f[2] if len(f) > 2 else True
        out.append(T.StructField(name, dtype, nullable))
    return T.StructType(out)


# ---------------------------------------------------------------- raw event
# The event contract: three required strings, three optional ids and a nested
# record of 26 optional properties.
EVENT_PROPERTIES = _struct(
    ("page", S), ("referrer", S), ("utm_source", S), ("utm_medium", S),
    ("utm_campaign", S), ("device", S), ("browser", S), ("os", S),
    ("country", S), ("city", S), ("plan", S), ("signup_method", S),
    ("referral_source", S), ("login_method", S), ("session_number", I),
    ("feature_name", S), ("duration_seconds", I), ("actions_taken", I),
    ("from_plan", S), ("to_plan", S), ("mrr_usd", D), ("payment_method", S),
    ("billing_cycle", S), ("reason", S), ("days_active", I), ("mrr_lost_usd", D),
)

RAW_EVENT = _struct(
    ("event_id", S), ("event_type", S), ("timestamp", S),
    ("session_id", S), ("user_id", S), ("anonymous_id", S),
    ("properties", EVENT_PROPERTIES),
)

REQUIRED_EVENT_FIELDS = ("event_id", "event_type", "timestamp")

# ---------------------------------------------------------------- broker / bronze
MESSAGE = _struct(
    ("key", BIN), ("value", BIN), ("topic", S), ("partition", I),
    ("offset", L), ("timestamp", TS), ("timestampType", I),
)

BRONZE = _struct(
    ("value", BIN), ("ingested_at", TS), ("kafka_offset", L),
    ("kafka_partition", I), ("kafka_topic", S), ("processing_date", DT),
)

# ---------------------------------------------------------------- silver
# Documented wide projection (code subset plus referrer, city,
# duration_seconds and reason).
SILVER_EVENT_COLUMNS = (
    "event_id", "event_type", "event_timestamp", "session_id", "user_id",
    "anonymous_id", "page", "referrer", "feature_name", "device", "country",
    "city", "plan", "mrr_usd", "mrr_lost_usd", "from_plan", "to_plan",
    "duration_seconds", "reason", "processed_at", "processing_date",
)

SILVER_EVENTS = _struct(
    ("event_id", S), ("event_type", S), ("event_timestamp", TS),
    ("session_id", S), ("user_id", S), ("anonymous_id", S), ("page", S),
    ("referrer", S), ("feature_name", S), ("device", S), ("country", S),
    ("city", S), ("plan", S), ("mrr_usd", D), ("mrr_lost_usd", D),
    ("from_plan", S), ("to_plan", S), ("duration_seconds", I), ("reason", S),
    ("processed_at", TS), ("processing_date", DT),
)

SESSION_COLUMNS = (
    "session_id", "user_id", "anonymous_id", "device", "country",
    "session_start", "session_end", "page_count", "entry_page", "exit_page",
    "session_duration_secs", "is_bounce", "session_date",
)

USERS = _struct(
    ("user_id", S), ("plan", S), ("country", S), ("device", S),
    ("valid_from", TS), ("valid_to", TS), ("is_current", B), ("updated_at", TS),
)

# ---------------------------------------------------------------- gold / warehouse
# Warehouse target types: counts narrowed to INT, money and rates DOUBLE,
# JSON maps kept as text.
GOLD_DAU = _struct(
    ("date", DT), ("dau_count", I), ("new_users", I), ("returning_users", I),
    ("wau_count", I), ("mau_count", I),
)
GOLD_MRR = _struct(
    ("date", DT), ("new_mrr", D), ("churned_mrr", D), ("expansion_mrr", D),
    ("net_mrr", D), ("total_mrr", D), ("pro_users", I), ("enterprise_users", I),
    ("plan", S), ("mrr_usd", D),
)
GOLD_FUNNEL = _struct(
    ("date", DT), ("total_page_views", I), ("unique_visitors", I),
    ("signups", I), ("logins", I), ("feature_activations", I), ("upgrades", I),
    ("churns", I), ("visitor_to_signup_rate", D),
    ("signup_to_activation_rate", D), ("activation_to_upgrade_rate", D),
    ("upgrade_to_churn_rate", D),
)
GOLD_FEATURE = _struct(
    ("date", DT), ("feature_name", S), ("unique_users", I), ("total_uses", I),
    ("avg_duration_seconds", D), ("plan_breakdown", S),
)
GOLD_SESSION = _struct(
    ("date", DT), ("avg_session_duration_secs", D), ("avg_pages_per_session", D),
    ("bounce_rate", D), ("mobile_pct", D), ("desktop_pct", D), ("tablet_pct", D),
    ("top_countries", S),
)

GOLD_SCHEMAS = {
    "daily_active_users": GOLD_DAU,
    "mrr_metrics": GOLD_MRR,
    "funnel_metrics": GOLD_FUNNEL,
    "feature_adoption": GOLD_FEATURE,
    "session_quality": GOLD_SESSION,
}

GOLD_KEYS = {
    "daily_active_users": ["date"],
    "mrr_metrics": ["date"],
    "funnel_metrics": ["date"],
    "feature_adoption": ["date", "feature_name"],
    "session_quality": ["date"],
}

# Columns the warehouse MERGE updates on a key match (everything else is
# insert-only).  mrr_metrics leaves ``plan`` untouched on update.
GOLD_UPDATE_COLUMNS = {
    name: [f.name for f in schema.fields if f.name not in GOLD_KEYS[name]]
    for name, schema in GOLD_SCHEMAS.items()
}
GOLD_UPDATE_COLUMNS["mrr_metrics"] = [
    "new_mrr", "churned_mrr", "expansion_mrr", "net_mrr", "total_mrr",
    "pro_users", "enterprise_users", "mrr_usd",
]

# ---------------------------------------------------------------- value domains
# Fixed values of the event contract.
EVENT_TYPES = ("page_view", "signup", "login", "feature_used", "upgrade", "churn")
PLAN_EVENT_TYPES = ("signup", "upgrade", "churn")
PLANS = ("free_trial", "pro", "enterprise")
DEVICES = ("mobile", "desktop", "tablet")
COUNTRIES = ("IN", "US", "GB", "DE", "SG")
PLAN_MRR_USD = {"pro": 49.00, "enterprise": 199.00}
EXPANSION_RATE = 0.1
