"""Silver: flatten, de-duplicate, stitch sessions, track user plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.functions.columns import to_event_time
from strata.operators.scan import scan_within_key

_PROP_COLUMNS = (
    "page", "referrer", "feature_name", "device", "country", "city", "plan",
    "mrr_usd", "mrr_lost_usd", "from_plan", "to_plan", "duration_seconds", "reason",
)


def flatten_events(decoded: DataFrame) -> DataFrame:
    """Decoded contract record -> flat silver event row (documented wide
    projection).  ``processing_date`` is the UTC date of the event time."""
    d = F.col("data")
    ts = to_event_time(d["timestamp"])
    return decoded.filter(d.isNotNull()).select(
        d["event_id"].alias("event_id"),
        d["event_type"].alias("event_type"),
        ts.alias("event_timestamp"),
        d["session_id"].alias("session_id"),
        d["user_id"].alias("user_id"),
        d["anonymous_id"].alias("anonymous_id"),
        *[d["properties"][c].alias(c) for c in _PROP_COLUMNS],
        F.col("ingested_at").alias("processed_at"),
        F.to_date(ts).alias("processing_date"),
        *[c for c in ("kafka_partition", "kafka_offset") if c in decoded.columns],
    )


def dedup_events(events: DataFrame, key: str | Sequence[str] = "event_id",
                 order_by: Sequence[str] = ("processed_at",), tiebreak: bool = True) -> DataFrame:
    """Keep one row per key: the first by ``order_by``; with ``tiebreak``
    remaining ties are broken by the other columns' struct order, so the
    survivor is deterministic (pass ``tiebreak=False`` when ``order_by`` is
    already unique, e.g. ends with the message partition and offset).

    Expressed as ``min_by(struct(row), struct(order))`` per key, a
    declarative aggregate with map-side partial aggregation: a key with a huge
    number of copies collapses inside each map task before the shuffle
    instead of landing whole in one reducer (as ``row_number`` would)."""
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in events.columns if c not in keys]
    rest = [c for c in others if c not in order_by] if tiebreak else []
    order = F.struct(*[F.col(c) for c in order_by], *[F.col(c) for c in rest])
    row = F.struct(*[F.col(c) for c in others])
    return (events.groupBy(*keys).agg(F.min_by(row, order).alias("_r"))
            .select(*keys, "_r.*").select(*events.columns))


def _first_by_time(value: str) -> Column:
    """Ordering key of the earliest row carrying a non-null ``value``."""
    return F.when(F.col(value).isNotNull(), F.struct("event_timestamp", "event_id"))


def _session_metrics() -> list[Column]:
    return [
        (F.col("session_end").cast("long") - F.col("session_start").cast("long")).alias("session_duration_secs"),
        (F.col("page_count") == 1).alias("is_bounce"),
        F.to_date("session_start").alias("session_date"),
    ]


SESSION_KEYS = ("session_id", "user_id", "anonymous_id", "device", "country")


def session_partials(events: DataFrame, *within: Column) -> DataFrame:
    """Mergeable session rows at the code's grain (``SESSION_KEYS``, and
    ``within``, e.g. a time window): bounds, number of events, and the earliest
    / latest (time, id, page) with a page.  Partials of disjoint sets of events add up by :func:`merge_partials`."""
    paged = F.when(F.col("page").isNotNull(), F.struct("event_timestamp", "event_id", "page"))
    return events.groupBy(*SESSION_KEYS, *within).agg(
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count("event_id").alias("page_count"),
        F.min(paged).alias("entry"),
        F.max(paged).alias("exit"))


def merge_partials(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*SESSION_KEYS).agg(
        F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"),
        F.sum("page_count").alias("page_count"),
        F.min("entry").alias("entry"),
        F.max("exit").alias("exit"))


def sessions_of_partials(merged: DataFrame) -> DataFrame:
    return merged.select(*SESSION_KEYS, "session_start", "session_end", "page_count",
                         F.col("entry.page").alias("entry_page"), F.col("exit.page").alias("exit_page"),
                         *_session_metrics())


def sessions_by_attributes(events: DataFrame) -> DataFrame:
    """Sessions at the code's grain: one row per (session_id, user_id,
    anonymous_id, device, country).  ``page_count`` counts all events; entry
    and exit pages are the earliest / latest non-null page by (time, id)."""
    return sessions_of_partials(session_partials(events))


def sessions(events: DataFrame) -> DataFrame:
    """Sessions at the documented grain: one row per ``session_id``.

    user_id / anonymous_id: the non-null value (max); device / country: the
    earliest non-null by (time, id); ``page_view_count`` counts page views,
    ``page_count`` keeps the all-events meaning."""
    agg = events.filter(F.col("session_id").isNotNull()).groupBy("session_id").agg(
        F.max("user_id").alias("user_id"),
        F.max("anonymous_id").alias("anonymous_id"),
        F.min_by("device", _first_by_time("device")).alias("device"),
        F.min_by("country", _first_by_time("country")).alias("country"),
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count("event_id").alias("page_count"),
        F.count(F.when(F.col("event_type") == "page_view", 1)).alias("page_view_count"),
        F.min_by("page", _first_by_time("page")).alias("entry_page"),
        F.max_by("page", _first_by_time("page")).alias("exit_page"),
    )
    return agg.select("session_id", "user_id", "anonymous_id", "device", "country",
                      "session_start", "session_end", "page_count", "page_view_count",
                      "entry_page", "exit_page",
                      *_session_metrics())


def plan_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type").isin(*schemas.PLAN_EVENT_TYPES))


def users_plan_events(events: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """The code's user table: one always-current row per plan event (signup,
    upgrade, churn), plan as carried by the event (NULL on upgrades)."""
    now = updated_at if updated_at is not None else F.current_timestamp()
    return plan_events(events).select(
        "user_id", "plan", "country", "device",
        F.col("event_timestamp").alias("valid_from"),
        F.lit(True).alias("is_current"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        now.alias("updated_at"),
    )


def user_signups(events: DataFrame) -> DataFrame:
    """Signup-only user profile projection."""
    return events.filter(F.col("event_type") == "signup").select(
        "user_id", "anonymous_id", "plan", "country", "device",
        F.col("event_timestamp").alias("signed_up_at"))


def user_versions(events: DataFrame) -> DataFrame:
    """user_id, valid_from, event_id, plan: where each version of a user starts
    (what as-of lookups need of the history)."""
    return plan_events(events).filter(F.col("user_id").isNotNull()).select(
        "user_id", F.col("event_timestamp").alias("valid_from"), "event_id",
        F.coalesce("to_plan", "plan").alias("plan"))


def users_scd2(events: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Documented SCD Type 2 user history: one row per plan event.

    plan = ``coalesce(to_plan, plan)``; rows of a user are ordered by
    (event time, event id); ``valid_to`` = the next row's ``valid_from``;
    ``is_current`` = no next row.  country / device carry the latest known
    value (upgrade and churn events carry none).  ``change_type`` is the
    event type, so churned intervals can be told apart.

    "Next row within user" is computed by the skew-safe ordered scan
    (:func:`strata.operators.scan.scan_within_key`, one pass for both the
    forward fill and the lead) over the plan events alone, not by a per-user
    window: a user with a huge history is spread over its hours."""
    now = updated_at if updated_at is not None else F.current_timestamp()
    pe = plan_events(events).filter(F.col("user_id").isNotNull()).select(
        "user_id",
        F.coalesce("to_plan", "plan").alias("plan"),
        "country", "device",
        F.col("event_timestamp").alias("valid_from"),
        F.col("event_type").alias("change_type"),
        "event_id",
    )
    nxt = scan_within_key(pe, "user_id", ["valid_from", "event_id"],
                          fill=["country", "device"], lead={"valid_to": "valid_from"})
    return nxt.select(
        "user_id", "plan", "country", "device", "valid_from", "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
        "change_type", "event_id",
        now.alias("updated_at"),
    )


def users_current(scd2: DataFrame) -> DataFrame:
    return scd2.filter(F.col("is_current"))
