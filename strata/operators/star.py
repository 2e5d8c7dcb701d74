"""Star schema: dimensions and facts derived from silver.

Dimensions are joined without hints: their sizes depend on the data (one
event with a far date stretches the calendar too), and AQE switches to a
broadcast only after measuring the built side at run time
(``spark.sql.adaptive.autoBroadcastJoinThreshold``), else keeps the shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.asof import asof_lookup
from strata.operators.gold import with_event_date
from strata.operators.kpi import calendar


def date_key(col: str = "date"):
    return (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")


def dim_date(events: DataFrame) -> DataFrame:
    """date_key, date, year, quarter, month, iso_week, day_of_week (1=Sun),
    is_weekend -- one row per calendar day of the event range."""
    cal = calendar(with_event_date(events))
    dow = F.dayofweek("date")
    return cal.select(
        date_key().alias("date_key"), "date",
        F.year("date").alias("year"), F.quarter("date").alias("quarter"),
        F.month("date").alias("month"), F.weekofyear("date").alias("iso_week"),
        dow.alias("day_of_week"), dow.isin(1, 7).alias("is_weekend"))


def dim_users(scd2: DataFrame) -> DataFrame:
    """SCD2 user versions with a surrogate key ``user_key`` (user + the
    plan event that opened the version; stable across reloads)."""
    return scd2.select(F.concat_ws(":", "user_id", "event_id").alias("user_key"),
                       "user_id", "plan", "country", "device", "valid_from", "valid_to",
                       "is_current", "change_type")


def dim_features(events: DataFrame) -> DataFrame:
    """feature_name, first_seen, last_seen, total_uses."""
    fe = events.filter((F.col("event_type") == "feature_used") & F.col("feature_name").isNotNull())
    return fe.groupBy("feature_name").agg(
        F.min("event_timestamp").alias("first_seen"),
        F.max("event_timestamp").alias("last_seen"),
        F.count(F.lit(1)).alias("total_uses"))


def campaign_key():
    return F.concat_ws("|", F.coalesce("utm_source", F.lit("")), F.coalesce("utm_medium", F.lit("")),
                       F.coalesce("utm_campaign", F.lit("")))


def dim_campaigns(events: DataFrame) -> DataFrame:
    """Distinct (utm_source, utm_medium, utm_campaign) with a key, first
    seen and event count; events without any UTM tag are not a campaign."""
    tagged = events.filter(F.coalesce("utm_source", "utm_medium", "utm_campaign").isNotNull())
    return tagged.groupBy("utm_source", "utm_medium", "utm_campaign").agg(
        F.min("event_timestamp").alias("first_seen"),
        F.count(F.lit(1)).alias("events")).select(
        campaign_key().alias("campaign_key"), "utm_source", "utm_medium", "utm_campaign",
        "first_seen", "events")


def event_facts(events: DataFrame) -> DataFrame:
    """Event grain with the keys that need no lookup: date_key, feature and
    campaign keys."""
    ev = with_event_date(events)
    has_utm = F.coalesce("utm_source", "utm_medium", "utm_campaign").isNotNull()
    return ev.select(
        "event_id", date_key().alias("date_key"), "event_timestamp", "event_type",
        "user_id", "anonymous_id", "session_id", "feature_name",
        F.when(has_utm, campaign_key()).alias("campaign_key"),
        "duration_seconds", "mrr_usd", "mrr_lost_usd")


def fact_events(events: DataFrame, users: DataFrame) -> DataFrame:
    """:func:`event_facts` with user_key, the SCD2 version in force at the
    event (as-of).  Of ``users`` only user_id, valid_from and event_id are
    needed (:func:`strata.operators.silver.user_versions`)."""
    versions = users.select("user_id", "valid_from", "event_id",
                            F.concat_ws(":", "user_id", "event_id").alias("user_key"))
    return asof_lookup(event_facts(events), versions, ["user_key"])


def fact_sessions(sessions: DataFrame) -> DataFrame:
    """Session grain (documented sessions) with the date key."""
    return sessions.select(
        "session_id", date_key("session_date").alias("date_key"), "user_id", "anonymous_id",
        "device", "country", "session_start", "session_duration_secs", "page_count",
        "page_view_count", "is_bounce")


def fact_mrr(events: DataFrame) -> DataFrame:
    """One row per MRR movement: upgrade (+mrr_usd) or churn (-mrr_lost_usd)."""
    ev = with_event_date(events).filter(F.col("event_type").isin("upgrade", "churn"))
    up = F.col("event_type") == "upgrade"
    return ev.select(
        "event_id", date_key().alias("date_key"), "user_id",
        F.col("event_type").alias("movement_type"),
        F.when(up, F.col("to_plan")).otherwise(F.col("plan")).alias("plan"),
        F.when(up, F.col("mrr_usd")).otherwise(-F.col("mrr_lost_usd")).alias("mrr_delta"))


def events_by_feature_month(facts: DataFrame, dates: DataFrame, features: DataFrame) -> DataFrame:
    """year, month, feature_name, uses, users, first_seen (from the dim)."""
    f = facts.filter(F.col("feature_name").isNotNull())
    j = (f.join(dates.select("date_key", "year", "month"), "date_key")
          .join(features.select("feature_name", "first_seen"), "feature_name"))
    return j.groupBy("year", "month", "feature_name").agg(
        F.count(F.lit(1)).alias("uses"),
        F.count_distinct("user_id").alias("users"),
        F.min("first_seen").alias("first_seen"))


def events_by_feature_week(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """year, iso_week, feature_name, uses, users of the given dates.  The date
    dimension has one row a calendar day, so it is broadcast, and Spark prunes a
    fact partitioned by ``date_key`` by the broadcast keys."""
    f = facts.filter(F.col("feature_name").isNotNull()).select("date_key", "feature_name", "user_id")
    j = f.join(F.broadcast(dates.select("date_key", "year", "iso_week")), "date_key")
    return j.groupBy("year", "iso_week", "feature_name").agg(F.count(F.lit(1)).alias("uses"), F.count_distinct("user_id").alias("users"))


def mrr_by_month(mrr_facts: DataFrame, dates: DataFrame) -> DataFrame:
    """year, month, upgrades, churns, gross_new_mrr, churned_mrr, net_mrr_movement."""
    j = mrr_facts.join(dates.select("date_key", "year", "month"), "date_key")
    up = F.col("movement_type") == "upgrade"
    return j.groupBy("year", "month").agg(
        F.count(F.when(up, 1)).alias("upgrades"),
        F.count(F.when(~up, 1)).alias("churns"),
        F.round(F.sum(F.when(up, F.col("mrr_delta")).otherwise(0.0)), 2).alias("gross_new_mrr"),
        F.round(-F.sum(F.when(~up, F.col("mrr_delta")).otherwise(0.0)), 2).alias("churned_mrr"),
        F.round(F.sum("mrr_delta"), 2).alias("net_mrr_movement"))
