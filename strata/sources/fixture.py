"""Replay view: the driver's ``events`` table re-expressed as SaaS product
events (the input model of this engine).

The mapping is deterministic and uses only portable expressions, so the same
rows can be rebuilt independently in SQL for oracle checks.  It reproduces the
event contract's null pattern: anonymous page views, device/country only on
page_view, login and signup, plan not carried on upgrade, and so on.

Three shapes are produced from one mapped frame:

* :func:`saas_events`      silver-shaped flat events (what the gold layer reads)
* :func:`raw_events`       the nested contract record (``timestamp`` as text)
* :func:`broker_messages`  message-bus rows: framed JSON payload + offsets
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.functions.columns import pick
from strata.sources.tables import ROW_GROUP_BYTES

# Fixed values of the replay mapping (value domains of the event contract).
PAGES = ("/home", "/pricing", "/features", "/docs", "/blog")
REFERRERS = ("google.com", "github.com", "twitter.com", "direct")
UTM_SOURCES = ("google", "newsletter", "social", "organic")
UTM_MEDIUMS = ("cpc", "email", "referral")
UTM_CAMPAIGN = "spring_launch"
DEVICES_3 = ("mobile", "desktop", "tablet")
DEVICES_2 = ("mobile", "desktop")
COUNTRIES = ("IN", "US", "GB", "DE", "SG")
CITIES = ("Chennai", "Austin", "London", "Berlin", "Singapore City")
FEATURE_PLANS = ("free_trial", "pro", "enterprise")
PAID_PLANS = ("pro", "enterprise")
FEATURES = ("dashboard", "reports", "export", "api", "settings", "integrations")
CHURN_REASONS = ("too_expensive", "missing_features", "switching_product", "no_longer_needed")
CHURN_MRR_LOST = 49.0
LOGIN_K_BELOW = 70
TOPIC = "saas.events.raw"
FRAME_HEADER = bytes([0, 0, 0, 0, 1])   # magic byte 0 + schema id 1
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _on(et: Column, types: tuple[str, ...], value: Column) -> Column:
    return F.when(et.isin(*types), value)


def mapped(events: DataFrame) -> DataFrame:
    """Flat mapped events plus helper columns ``_eid``, ``_uid``, ``_k``."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    base = events.select(
        F.col("event_id").alias("_eid"), F.col("ts"),
        F.col("user_id").alias("_uid"), F.col("event_type").alias("_raw"),
        k.alias("_k"))
    k, uid, raw = F.col("_k"), F.col("_uid"), F.col("_raw")
    et = (F.when(raw == "view", "page_view")
           .when(raw == "click", "feature_used")
           .when(raw == "purchase", "upgrade")
           .when(raw == "signup", "signup")
           .when(raw == "error", F.when(k < LOGIN_K_BELOW, "login").otherwise("churn")))
    base = base.withColumn("event_type", et)
    et = F.col("event_type")
    ts = F.col("ts").cast("timestamp")
    day = F.col("ts").cast("date")
    to_plan = _on(et, ("upgrade",), pick(k, PAID_PLANS))
    return base.select(
        "_eid", "_uid", "_k",
        F.concat(F.lit("evt_"), F.col("_eid").cast("string")).alias("event_id"),
        et.alias("event_type"),
        ts.alias("event_timestamp"),
        F.concat(F.lit("sess_"), uid.cast("string"), F.lit("_"), day.cast("string")).alias("session_id"),
        F.when(et != "page_view", F.concat(F.lit("u_"), uid.cast("string"))).alias("user_id"),
        F.concat(F.lit("anon_"), uid.cast("string")).alias("anonymous_id"),
        _on(et, ("page_view",), pick(k, PAGES)).alias("page"),
        _on(et, ("page_view",), pick(k, REFERRERS)).alias("referrer"),
        _on(et, ("page_view",), pick(k, UTM_SOURCES)).alias("utm_source"),
        _on(et, ("page_view",), pick(k, UTM_MEDIUMS)).alias("utm_medium"),
        _on(et, ("page_view",), F.lit(UTM_CAMPAIGN)).alias("utm_campaign"),
        _on(et, ("feature_used",), pick(k, FEATURES)).alias("feature_name"),
        F.when(et.isin("page_view", "login"), pick(k, DEVICES_3))
         .when(et == "signup", pick(k, DEVICES_2)).alias("device"),
        _on(et, ("page_view", "login", "signup"), pick(uid, COUNTRIES)).alias("country"),
        _on(et, ("page_view",), pick(uid, CITIES)).alias("city"),
        F.when(et == "signup", F.lit("free_trial"))
         .when(et == "feature_used", pick(k, FEATURE_PLANS))
         .when(et == "churn", pick(k, PAID_PLANS)).alias("plan"),
        _on(et, ("upgrade",), F.when(to_plan == "pro", F.lit(schemas.PLAN_MRR_USD["pro"]))
            .otherwise(F.lit(schemas.PLAN_MRR_USD["enterprise"]))).alias("mrr_usd"),
        _on(et, ("churn",), F.lit(CHURN_MRR_LOST)).alias("mrr_lost_usd"),
        _on(et, ("upgrade",), F.lit("free_trial")).alias("from_plan"),
        to_plan.alias("to_plan"),
        _on(et, ("feature_used",),
            (F.lit(10) + (F.col("_eid") * 37) % 3591).cast("int")).alias("duration_seconds"),
        _on(et, ("churn",), pick(k, CHURN_REASONS)).alias("reason"),
        day.alias("processing_date"),
    )


CAMPAIGN_COLUMNS = ("utm_source", "utm_medium", "utm_campaign")


def saas_events(events: DataFrame, with_campaign: bool = False) -> DataFrame:
    """Silver-shaped events: the documented wide projection; ``processed_at``
    is the event time (replay).  ``with_campaign`` adds the UTM columns
    (campaign dimension input)."""
    m = mapped(events).withColumn("processed_at", F.col("event_timestamp"))
    return m.select(*schemas.SILVER_EVENT_COLUMNS, *(CAMPAIGN_COLUMNS if with_campaign else ()))


def raw_event_struct(m: Column | None = None) -> Column:
    """Nested contract record built from mapped columns."""
    props = []
    for f in schemas.EVENT_PROPERTIES.fields:
        props.append(F.col(f.name).cast(f.dataType).alias(f.name)
                     if f.name in _MAPPED_PROPS else F.lit(None).cast(f.dataType).alias(f.name))
    return F.struct(
        F.col("event_id"), F.col("event_type"),
        F.date_format("event_timestamp", ISO_MICROS).alias("timestamp"),
        F.col("session_id"), F.col("user_id"), F.col("anonymous_id"),
        F.struct(*props).alias("properties"))


_MAPPED_PROPS = {
    "page", "referrer", "utm_source", "utm_medium", "utm_campaign", "device",
    "country", "city", "plan", "feature_name", "duration_seconds", "from_plan",
    "to_plan", "mrr_usd", "reason", "mrr_lost_usd",
}


def raw_events(events: DataFrame) -> DataFrame:
    return mapped(events).select(raw_event_struct().alias("event"), "_eid", "_uid", "_k")


def payload_json(event: Column) -> Column:
    # Nulls are written explicitly so the text is a fixed function of the row.
    return F.to_json(event, {"ignoreNullFields": "false"})


def broker_messages(events: DataFrame, topic: str = TOPIC, partitions: int = 3,
                    corrupt: bool = False) -> DataFrame:
    """Message-bus rows (``key value topic partition offset timestamp
    timestampType``).  ``value`` = 5-byte frame + JSON payload.

    ``corrupt=True`` injects contract violations by the row's ``k``:
    0 → event_id NULL, 1 → event_type NULL, 2 → timestamp NULL,
    3 → payload is not JSON, 4 → unparsable timestamp text, 5 → ``mrr_usd``
    holds a word; and 6 → a blank before
    the payload, which violates nothing."""
    m = mapped(events)
    ev = raw_event_struct()
    k = F.col("_k")
    if corrupt:
        ev = (ev.withField("event_id", F.when(k == 0, F.lit(None).cast("string")).otherwise(ev["event_id"]))
                .withField("event_type", F.when(k == 1, F.lit(None).cast("string")).otherwise(ev["event_type"]))
                .withField("timestamp", F.when(k == 2, F.lit(None).cast("string"))
                           .when(k == 4, F.lit("not-a-timestamp")).otherwise(ev["timestamp"])))
    text = payload_json(ev)
    if corrupt:
        text = (F.when(k == 3, F.concat(F.lit("<<garbage "), F.col("event_id"), F.lit(">>")))
                 .when(k == 5, F.concat(F.lit('{"event_id":"'), F.col("event_id"), F.lit('","event_type":"upgrade",'
                       '"timestamp":"2024-01-01T00:00:00Z","properties":{"mrr_usd":"oops"}}')))
                 .when(k == 6, F.concat(F.lit(" "), text)).otherwise(text))
    value = F.concat(F.lit(FRAME_HEADER), text.cast("binary"))
    return m.select(
        F.col("event_id").cast("binary").alias("key"),
        value.alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("_eid") % partitions).cast("int").alias("partition"),
        F.col("_eid").cast("long").alias("offset"),
        F.col("event_timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def after_last(messages: DataFrame, again: DataFrame) -> DataFrame:
    """``again`` at offsets after the last one of ``messages``."""
    last = messages.agg(F.max("offset")).first()[0] or 0
    return again.withColumn("offset", F.col("offset") + F.lit(last + 1))


def redelivered(events: DataFrame, k_below: int = 10,
                delay: str = "1 hour", topic: str = TOPIC, partitions: int = 3) -> DataFrame:
    """Broker rows with at-least-once redelivery: every event, plus a second
    copy of events with ``k < k_below`` at a later offset and broker time."""
    first = broker_messages(events, topic, partitions)
    again_src = events.filter(F.regexp_extract("props", "[0-9]+", 0).cast("int") < k_below)
    again = (broker_messages(again_src, topic, partitions)
             .withColumn("timestamp", F.col("timestamp") + F.expr(f"INTERVAL {delay}")))
    return first.unionByName(after_last(first, again))


def write_message_files(messages: DataFrame, path: str, groups: int = 4,
                        rows_per_file: int = 500_000, first_group: int = 0,
                        last_group: int | None = None) -> list[str]:
    """Archive broker rows as Parquet files in arrival order: the offset range
    is cut into ``groups`` consecutive slices, each written by its own job
    (so file modification times follow offsets), and a slice into equal ranges
    of offsets, one file of about ``rows_per_file`` rows each.  The ranges are
    known beforehand, so that the payloads are built once and not sampled
    first.  ``first_group``/``last_group`` write a
    subset, e.g. to add data between two runs of a stream."""
    bounds = messages.agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo, hi = int(bounds["lo"]), int(bounds["hi"])
    step = (hi - lo) // groups + 1
    files = max(2, -(-bounds["n"] // (groups * rows_per_file)))
    width = -(-step // files)
    last = groups - 1 if last_group is None else last_group
    out = []
    for g in range(first_group, last + 1):
        start = lo + g * step
        part = messages.filter((F.col("offset") >= start) & (F.col("offset") < start + step))
        target = f"{path.rstrip('/')}/group={g:04d}"
        (part.repartitionById(files, F.expr(f"CAST((offset - {start}L) DIV {width}L AS INT)")).write.mode("overwrite")
         .option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(target))
        out.append(target)
    return out
