"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the given tables (``events`` through the replay view) and
runs over all of it; oracle SQL for each lives in :mod:`strata.plans.oracles`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import asof, bitmaps, bronze, checks, gold, kpi, merge, silver, star
from strata import sinks
from strata.functions import columns
from strata.plans import jobs
from strata.session import configure, work_dir
from strata.sources.tables import read_event_stream, read_stage, read_table_stream, stage_files
from strata.streaming.jobs import (
    SilverPaths,
    read_dlq,
    read_events,
    read_gold,
    read_late,
    read_plan_events,
    read_sessions,
    read_users,
    run_to_completion,
    start_bronze,
    start_sessions,
    start_silver,
    StreamStatus,
)
from strata.sources import fixture
from strata.sources.fixture import saas_events
from strata.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    """Register ``fn`` under ``name``; the registered callable first applies
    the engine's required session settings (the caller may bring its own
    session)."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver event table of a fixture directory (replay view)."""
    configure(spark)
    return saas_events(read_table(spark, sf_dir, "events"))


# ------------------------------------------------------------------ gold
@query("daily_active_users")
def q_daily_active_users(spark, sf_dir):
    return gold.daily_active_users(silver_events(spark, sf_dir))


@query("funnel_metrics")
def q_funnel_metrics(spark, sf_dir):
    return gold.funnel_metrics(silver_events(spark, sf_dir))


@query("feature_adoption")
def q_feature_adoption(spark, sf_dir):
    return gold.feature_adoption(silver_events(spark, sf_dir))


@query("mrr_metrics")
def q_mrr_metrics(spark, sf_dir):
    return gold.mrr_metrics(silver_events(spark, sf_dir))


@query("session_quality")
def q_session_quality(spark, sf_dir):
    return gold.session_quality(silver.sessions_by_attributes(silver_events(spark, sf_dir)))


# ------------------------------------------------------------------ bronze / contract
def _bronze(spark, sf_dir, corrupt=False):
    """Replay the fixture through the message path; ingestion time = broker time."""
    msgs = fixture.broker_messages(read_table(spark, sf_dir, "events"), corrupt=corrupt)
    return bronze.to_bronze(msgs, ingested_at=F.col("timestamp"))


@query("bronze_events")
def q_bronze_events(spark, sf_dir):
    """Bronze layout; the binary payload is shown as hex text."""
    b = _bronze(spark, sf_dir)
    return b.select(F.hex("value").alias("value_hex"), "ingested_at", "kafka_offset",
                    "kafka_partition", "kafka_topic", "processing_date")


@query("dlq_events")
def q_dlq_events(spark, sf_dir):
    _, rejected = bronze.split_contract(bronze.decode_payload(_bronze(spark, sf_dir, corrupt=True)))
    return bronze.dead_letters(rejected)


@query("contract_valid_events")
def q_contract_valid_events(spark, sf_dir):
    valid, _ = bronze.split_contract(bronze.decode_payload(_bronze(spark, sf_dir, corrupt=True)))
    return silver.flatten_events(valid).select(*schemas.SILVER_EVENT_COLUMNS)


# ------------------------------------------------------------------ silver
@query("silver_events")
def q_silver_events(spark, sf_dir):
    """Full path: messages -> bronze -> decode -> contract -> flatten -> dedup."""
    valid, _ = bronze.split_contract(bronze.decode_payload(_bronze(spark, sf_dir)))
    flat = silver.flatten_events(valid)
    first = silver.dedup_events(flat, order_by=("processed_at", "kafka_partition", "kafka_offset"),
                                tiebreak=False)
    return first.select(*schemas.SILVER_EVENT_COLUMNS)


@query("silver_events_dedup")
def q_silver_events_dedup(spark, sf_dir):
    """At-least-once redelivery: the earliest-ingested copy of each event survives."""
    msgs = fixture.redelivered(read_table(spark, sf_dir, "events"))
    b = bronze.to_bronze(msgs, ingested_at=F.col("timestamp"))
    valid, _ = bronze.split_contract(bronze.decode_payload(b))
    flat = silver.flatten_events(valid)
    first = silver.dedup_events(flat, order_by=("processed_at", "kafka_partition", "kafka_offset"),
                                tiebreak=False)
    return first.drop("kafka_partition")


@query("silver_time_bounds")
def q_silver_time_bounds(spark, sf_dir):
    ev = silver_events(spark, sf_dir)
    return ev.agg(F.count(F.lit(1)).alias("total_records"),
                  F.min("event_timestamp").alias("min_event_timestamp"),
                  F.max("event_timestamp").alias("max_event_timestamp"),
                  F.min("processing_date").alias("min_processing_date"),
                  F.max("processing_date").alias("max_processing_date"))


@query("sessions_by_attributes")
def q_sessions_by_attributes(spark, sf_dir):
    return silver.sessions_by_attributes(silver_events(spark, sf_dir))


@query("sessions")
def q_sessions(spark, sf_dir):
    return silver.sessions(silver_events(spark, sf_dir))


@query("users_plan_events")
def q_users_plan_events(spark, sf_dir):
    # updated_at is the load time: left out of the comparable output.
    return silver.users_plan_events(silver_events(spark, sf_dir)).drop("updated_at")


@query("user_signups")
def q_user_signups(spark, sf_dir):
    return silver.user_signups(silver_events(spark, sf_dir))


@query("users_scd2")
def q_users_scd2(spark, sf_dir):
    return silver.users_scd2(silver_events(spark, sf_dir)).drop("updated_at")


@query("users_current")
def q_users_current(spark, sf_dir):
    return silver.users_current(silver.users_scd2(silver_events(spark, sf_dir))).drop("updated_at")


@query("events_with_plan_asof")
def q_events_with_plan_asof(spark, sf_dir):
    ev = silver_events(spark, sf_dir)
    return asof.plan_asof(ev, silver.user_versions(ev))


@query("feature_plan_breakdown")
def q_feature_plan_breakdown(spark, sf_dir):
    return gold.feature_plan_breakdown(silver_events(spark, sf_dir))


@query("session_country_breakdown")
def q_session_country_breakdown(spark, sf_dir):
    return gold.session_country_breakdown(silver.sessions_by_attributes(silver_events(spark, sf_dir)))


def _gold(spark, sf_dir) -> dict[str, DataFrame]:
    ev = silver_events(spark, sf_dir)
    return gold.build_gold(ev, silver.sessions_by_attributes(ev))


# ------------------------------------------------------------------ KPI trends
@query("rolling_wau_mau")
def q_rolling_wau_mau(spark, sf_dir):
    return kpi.rolling_actives(silver_events(spark, sf_dir), (7, 30))


def late_day_bitmaps(spark, root, late, numbers):
    """Stored bitmaps of the late events' dates, with the late users added:
    those dates' partitions are read and replaced, and no other."""
    fresh = bitmaps.day_bitmaps(late, numbers)
    dates = [r[0] for r in fresh.select("date").distinct().collect()]  # bounded by the calendar
    stored = spark.read.parquet(f"{root}/bitmaps").select("date", "block", "bitmap").filter(sinks.one_of("date", dates))
    return bitmaps.merge_bitmaps(stored, fresh)


@query("rolling_wau_mau_late_day")
def q_rolling_wau_mau_late_day(spark, sf_dir):
    """Rolling actives from stored user bitmaps: the events of day 12 with
    k >= 60 arrive after all others; only that day's bitmaps are written again,
    and users not seen before get the next numbers."""
    root = work_dir(spark, "bitmaps")
    raw = read_table(spark, sf_dir, "events")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    held = (F.dayofmonth(F.col("ts").cast("timestamp")) == 12) & (k >= 60)
    on_time, late = saas_events(raw.filter(~held)), saas_events(raw.filter(held))
    sinks.write_snapshot(bitmaps.number_users(on_time), f"{root}/users/load=0")
    known = spark.read.parquet(f"{root}/users/load=0")
    sinks.overwrite_partitions(bitmaps.day_bitmaps(on_time, known), f"{root}/bitmaps", ["date"])
    sinks.write_snapshot(bitmaps.number_users(late, known), f"{root}/users/load=1")
    numbers = spark.read.parquet(f"{root}/users")
    sinks.overwrite_partitions(late_day_bitmaps(spark, root, late, numbers), f"{root}/bitmaps", ["date"])
    return bitmaps.window_actives(spark.read.parquet(f"{root}/bitmaps"), (7, 30))


@query("dau_growth")
def q_dau_growth(spark, sf_dir):
    return kpi.dau_growth(gold.daily_active_users(silver_events(spark, sf_dir)))


@query("mrr_cumulative")
def q_mrr_cumulative(spark, sf_dir):
    return kpi.mrr_cumulative(gold.mrr_metrics(silver_events(spark, sf_dir)))


@query("top_countries_by_date")
def q_top_countries_by_date(spark, sf_dir):
    return kpi.top_countries(silver.sessions_by_attributes(silver_events(spark, sf_dir)), 3)


@query("mrr_trend_30d")
def q_mrr_trend_30d(spark, sf_dir):
    return kpi.mrr_trend(gold.mrr_metrics(silver_events(spark, sf_dir)), 30)


@query("dau_mau_trend")
def q_dau_mau_trend(spark, sf_dir):
    return kpi.dau_mau_trend(gold.daily_active_users(silver_events(spark, sf_dir)), 30)


@query("top_features")
def q_top_features(spark, sf_dir):
    return kpi.top_features(gold.feature_adoption(silver_events(spark, sf_dir)))


@query("gold_preview")
def q_gold_preview(spark, sf_dir):
    """Newest 5 rows of each gold table, as (table_name, date, row JSON)."""
    frames = []
    for name, df in _gold(spark, sf_dir).items():
        tie = ["feature_name"] if name == "feature_adoption" else []
        top = kpi.preview(df, 5, tiebreak=tie)
        frames.append(top.select(F.lit(name).alias("table_name"), "date",
                                 F.to_json(F.struct(*[c for c in df.columns if c != "date"])).alias("row_json")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ------------------------------------------------------------------ health checks
@query("check_row_counts")
def q_check_row_counts(spark, sf_dir):
    return checks.check_row_counts(_gold(spark, sf_dir))


@query("check_duplicates")
def q_check_duplicates(spark, sf_dir):
    return checks.check_duplicates(_gold(spark, sf_dir), schemas.GOLD_KEYS)


@query("check_latest_date")
def q_check_latest_date(spark, sf_dir):
    return checks.check_latest_date(_gold(spark, sf_dir))


# ------------------------------------------------------------------ warehouse load
@query("conform_gold_dau")
def q_conform_gold_dau(spark, sf_dir):
    return merge.conform(gold.daily_active_users(silver_events(spark, sf_dir)), schemas.GOLD_DAU)


# (table, changed column, change) for the merge fixture: target = days 1-20,
# source = days 11-30 with day 15 changed; mrr target rows carry a plan value
# that the partial-update MERGE must keep.
MERGE_CHANGES = {
    "daily_active_users": ("dau_count", lambda c: c + 1000),
    "mrr_metrics": ("new_mrr", lambda c: c + 1000.0),
    "funnel_metrics": ("signups", lambda c: c + 1000),
    "feature_adoption": ("total_uses", lambda c: c + 1000),
    "session_quality": ("bounce_rate", lambda c: c + 1.0),
}


def merge_fixture(table: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    schema = schemas.GOLD_SCHEMAS[name]
    g = merge.conform(table, schema)
    day = F.dayofmonth("date")
    target = g.filter(day <= 20)
    if name == "mrr_metrics":
        target = target.withColumn("plan", F.lit("legacy")).withColumn("mrr_usd", F.lit(1.0))
    col, fn = MERGE_CHANGES[name]
    source = g.filter(day >= 11).withColumn(
        col, F.when(day == 15, fn(F.col(col))).otherwise(F.col(col)).cast(schema[col].dataType))
    return target, source


def _merge_query(name):
    def run(spark, sf_dir):
        target, source = merge_fixture(_gold(spark, sf_dir)[name], name)
        return merge.merge_upsert(target, source, schemas.GOLD_KEYS[name],
                                  schemas.GOLD_UPDATE_COLUMNS[name])
    return run


for _name, _qid in [("daily_active_users", "merge_upsert_dau"), ("mrr_metrics", "merge_upsert_mrr"),
                    ("funnel_metrics", "merge_upsert_funnel"),
                    ("feature_adoption", "merge_upsert_feature"),
                    ("session_quality", "merge_upsert_session")]:
    query(_qid)(_merge_query(_name))


@query("late_data_rerun")
def q_late_data_rerun(spark, sf_dir):
    """Gold built before late events arrived (those of the first three days
    with k >= 90 held back), then only the dates the late batch touches are
    recomputed and upserted."""
    raw = read_table(spark, sf_dir, "events")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    held = (F.dayofmonth(F.col("ts").cast("timestamp")) <= 3) & (k >= 90)
    on_time = saas_events(raw.filter(~held))
    late = saas_events(raw.filter(held))
    everything = saas_events(raw)
    before = merge.conform(gold.daily_active_users(on_time), schemas.GOLD_DAU)
    return gold.rerun_touched_dates(everything, late, gold.daily_active_users, before,
                                    ["date"], schemas.GOLD_UPDATE_COLUMNS["daily_active_users"],
                                    schemas.GOLD_DAU)


@query("plan_breakdown_extract")
def q_plan_breakdown_extract(spark, sf_dir):
    """JSON plan map -> VARIANT -> typed per-plan columns."""
    fa = gold.feature_adoption(silver_events(spark, sf_dir))
    v = F.parse_json("plan_breakdown")
    return fa.select("date", "feature_name",
                     *[F.variant_get(v, f"$.{p}", "bigint").alias(f"{p}_uses") for p in schemas.PLANS])


@query("plan_breakdown_rows")
def q_plan_breakdown_rows(spark, sf_dir):
    """JSON plan map -> VARIANT -> one row a plan, whatever plans there are."""
    fa = gold.feature_adoption(silver_events(spark, sf_dir)).select("date", "feature_name", F.parse_json("plan_breakdown").alias("plans"))
    return columns.variant_rows(fa, "plans", "plan", "uses", "bigint")


@query("plan_breakdown_schema")
def q_plan_breakdown_schema(spark, sf_dir):
    """The common schema of each feature's plan maps, found in the data."""
    fa = gold.feature_adoption(silver_events(spark, sf_dir))
    return fa.groupBy("feature_name").agg(F.schema_of_variant_agg(F.parse_json("plan_breakdown")).alias("schema"))


# ------------------------------------------------------------------ star schema
def _wide(spark, sf_dir):
    configure(spark)
    return saas_events(read_table(spark, sf_dir, "events"), with_campaign=True)


@query("dim_date")
def q_dim_date(spark, sf_dir):
    return star.dim_date(silver_events(spark, sf_dir))


@query("dim_users")
def q_dim_users(spark, sf_dir):
    return star.dim_users(silver.users_scd2(silver_events(spark, sf_dir)))


@query("dim_features")
def q_dim_features(spark, sf_dir):
    return star.dim_features(silver_events(spark, sf_dir))


@query("dim_campaigns")
def q_dim_campaigns(spark, sf_dir):
    return star.dim_campaigns(_wide(spark, sf_dir))


@query("fact_events")
def q_fact_events(spark, sf_dir):
    ev = _wide(spark, sf_dir)
    return star.fact_events(ev, silver.user_versions(ev))


@query("fact_sessions")
def q_fact_sessions(spark, sf_dir):
    return star.fact_sessions(silver.sessions(silver_events(spark, sf_dir)))


@query("fact_mrr")
def q_fact_mrr(spark, sf_dir):
    return star.fact_mrr(silver_events(spark, sf_dir))


@query("star_events_by_feature")
def q_star_events_by_feature(spark, sf_dir):
    ev = _wide(spark, sf_dir)
    return star.events_by_feature_month(star.event_facts(ev), star.dim_date(ev), star.dim_features(ev))


def events_by_date_key(spark, sf_dir):
    """The event fact as a table partitioned by ``date_key``, and its date dimension."""
    ev = _wide(spark, sf_dir)
    root = work_dir(spark, "star")
    sinks.write_snapshot(star.event_facts(ev), f"{root}/fact", ["date_key"])
    sinks.write_snapshot(star.dim_date(ev), f"{root}/dim_date")
    return spark.read.parquet(f"{root}/fact"), spark.read.parquet(f"{root}/dim_date"), ev


@query("star_events_of_weeks")
def q_star_events_of_weeks(spark, sf_dir):
    """Feature use in the second and third week: the filter on the date
    dimension prunes the fact's partitions at run time."""
    facts, dates, _ = events_by_date_key(spark, sf_dir)
    return star.events_by_feature_week(facts, dates.filter(F.col("iso_week").isin(2, 3)))


@query("star_mrr_by_month")
def q_star_mrr_by_month(spark, sf_dir):
    ev = silver_events(spark, sf_dir)
    return star.mrr_by_month(star.fact_mrr(ev), star.dim_date(ev))


# ------------------------------------------------------------------ dashboards
@query("dashboard_new_vs_returning")
def q_dashboard_new_vs_returning(spark, sf_dir):
    return kpi.new_vs_returning(gold.daily_active_users(silver_events(spark, sf_dir)))


@query("dashboard_plan_tiers")
def q_dashboard_plan_tiers(spark, sf_dir):
    return kpi.plan_tiers(gold.feature_plan_breakdown(silver_events(spark, sf_dir)))


@query("dashboard_device_split")
def q_dashboard_device_split(spark, sf_dir):
    ev = silver_events(spark, sf_dir)
    return kpi.device_split(gold.session_quality(silver.sessions_by_attributes(ev)))


@query("session_quality_per_session")
def q_session_quality_per_session(spark, sf_dir):
    return gold.session_quality(silver.sessions(silver_events(spark, sf_dir)))


# ------------------------------------------------------------------ sinks / stage round trips
@query("gold_overwrite_roundtrip")
def q_gold_overwrite_roundtrip(spark, sf_dir):
    """Overwrite replaces data and schema: a stale, wider snapshot is
    replaced by the current DAU table."""
    path = work_dir(spark, "gold_overwrite") + "/daily_active_users"
    dau = gold.daily_active_users(silver_events(spark, sf_dir))
    sinks.write_snapshot(dau.withColumn("stale_col", F.lit(1)).filter(F.dayofmonth("date") < 5), path)
    sinks.write_snapshot(dau, path)
    return spark.read.parquet(path)


def _export(spark, sf_dir, name):
    base = work_dir(spark, name)
    sinks.export_tables(_gold(spark, sf_dir), base)
    return base


@query("gold_export_roundtrip")
def q_gold_export_roundtrip(spark, sf_dir):
    base = _export(spark, sf_dir, "gold_export")
    return spark.read.parquet(f"{base}/feature_adoption/")


@query("stage_typed_scan")
def q_stage_typed_scan(spark, sf_dir):
    """Typed warehouse scan of the exported mrr table: INT counts, and the
    warehouse-only ``plan`` / ``mrr_usd`` columns as typed NULLs."""
    base = _export(spark, sf_dir, "gold_stage")
    return read_stage(spark, f"{base}/mrr_metrics/", schemas.GOLD_MRR, "*.parquet")


@query("stage_files")
def q_stage_files(spark, sf_dir):
    """Staged files, summed up by stage (their names are Spark's)."""
    base = _export(spark, sf_dir, "gold_stage_list")
    files = stage_files(spark, {n: f"{base}/{n}/" for n in schemas.GOLD_SCHEMAS})
    return files.groupBy("stage").agg(F.sum("row_count").alias("row_count"), F.min(F.col("file_size") > 0).alias("sized"))


@query("schema_evolution_union")
def q_schema_evolution_union(spark, sf_dir):
    """Additive evolution on write: early files lack ``duration_seconds``,
    later ones carry it; a merged-schema read returns both."""
    path = work_dir(spark, "evolution") + "/events"
    ev = silver_events(spark, sf_dir)
    early = ev.filter(F.dayofmonth("processing_date") <= 15).drop("duration_seconds")
    late = ev.filter(F.dayofmonth("processing_date") > 15)
    early.write.mode("append").parquet(path)
    late.write.mode("append").parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path).select(*schemas.SILVER_EVENT_COLUMNS)


# ------------------------------------------------------------------ streaming
def _stream_silver(spark, sf_dir, name, runs=((0, 3),), messages=None, via_bronze_table=False, sessions=None, **options):
    """Message files -> silver, in one or more runs; ``sessions`` are options
    of the sessions query, which follows each run."""
    root = work_dir(spark, name)
    # dealt out, as building the messages costs far more than reading a small file's few row groups
    raw = read_table(spark, sf_dir, "events").repartition(2 * spark.sparkContext.defaultParallelism, "event_id", "ts")
    msgs = messages(raw) if messages else fixture.broker_messages(raw)
    paths = SilverPaths(f"{root}/silver")
    queries = []
    for first, last in runs:
        fixture.write_message_files(msgs, f"{root}/messages", groups=4,
                                    first_group=first, last_group=last)
        stream = read_event_stream(spark, "parquet", {"maxFilesPerTrigger": "2"},
                                   path=f"{root}/messages/*")
        if via_bronze_table:
            # message stream -> bronze table (append, date-partitioned) ->
            # table stream -> silver
            run_to_completion([start_bronze(stream, paths.bronze, paths.checkpoint("bronze"), "availableNow",
                                            ingested_at=F.col("timestamp"))])
            b = read_table_stream(spark, paths.bronze, schemas.BRONZE, max_files_per_trigger=8)
        else:
            b = bronze.to_bronze(stream, ingested_at=F.col("timestamp"))
        q = start_silver(b, paths, trigger="availableNow", **options)
        run_to_completion([q])
        queries.append(q)
        if sessions is not None:
            run_to_completion([start_sessions(spark, paths, "availableNow", **sessions)])
    return paths, queries


@query("stream_silver_events")
def q_stream_silver_events(spark, sf_dir):
    paths, _ = _stream_silver(spark, sf_dir, "stream_silver")
    return read_events(spark, paths)


@query("stream_sessions")
def q_stream_sessions(spark, sf_dir):
    """A streaming aggregate in update mode over two runs; a day's sessions
    leave the state store when the watermark has passed the day."""
    paths, _ = _stream_silver(spark, sf_dir, "stream_sessions", runs=((0, 1), (2, 3)), outputs=("events",),
                              watermark="1 hour", sessions={"watermark": "1 hour"})
    return read_sessions(spark, paths)


@query("stream_users_scd2")
def q_stream_users_scd2(spark, sf_dir):
    paths, _ = _stream_silver(spark, sf_dir, "stream_users", outputs=("plan_events",))
    return silver.users_scd2(read_plan_events(spark, paths)).drop("updated_at")


@query("stream_restart_exactly_once")
def q_stream_restart_exactly_once(spark, sf_dir):
    """First run sees half of the message files; after more files arrive the
    same query restarts from its checkpoint: every event exactly once."""
    paths, _ = _stream_silver(spark, sf_dir, "stream_restart", runs=((0, 1), (2, 3)), outputs=("events",))
    return read_events(spark, paths)


@query("stream_health")
def q_stream_health(spark, sf_dir):
    """Status of the query and its input rows over two runs, as the engine
    reports them to a listener."""
    status = StreamStatus()
    spark.streams.addListener(status)
    try:
        _, queries = _stream_silver(spark, sf_dir, "stream_health", runs=((0, 1), (2, 3)), outputs=("events",))
        status.wait_ended(queries)
    finally:
        spark.streams.removeListener(status)
    return status.status(spark)


@query("stream_dedup_redelivery")
def q_stream_dedup_redelivery(spark, sf_dir):
    """At-least-once delivery: re-sent copies arrive in later files and
    micro-batches and are recognised by Spark's deduplication state."""
    paths, _ = _stream_silver(spark, sf_dir, "stream_redelivery", outputs=("events",),
                              messages=lambda raw: fixture.redelivered(raw))
    return read_events(spark, paths)


@query("stream_dlq_events")
def q_stream_dlq_events(spark, sf_dir):
    """Contract violations routed to the dead-letter sink by the stream."""
    paths, _ = _stream_silver(spark, sf_dir, "stream_dlq", outputs=("dlq",),
                              messages=lambda raw: fixture.broker_messages(raw, corrupt=True))
    return read_dlq(spark, paths)


@query("stream_bronze_to_silver")
def q_stream_bronze_to_silver(spark, sf_dir):
    """Bronze append stream into a date-partitioned table, then silver
    streaming from that table (the medallion hop)."""
    paths, _ = _stream_silver(spark, sf_dir, "stream_medallion", via_bronze_table=True, outputs=("events",))
    return read_events(spark, paths)


@query("stream_sessions_complete")
def q_stream_sessions_complete(spark, sf_dir):
    """Sessions in complete output mode: each batch rewrites the snapshot."""
    paths, _ = _stream_silver(spark, sf_dir, "stream_sessions_complete", runs=((0, 1), (2, 3)), outputs=("events",),
                              sessions={"mode": "complete"})
    return read_sessions(spark, paths)


def _backfill_last(raw):
    """Messages with bad ones among them, the early days' events with k >= 90
    held back to the end, and some sent again."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    held = (F.dayofmonth(F.col("ts").cast("timestamp")) <= 3) & (k >= 90)
    first = fixture.broker_messages(raw.filter(~held), corrupt=True)
    first = first.unionByName(fixture.after_last(first, fixture.broker_messages(raw.filter(held))))
    again = fixture.broker_messages(raw.filter(F.col("event_id") % 11 == 0).filter(k > 6))
    return first.unionByName(fixture.after_last(first, again))


@query("stream_dedup_watermark")
def q_stream_dedup_watermark(spark, sf_dir):
    """Spark's deduplication within a one-hour watermark, under bad messages,
    backfill and redelivery: silver and the late output together hold every
    valid event once."""
    paths, _ = _stream_silver(spark, sf_dir, "stream_dedup_wm", watermark="1 hour", outputs=("events",),
                              messages=_backfill_last)
    late = read_late(spark, paths).drop("processed_at")
    return read_events(spark, paths).drop("processed_at").unionByName(late)


@query("stream_gold_self_healing")
def q_stream_gold_self_healing(spark, sf_dir):
    """Late data heals gold: events of the first days with k >= 90 arrive in
    a last, late file; each micro-batch refreshes all five tables for the dates
    it touched, so their row counts and sums equal those over all events."""
    def late_last(raw):
        k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
        late = (F.dayofmonth(F.col("ts").cast("timestamp")) <= 3) & (k >= 90)
        on_time = fixture.broker_messages(raw.filter(~late))
        return on_time.unionByName(fixture.after_last(on_time, fixture.broker_messages(raw.filter(late))))
    paths, _ = _stream_silver(spark, sf_dir, "stream_gold_heal", messages=late_last, outputs=("events",),
                              gold_tables=tuple(schemas.GOLD_SCHEMAS))
    measure = {"daily_active_users": "dau_count", "mrr_metrics": "net_mrr", "funnel_metrics": "unique_visitors",
               "feature_adoption": "unique_users", "session_quality": "avg_session_duration_secs"}
    frames = [read_gold(spark, paths, name).select(
        F.lit(name).alias("table_name"), "date", F.col("feature_name" if name == "feature_adoption" else "date")
        .cast("string").alias("key"), F.col(col).cast("double").alias("value")) for name, col in measure.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query("stream_users_scd2_upsert")
def q_stream_users_scd2_upsert(spark, sf_dir):
    """SCD2 maintained per micro-batch: touched users' histories rebuilt and
    replaced by bucket, across a restart with more data."""
    paths, _ = _stream_silver(spark, sf_dir, "stream_users_upsert", runs=((0, 1), (2, 3)),
                              outputs=("events",), upsert_users=True)
    return read_users(spark, paths).drop("updated_at")


# ------------------------------------------------------------------ incremental batch
@query("batch_silver_reprocess")
def q_batch_silver_reprocess(spark, sf_dir):
    """Full batch run over bronze that lacks a third of the first day's rows
    and has another third of them under other users and sessions; then that day
    is corrected and run again alone: all equals a full run.
    Returns (part, key, n, total) over events, sessions and users read back."""
    root = work_dir(spark, "batch_reprocess")
    right = _bronze(spark, sf_dir)
    day = right.agg(F.min("processing_date")).first()[0]
    text = F.expr("decode(substring(value, 6), 'UTF-8')")
    wrong = F.regexp_replace(F.regexp_replace(text, '"user_id":"u_', '"user_id":"u_9'), '"session_id":"sess_', '"session_id":"sess_9')
    first_day, third = F.col("processing_date") == F.lit(day), F.col("kafka_offset") % 3
    before = right.filter(~first_day | (third != 0)).withColumn("value", F.when(
        first_day & (third == 1), F.concat(F.expr("substring(value, 1, 5)"), wrong.cast("binary"))).otherwise(F.col("value")))
    sinks.write_snapshot(before, f"{root}/bronze", ["processing_date"])
    jobs.run_silver_batch(spark, f"{root}/bronze", f"{root}/silver")
    sinks.overwrite_partitions(right.filter(first_day), f"{root}/bronze", ["processing_date"])
    paths = jobs.run_silver_batch(spark, f"{root}/bronze", f"{root}/silver", (str(day), str(day)))
    events, sess, users = (spark.read.parquet(paths[n]) for n in ("events", "sessions", "users"))
    return (events.select(F.lit("event").alias("part"), F.col("event_id").alias("key"), F.lit(1).cast("long").alias("n"),
                          F.unix_timestamp("event_timestamp").alias("total"))
            .unionByName(sess.groupBy(F.lit("session").alias("part"), F.col("session_id").alias("key")).agg(
                F.count(F.lit(1)).alias("n"), F.sum("page_count").alias("total")))
            .unionByName(users.groupBy(F.lit("user").alias("part"), F.col("user_id").alias("key")).agg(
                F.count(F.lit(1)).alias("n"), F.sum(F.unix_timestamp(F.coalesce("valid_to", "valid_from"))).alias("total"))))


@query("merge_upsert_evolve")
def q_merge_upsert_evolve(spark, sf_dir):
    """Additive evolution through the keyed load: the source brings a column
    the target lacks; first and second load take one path."""
    base = work_dir(spark, "evolve") + "/dau"
    g = merge.conform(gold.daily_active_users(silver_events(spark, sf_dir)), schemas.GOLD_DAU)
    day = F.dayofmonth("date")
    sinks.merge_into(spark, base, g.filter(day <= 20), ["date"])
    return sinks.merge_into(spark, base, g.filter(day >= 11).withColumn("region", F.concat(F.lit("r"), day.cast("string"))), ["date"],
                            schemas.GOLD_UPDATE_COLUMNS["daily_active_users"])
