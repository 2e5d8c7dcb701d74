"""Batch jobs a scheduler calls: silver -> gold -> export -> warehouse load.

Every job takes explicit paths (shared storage) and a session; none keeps
state in the driver.  The gold job writes each table once and exports by
re-reading the written snapshot, so the five KPI plans run exactly once and
the export equals what was written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas, sinks
from strata.operators import bronze as B
from strata.operators import gold, merge, silver
from strata.session import work_dir
from strata.sources.tables import read_stage


BUCKETS = 64
DERIVED = {"sessions": (silver.SESSION_KEYS, silver.sessions_by_attributes), "users": (("user_id",), silver.users_scd2)}


def _bucket(keys: Sequence[str]) -> Column:
    """The partition of a group of rows."""
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def run_silver_batch(spark: SparkSession, bronze_path: str, out: str,
                     processing_dates: tuple[str, str] | None = None) -> dict[str, str]:
    """Bronze table -> silver events (deduplicated), dead letters, sessions
    and SCD2 users.  Bronze is decoded once, into a staged copy that all
    outputs read.

    ``processing_dates`` (inclusive range of ingestion dates) reprocesses
    those bronze partitions and keeps the rest: of events, only the dates the
    range's events fall on are rewritten, from the new rows and the stored ones
    of other ingestion dates; of dead letters, the range's partitions; of
    sessions and users, which are partitioned by a hash of their keys, the
    session groups (those without a session id too) and user ids of the range's
    events and of the stored events they replace are rebuilt from all silver
    events of theirs, and only their partitions are replaced."""
    stage = work_dir(spark, "silver-stage")
    paths = {name: f"{out}/{name}" for name in ("events", "dlq", "sessions", "users")}
    b = spark.read.parquet(bronze_path)
    if processing_dates:
        b = b.filter(F.col("processing_date").between(*(F.lit(d).cast("date") for d in processing_dates)))
    tagged = B.tag_contract(B.decode_payload(b)).drop("value")
    sinks.write_snapshot(tagged, f"{stage}/decoded")
    decoded = spark.read.parquet(f"{stage}/decoded")
    dead = decoded.filter(F.col("error").isNotNull())
    sinks.overwrite_partitions(B.dead_letters(dead).withColumn("processing_date", F.to_date("ingested_at")), paths["dlq"],
                               ["processing_date"], static=not processing_dates)
    flat = silver.flatten_events(decoded.filter(F.col("error").isNull()))
    fresh = silver.dedup_events(flat, order_by=("processed_at", "kafka_partition", "kafka_offset"),
                                tiebreak=False).select(*schemas.SILVER_EVENT_COLUMNS)
    if not processing_dates:
        sinks.write_snapshot(fresh, paths["events"], ["processing_date"])
        ev = spark.read.parquet(paths["events"])
        for name, (keys, build) in DERIVED.items():
            sinks.write_snapshot(build(ev).withColumn("bucket", _bucket(keys)), paths[name], ["bucket"])
        return paths

    sinks.write_snapshot(fresh, f"{stage}/fresh")
    fresh = spark.read.parquet(f"{stage}/fresh")
    dates = fresh.select("processing_date").distinct()  # bounded by the calendar
    before = spark.read.parquet(paths["events"]).join(F.broadcast(dates), "processing_date", "left_semi").select(*fresh.columns)
    in_range = F.to_date("processed_at").between(*(F.lit(d).cast("date") for d in processing_dates))
    stored = before.filter(~in_range)
    replaced = before.filter(in_range).unionByName(stored.join(fresh.select("event_id"), "event_id", "left_semi"))
    sinks.write_snapshot(fresh.unionByName(replaced).select(*silver.SESSION_KEYS).distinct(), f"{stage}/touched")
    touched = spark.read.parquet(f"{stage}/touched")
    rebuilt = silver.dedup_events(stored.unionByName(fresh), order_by=("processed_at",))
    sinks.overwrite_partitions(rebuilt, paths["events"], ["processing_date"])
    ev = spark.read.parquet(paths["events"]).select(*schemas.SILVER_EVENT_COLUMNS)
    for name, (keys, build) in DERIVED.items():
        # ids of the touched groups' buckets: only those buckets are read, rebuilt and replaced
        ids = touched.select(*(F.col(k).alias(f"touched_{k}") for k in keys)).distinct()
        buckets = [r[0] for r in touched.select(_bucket(keys).alias("bucket")).distinct().collect()]  # at most BUCKETS
        same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"touched_{k}")) for k in keys))
        old = spark.read.parquet(paths[name]).filter(F.col("bucket").isin(buckets))
        again = build(ev.join(ids, same, "left_semi")).withColumn("bucket", _bucket(keys)).select(*old.columns)
        sinks.replace_partitions(old.join(ids, same, "left_anti").unionByName(again), paths[name], "bucket", buckets)
    return paths


def run_gold(spark: SparkSession, events: DataFrame, sessions_attr: DataFrame, gold_root: str,
             export_root: str | None = None) -> dict[str, str]:
    """Write the five gold tables once; optionally export them as plain
    Parquet from the written snapshots."""
    tables = gold.build_gold(events, sessions_attr)
    written = {name: sinks.write_snapshot(df, f"{gold_root}/{name}") for name, df in tables.items()}
    if export_root:
        sinks.export_tables({n: spark.read.parquet(p) for n, p in written.items()}, export_root)
    return written


def load_warehouse(spark: SparkSession, stages: Mapping[str, str], warehouse_root: str,
                   stamp_updated_at: bool = False) -> dict[str, DataFrame]:
    """Typed stage scan of each exported table and keyed MERGE into the
    warehouse table, in the date partitions it touches (partial update columns
    per table).

    ``stamp_updated_at`` adds the warehouse's ``updated_at`` column: the load
    time on every row the MERGE inserts or updates; untouched rows keep
    theirs."""
    out = {}
    for name, stage in stages.items():
        schema = schemas.GOLD_SCHEMAS[name]
        src = merge.conform(read_stage(spark, stage, schema), schema)
        update = list(schemas.GOLD_UPDATE_COLUMNS[name])
        if stamp_updated_at:
            src = src.withColumn("updated_at", F.current_timestamp())
            update.append("updated_at")
        out[name] = sinks.merge_into(spark, f"{warehouse_root}/{name}", src,
                                     schemas.GOLD_KEYS[name], update)
    return out
