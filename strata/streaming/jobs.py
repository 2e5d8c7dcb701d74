"""Structured Streaming jobs: bronze ingest, the silver fan-out, sessions.

The silver query decodes the messages and removes duplicates by Spark's own
operators; its ``foreachBatch`` writes every output of the batch (one fan-out,
one checkpoint).  With a watermark the state is bounded
(``dropDuplicatesWithinWatermark``), and Spark drops what lies behind the
watermark: the same stream therefore also carries the arrivals, and what
arrived but is in silver neither now nor before goes to ``late``.  Without one,
``dropDuplicates`` keeps every event id and takes every event, however late.

Tables under ``root`` (plain Parquet; a batch owns its partitions, or replaces
partitions that it recomputes from such tables, so a replay after any failure
gives the same tables):

* ``events`` -- silver events, by date and batch; ``late`` likewise;
* ``plan_events`` -- signup / upgrade / churn rows, by user bucket and batch;
* ``users`` -- SCD2 histories, by user bucket and batch: the rows that a batch
  brought or changed; an event's row of the last batch counts;
* ``dlq`` -- contract violations with the error text, by batch;
* ``gold/<table>`` -- by date; touched dates are replaced;
* ``sessions`` -- from the query of :func:`start_sessions`, a streaming
  aggregate over ``events`` in update or complete mode.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from strata import schemas
from strata.operators import bronze as B
from strata.operators import silver as S
from strata.operators.merge import conform
from strata.session import DEFAULT_CONF
from strata.sinks import make_folder, merge_into, one_of, overwrite_partitions, read_current, read_folder, write_batch, write_snapshot
from strata.sources.tables import ROW_GROUP_BYTES, read_table_stream

OUTPUTS = ("events", "dlq")
USER_BUCKETS = 32
STATE_CONF = {k: v for k, v in DEFAULT_CONF.items() if k.startswith("spark.sql.streaming.stateStore.")}
STATE_WAVES = 4  # state partitions for each core of the cluster

_DLQ = T.StructType([T.StructField(n, t) for n, t in (
    ("kafka_topic", T.StringType()), ("kafka_partition", T.IntegerType()), ("kafka_offset", T.LongType()),
    ("event_id", T.StringType()), ("payload", T.StringType()), ("error", T.StringType()),
    ("ingested_at", T.TimestampType()))])
_PAGE = T.StructType([T.StructField("event_timestamp", T.TimestampType()), T.StructField("event_id", T.StringType()),
                      T.StructField("page", T.StringType())])
_PARTIALS = T.StructType([*(T.StructField(k, T.StringType()) for k in S.SESSION_KEYS),
                          T.StructField("session_start", T.TimestampType()), T.StructField("session_end", T.TimestampType()),
                          T.StructField("page_count", T.LongType()), T.StructField("entry", _PAGE),
                          T.StructField("exit", _PAGE)])
_SESSIONS = T.StructType([*_PARTIALS.fields, T.StructField("day", T.DateType())])
_USERS = T.StructType([*schemas.USERS.fields[:-1], T.StructField("change_type", T.StringType()),
                       T.StructField("event_id", T.StringType()), T.StructField("updated_at", T.TimestampType())])
_BUCKET = T.StructField("bucket", T.IntegerType())
TABLES = {"events": schemas.SILVER_EVENTS, "late": schemas.SILVER_EVENTS, "dlq": _DLQ,
          "plan_events": T.StructType([*schemas.SILVER_EVENTS.fields, _BUCKET]),
          "users": T.StructType([*_USERS.fields, _BUCKET]), "sessions": _SESSIONS, "partials": _PARTIALS}


@dataclass(frozen=True)
class SilverPaths:
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    def read(self, spark: SparkSession, name: str, before: int | None = None) -> DataFrame:
        return read_folder(spark, self.table(name), TABLES[name], before)


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def _adaptive(caller: SparkSession, write):
    """``write`` (of foreachBatch) with the caller's setting of adaptive
    execution, which Spark switches off in the session of a stateful stream.
    The batch's own plan is fixed by then.  Without it, "rebalance" does
    nothing: each shuffle partition writes a file for each date or bucket, and
    every small step after it runs as many tasks."""
    key = "spark.sql.adaptive.enabled"
    wanted = caller.conf.get(key)

    def run(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        before = conf.get(key)
        conf.set(key, wanted)
        try:
            write(batch, batch_id)
        finally:
            conf.set(key, before)
    return run


@contextmanager
def _state_settings(caller: SparkSession) -> Iterator[None]:
    """Settings under which a stream whose state grows starts; Spark copies
    them at the start, and a restart takes the provider and the number of state
    partitions from its checkpoint.

    A caller who names no state store gets RocksDB: Spark's default holds every
    id in the executors' heaps and copies all of them for each batch.  A state
    partition commits a file a batch however few its rows, and streams do not
    merge shuffle partitions, so there are at most ``STATE_WAVES`` a core."""
    conf, key = caller.conf, "spark.sql.shuffle.partitions"
    wanted = {key: str(min(int(conf.get(key)), STATE_WAVES * caller.sparkContext.defaultParallelism))}
    if conf.get("spark.sql.streaming.stateStore.providerClass", None) is None:
        wanted |= STATE_CONF
    before = {k: conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                conf.unset(k)
            else:
                conf.set(k, v)


def start_bronze(messages: DataFrame, path: str, checkpoint: str, trigger: str | None = "30 seconds",
                 ingested_at=None) -> StreamingQuery:
    """Append broker rows to the date-partitioned bronze table.  A batch writes
    a file a date (a hot one more, where Spark runs the stream adaptively), not
    one for every task and date: the silver stream takes its batches in files."""
    w = (B.to_bronze(messages, ingested_at).hint("rebalance", "processing_date").writeStream.format("parquet").queryName("bronze")
         .option("parquet.block.size", str(ROW_GROUP_BYTES)).partitionBy("processing_date").option("checkpointLocation", checkpoint).outputMode("append"))
    return _trigger(w, trigger).start(path)


# ------------------------------------------------------------------ silver

def silver_stream(bronze_stream: DataFrame, watermark: str | None = "1 hour") -> tuple[DataFrame, DataFrame]:
    """(valid silver events, each id once; dead letters) as streams.  The dead
    letters are split off before the watermark, so a malformed message moves it
    nowhere.

    With ``watermark``: ``dropDuplicatesWithinWatermark`` on the event time,
    state bounded by the delay, events behind it dropped by Spark (the query of
    :func:`start_silver` keeps them in ``late``).  With None:
    ``dropDuplicates(event_id)``; state grows with the distinct ids."""
    tagged = B.tag_contract(B.decode_payload(bronze_stream))
    return _once(_valid(tagged), watermark), B.dead_letters(tagged.filter(F.col("error").isNotNull()))


def _valid(tagged: DataFrame) -> DataFrame:
    return S.flatten_events(tagged.filter(F.col("error").isNull())).select(*schemas.SILVER_EVENT_COLUMNS)


def _once(events: DataFrame, watermark: str | None) -> DataFrame:
    if watermark is None:
        return events.dropDuplicates(["event_id"])
    return events.withWatermark("event_timestamp", watermark).dropDuplicatesWithinWatermark(["event_id"])


def _fan_in(bronze_stream: DataFrame, watermark: str | None, dead: bool = True) -> DataFrame:
    """One stream of rows ``event`` or ``dead``; ``kept`` marks the events that
    Spark's deduplication let through, the others are arrivals (all of them
    with a watermark, else none).  Counts of arrivals are observed.  Every
    branch decodes the messages, so there is one for the dead letters only if
    ``dead``."""
    tagged = B.tag_contract(B.decode_payload(bronze_stream))
    event, letter = F.struct(*schemas.SILVER_EVENT_COLUMNS), F.struct(*_DLQ.fieldNames())
    no_event, no_dead = F.lit(None).cast(schemas.SILVER_EVENTS), F.lit(None).cast(_DLQ)
    counted = tagged.observe("arrivals", F.count(F.lit(1)).alias("rows"), F.count("error").alias("dead"))
    rows = _once(_valid(counted), watermark).select(
        event.cast(schemas.SILVER_EVENTS).alias("event"), no_dead.alias("dead"), F.lit(True).alias("kept"))
    if dead:
        rows = rows.unionByName(B.dead_letters(tagged.filter(F.col("error").isNotNull())).select(
            no_event.alias("event"), letter.cast(_DLQ).alias("dead"), F.lit(False).alias("kept")))
    if watermark is not None:
        rows = rows.unionByName(_valid(tagged).select(
            event.cast(schemas.SILVER_EVENTS).alias("event"), no_dead.alias("dead"), F.lit(False).alias("kept")))
    return rows


def _late(arrived: DataFrame, kept: DataFrame, spark: SparkSession, paths: SilverPaths, batch_id: int) -> DataFrame:
    """Valid events that arrived and were not let through now nor before, each
    once.  Only what this batch did not keep (copies and late events) is looked
    up, in the stored ids of its dates."""
    rest = arrived.join(kept.select("event_id"), "event_id", "left_anti").dropDuplicates(["event_id"])
    dates = [r[0] for r in rest.select("processing_date").distinct().collect()]  # bounded by the calendar
    if not dates:
        return rest
    for name in ("events", "late"):
        stored = paths.read(spark, name, before=batch_id).filter(one_of("processing_date", dates))
        rest = rest.join(stored.select("event_id"), "event_id", "left_anti")
    return rest.select(*schemas.SILVER_EVENT_COLUMNS)


def user_bucket() -> Column:
    return F.pmod(F.xxhash64("user_id"), F.lit(USER_BUCKETS)).cast("int").alias("bucket")


def start_silver(bronze_stream: DataFrame, paths: SilverPaths, trigger: str | None = "30 seconds",
                 outputs: Sequence[str] = OUTPUTS, watermark: str | None = None,
                 gold_tables: Sequence[str] = (), upsert_users: bool = False, after=None) -> StreamingQuery:
    """Start the silver query: one decode-and-deduplicate stream for all
    ``outputs`` (events are always written; "plan_events", "dlq" if asked for).

    ``watermark`` (e.g. "1 hour"): see the module; events behind it go to
    ``late``.  ``gold_tables`` are refreshed after each batch for the dates it
    touched: late events heal the KPIs of their dates.  ``upsert_users`` keeps
    the SCD2 users table.  ``after(name, batch_id)`` is called behind each
    output (for tests: a failure between two outputs)."""
    outputs = set(outputs) | {"events"} | ({"plan_events"} if upsert_users else set())
    if "session_quality" in gold_tables:
        outputs.add("partials")
    after = after or (lambda name, batch_id: None)

    def fan_out(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # every output below reads the batch again; a task for each state partition, as Spark sends
        # it to the executor that holds the state (one for several would load their state from files)
        batch = batch.persist()
        try:
            kept = batch.filter("kept").select("event.*")
            write_batch(kept, paths.table("events"), batch_id, ["processing_date"])
            after("events", batch_id)
            if watermark is not None:
                arrived = batch.filter("NOT kept AND event IS NOT NULL").select("event.*")
                write_batch(_late(arrived, kept, spark, paths, batch_id), paths.table("late"), batch_id, ["processing_date"])
                after("late", batch_id)
            if "dlq" in outputs:
                write_batch(batch.filter("dead IS NOT NULL").select("dead.*"), paths.table("dlq"), batch_id)
                after("dlq", batch_id)
            if "partials" in outputs:
                write_batch(S.session_partials(kept), paths.table("partials"), batch_id)
                after("partials", batch_id)
            if "plan_events" in outputs:
                write_batch(S.plan_events(kept).withColumn("bucket", user_bucket()), paths.table("plan_events"), batch_id, ["bucket"])
                after("plan_events", batch_id)
            if upsert_users:
                upsert_users_scd2(spark, paths, S.plan_events(kept), batch_id)
                after("users", batch_id)
            if gold_tables:
                refresh_gold(spark, paths, kept, gold_tables)
                after("gold", batch_id)
        finally:
            batch.unpersist()

    caller = bronze_stream.sparkSession
    writer = (_fan_in(bronze_stream, watermark, "dlq" in outputs).writeStream.foreachBatch(_adaptive(caller, fan_out)).queryName("silver")
              .option("checkpointLocation", paths.checkpoint("silver")))
    with _state_settings(caller):
        return _trigger(writer, trigger).start()


def upsert_users_scd2(spark: SparkSession, paths: SilverPaths, batch_plan_events: DataFrame, batch_id: int) -> None:
    """SCD2 maintenance: of each user that a batch touched, the history from the
    row before their first new event on is rebuilt from the plan events and
    written as the batch's rows; no other row can change.  :func:`read_users`
    takes the last row written for an event.  A late plan event re-closes the
    interval it splits, and all behind it is written again."""
    place = F.struct("event_timestamp", "event_id")
    first = (batch_plan_events.filter("user_id IS NOT NULL").groupBy("user_id").agg(F.min(place).alias("_first"))
             .withColumn("bucket", user_bucket()))
    touched = [r[0] for r in first.select("bucket").distinct().collect()]
    if not touched:  # at most USER_BUCKETS values
        return
    columns = ["user_id", "event_timestamp", "event_id", "event_type", "plan", "to_plan", "country", "device"]
    stored = paths.read(spark, "plan_events").filter(F.col("bucket").isin(touched)).select(*columns).join(first.drop("bucket"), "user_id")
    again = stored.filter(place >= F.col("_first")).select(*columns)
    # the row before, with the country and device known by then
    known = [F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in ("country", "device")]
    row = [c for c in columns if c not in ("user_id", "country", "device")]
    before = (stored.filter(place < F.col("_first")).groupBy("user_id")
              .agg(F.max_by(F.struct(*row), place).alias("_row"), *known).select("user_id", "_row.*", "country", "device"))
    users = S.users_scd2(again.unionByName(before)).withColumn("bucket", user_bucket())
    write_batch(users.select(*TABLES["users"].fieldNames()), paths.table("users"), batch_id, ["bucket"])


def refresh_gold(spark: SparkSession, paths: SilverPaths, batch_events: DataFrame,
                 tables: Sequence[str] = tuple(schemas.GOLD_SCHEMAS)) -> None:
    """Recompute gold tables for the dates a batch touched, whole, and replace
    those dates' partitions of ``gold/<table>``.

    Event tables read the partitions of those dates alone.  session_quality is
    built from the partial sessions: a late event can move its session to an
    earlier day, so the dates of all partial rows of the touched sessions count
    as touched."""
    from strata.operators import gold as G
    builders = {"daily_active_users": G.daily_active_users, "funnel_metrics": G.funnel_metrics,
                "feature_adoption": G.feature_adoption, "mrr_metrics": G.mrr_metrics}
    dates = [r[0] for r in batch_events.select("processing_date").distinct().collect()]  # bounded by the calendar
    if not dates:
        return
    ev = read_events(spark, paths).filter(one_of("processing_date", dates))
    for name in tables:
        if name == "session_quality":
            partials = paths.read(spark, "partials")
            ids = batch_events.select("session_id").filter("session_id IS NOT NULL").distinct()
            moved = (partials.join(ids, "session_id", "left_semi").select(F.to_date("session_start").alias("date")).distinct())
            whole = S.sessions_of_partials(S.merge_partials(partials))
            fresh = G.session_quality(whole).join(F.broadcast(moved), "date", "left_semi")  # one row a date
        else:
            fresh = builders[name](ev)
        overwrite_partitions(conform(fresh, schemas.GOLD_SCHEMAS[name]), f"{paths.table('gold')}/{name}", ["date"])


# ------------------------------------------------------------------ sessions

def session_stream(events: DataFrame, watermark: str | None = None) -> DataFrame:
    """Sessions as a streaming aggregate over silver events.  With
    ``watermark``, one row for each session and day, whose state Spark evicts
    when the watermark has passed the day; without, one row a session (``day``
    NULL), kept in the state store for good."""
    if watermark is None:
        return S.session_partials(events).withColumn("day", F.lit(None).cast("date"))
    daily = events.withWatermark("event_timestamp", watermark)
    day = F.window("event_timestamp", "1 day").alias("window")
    return S.session_partials(daily, day).withColumn("day", F.to_date("window.start")).drop("window")


def start_sessions(spark: SparkSession, paths: SilverPaths, trigger: str | None = "30 seconds", mode: str = "update",
                   watermark: str | None = None, max_files: int | None = None) -> StreamingQuery:
    """Start the sessions query on the stream of the ``events`` table.

    ``mode="update"``: a batch brings the sessions it changed, whole, and they
    are upserted into ``sessions``, in the partitions of their days alone.
    ``mode="complete"``: a batch brings all sessions and rewrites the snapshot
    (Spark evicts no state in this mode)."""
    events = read_table_stream(spark, make_folder(spark, paths.table("events")), schemas.SILVER_EVENTS, max_files_per_trigger=max_files)
    keys = [*S.SESSION_KEYS, "day"]

    def upsert(batch: DataFrame, batch_id: int) -> None:
        merge_into(batch.sparkSession, paths.table("sessions"), batch.select(*_SESSIONS.fieldNames()), keys, partition="day")

    def replace(batch: DataFrame, batch_id: int) -> None:
        write_snapshot(batch.select(*_SESSIONS.fieldNames()), paths.table("sessions"))

    writer = (session_stream(events, watermark).writeStream.outputMode(mode).queryName("sessions")
              .foreachBatch(_adaptive(spark, upsert if mode == "update" else replace)).option("checkpointLocation", paths.checkpoint("sessions")))
    return _trigger(writer, trigger).start()


# ------------------------------------------------------------------ readers

def read_events(spark: SparkSession, paths: SilverPaths) -> DataFrame:
    return paths.read(spark, "events")


def read_late(spark: SparkSession, paths: SilverPaths) -> DataFrame:
    return paths.read(spark, "late")


def read_plan_events(spark: SparkSession, paths: SilverPaths) -> DataFrame:
    return paths.read(spark, "plan_events").drop("bucket")


def read_sessions(spark: SparkSession, paths: SilverPaths) -> DataFrame:
    """Current sessions: the rows of a session's days added up."""
    return S.sessions_of_partials(S.merge_partials(paths.read(spark, "sessions")))


def read_dlq(spark: SparkSession, paths: SilverPaths) -> DataFrame:
    return paths.read(spark, "dlq")


def read_users(spark: SparkSession, paths: SilverPaths) -> DataFrame:
    """Current histories: of each event's rows the one of the last batch."""
    names = _USERS.fieldNames()
    rows = read_folder(spark, paths.table("users"), T.StructType([*_USERS.fields, T.StructField("batch", T.IntegerType())]))
    return (rows.groupBy("user_id", "event_id").agg(F.max_by(F.struct(*names), "batch").alias("_r"))
            .select(*(F.col(f"_r.{c}").alias(c) for c in names)))


def read_gold(spark: SparkSession, paths: SilverPaths, name: str) -> DataFrame:
    return conform(read_current(spark, f"{paths.table('gold')}/{name}"), schemas.GOLD_SCHEMAS[name])


# ------------------------------------------------------------------ running and status

def run_to_completion(queries: Sequence[StreamingQuery], timeout_s: float | None = None) -> None:
    """Wait for ``availableNow`` queries.  Raises a query's failure; past
    ``timeout_s`` (default: none) it stops all queries and raises
    TimeoutError, so that no caller reads part of the output as the whole."""
    for q in queries:
        done = q.awaitTermination(timeout_s) if timeout_s is not None else (q.awaitTermination() or True)
        if q.exception() is not None:
            raise q.exception()
        if not done:
            for other in queries:
                other.stop()
            raise TimeoutError(f"streaming query {q.name or q.id} has not finished in {timeout_s} s")


class StreamStatus(StreamingQueryListener):
    """What the engine reports of the session's streaming queries: rows observed
    on arrival, rows dropped behind the watermark and rows in state, for each
    query and batch.  A query that restarts from its checkpoint keeps its id,
    and a batch counts once however often it is run."""

    def __init__(self) -> None:
        self.names: dict[str, str] = {}
        self.batches: dict[tuple[str, int], dict] = {}
        self.active: dict[str, str] = {}  # run id -> query id
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self.names[str(event.id)] = event.name
            self.active[str(event.runId)] = str(event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        arrivals = p.observedMetrics.get("arrivals")
        with self._changed:
            if p.numInputRows or arrivals:
                self.batches[str(p.id), p.batchId] = {
                    "rows": arrivals["rows"] if arrivals else p.numInputRows,
                    "dropped": sum(s.numRowsDroppedByWatermark for s in p.stateOperators)}
            self.batches.setdefault((str(p.id), -1), {})["state"] = sum(s.numRowsTotal for s in p.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self.active.pop(str(event.runId), None)
            self._changed.notify_all()

    def wait_ended(self, queries: Sequence[StreamingQuery], timeout_s: float = 60) -> None:
        """Reports arrive behind the query: wait until its end is reported."""
        runs = {str(q.runId) for q in queries}
        with self._changed:
            if not self._changed.wait_for(lambda: not runs & set(self.active), timeout_s):
                raise TimeoutError("the end of a streaming query was not reported")

    def total(self, query_id: str, what: str) -> int:
        with self._changed:
            return sum(b.get(what, 0) for (q, _), b in self.batches.items() if q == query_id)

    def status(self, spark: SparkSession) -> DataFrame:
        """query_name, is_active, total_input_rows of every query seen."""
        with self._changed:
            seen, active = dict(self.names), set(self.active.values())
        return spark.createDataFrame([(name, q in active, self.total(q, "rows")) for q, name in seen.items()],
                                     "query_name string, is_active boolean, total_input_rows long")
