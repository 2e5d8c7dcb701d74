"""Dirty input: empty denominators, late events in a stream."""

import datetime

import pytest
from pyspark.sql import functions as F

from strata.operators import bronze as B
from strata.operators import gold, merge, silver
from strata.plans.catalog import silver_events
from strata.session import work_dir
from strata.sources import fixture
from strata.sinks import make_folder
from strata.sources.fixture import saas_events
from strata.sources.tables import read_event_stream
from strata import schemas
from strata.streaming import (SilverPaths, StreamStatus, read_dlq, read_events, read_gold, read_late, read_plan_events, read_sessions,
                              read_users, run_to_completion, start_bronze, start_sessions, start_silver)
from strata.streaming import jobs
from strata.streaming.jobs import _fan_in

from .conftest import SF_SMALL


def test_empty_denominator_day_guards(spark):
    ev = silver_events(spark, SF_SMALL)
    day = F.dayofmonth("event_timestamp") == 7
    sparse = ev.filter(~(day & F.col("event_type").isin("page_view", "signup", "upgrade")))
    f = {r.date.day: r for r in gold.funnel_metrics(sparse).collect()}[7]
    assert f.unique_visitors == 0 and f.signups == 0 and f.upgrades == 0
    assert f.visitor_to_signup_rate == 0.0 and f.signup_to_activation_rate == 0.0
    assert f.upgrade_to_churn_rate == 0.0
    m = {r.date.day: r for r in gold.mrr_metrics(sparse).collect()}[7]
    assert m.new_mrr == 0.0 and m.expansion_mrr == 0.0 and m.pro_users == 0
    assert m.net_mrr == -m.churned_mrr
    d = {r.date.day: r for r in gold.daily_active_users(sparse).collect()}[7]
    assert d.new_users == 0 and d.returning_users == d.dau_count


def _late_split(spark):
    raw = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    late = (F.dayofmonth(F.col("ts").cast("timestamp")) <= 3) & (k >= 90)
    on_time = fixture.broker_messages(raw.filter(~late))
    return raw, on_time, fixture.after_last(on_time, fixture.broker_messages(raw.filter(late))), raw.filter(late).count()


def _run(spark, root, paths, sessions=None, **options):
    stream = read_event_stream(spark, "parquet", {"maxFilesPerTrigger": "2"}, path=f"{root}/messages/*/*")
    q = start_silver(B.to_bronze(stream, F.col("timestamp")), paths, trigger="availableNow", **options)
    run_to_completion([q])
    if sessions is not None:
        run_to_completion([start_sessions(spark, paths, "availableNow", **sessions)])
    return q


def _rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_late_file_is_exact_without_a_watermark(spark):
    """A file of old events after newer ones: events, sessions and users equal
    those of a batch run over all events."""
    root = work_dir(spark, "late")
    raw, on_time, late, _ = _late_split(spark)
    paths = SilverPaths(f"{root}/silver")
    fixture.write_message_files(on_time, f"{root}/messages/a", groups=2)
    _run(spark, root, paths, sessions={}, upsert_users=True)
    fixture.write_message_files(late, f"{root}/messages/b", groups=1)
    _run(spark, root, paths, sessions={}, upsert_users=True)
    ev = silver_events(spark, SF_SMALL)
    assert _rows(read_events(spark, paths)) == _rows(ev)
    assert _rows(read_sessions(spark, paths)) == _rows(silver.sessions_by_attributes(ev))
    assert _rows(read_users(spark, paths).drop("updated_at")) == _rows(silver.users_scd2(ev).drop("updated_at"))
    assert read_users(spark, paths).filter("updated_at IS NULL").count() == 0


def test_late_file_goes_to_the_late_output_with_a_watermark(spark):
    """Bad messages move no watermark; the late file's events, all of them
    more than an hour behind, are exactly the late output."""
    root = work_dir(spark, "late_wm")
    raw, on_time, late, n_late = _late_split(spark)
    paths = SilverPaths(f"{root}/silver")
    fixture.write_message_files(on_time, f"{root}/messages/a", groups=1)
    _run(spark, root, paths, watermark="1 hour")
    kept = read_events(spark, paths).count()
    fixture.write_message_files(late, f"{root}/messages/b", groups=1)
    _run(spark, root, paths, watermark="1 hour")
    assert read_late(spark, paths).count() == n_late
    assert read_events(spark, paths).count() == kept == raw.count() - n_late


def test_one_bad_message_does_not_hide_backfilled_events(spark):
    root = work_dir(spark, "badmsg")
    raw = spark.read.parquet(f"{SF_SMALL}/events.parquet").orderBy("event_id").limit(4)
    good = fixture.broker_messages(raw).withColumn("timestamp", F.lit("2030-01-01").cast("timestamp"))
    bad = good.limit(1).withColumn("value", F.lit(b"\0\0\0\0\1nonsense"))
    paths = SilverPaths(f"{root}/silver")
    fixture.write_message_files(bad, f"{root}/messages/a", groups=1)
    _run(spark, root, paths, watermark="1 hour")
    fixture.write_message_files(good, f"{root}/messages/b", groups=1)
    _run(spark, root, paths, watermark="1 hour")
    assert read_events(spark, paths).count() == 4 and read_late(spark, paths).count() == 0


def test_the_engine_reports_what_lies_behind_the_watermark(spark):
    """Late events, some sent twice, and copies of accepted events: each late
    event is in ``late`` once, and the rows that Spark says it dropped are the
    late arrivals and nothing else."""
    root = work_dir(spark, "reported")
    raw, on_time, late, n_late = _late_split(spark)
    again = fixture.after_last(late, late.unionByName(on_time.limit(20)))
    paths = SilverPaths(f"{root}/silver")
    status = StreamStatus()
    spark.streams.addListener(status)
    try:
        for name, part in (("a", on_time), ("b", late), ("c", again)):
            fixture.write_message_files(part, f"{root}/messages/{name}", groups=1)
            q = _run(spark, root, paths, watermark="1 hour")
        status.wait_ended([q])
    finally:
        spark.streams.removeListener(status)
    assert read_late(spark, paths).count() == n_late and read_events(spark, paths).count() == raw.count() - n_late
    assert status.total(str(q.id), "rows") == on_time.count() + late.count() + again.count()
    assert status.total(str(q.id), "dropped") == 2 * n_late + 20
    assert [r.is_active for r in status.status(spark).collect()] == [False]


def test_session_state_is_bounded_by_the_watermark(spark):
    """Thirty days in ten batches: the days behind the watermark leave the
    state store, and the upserted sessions equal those of a batch run."""
    root = work_dir(spark, "evict")
    msgs = fixture.broker_messages(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    paths = SilverPaths(f"{root}/silver")
    states = []
    for g in range(5):
        fixture.write_message_files(msgs, f"{root}/messages/m", groups=5, first_group=g, last_group=g)
        stream = read_event_stream(spark, "parquet", path=f"{root}/messages/*/*")
        run_to_completion([start_silver(B.to_bronze(stream, F.col("timestamp")), paths, trigger="availableNow", watermark="1 hour")])
        q = start_sessions(spark, paths, "availableNow", watermark="1 hour")
        run_to_completion([q])
        ops = q.lastProgress["stateOperators"]
        assert "rocksdbCommitCheckpointLatency" in str(ops[0]["customMetrics"]) or any("rocksdb" in k for k in ops[0]["customMetrics"])
        states.append(ops[0]["numRowsTotal"])
    ev = silver_events(spark, SF_SMALL)
    whole = silver.sessions_by_attributes(ev)
    assert _rows(read_sessions(spark, paths)) == _rows(whole)
    # after each run's last batch only days that the watermark has not passed are left
    assert max(states) < whole.count() / 6


def test_replay_after_a_failure_between_two_outputs(spark):
    """The second batch fails behind each of its outputs in turn; after the
    restart all outputs equal those of an undisturbed run."""
    root = work_dir(spark, "replay")
    raw = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    fixture.write_message_files(fixture.broker_messages(raw, corrupt=True), f"{root}/messages/m", groups=2)
    options = dict(outputs=("events", "dlq"), upsert_users=True, gold_tables=("daily_active_users", "session_quality"))

    def run(paths, after=None):
        stream = read_event_stream(spark, "parquet", {"maxFilesPerTrigger": "2"}, path=f"{root}/messages/*/*")
        run_to_completion([start_silver(B.to_bronze(stream, F.col("timestamp")), paths, trigger="availableNow", after=after, **options)])

    def outputs(paths):
        gold_rows = [_rows(read_gold(spark, paths, n)) for n in options["gold_tables"]]
        return [_rows(f(spark, paths)) for f in (read_events, read_dlq, read_plan_events)] + \
            [_rows(read_users(spark, paths).drop("updated_at"))] + gold_rows

    plain, broken = SilverPaths(f"{root}/plain"), SilverPaths(f"{root}/broken")
    run(plain)
    for failing in ("events", "dlq", "partials", "plan_events", "users", "gold"):
        def fail(name, batch_id, failing=failing):
            if name == failing and batch_id == 1:
                raise RuntimeError(f"injected behind {name}")
        with pytest.raises(Exception, match="injected"):
            run(broken, fail)
    run(broken)
    want = outputs(plain)
    assert outputs(broken) == want and all(want)
    ev = read_events(spark, plain)
    assert _rows(read_gold(spark, plain, "session_quality")) == _rows(
        merge.conform(gold.session_quality(silver.sessions_by_attributes(ev)), schemas.GOLD_SCHEMAS["session_quality"]))


def test_unfinished_stream_raises(spark):
    root = work_dir(spark, "timeout")
    raw = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    fixture.write_message_files(fixture.broker_messages(raw), f"{root}/messages/a", groups=4)
    stream = read_event_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, path=f"{root}/messages/*/*")
    q = start_silver(B.to_bronze(stream, F.col("timestamp")), SilverPaths(f"{root}/silver"), trigger="availableNow")
    with pytest.raises(TimeoutError):
        run_to_completion([q], timeout_s=1)
    assert not q.isActive


def test_stream_dedup_modes(spark):
    """The streaming form for sinks of one's own keeps each event once."""
    from strata.streaming.jobs import silver_stream
    root = work_dir(spark, "modes")
    raw = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    fixture.write_message_files(fixture.redelivered(raw), f"{root}/messages/a", groups=1)
    for name, watermark in (("state", None), ("watermark", "1 hour")):
        stream = read_event_stream(spark, "parquet", path=f"{root}/messages/*/*")
        events, _ = silver_stream(B.to_bronze(stream, F.col("timestamp")), watermark)
        q = (events.writeStream.format("parquet").option("checkpointLocation", f"{root}/ck-{name}")
             .trigger(availableNow=True).start(f"{root}/out-{name}"))
        run_to_completion([q])
        out = spark.read.parquet(f"{root}/out-{name}")
        assert out.count() == raw.count() == out.select("event_id").distinct().count()


def _files(spark, path):
    return [r[0] for r in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()]


def test_a_batch_writes_a_file_a_date_and_only_changed_users(spark):
    """Not a file for every state partition and date or bucket; of the users
    table a batch writes its new rows and the rows they close, no more."""
    root = work_dir(spark, "small")
    raw = spark.createDataFrame([(i, datetime.datetime(2024, 1, 1 + i // 20, 1, i % 20), i % 4, "signup", 1.0, '{"k": 50}')
                                 for i in range(60)], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    msgs = fixture.broker_messages(raw)
    paths = SilverPaths(f"{root}/silver")
    for g in range(2):
        fixture.write_message_files(msgs, f"{root}/messages/m", groups=2, first_group=g, last_group=g)
        _run(spark, root, paths, upsert_users=True)
    stored = spark.read.parquet(paths.table("events"))
    assert len(_files(spark, paths.table("events"))) == stored.select("processing_date", "batch").distinct().count()
    written = spark.read.parquet(paths.table("users")).groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in written} == {0: 30, 1: 30 + 4}
    assert _rows(read_users(spark, paths).drop("updated_at")) == _rows(silver.users_scd2(saas_events(raw)).drop("updated_at"))


def test_bronze_batch_writes_a_file_a_date(spark):
    root = work_dir(spark, "bronze-files")
    raw = spark.createDataFrame([(i, datetime.datetime(2024, 1, 1 + i % 3), i % 4, "signup", 1.0, '{"k": 50}') for i in range(400)],
                                "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    fixture.broker_messages(raw).repartition(4).write.parquet(f"{root}/messages")
    stream = read_event_stream(spark, "parquet", path=f"{root}/messages")
    run_to_completion([start_bronze(stream, f"{root}/bronze", f"{root}/ckpt", "availableNow", F.col("timestamp"))])
    assert spark.read.parquet(f"{root}/bronze").count() == 400 and len(_files(spark, f"{root}/bronze")) == 3


def test_messages_are_decoded_once_without_dead_letters(spark):
    """The dead letters' branch decodes all messages again; without it the
    counts on arrival still hold every message."""
    bronze = spark.readStream.schema(schemas.BRONZE).parquet(make_folder(spark, work_dir(spark, "plan")))
    plan = _fan_in(bronze, None, dead=False)._jdf.queryExecution().analyzed().toString()
    assert plan.count("from_json") == 1 and "CollectMetrics arrivals" in plan


def test_state_stays_with_its_executor_and_out_of_the_heap(spark, monkeypatch):
    """A task for each state partition, as many as the cluster can use, and
    RocksDB unless the caller names a state store; a restart adds the rest."""
    tasks, write = [], jobs.write_batch
    monkeypatch.setattr(jobs, "write_batch", lambda df, *a: tasks.append(df.rdd.getNumPartitions()) or write(df, *a))
    own = {"spark.sql.shuffle.partitions": "64", "spark.sql.streaming.stateStore.providerClass": None}
    before = {k: spark.conf.get(k) for k in own}
    root = work_dir(spark, "state")
    paths = SilverPaths(f"{root}/silver")
    raw = spark.createDataFrame([(i % 50, datetime.datetime(2024, 1, 1 + i % 3), i % 4, "signup", 1.0, '{"k": 50}') for i in range(60)],
                                "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        for g in range(2):
            fixture.write_message_files(fixture.broker_messages(raw), f"{root}/messages/m", groups=2, first_group=g, last_group=g)
            q = _run(spark, root, paths, outputs=("events",))
            state = next(p for p in q.recentProgress if p.numInputRows).stateOperators[0]
            assert state.numShufflePartitions == min(64, 4 * spark.sparkContext.defaultParallelism)
            assert any(name.startswith("rocksdb") for name in state.customMetrics)
            assert {k: spark.conf.get(k, None) for k in own} == own
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert tasks == [state.numShufflePartitions] * 2
    assert sorted(r.event_id for r in read_events(spark, paths).collect()) == sorted(f"evt_{i}" for i in range(50))
