"""End-to-end batch jobs: bronze -> silver -> gold -> export -> warehouse."""

from pyspark.sql import functions as F

from strata import schemas, sinks
from strata.operators import bronze as B
from strata.operators import gold, merge, silver
from strata.plans import jobs
from strata.plans.catalog import silver_events
from strata.session import work_dir
from strata.sources import fixture

from .conftest import SF_SMALL


def test_batch_jobs_end_to_end(spark):
    root = work_dir(spark, "jobs")
    raw = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    msgs = fixture.broker_messages(raw, corrupt=True)
    sinks.write_snapshot(B.to_bronze(msgs, F.col("timestamp")), f"{root}/bronze", ["processing_date"])
    paths = jobs.run_silver_batch(spark, f"{root}/bronze", f"{root}/silver")
    ev = spark.read.parquet(paths["events"])
    dlq = spark.read.parquet(paths["dlq"])
    assert ev.count() + dlq.count() == raw.count()
    assert ev.select("event_id").distinct().count() == ev.count()

    written = jobs.run_gold(spark, ev, spark.read.parquet(paths["sessions"]), f"{root}/gold", f"{root}/export")
    assert set(written) == set(schemas.GOLD_SCHEMAS)
    stages = {n: f"{root}/export/{n}/" for n in schemas.GOLD_SCHEMAS}
    first = {n: sorted(map(tuple, df.collect())) for n, df in jobs.load_warehouse(spark, stages, f"{root}/wh").items()}
    again = jobs.load_warehouse(spark, stages, f"{root}/wh")   # idempotent re-run
    for n in schemas.GOLD_SCHEMAS:
        a = first[n]
        b = sorted(map(tuple, again[n].collect()))
        assert a == b and len(a) == spark.read.parquet(written[n]).count()
    want = merge.conform(gold.daily_active_users(ev), schemas.GOLD_DAU)
    assert sorted(map(tuple, want.collect())) == sorted(map(tuple, again["daily_active_users"].collect()))


def test_replay_matches_direct_silver(spark):
    """The message path yields exactly the replay view's valid rows."""
    raw = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    valid, _ = B.split_contract(B.decode_payload(B.to_bronze(fixture.broker_messages(raw), F.col("timestamp"))))
    from strata.operators import silver
    flat = silver.flatten_events(valid).select(*schemas.SILVER_EVENT_COLUMNS)
    direct = silver_events(spark, SF_SMALL)
    assert flat.exceptAll(direct).count() == 0 and direct.exceptAll(flat).count() == 0


def test_gold_reads_prune_date_partitions(spark):
    from strata.sources.tables import read_silver_events
    root = work_dir(spark, "prune")
    sinks.write_snapshot(silver_events(spark, SF_SMALL), f"{root}/events", ["processing_date"])
    ev = read_silver_events(spark, f"{root}/events", ("2024-01-05", "2024-01-06"))
    plan = ev._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(processing_date" in plan
    dau = gold.daily_active_users(ev).collect()
    assert sorted(r.date.day for r in dau) == [5, 6]


def test_warehouse_updated_at_stamped_on_touched_rows_only(spark):
    import time
    root = work_dir(spark, "stamp")
    g = merge.conform(gold.daily_active_users(silver_events(spark, SF_SMALL)), schemas.GOLD_DAU)
    sinks.write_snapshot(g, f"{root}/stage_all/")
    sinks.write_snapshot(g.filter(F.dayofmonth("date") > 25), f"{root}/stage_tail/")
    first = jobs.load_warehouse(spark, {"daily_active_users": f"{root}/stage_all/"}, f"{root}/wh", True)
    t1 = {r.date: r.updated_at for r in first["daily_active_users"].collect()}
    time.sleep(1.1)
    second = jobs.load_warehouse(spark, {"daily_active_users": f"{root}/stage_tail/"}, f"{root}/wh", True)
    t2 = {r.date: r.updated_at for r in second["daily_active_users"].collect()}
    assert set(t1) == set(t2)
    for d in t1:
        if d.day > 25:
            assert t2[d] > t1[d]
        else:
            assert t2[d] == t1[d]


def _tables(spark, paths):
    return {n: sorted(map(repr, (tuple(r) for r in spark.read.parquet(p).select(*sorted(
        c for c in spark.read.parquet(p).columns if c != "updated_at")).collect()))) for n, p in paths.items()}


def test_reprocessing_one_day_keeps_all_others(spark):
    root = work_dir(spark, "reprocess")
    raw = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    sinks.write_snapshot(B.to_bronze(fixture.broker_messages(raw, corrupt=True), F.col("timestamp")), f"{root}/bronze",
                         ["processing_date"])
    full = _tables(spark, jobs.run_silver_batch(spark, f"{root}/bronze", f"{root}/silver"))
    again = _tables(spark, jobs.run_silver_batch(spark, f"{root}/bronze", f"{root}/silver", ("2024-01-05", "2024-01-06")))
    assert {n: len(x) for n, x in full.items()} == {n: len(x) for n, x in again.items()}
    assert full == again


def test_reprocessing_takes_in_what_bronze_gained(spark):
    """Days added and a day corrected after the first run equal one full run."""
    root = work_dir(spark, "regain")
    raw = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    late = (F.dayofmonth(F.col("ts").cast("timestamp")) >= 20) | (F.col("event_id") % 9 == 0)
    bronze = lambda r: B.to_bronze(fixture.broker_messages(r, corrupt=True), F.col("timestamp"))
    sinks.write_snapshot(bronze(raw.filter(~late)), f"{root}/bronze", ["processing_date"])
    jobs.run_silver_batch(spark, f"{root}/bronze", f"{root}/silver")
    bronze(raw.filter(late)).write.mode("append").partitionBy("processing_date").parquet(f"{root}/bronze")
    got = _tables(spark, jobs.run_silver_batch(spark, f"{root}/bronze", f"{root}/silver", ("2024-01-01", "2024-12-31")))
    want = _tables(spark, jobs.run_silver_batch(spark, f"{root}/bronze", f"{root}/full"))
    assert got == want


def test_reprocessing_rebuilds_sessions_without_an_id(spark):
    """Events without a session id, and other keys, arrive later or lose them
    by a correction: an incremental run equals a full one."""
    root = work_dir(spark, "null-sessions")
    raw = spark.read.parquet(f"{SF_SMALL}/events.parquet").filter("event_id % 5 < 3")
    day = F.dayofmonth(F.col("ts").cast("timestamp"))

    def bronze(rows, blank):
        b = B.to_bronze(fixture.broker_messages(rows, corrupt=True), F.col("timestamp"))
        text = F.expr("decode(substring(value, 6), 'UTF-8')")
        for i, field in enumerate(("session_id", "user_id", "anonymous_id", "country")):
            found = F.regexp_replace(text, f'"{field}":"[^"]*"', f'"{field}":null')
            text = F.when(F.col("kafka_offset") % blank <= 1 - i % 2, found).otherwise(text)
        return b.withColumn("value", F.concat(F.expr("substring(value, 1, 5)"), text.cast("binary")))

    first, late = bronze(raw.filter(day < 20), 4), bronze(raw.filter(day >= 20), 4)
    corrected = bronze(raw.filter(day == 7), 3)
    date = corrected.select("processing_date").first()[0]
    sinks.write_snapshot(first, f"{root}/bronze", ["processing_date"])
    paths = jobs.run_silver_batch(spark, f"{root}/bronze", f"{root}/silver")
    assert spark.read.parquet(paths["sessions"]).filter("session_id IS NULL").count() > 1
    late.write.mode("append").partitionBy("processing_date").parquet(f"{root}/bronze")
    for rows, dates in ((None, ("2024-01-20", "2024-12-31")), (corrected, (str(date), str(date)))):
        if rows is not None:
            sinks.overwrite_partitions(rows, f"{root}/bronze", ["processing_date"])
        got = _tables(spark, jobs.run_silver_batch(spark, f"{root}/bronze", f"{root}/silver", dates))
        want = _tables(spark, jobs.run_silver_batch(spark, f"{root}/bronze", f"{root}/full"))
        assert {n: (len(set(got[n]) - set(want[n])), len(set(want[n]) - set(got[n]))) for n in want} == dict.fromkeys(want, (0, 0))
        assert got == want


def test_warehouse_loaded_without_stamp_gains_it_later(spark):
    root = work_dir(spark, "late_stamp")
    g = merge.conform(gold.daily_active_users(silver_events(spark, SF_SMALL)), schemas.GOLD_DAU)
    sinks.write_snapshot(g, f"{root}/all/")
    sinks.write_snapshot(g.filter(F.dayofmonth("date") > 25), f"{root}/tail/")
    jobs.load_warehouse(spark, {"daily_active_users": f"{root}/all/"}, f"{root}/wh")
    out = jobs.load_warehouse(spark, {"daily_active_users": f"{root}/tail/"}, f"{root}/wh", True)["daily_active_users"]
    assert all((r.updated_at is not None) == (r.date.day > 25) for r in out.collect()) and out.count() == g.count()


def test_decoded_avro_with_binary_payload_passes_the_contract(spark):
    """The check looks at the decoded record alone: no text, no marker."""
    row = spark.createDataFrame([("e1", "login", "2024-01-01T00:00:00Z"), (None, "login", "2024-01-01T00:00:00Z")],
                                "event_id string, event_type string, timestamp string")
    decoded = row.select(F.struct("*").alias("data"), F.base64(F.lit(b"\x02\xff\x00")).alias("payload"))
    assert [r.error for r in B.tag_contract(decoded).collect()] == [None, "missing required field: event_id"]


def test_wrongly_typed_values_and_leading_blanks(spark):
    rows = [b'     {"event_id":"a","event_type":"login","timestamp":"2024-01-01T00:00:00Z"}',
            b'\0\0\0\0\1{"event_id":"b","event_type":"churn","timestamp":"2024-01-01T00:00:00Z","properties":{"mrr_usd":"oops"}}',
            b"\0\0\0\0\1nonsense", b"\0\0\0\0\1", None]
    df = spark.createDataFrame([(r,) for r in rows], "value binary")
    errors = [r.error for r in B.tag_contract(B.decode_payload(df)).collect()]
    assert errors == [None, "value of the wrong type", "undecodable payload", "undecodable payload", "undecodable payload"]


def test_touched_dates_prune_both_reads(spark):
    root = work_dir(spark, "touched")
    ev = silver_events(spark, SF_SMALL)
    sinks.write_snapshot(ev, f"{root}/events", ["processing_date"])
    stored = spark.read.parquet(f"{root}/events").select(*schemas.SILVER_EVENT_COLUMNS)
    late = stored.filter(F.col("processing_date") == F.lit("2024-01-05").cast("date"))
    target = merge.conform(gold.daily_active_users(ev), schemas.GOLD_DAU)
    out = gold.rerun_touched_dates(stored, late, gold.daily_active_users, target, ["date"],
                                   schemas.GOLD_UPDATE_COLUMNS["daily_active_users"], schemas.GOLD_DAU)
    plan = out._jdf.queryExecution().executedPlan().toString()
    scans = [x[x.index("PartitionFilters"):] for x in plan.splitlines() if "FileScan" in x and "processing_date" in x]
    assert len(scans) == 2 and all("processing_date" in x.split("PushedFilters")[0] for x in scans)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, target.collect()))


def test_gold_is_lazy(spark):
    """Building the five plans runs no job."""
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    ev = silver_events(spark, SF_SMALL)
    seen = set(spark.sparkContext.statusTracker().getJobIdsForGroup())
    gold.build_gold(ev, silver.sessions_by_attributes(ev))
    assert set(spark.sparkContext.statusTracker().getJobIdsForGroup()) == seen >= set(before)
