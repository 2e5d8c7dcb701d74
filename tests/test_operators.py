"""Invariants and idempotence of operators."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException  # noqa: F401

from strata import schemas, sinks
from strata.operators import gold, kpi, merge, silver
from strata.plans.catalog import merge_fixture, silver_events
from strata.session import work_dir

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def events(spark):
    return silver_events(spark, SF_SMALL).cache()


def test_returning_is_dau_minus_new(events):
    d = gold.daily_active_users(events)
    assert d.filter(F.col("returning_users") != F.col("dau_count") - F.col("new_users")).count() == 0


def test_net_mrr_is_total_minus_churned(events):
    m = gold.mrr_metrics(events)
    bad = m.filter(F.abs(F.col("net_mrr") - (F.col("total_mrr") - F.col("churned_mrr"))) > 0.011)
    assert bad.count() == 0


def test_device_shares_at_most_100(events):
    q = gold.session_quality(silver.sessions_by_attributes(events))
    total = F.col("mobile_pct") + F.col("desktop_pct") + F.col("tablet_pct")
    assert q.filter(total > 100.01).count() == 0


def test_sessions_primary_key_and_event_conservation(events):
    s = silver.sessions(events)
    assert s.count() == s.select("session_id").distinct().count()
    assert s.agg(F.sum("page_count")).first()[0] == events.filter(F.col("session_id").isNotNull()).count()


def test_scd2_one_current_row_and_contiguous(events):
    u = silver.users_scd2(events)
    cur = u.groupBy("user_id").agg(F.sum(F.col("is_current").cast("int")).alias("n"))
    assert cur.filter(F.col("n") != 1).count() == 0
    # each valid_to equals the next version's valid_from
    nxt = u.alias("a").join(u.alias("b"), (F.col("a.user_id") == F.col("b.user_id"))
                            & (F.col("a.valid_to") == F.col("b.valid_from")), "left")
    assert nxt.filter(F.col("a.valid_to").isNotNull() & F.col("b.user_id").isNull()).count() == 0


def test_rolling_actives_brute_force(events):
    r = {row.date: (row.active_7d, row.active_30d) for row in kpi.rolling_actives(events).collect()}
    act = (gold.with_event_date(events).filter(F.col("user_id").isNotNull())
           .select("user_id", "date").distinct().toPandas())
    import datetime as dt
    for d, (a7, a30) in r.items():
        win7 = act[(act.date <= d) & (act.date > d - dt.timedelta(days=7))].user_id.nunique()
        win30 = act[(act.date <= d) & (act.date > d - dt.timedelta(days=30))].user_id.nunique()
        assert (a7, a30) == (win7, win30), d


def test_merge_twice_equals_once(events):
    g = gold.daily_active_users(events)
    target, source = merge_fixture(g, "daily_active_users")
    keys, upd = schemas.GOLD_KEYS["daily_active_users"], schemas.GOLD_UPDATE_COLUMNS["daily_active_users"]
    once = merge.merge_upsert(target, source, keys, upd)
    twice = merge.merge_upsert(once, source, keys, upd)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_merge_rejects_ambiguous_source(events):
    g = merge.conform(gold.daily_active_users(events), schemas.GOLD_DAU)
    bad = g.unionByName(g.withColumn("dau_count", F.col("dau_count") + 1))
    with pytest.raises(Exception, match="duplicate keys"):
        merge.merge_upsert(g, bad, ["date"]).collect()


def test_first_load_rejects_ambiguous_source(spark, events):
    g = merge.conform(gold.daily_active_users(events), schemas.GOLD_DAU)
    bad = g.unionByName(g.withColumn("dau_count", F.col("dau_count") + 1))
    with pytest.raises(Exception, match="duplicate keys"):
        sinks.merge_into(spark, work_dir(spark, "first") + "/t", bad, ["date"])
    assert sinks.read_current(spark, work_dir(spark, "first2") + "/t") is None


def test_merge_adds_source_columns(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "B", 7), (3, "C", 8)], "k int, v string, n int")
    out = merge.merge_upsert(t, s, ["k"], ["n"])
    assert out.columns == ["k", "v", "n"]
    assert sorted(map(tuple, out.collect())) == [(1, "a", None), (2, "b", 7), (3, "C", 8)]


def _part_files(path):
    import os
    return {d: sorted(f for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet"))
            for d in os.listdir(path) if d.startswith("date=")}


def test_merge_into_replaces_touched_partitions_alone(spark, events):
    base = work_dir(spark, "merge") + "/t"
    g = merge.conform(gold.daily_active_users(events), schemas.GOLD_DAU)
    target, source = merge_fixture(gold.daily_active_users(events), "daily_active_users")
    assert sinks.merge_into(spark, base, target, ["date"]).count() == target.count()
    before = _part_files(base)
    out = sinks.merge_into(spark, base, source, ["date"], schemas.GOLD_UPDATE_COLUMNS["daily_active_users"])
    want = merge.merge_upsert(target, source, ["date"], schemas.GOLD_UPDATE_COLUMNS["daily_active_users"])
    assert out.columns == g.columns and sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
    after = _part_files(base)
    for day, files in before.items():
        assert (after[day] == files) == (int(day[-2:]) <= 10)


def test_merge_reads_only_touched_partitions_of_the_target(spark, events):
    base = work_dir(spark, "merge-plan") + "/t"
    g = merge.conform(gold.daily_active_users(events), schemas.GOLD_DAU)
    sinks.merge_into(spark, base, g, ["date"])
    source = g.filter(F.dayofmonth("date") == 5)
    current = sinks.read_current(spark, base)
    merged = sinks.merge_plan(current, source, ["date"])
    scans = [x[x.index("PartitionFilters"):].split("PushedFilters")[0]
             for x in merged._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters: [" in x]
    assert any("2024-01-05" in x or "date" in x for x in scans) and merged.count() == 1
    kept = merged.filter(F.col("date") != F.lit("2024-01-05").cast("date"))
    assert kept.count() == 0


def test_merge_takes_null_partitions_and_new_columns(spark):
    base = work_dir(spark, "merge-null") + "/t"
    rows = spark.createDataFrame([(None, "a", 1), ("2024-01-01", "b", 2)], "d string, k string, n int").withColumn("date", F.to_date("d")).drop("d")
    sinks.merge_into(spark, base, rows, ["date", "k"])
    more = rows.filter("date IS NULL").withColumn("n", F.lit(9)).withColumn("extra", F.lit("x"))
    out = sinks.merge_into(spark, base, more, ["date", "k"])
    assert sorted((r.k, r.n, r.extra, r.date is None) for r in out.collect()) == [("a", 9, "x", True), ("b", 2, None, False)]
    with pytest.raises(ValueError):
        sinks.merge_into(spark, base, more, ["k"])


def test_dedup_keeps_earliest_copy(events):
    e = events.select("event_id", "processed_at", "event_type")
    later = e.withColumn("processed_at", F.col("processed_at") + F.expr("INTERVAL 1 HOUR")) \
             .withColumn("event_type", F.lit("copy"))
    out = silver.dedup_events(later.unionByName(e))
    assert out.count() == e.count()
    assert out.filter(F.col("event_type") == "copy").count() == 0


def test_dynamic_partition_overwrite_keeps_other_dates(spark, events):
    path = work_dir(spark, "dyn") + "/dau"
    dau = gold.daily_active_users(events)
    sinks.write_snapshot(dau, path, ["date"])
    changed = dau.filter(F.dayofmonth("date") == 3).withColumn("dau_count", F.lit(-1).cast("long"))
    sinks.overwrite_partitions(changed, path, ["date"])
    back = spark.read.parquet(path)
    assert back.count() == dau.count()
    assert back.filter(F.col("dau_count") == -1).count() == 1
    sinks.write_snapshot(changed, path, ["date"])          # static: full replace
    assert spark.read.parquet(path).count() == 1
