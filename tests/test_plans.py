"""What the plans read: late days, pruned facts, and plans unknown to the code."""

from pyspark.sql import functions as F

from strata import sinks
from strata.functions import columns
from strata.operators import bitmaps, kpi, star
from strata.plans import catalog
from strata.session import work_dir

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_late_day_reads_its_own_bitmaps_alone(spark):
    root = work_dir(spark, "late-day")
    ev = catalog.silver_events(spark, SF_SMALL)
    numbers = bitmaps.number_users(ev)
    sinks.overwrite_partitions(bitmaps.day_bitmaps(ev, numbers), f"{root}/bitmaps", ["date"])
    day = ev.filter(F.dayofmonth("processing_date") == 12)
    merged = catalog.late_day_bitmaps(spark, root, day, numbers)
    scans = [x for x in _plan(merged).splitlines() if "FileScan" in x and "bitmap" in x]
    assert len(scans) == 1 and "PartitionFilters: [" in scans[0] and "2024-01-12" in scans[0].split("PushedFilters")[0]
    # the windows are made from bitmaps, events are not read again
    windows = bitmaps.window_actives(spark.read.parquet(f"{root}/bitmaps"))
    assert "event_timestamp" not in _plan(windows) and "events.parquet" not in _plan(windows)
    assert _rows(windows) == _rows(kpi.rolling_actives(ev))


def test_numbers_stay_and_new_users_follow(spark):
    users = spark.createDataFrame([(f"u{i}",) for i in range(300)], "user_id string")
    first = bitmaps.number_users(users.filter("user_id < 'u2'"))
    rest = bitmaps.number_users(users.unionByName(users), first)
    both = first.unionByName(rest).collect()
    assert len(both) == 300 == len({r.number for r in both})
    for lane in {r.lane for r in both}:
        places = sorted(r.number - lane * bitmaps.LANE_SIZE for r in both if r.lane == lane)
        assert places == list(range(1, len(places) + 1))


def test_days_without_events_count_nobody_new(spark):
    rows = [("a", "2024-01-01"), ("b", "2024-01-01"), ("a", "2024-01-04"), (None, "2024-01-02"), ("c", "2024-02-20")]
    ev = spark.createDataFrame(rows, "user_id string, t string").select("user_id", F.col("t").cast("timestamp").alias("event_timestamp"))
    assert _rows(bitmaps.window_actives(bitmaps.day_bitmaps(ev, bitmaps.number_users(ev)))) == _rows(kpi.rolling_actives(ev))


def test_date_dimension_prunes_the_fact_at_run_time(spark):
    facts, dates, _ = catalog.events_by_date_key(spark, SF_SMALL)
    plan = _plan(star.events_by_feature_week(facts, dates.filter(F.col("iso_week").isin(2, 3))))
    assert "dynamicpruning" in plan


def test_plans_unknown_to_the_code_are_found(spark):
    df = spark.createDataFrame([(1, '{"gold":3,"pro":4}'), (2, "{}"), (3, None)], "id int, j string")
    out = columns.variant_rows(df.select("id", F.parse_json("j").alias("v")), "v", "plan", "uses", "bigint")
    assert [r for r in _rows(out) if r[1] is not None] == [(1, "gold", 3), (1, "pro", 4)]
    assert df.agg(F.schema_of_variant_agg(F.parse_json("j"))).first()[0] == "OBJECT<gold: BIGINT, pro: BIGINT>"
