"""The skew-safe ordered scan equals a per-key window (brute force), also
with a hot key spread over many partitions."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators.scan import fill_within_key, hour_bucket, scan_within_key

from .conftest import SF_SMALL


def _frame(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    # a third of the rows share one key; values are sparse (NULL unless k%4==0)
    key = F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string")))
    return ev.select(key.alias("key"), F.col("ts").cast("timestamp").alias("ts"),
                     F.col("event_id").alias("id"),
                     F.when(k % 4 == 0, F.concat(F.lit("v"), k.cast("string"))).alias("val"))


def _brute(pdf, inclusive, descending):
    pdf = pdf.sort_values(["key", "ts", "id"], ascending=not descending)
    g = pdf.groupby("key", sort=False)["val"]
    incl = g.ffill()
    res = incl if inclusive else incl.groupby(pdf["key"], sort=False).shift(1)
    return dict(zip(pdf["id"], res.where(res.notna(), None)))


@pytest.mark.parametrize("inclusive,descending", [(True, False), (False, False), (False, True), (True, True)])
def test_fill_matches_window(spark, inclusive, descending):
    df = _frame(spark)
    got = fill_within_key(df, "key", ["ts", "id"], ["val"], inclusive=inclusive,
                          descending=descending)
    got = {r.id: r.val for r in got.collect()}
    want = _brute(df.toPandas(), inclusive, descending)
    assert got == want


def test_null_keys_pass_through(spark):
    df = _frame(spark).withColumn("key", F.when(F.col("id") % 5 == 0, None).otherwise(F.col("key")))
    out = fill_within_key(df, "key", ["ts", "id"], ["val"])
    assert out.count() == df.count()
    nulls = out.filter(F.col("key").isNull()).select("id", "val").collect()
    base = {r.id: r.val for r in df.filter(F.col("key").isNull()).collect()}
    assert {r.id: r.val for r in nulls} == base


def test_lead_matches_window(spark):
    df = _frame(spark)
    got = scan_within_key(df, "key", ["ts", "id"], fill=["val"],
                          lead={"next_ts": "ts", "next_id": "id"})
    got = {r.id: (r.val, r.next_ts, r.next_id) for r in got.collect()}
    pdf = df.toPandas().sort_values(["key", "ts", "id"])
    g = pdf.groupby("key", sort=False)
    fill = g["val"].ffill()
    nts, nid = g["ts"].shift(-1), g["id"].shift(-1)
    want = {i: (None if pd.isna(v) else v, None if pd.isna(t) else t.to_pydatetime(),
                None if pd.isna(n) else int(n))
            for i, v, t, n in zip(pdf["id"], fill, nts, nid)}
    assert got == want


def test_hot_key_is_spread_over_its_hours(spark):
    """The windows are over (key, hour): the rows of a key that holds a third
    of the table meet by hour only, and its hours go to many partitions."""
    df = _frame(spark).withColumn("b", hour_bucket("ts"))
    hot = df.filter(F.col("key") == "hot")
    largest = hot.groupBy("b").count().agg(F.max("count")).first()[0]
    assert largest < hot.count() / 20
    parts = df.repartition(12, "key", "b").withColumn("pid", F.spark_partition_id())
    assert parts.filter(F.col("key") == "hot").select("pid").distinct().count() == 12
    plan = scan_within_key(_frame(spark), "key", ["ts", "id"], ["val"])._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert windows and all("_b" in x for x in windows) and "InArrow" not in plan


def test_coarse_and_fine_buckets_agree(spark):
    df = _frame(spark)
    frames = [sorted(map(tuple, scan_within_key(df, "key", ["ts", "id"], ["val"], {"nid": "id"}, bucket=b).collect()), key=repr)
              for b in (F.lit(0), F.date_trunc("minute", "ts"), F.date_trunc("month", "ts"))]
    assert frames[0] == frames[1] == frames[2]


def _reads(spark, df):
    """How often the plan that ran scans the events table."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan parquet")


def test_lookup_reads_events_twice_and_versions_once(spark):
    from strata.operators import silver, star
    from strata.plans.catalog import _wide
    ev = _wide(spark, SF_SMALL)
    assert _reads(spark, star.fact_events(ev, silver.user_versions(ev))) <= 3
    assert _reads(spark, silver.users_scd2(ev)) == 0  # from the narrow checkpoint, which read the events once


def test_asof_with_ties_and_null_keys(spark):
    from strata.operators.asof import asof_lookup
    t = "2024-01-01 {}".format
    ev = spark.createDataFrame([("a", t("10:00:00"), 1), ("a", t("10:30:00"), 2), ("a", t("12:00:00"), 3), ("b", t("09:00:00"), 4),
                                (None, t("09:00:00"), 5), ("a", None, 6)], "user_id string, x string, event_id int") \
        .select("user_id", F.col("x").cast("timestamp").alias("event_timestamp"), "event_id")
    vs = spark.createDataFrame([("a", t("10:00:00"), "1", "p"), ("a", t("10:00:00"), "2", "q"), ("a", t("10:45:00"), "3", None),
                                (None, t("01:00:00"), "4", "z")], "user_id string, x string, event_id string, plan string") \
        .select("user_id", F.col("x").cast("timestamp").alias("valid_from"), "event_id", "plan")
    got = {r.event_id: r.plan for r in asof_lookup(ev, vs, ["plan"]).collect()}
    assert got == {1: "q", 2: "q", 3: None, 4: None, 5: None, 6: None}


def _burst(spark, n, every):
    """``n`` rows of one key within one hour, every ``every``-th a version;
    times repeat."""
    at = F.expr(f"timestamp '2024-01-05 10:00:00' + make_dt_interval(0, 0, 0, CAST((id * 7919 % {n // 2}) * 3500.0 / {n // 2} AS DECIMAL(18, 6)))")
    rows = spark.range(n).select(F.lit("u").alias("user_id"), at.alias("t"), F.col("id"))
    return rows, rows.filter(F.col("id") % every == 0).select("user_id", F.col("t").alias("valid_from"),
                                                            F.col("id").alias("event_id"), F.concat(F.lit("p"), "id").alias("plan"))


def _spread(df, value):
    """Rows by task of the last stage, which computes ``value``."""
    counts = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max(value)).collect()
    return sorted((r["n"] for r in counts), reverse=True)


def test_burst_of_one_key_in_one_hour_is_spread(spark):
    """A million events and 100,000 versions of one key in one hour."""
    from strata.operators.asof import asof_lookup
    rows, versions = _burst(spark, 1_000_000, 10)
    events = rows.select("user_id", F.col("t").alias("event_timestamp"), "id")
    large = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}  # as for data too large to broadcast
    for k, v in large.items():
        spark.conf.set(k, v)
    try:
        out = asof_lookup(events, versions, ["plan"])
        sizes = _spread(out, "plan")
        assert sum(sizes) == 1_000_000 and len(sizes) == 8 and sizes[0] < 250_000
        got = out.toPandas()
        scd = scan_within_key(versions.withColumn("val", F.col("plan")), "user_id", ["valid_from", "event_id"], fill=["val"],
                              lead={"valid_to": "valid_from"}, hot_rows=10_000)
        sizes = _spread(scd, "valid_to")
        assert sum(sizes) == 100_000 and len(sizes) == 8 and sizes[0] < 25_000
        ends = scd.toPandas().sort_values(["valid_from", "event_id"])
    finally:
        for k in large:
            spark.conf.unset(k)
    v = versions.toPandas().sort_values(["valid_from", "event_id"])
    assert ends["valid_to"].iloc[:-1].tolist() == v["valid_from"].iloc[1:].tolist() and pd.isna(ends["valid_to"].iloc[-1])
    v = v.assign(as_text=v["event_id"].astype(str)).sort_values(["valid_from", "as_text"])  # ids are compared as text
    at = v["valid_from"].to_numpy().searchsorted(got["event_timestamp"].to_numpy(), side="right") - 1
    want = [None if i < 0 else p for i, p in zip(at, v["plan"].to_numpy()[at])]
    assert got["plan"].where(got["plan"].notna(), None).tolist() == want


@pytest.mark.parametrize("hot_rows", [3, 100_000])
def test_parts_of_hot_hours_change_nothing(spark, hot_rows):
    from strata.operators.asof import asof_lookup
    df = _frame(spark).withColumn("ts", F.date_trunc("minute", "ts"))
    df = df.withColumn("ts", F.when(F.col("id") % 50 == 7, None).otherwise(F.lit("2024-01-01 05:00:00").cast("timestamp")
                                                                           + F.expr("make_dt_interval(0, 0, id % 90, 0)")))
    got = {r.id: r.val for r in scan_within_key(df, "key", ["ts", "id"], fill=["val"], hot_rows=hot_rows).collect()}
    pdf = df.toPandas().sort_values(["key", "ts", "id"], na_position="first")
    want = pdf.groupby("key", sort=False)["val"].ffill()
    assert got == dict(zip(pdf["id"], want.where(want.notna(), None)))
    versions = df.filter("val IS NOT NULL").select("key", F.col("ts").alias("valid_from"), F.col("id").alias("event_id"), "val")
    out = asof_lookup(df.drop("val"), versions, ["val"], key="key", event_time="ts", hot_rows=hot_rows).collect()
    rows = [r for r in versions.collect() if r.valid_from is not None]
    assert len(out) == df.count()
    for r in out:
        past = [v for v in rows if r.ts is not None and v.key == r.key and v.valid_from <= r.ts]
        assert r.val == (max(past, key=lambda v: (v.valid_from, str(v.event_id))).val if past else None)
