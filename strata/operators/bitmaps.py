"""Mergeable exact distinct counts: one user bitmap a day.

Users get numbers that stay: a user's hash says its *lane*, and its place in
the lane counts up from 1, so numbers are dense in every lane and can be given
lane by lane, in parallel.  A day's actives are bitmaps (32,768 numbers each);
bitmaps of several days, or of a day's first and later events, are merged by
OR.  A late event costs its own day's bitmaps and the merges of the windows
that hold the day; no event is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.gold import with_event_date

LANES = 64
LANE_SIZE = 1 << 40


def lane() -> Column:
    return F.pmod(F.xxhash64("user_id"), F.lit(LANES)).cast("int")


def number_users(users: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """user_id, lane, number of the users not in ``known`` (which has the same
    columns): they follow on the last number of their lane."""
    new = users.select("user_id").filter("user_id IS NOT NULL").distinct().withColumn("lane", lane())
    place = F.row_number().over(Window.partitionBy("lane").orderBy("user_id")).cast("long")
    if known is None:
        return new.select("user_id", "lane", (F.col("lane") * F.lit(LANE_SIZE) + place).alias("number"))
    last = known.groupBy("lane").agg(F.max("number").alias("last"))  # one row a lane
    return (new.join(known.select("user_id"), "user_id", "left_anti").join(F.broadcast(last), "lane", "left")
            .select("user_id", "lane", (F.coalesce("last", F.col("lane") * F.lit(LANE_SIZE)) + place).alias("number")))


def day_bitmaps(events: DataFrame, numbers: DataFrame) -> DataFrame:
    """date, block, bitmap: the users active on each date."""
    active = with_event_date(events).filter("user_id IS NOT NULL").select("user_id", "date").distinct()
    n = F.col("number")
    return (active.join(numbers.select("user_id", "number"), "user_id")
            .groupBy("date", F.bitmap_bucket_number(n).alias("block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("bitmap")))


def merge_bitmaps(*bitmaps: DataFrame) -> DataFrame:
    """OR of bitmaps of one date and block."""
    rows = bitmaps[0]
    for more in bitmaps[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("date", "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def window_actives(bitmaps: DataFrame, days: Sequence[int] = (7, 30)) -> DataFrame:
    """date, dau_count, active_<N>d: exact distinct users of the trailing N
    days, for every calendar date from the first to the last with a bitmap.  A
    bitmap is sent to the windows that hold it, at most the longest N, and
    combined on the map side; nothing else is read."""
    first, last = bitmaps.agg(F.min("date"), F.max("date")).first()
    spans = sorted({1, *days})
    lo, hi = (F.lit(d).cast("date") for d in (first, last))
    calendar = bitmaps.sparkSession.range(1).select(F.explode(F.sequence(lo, hi)).alias("date"))
    sent = bitmaps.select(F.explode(F.sequence("date", F.least(F.date_add("date", max(spans) - 1), hi))).alias("upto"), "date", "block", "bitmap")
    age = F.date_diff("upto", "date")
    per_block = sent.groupBy("upto", "block").agg(
        *[F.bitmap_or_agg(F.when(age < n, F.col("bitmap")).otherwise(F.unhex(F.lit("00")))).alias(f"_{n}") for n in spans])
    counts = per_block.groupBy(F.col("upto").alias("date")).agg(
        *[F.sum(F.bitmap_count(f"_{n}")).cast("long").alias(f"_{n}") for n in spans])
    return (calendar.join(counts, "date", "left")
            .select("date", *[F.coalesce(f"_{n}", F.lit(0).cast("long")).alias("dau_count" if n == 1 else f"active_{n}d") for n in spans]))
