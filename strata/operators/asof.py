"""Point-in-time (as-of) lookups: the version of a keyed dimension in force
at each event, e.g. the plan a user was on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.scan import HOT_ROWS, hour_bucket, with_parts
from strata.session import checkpoint_root


def asof_lookup(events: DataFrame, versions: DataFrame, cols: Sequence[str],
                key: str = "user_id", event_time: str = "event_timestamp",
                version_start: str = "valid_from", version_id: str = "event_id",
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """All event columns plus ``cols`` taken from the latest version of the
    same ``key`` whose start is at or before the event time (of versions with
    one start, that with the largest id).

    Equivalent to the interval join ``e.key = v.key AND e.t >= v.valid_from
    AND (v.valid_to IS NULL OR e.t < v.valid_to)`` over contiguous versions,
    without comparing events and versions: both are one ordered sequence, and
    the last version so far is carried along it, inside the parts of
    :mod:`strata.operators.scan` (key, hour, and quantiles of a hot hour) by a
    window and across a key's parts by one row a part.  The event columns are
    shuffled once, in the JVM; key and time are read once more for the parts.
    Events without key or time get NULLs."""
    none = F.lit(None)
    version = F.struct(*[F.col(c).alias(c) for c in cols])
    checkpoint_root(events.sparkSession)
    starts = versions.filter(F.col(key).isNotNull() & F.col(version_start).isNotNull()).select(
        F.col(key).alias("_k"), F.col(version_start).alias("_t"), F.lit(0).alias("_kind"), F.col(version_id).cast("string").alias("_id"),
        version.alias("_v")).checkpoint(eager=True)  # narrow, and used for the parts and in them
    taken = events.select(
        F.when(F.col(event_time).isNotNull(), F.col(key)).alias("_k"), F.col(event_time).alias("_t"), F.lit(1).alias("_kind"),
        none.cast("string").alias("_id"), none.cast(starts.schema["_v"].dataType).alias("_v"), F.struct(*events.columns).alias("_e"))
    rows = (starts.withColumn("_e", none.cast(taken.schema["_e"].dataType)).unionByName(taken)
            .withColumn("_b", hour_bucket("_t")))
    rows = with_parts(rows, rows, "_k", "_t", hot_rows)
    # events without a key have no version: dealt by their hash, no part of theirs is hot
    rows = rows.withColumn("_s", F.when(F.col("_k").isNull(), F.pmod(F.xxhash64("_e"), F.lit(1 << 20)).cast("int")).otherwise(F.col("_s")))
    place = F.when(F.col("_kind") == 0, F.struct("_t", "_id"))
    parts = rows.groupBy("_k", "_b", "_s").agg(F.max_by("_v", place).alias("_newest"))
    before = Window.partitionBy("_k").orderBy("_b", "_s").rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.filter("_k IS NOT NULL").select("_k", "_b", "_s", F.last("_newest", ignorenulls=True).over(before).alias("_past"))
    upto = (Window.partitionBy("_k", "_b", "_s").orderBy("_t", "_kind", F.asc_nulls_first("_id"))
            .rowsBetween(Window.unboundedPreceding, 0))
    local = rows.withColumn("_own", F.last("_v", ignorenulls=True).over(upto)).filter(F.col("_kind") == 1)
    found = F.coalesce("_own", "_past")
    return local.join(carry, ["_k", "_b", "_s"], "left").select("_e.*", *[found[c].alias(c) for c in cols])


def plan_asof(events: DataFrame, users: DataFrame) -> DataFrame:
    """event_id, user_id, event_timestamp, event_type, plan_asof."""
    ev = events.select("event_id", "user_id", "event_timestamp", "event_type")
    v = users.select("user_id", "valid_from", "event_id", F.col("plan").alias("plan_asof"))
    return asof_lookup(ev, v, ["plan_asof"])
