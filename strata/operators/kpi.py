"""KPI trend operators over silver events and gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.gold import sessions_by_date_country, with_event_date


def calendar(events: DataFrame, date_col: str = "date") -> DataFrame:
    """Every date between the first and last event date (one row per day).

    Built from a one-row min/max aggregate, so its size is the calendar span,
    not the data size."""
    bounds = events.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias(date_col))


def rolling_actives(events: DataFrame, days: Sequence[int] = (7, 30)) -> DataFrame:
    """date, dau_count, active_<N>d for each N: exact distinct users active in
    the trailing N days (date - N + 1 .. date), for every calendar date from
    the first to the last active date.

    No day explosion per user and no range join: per user, the distinct
    active dates d1 < d2 < ... each cover [d_i, min(d_i + N, d_(i+1))); those
    pieces are disjoint, so a +1 at the start and a -1 at the end, summed per
    date and accumulated over dates, count each user once (N = 1 is the DAU).
    Work is O(user-days) in one linear plan: the per-user window holds at most
    one row per calendar day (a fixed bound), and the running sums run over one
    row per date; days without any delta are filled by exploding each date's
    span up to the next one."""
    spans_n = sorted({1, *days})
    ev = with_event_date(events).filter(F.col("user_id").isNotNull())
    active = ev.groupBy("user_id", "date").agg(F.lit(1).alias("_a")).drop("_a")
    nxt = F.lead("date").over(Window.partitionBy("user_id").orderBy("date"))
    spans = active.withColumn("_next", nxt)
    recs = []
    for n in spans_n:
        end = F.least(F.date_add("date", n), F.coalesce("_next", F.date_add("date", n)))
        recs.append(F.struct(F.col("date").alias("d"), F.lit(n).alias("n"), F.lit(1).alias("delta")))
        recs.append(F.struct(end.alias("d"), F.lit(n).alias("n"), F.lit(-1).alias("delta")))
    deltas = spans.select(F.inline(F.array(*recs)))
    per_day = deltas.groupBy("d").agg(
        *[F.sum(F.when(F.col("n") == n, F.col("delta")).otherwise(0)).alias(f"_s{n}") for n in spans_n],
        F.max(F.col("delta") > 0).alias("_start"))
    w = Window.orderBy("d")   # one row per date
    run = per_day.select(
        "d", *[F.sum(f"_s{n}").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_a{n}")
               for n in spans_n],
        F.lead("d").over(w).alias("_nd"),
        F.max(F.when(F.col("_start"), F.col("d"))).over(Window.partitionBy()).alias("_last"))
    upto = F.least(F.coalesce(F.date_sub("_nd", 1), F.col("d")), F.col("_last"))
    out = run.filter(F.col("d") <= F.col("_last")).select(
        F.explode(F.sequence("d", upto)).alias("date"),
        *[F.col(f"_a{n}").cast("long").alias(f"_a{n}") for n in spans_n])
    return out.select("date", F.col("_a1").alias("dau_count"),
                      *[F.col(f"_a{n}").alias(f"active_{n}d") for n in days])


def dau_growth(dau: DataFrame) -> DataFrame:
    """date, dau_count, prev_dau_count, dau_growth_pct (NULL when the
    previous day had no users or there is none).  One row per date."""
    prev = F.lag("dau_count").over(Window.orderBy("date"))
    d = dau.select("date", "dau_count", prev.alias("prev_dau_count"))
    return d.withColumn("dau_growth_pct", F.round(F.try_divide(
        (F.col("dau_count") - F.col("prev_dau_count")) * F.lit(100.0), F.col("prev_dau_count")), 2))


def mrr_cumulative(mrr: DataFrame) -> DataFrame:
    """date, net_mrr, cumulative_net_mrr (running sum over dates).  The
    input is a gold table (one row per date), so the unpartitioned window
    holds the calendar span, not the data."""
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return mrr.select("date", "net_mrr", F.round(F.sum("net_mrr").over(w), 2).alias("cumulative_net_mrr"))


def top_countries(sessions: DataFrame, n: int = 3) -> DataFrame:
    """date, country, sessions, rank: the n countries with most sessions per
    date (ties by country code).  Ranking runs on per-(date, country) counts,
    bounded by the country domain per date."""
    counts = (sessions_by_date_country(sessions).filter(F.col("country").isNotNull())
              .select("date", "country", F.col("n").alias("sessions")))
    w = Window.partitionBy("date").orderBy(F.desc("sessions"), F.asc("country"))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def trend(df: DataFrame, cols: Sequence[str], n: int = 30, date_col: str = "date") -> DataFrame:
    """Newest n rows by date (top-k: ``TakeOrderedAndProject``)."""
    return df.select(*cols).orderBy(F.desc(date_col)).limit(n)


def mrr_trend(mrr: DataFrame, n: int = 30) -> DataFrame:
    return trend(mrr, ["date", "total_mrr", "net_mrr", "new_mrr", "churned_mrr"], n)


def dau_mau_trend(dau: DataFrame, n: int = 30) -> DataFrame:
    """date, dau/wau/mau counts and stickiness ``dau * 100 / mau``."""
    ratio = F.round(F.try_divide(F.col("dau_count") * F.lit(100.0),
                                 F.nullif(F.col("mau_count"), F.lit(0))), 2)
    return (dau.select("date", "dau_count", "wau_count", "mau_count", ratio.alias("dau_mau_ratio"))
               .orderBy(F.desc("date")).limit(n))


def top_features(feature: DataFrame) -> DataFrame:
    """Re-aggregate feature adoption over all dates, most used first."""
    return (feature.groupBy("feature_name").agg(
                F.sum("total_uses").alias("total_uses"),
                F.sum("unique_users").alias("unique_users"),
                # 2-dp values averaged in decimal: exact, then rounded half-up.
                F.round(F.avg(F.col("avg_duration_seconds").cast("decimal(20,2)")), 2)
                 .cast("double").alias("avg_duration_secs"))
            .orderBy(F.desc("total_uses")))


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ("date",),
            tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest rows of a table (ties broken by ``tiebreak`` for a stable answer)."""
    return df.orderBy(*[F.desc(c) for c in order], *[F.asc(c) for c in tiebreak]).limit(n)


def new_vs_returning(dau: DataFrame) -> DataFrame:
    """date, dau_count, new_users, returning_users, new_user_pct."""
    pct = F.round(F.try_divide(F.col("new_users") * F.lit(100.0), F.nullif(F.col("dau_count"), F.lit(0))), 2)
    return dau.select("date", "dau_count", "new_users", "returning_users", pct.alias("new_user_pct"))


def plan_tiers(breakdown: DataFrame) -> DataFrame:
    """date, plan, uses, features_used from the long plan breakdown."""
    return breakdown.groupBy("date", "plan").agg(
        F.sum("cnt").alias("uses"), F.count_distinct("feature_name").alias("features_used"))


def device_split(session_quality: DataFrame) -> DataFrame:
    """date, device, session_pct (long form of the three device shares)."""
    long = session_quality.unpivot("date", ["mobile_pct", "desktop_pct", "tablet_pct"],
                                   "device", "session_pct")
    return long.select("date", F.regexp_replace("device", "_pct$", "").alias("device"), "session_pct")
