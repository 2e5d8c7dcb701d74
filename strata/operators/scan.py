"""Skew-safe ordered scan within a key: forward fill ("last non-null value so
far") and lead ("next row's value"), in the JVM.

A per-key ``Window`` puts every row of a key into one task; if one key holds
a third of the data, that task holds a third of the data.  Here the rows of a
key are split by a *bucket* that grows with the scan order: the hour of the
first order column, and within an hour that holds more than ``HOT_ROWS`` rows
of the key, one of ``SPLITS`` parts whose edges are approximate quantiles of
the times measured there:

1. windows over (key, bucket, part) resolve everything inside a part;
2. each part is also combined, on the map side first, to one summary row (its
   first and last values), and a window over a key's summaries -- bounded by
   the number of parts, not by the rows -- carries values across parts;
3. the carried values are joined back, one summary row for many rows, on the
   partitioning that the windows already have.

Rows of one instant stay in one part.  The input is checkpointed first (in the
shared ``spark.checkpoint.dir``), as rows and summaries both need it; callers
pass narrow frames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import checkpoint_root

HOT_ROWS = 100_000
SPLITS = 256
SALTS = 64


def hour_bucket(order: str) -> Column:
    """Hour of a timestamp column; rows without one come first."""
    return F.coalesce(F.date_trunc("hour", order), F.lit("0001-01-01").cast("timestamp"))


def with_parts(rows: DataFrame, counted: DataFrame, key: str, time: str | None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``rows`` (with bucket ``_b``) and the part ``_s`` of their bucket: 0,
    unless the (key, bucket) holds more than ``hot_rows`` rows.  ``counted`` are
    the same rows, or their narrow columns alone; ``time`` is the timestamp
    whose quantiles are the edges (None: nothing is split)."""
    if time is None:
        return rows.withColumn("_s", F.lit(0))
    checkpoint_root(rows.sparkSession)
    narrow = counted.filter(F.col(key).isNotNull()).select(key, "_b", F.unix_micros(time).alias("_at"))
    hot = (narrow.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
           .select(key, "_b").checkpoint(eager=True))  # fewer than rows / hot_rows
    if hot.isEmpty():
        return rows.withColumn("_s", F.lit(0))
    edges = (narrow.join(hot, [key, "_b"], "left_semi").groupBy(key, "_b")
             .agg(F.percentile_approx("_at", [i / SPLITS for i in range(1, SPLITS)], 10_000).alias("_edges")))
    part = F.size(F.filter("_edges", lambda e: e < F.unix_micros(time)))
    # the edges of a hot bucket go to SALTS tasks, so that its rows never meet in one
    salted = edges.withColumn("_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    return (rows.withColumn("_salt", F.pmod(F.xxhash64(time), F.lit(SALTS)).cast("int")).join(salted, [key, "_b", "_salt"], "left")
            .withColumn("_s", F.when(F.col("_edges").isNull(), 0).otherwise(part)).drop("_edges", "_salt"))


def scan_within_key(df: DataFrame, key: str, order: Sequence[str],
                    fill: Sequence[str] = (), lead: Mapping[str, str] | None = None,
                    inclusive: bool = True, descending: bool = False,
                    bucket: Column | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Ordered scan within ``key``.

    * ``fill``: replace each column by the last non-null value among rows of
      the same key up to this row in ``order`` (``inclusive=False``:
      strictly before it);
    * ``lead``: ``{out: src}`` adds ``out`` = the next row's ``src`` within
      the key (NULL for the key's last row).

    ``order`` must be a total order within a key (append a unique id);
    ``descending`` scans in reverse order.  ``bucket`` must not decrease along
    ``order`` (whatever its direction); own buckets are not split.  Rows with a NULL key are returned
    unchanged (lead columns NULL)."""
    fill, lead = list(fill), dict(lead or {})
    checkpoint_root(df.sparkSession)
    base = df.withColumn("_b", bucket if bucket is not None else hour_bucket(order[0])).checkpoint(eager=True)
    types = {f.name: f.dataType for f in df.schema.fields}
    nulls = base.filter(F.col(key).isNull()).select(
        *df.columns, *[F.lit(None).cast(types[src]).alias(out) for out, src in lead.items()])
    body = base.filter(F.col(key).isNotNull())
    body = with_parts(body, body, key, order[0] if bucket is None else None, hot_rows)

    def sort(c: str) -> Column:
        return F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first()

    # order of rows as one struct; min_by / max_by take the first / last row
    place = F.struct(*order)
    first, last = (F.max_by, F.min_by) if descending else (F.min_by, F.max_by)
    sums = body.groupBy(key, "_b", "_s").agg(
        *[last(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(f"_t_{c}") for c in fill],
        *[first(F.struct(src), place).alias(f"_h_{out}") for out, src in lead.items()])
    along = Window.partitionBy(key).orderBy(sort("_b"), sort("_s"))
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(
        key, "_b", "_s",
        *[F.last(f"_t_{c}", ignorenulls=True).over(before).alias(f"_c_{c}") for c in fill],
        *[F.lead(f"_h_{out}").over(along).alias(f"_n_{out}") for out in lead])

    own = Window.partitionBy(key, "_b", "_s").orderBy(*map(sort, order))
    upto = own.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = body.select(
        "*", *[F.last(c, ignorenulls=True).over(upto).alias(f"_f_{c}") for c in fill],
        *[F.lead(F.struct(src)).over(own).alias(f"_l_{out}") for out, src in lead.items()])
    joined = local.join(carry, [key, "_b", "_s"])
    done = joined.select(
        *[F.coalesce(f"_f_{c}", f"_c_{c}").alias(c) if c in fill else F.col(c) for c in df.columns],
        *[F.coalesce(f"_l_{out}", f"_n_{out}")[src].alias(out) for out, src in lead.items()])
    return done.unionByName(nulls)


def fill_within_key(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str],
                    inclusive: bool = True, descending: bool = False, bucket: Column | None = None) -> DataFrame:
    """Forward fill only (see :func:`scan_within_key`)."""
    return scan_within_key(df, key, order, fill=cols, inclusive=inclusive, descending=descending, bucket=bucket)
