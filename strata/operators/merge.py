"""Typed conformance and keyed upsert (MERGE) as DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast and reorder to ``schema``; columns the frame lacks become typed
    NULLs, extra columns are dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def unique_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``DISTINCT`` source rows, failing the job if a key still has two
    different rows (such a MERGE would be ambiguous).  The check is a lazy
    count per key with map-side combine, so a key with very many rows is
    counted down before the shuffle and the job fails fast."""
    keys = list(keys)
    rest = [c for c in source.columns if c not in keys]
    d = source.distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                             F.first(F.struct(F.lit(0).alias("_"), *rest)).alias("_r"))
    ok = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"merge source has duplicate keys on {keys}"))) \
          .otherwise(F.lit(True))
    return d.filter(ok).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*source.columns)


def evolved_schema(target: T.StructType, source: T.StructType) -> T.StructType:
    """The target's columns, then the source's new ones (additive evolution)."""
    have = set(target.fieldNames())
    return T.StructType([*target.fields, *(f for f in source.fields if f.name not in have)])


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 update_cols: Sequence[str] | None = None) -> DataFrame:
    """MERGE INTO target USING (SELECT DISTINCT * FROM source) ON keys:
    matched rows take the source value of ``update_cols`` (other columns
    keep the target's value), unmatched source rows are inserted, target rows
    without a match are kept.  Columns that only the source has are added:
    set on inserted rows and, as the target has no value to keep, on matched
    ones, NULL elsewhere."""
    keys = list(keys)
    schema = evolved_schema(target.schema, source.schema)
    cols = [c for c in schema.fieldNames() if c not in keys]
    upd = set(cols if update_cols is None else update_cols) | (set(cols) - set(target.columns))
    s = unique_source(conform(source, schema), keys)
    t = conform(target, schema).select(*keys, *cols, F.lit(True).alias("_t"))
    s = s.select(*[F.col(k).alias(f"_s_{k}") for k in keys],
                 *[F.col(c).alias(f"_s_{c}") for c in cols], F.lit(True).alias("_s"))
    cond = [t[k].eqNullSafe(s[f"_s_{k}"]) for k in keys]
    j = t.join(s, cond, "full_outer")
    matched_src = F.col("_s").isNotNull()
    matched_tgt = F.col("_t").isNotNull()
    out = [F.when(matched_src, F.col(f"_s_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    for c in cols:
        if c in upd:
            out.append(F.when(matched_src, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(matched_tgt, F.col(c)).otherwise(F.col(f"_s_{c}")).alias(c))
    return j.select(*out).select(*schema.fieldNames())
