"""Post-load data-quality checks over a set of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed status texts of the duplicate report.
STATUS_OK = "✅ No Duplicates"
STATUS_DUP = "❌ Duplicates Found"


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def check_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, row_count -- one global aggregate per table, unioned."""
    return _union([df.agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(name).alias("table_name"), "row_count")
                   for name, df in tables.items()])


def check_duplicates(tables: Mapping[str, DataFrame],
                     keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """table_name, total_rows, unique_keys, status.  Composite keys are
    counted as tuples (no string concatenation, so no collisions)."""
    frames = []
    for name, df in tables.items():
        k = list(keys[name])
        frames.append(df.agg(F.count(F.lit(1)).alias("total_rows"),
                             F.count_distinct(*[F.col(c) for c in k]).alias("unique_keys"))
                      .select(F.lit(name).alias("table_name"), "total_rows", "unique_keys",
                              F.when(F.col("total_rows") == F.col("unique_keys"), F.lit(STATUS_OK))
                               .otherwise(F.lit(STATUS_DUP)).alias("status")))
    return _union(frames)


def check_latest_date(tables: Mapping[str, DataFrame], date_col: str = "date") -> DataFrame:
    """table_name, latest_date."""
    return _union([df.agg(F.max(date_col).alias("latest_date"))
                     .select(F.lit(name).alias("table_name"), "latest_date")
                   for name, df in tables.items()])
