"""Column-level building blocks.  All are built-in Spark expressions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_rate(num: Column | str, den: Column | str, scale: int = 4) -> Column:
    """``round(num / den, scale)`` when ``den > 0``, else ``0.0``."""
    num, den = F.col(num) if isinstance(num, str) else num, F.col(den) if isinstance(den, str) else den
    return F.when(den > 0, F.round(num / den, scale)).otherwise(F.lit(0.0))


def strip_frame(value: Column | str, header_bytes: int = 5) -> Column:
    """Drop a fixed-size wire-format header (magic byte + schema id) from a
    binary payload; the remainder is the encoded record."""
    v = F.col(value) if isinstance(value, str) else value
    return v.substr(F.lit(header_bytes + 1), F.length(v) - F.lit(header_bytes))


def to_event_time(text: Column | str) -> Column:
    """ISO-8601 text (``...Z``, with or without fraction) -> TIMESTAMP.

    ``try_to_timestamp`` yields NULL for unparsable text instead of failing the
    job (ANSI mode is on by default)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(t)


def pick(index: Column, values: Sequence[str]) -> Column:
    """``values[index % len(values)]`` for a non-negative integer column."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, ((index % F.lit(len(values))) + F.lit(1)).cast("int"))


def json_map(entries: Column | str) -> Column:
    """JSON object of an array of (label, value) structs, labels ascending;
    ``"{}"`` if it is empty.  Labels must be unique."""
    return F.when(F.size(entries) > 0, F.to_json(F.map_from_entries(F.array_sort(entries)))).otherwise(F.lit("{}"))


def variant_rows(df: DataFrame, variant: str, key: str, value: str, value_type: str) -> DataFrame:
    """One row for each member of the object in the VARIANT column: the other
    columns, ``key`` and ``value``; rows without members give none."""
    members = df.sparkSession.tvf.variant_explode(F.col(variant).outer())
    return df.lateralJoin(members).select(
        *[c for c in df.columns if c != variant], F.col("key").alias(key),
        F.variant_get(F.col("value"), "$", value_type).alias(value))
