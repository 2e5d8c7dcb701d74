"""Batch and stream readers for tables, message streams and staged exports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas

ROW_GROUP_BYTES = 8 << 20  # of files of messages: as many tasks decode a file as it has row groups


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Batch read of ``<root>/<name>.parquet`` (or a table folder)."""
    path = f"{root.rstrip('/')}/{name}.parquet" if fmt == "parquet" and not name.endswith("/") else f"{root.rstrip('/')}/{name}"
    return spark.read.format(fmt).load(path)


def read_silver_events(spark: SparkSession, path: str,
                       dates: tuple[str, str] | None = None) -> DataFrame:
    """Silver events table (partitioned by ``processing_date``); a date range
    becomes a partition filter, so only those folders are listed and read."""
    df = spark.read.parquet(path)
    if dates:
        df = df.filter(F.col("processing_date").between(F.lit(dates[0]).cast("date"),
                                                        F.lit(dates[1]).cast("date")))
    return df.select(*schemas.SILVER_EVENT_COLUMNS)


def read_event_stream(spark: SparkSession, fmt: str = "kafka",
                      options: Mapping[str, str] | None = None,
                      schema: T.StructType | None = None,
                      path: str | None = None) -> DataFrame:
    """Message-stream source.

    With ``fmt="kafka"`` this is a subscription (``subscribe``,
    ``startingOffsets=earliest`` and any SASL options passed in ``options``).
    Any other streaming format carrying the same columns (``key value topic
    partition offset timestamp timestampType``) is a drop-in replacement, e.g.
    Parquet files replayed from a message archive."""
    opts = {"startingOffsets": "earliest"} if fmt == "kafka" else {}
    opts.update(options or {})
    reader = spark.readStream.format(fmt).options(**opts)
    if fmt != "kafka":
        reader = reader.schema(schema or schemas.MESSAGE)
    elif schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def read_table_stream(spark: SparkSession, path: str, schema: T.StructType,
                      fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream over a table folder (new files become new micro-batches)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def read_stage(spark: SparkSession, path: str, schema: T.StructType,
               pattern: str = "*.parquet") -> DataFrame:
    """Typed projection of a staged Parquet export.

    Each target column is read and cast to its declared type; a column the
    files do not carry becomes a typed NULL (the warehouse schema may be wider
    than what the export writes)."""
    raw = spark.read.option("pathGlobFilter", pattern).parquet(path)
    have = set(raw.columns)
    cols = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    return raw.select(*cols)


def stage_files(spark: SparkSession, stages: Mapping[str, str],
                pattern: str = "*.parquet") -> DataFrame:
    """File listing of staged exports: one row per (stage, file) with size
    and row count, from the scan's hidden ``_metadata`` column."""
    out = None
    for name, path in stages.items():
        df = (spark.read.option("pathGlobFilter", pattern).parquet(path)
              .select(F.col("_metadata.file_name").alias("file_name"),
                      F.col("_metadata.file_size").alias("file_size"))
              .groupBy("file_name", "file_size").agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("stage"), "file_name", "file_size", "row_count"))
        out = df if out is None else out.unionByName(df)
    return out
