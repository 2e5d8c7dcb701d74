"""Writers: snapshots, exports, partitions owned by a micro-batch, keyed MERGE.

All tables are plain Parquet folders.  What has to be replaced is replaced by
dynamic partition overwrite, so a write touches the partitions it has rows for
and no others; a micro-batch owns its partitions, so that its replay writes the
same files' rows again and adds none.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.merge import evolved_schema, merge_upsert


def _rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Cluster rows by the output partition columns before a partitioned
    write (few files per partition value instead of one per task and value).
    ``REBALANCE`` lets AQE split a hot value (a date holding a third of the
    data) into several advisory-size tasks and merge small ones."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                   compression: str = "snappy") -> str:
    """Overwrite ``path`` with ``df`` (schema replaced, all partitions)."""
    w = (_rebalanced(df, partition_by).write.mode("overwrite").option("compression", compression)
         .option("partitionOverwriteMode", "static"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                         compression: str = "snappy", static: bool = False) -> str:
    """Replace only the partitions present in ``df`` (dynamic overwrite),
    e.g. the dates recomputed after late data; with ``static`` all of them."""
    (_rebalanced(df, partition_by).write.mode("overwrite").option("compression", compression)
       .option("partitionOverwriteMode", "static" if static else "dynamic").partitionBy(*partition_by).parquet(path))
    return path


def _files(spark: SparkSession, path: str, column: str, values: Sequence) -> dict:
    """Names of the files in the partitions of ``values``."""
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = {v: Path(f"{path}/{column}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}") for v in values}
    return {v: (fs, p, {f.getPath().getName() for f in fs.listStatus(p)}) for v, p in folders.items() if fs.exists(p)}


def replace_partitions(df: DataFrame, path: str, column: str, values: Sequence) -> str:
    """The partitions of ``values`` become the rows of ``df``, which has no
    others: those it has rows for are overwritten, the rest of them removed (a
    dynamic overwrite alone would leave their old rows)."""
    spark = df.sparkSession
    before = _files(spark, path, column, values)
    overwrite_partitions(df, path, [column])
    for v, (fs, folder, names) in _files(spark, path, column, values).items():
        if v in before and before[v][2] == names:
            fs.delete(folder, True)
    return path


def export_tables(tables: Mapping[str, DataFrame], base: str) -> dict[str, str]:
    """Plain Parquet export, one fixed folder per table (overwritten each run)."""
    return {name: write_snapshot(df, f"{base.rstrip('/')}/{name}/") for name, df in tables.items()}


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> str:
    """Idempotent append: micro-batch ``batch_id`` owns the partitions
    ``.../batch=<batch_id>``; its replay overwrites them instead of adding rows."""
    return overwrite_partitions(df.withColumn("batch", F.lit(batch_id)), path, [*partition_by, "batch"])


def make_folder(spark: SparkSession, path: str) -> str:
    """An empty folder, so that readers find a table before its first write."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    return path


def read_folder(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """Rows of a table written by :func:`write_batch` or
    :func:`overwrite_partitions`; none while nothing is written.  ``before``:
    only rows of earlier batches (what a replayed batch may look at)."""
    fields = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())]) if before is not None else schema
    df = spark.read.schema(fields).parquet(make_folder(spark, path))
    return (df if before is None else df.filter(F.col("batch") < before)).select(*schema.fieldNames())


def one_of(column: str, values: Sequence) -> Column:
    """Whether the column is one of ``values``, NULL among them; on a partition
    column it is a partition filter."""
    known = [v for v in values if v is not None]
    test = F.col(column).isin(known)
    return (test | F.col(column).isNull()) if len(known) < len(values) else test


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The table that :func:`merge_into` keeps; columns that were added later
    are NULL in older partitions."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.option("mergeSchema", "true").parquet(path)


def merge_plan(current: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str] | None = None,
               partition: str = "date") -> DataFrame:
    """The rows of the touched partitions after the MERGE.  ``partition`` is one
    of ``keys``, so a source row can only match in its own partition: the target
    is read and joined there alone.  The list of touched partition values (at
    most one a calendar day) becomes a partition filter."""
    values = [r[0] for r in source.select(partition).distinct().collect()]
    schema = evolved_schema(current.schema, source.schema)
    return merge_upsert(current.filter(one_of(partition, values)), source, keys, update_cols).select(*schema.fieldNames())


def merge_into(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
               update_cols: Sequence[str] | None = None, partition: str = "date") -> DataFrame:
    """Keyed upsert of ``source`` into the table at ``path``, which is
    partitioned by ``partition``: touched partitions are replaced, all others
    keep their files.  Returns the table, columns in its order.  The first load
    merges into an empty table, so it checks the source's keys alike."""
    if partition not in keys:
        raise ValueError(f"the partition column {partition} must be one of the keys {list(keys)}")
    current = read_current(spark, path)
    if current is None:
        current = spark.createDataFrame([], source.schema)
    types = {f.name: f.dataType for f in source.schema}
    current = current.withColumn(partition, F.col(partition).cast(types[partition]))
    merged = merge_plan(current, source, keys, update_cols, partition)
    overwrite_partitions(merged, path, [partition])
    columns = [*source.columns, *(c for c in merged.columns if c not in source.columns)]
    return read_current(spark, path).withColumn(partition, F.col(partition).cast(types[partition])).select(*columns)
