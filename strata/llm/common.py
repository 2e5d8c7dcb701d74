"""Shared helpers: column selection, Arrow maps, shared-storage tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import work_dir


SLICE = 1000


def pick(df: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast; whatever else ``df`` has, clashing names
    included, is pruned before any work."""
    return df.select(*(F.col(c).cast(t).alias(c) for c, t in types.items()))


def arrow_map(df: DataFrame, row_fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``row_fn`` turns a record batch into a dict of columns (name -> list or
    Arrow array); batches stream, so a task holds one batch at a time, and what
    it returns is made for ``SLICE`` rows at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    want = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                cols = row_fn(batch.slice(at, SLICE))
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type)
                     for f, c in ((f, cols[f.name]) for f in want)], schema=want)

    return df.mapInArrow(run, schema)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the cluster's shared folder and read back: cuts the lineage,
    so that a lost executor costs one read and not a recomputation."""
    spark = df.sparkSession
    path = f"{work_dir(spark, name)}/data"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
