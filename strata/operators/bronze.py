"""Bronze: raw messages -> append-only table; decode and contract split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas
from strata.functions.columns import strip_frame, to_event_time


def to_bronze(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Project broker rows to the bronze layout with ingestion metadata.

    ``ingested_at`` defaults to ``current_timestamp()``; a replay passes a
    column (e.g. the broker timestamp) to make the output reproducible."""
    now = ingested_at if ingested_at is not None else F.current_timestamp()
    return messages.select(
        F.col("value").cast("binary").alias("value"),
        now.alias("ingested_at"),
        F.col("offset").alias("kafka_offset"),
        F.col("partition").alias("kafka_partition"),
        F.col("topic").alias("kafka_topic"),
        F.to_date(now).alias("processing_date"),
    )


CORRUPT = "_corrupt_record"


def decode_payload(bronze: DataFrame, schema: T.StructType = schemas.RAW_EVENT,
                   decoder: str = "json", header_bytes: int = 5,
                   avro_schema: str | None = None) -> DataFrame:
    """Strip the wire-format header and decode the record into ``data``.

    Decoding is permissive: a payload that cannot be decoded yields a NULL
    ``data`` (or NULL fields) instead of failing the micro-batch; the
    contract split routes those rows to the dead-letter output.  The JSON
    decoder also keeps its corrupt-record marker, so that a value of the wrong
    type is seen although its field reads NULL.  ``payload`` keeps the original
    for the DLQ: the text of a JSON payload, the base64 of an Avro one."""
    body = strip_frame("value", header_bytes)
    if decoder == "json":
        marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        data = F.from_json(body.cast("string"), marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
        payload = body.cast("string")
    elif decoder == "avro":  # needs the spark-avro module on the classpath
        from pyspark.sql.avro.functions import from_avro
        data = from_avro(body, avro_schema, {"mode": "PERMISSIVE"})
        payload = F.base64(body)
    else:
        raise ValueError(f"unknown decoder {decoder!r}")
    # explode(array(x)) emits exactly one row per message and pins the
    # decode: the parser runs once per row, and predicates on ``data``
    # (contract checks) are not pushed below it, where each field reference
    # would re-run the parser inside a non-codegen Filter.
    return bronze.select("*", payload.alias("payload"), F.explode(F.array(data)).alias("data"))


def contract_error(data: T.StructType, required: Sequence[str] = schemas.REQUIRED_EVENT_FIELDS) -> Column:
    """Text of the first contract violation of a decoded row, NULL if valid.
    Only the decoder's result is judged, whatever the payload looks like;
    ``data`` is its type."""
    d = F.col("data")
    err = F.when(d.isNull(), F.lit("undecodable payload"))
    if CORRUPT in data.fieldNames():
        empty = F.coalesce(*[d[name].cast("string") for name in required]).isNull()
        err = (err.when(d[CORRUPT].isNotNull() & empty, F.lit("undecodable payload"))
               .when(d[CORRUPT].isNotNull(), F.lit("value of the wrong type")))
    for name in required:
        err = err.when(d[name].isNull(), F.lit(f"missing required field: {name}"))
    return err.when(to_event_time(d["timestamp"]).isNull(), F.lit("unparsable timestamp"))


def tag_contract(decoded: DataFrame, required: Sequence[str] = schemas.REQUIRED_EVENT_FIELDS) -> DataFrame:
    """Decoded rows with ``error``."""
    return decoded.withColumn("error", contract_error(decoded.schema["data"].dataType, required))


def split_contract(decoded: DataFrame,
                   required: Sequence[str] = schemas.REQUIRED_EVENT_FIELDS
                   ) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected).  Both are lazy filters of one tagged frame, so a
    caller writing both should persist or use ``foreachBatch`` once."""
    tagged = tag_contract(decoded, required)
    valid = tagged.filter(F.col("error").isNull()).drop("error")
    rejected = tagged.filter(F.col("error").isNotNull())
    return valid, rejected


def dead_letters(rejected: DataFrame) -> DataFrame:
    """DLQ record: message coordinates, event id if readable, original
    payload text and the error."""
    return rejected.select(
        "kafka_topic", "kafka_partition", "kafka_offset",
        F.col("data.event_id").alias("event_id"),
        F.col("payload"), F.col("error"), "ingested_at")
