"""The corpus pipeline: toxicity, quality, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs.  All stages but
the last return the columns of documents; the last returns the packed pieces.
Models learn from the stage's own documents and the labels table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import bpe_codec, jaccard_join, packing, quality, secret_scan, toxicity
from strata.llm.common import materialise
from strata.llm.queries import byte_bpe, table

NEAR_DUPLICATE = jaccard_join.Rule(words=5, percent=80)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the quality classifier."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.keep_one_each(docs, NEAR_DUPLICATE)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return secret_scan.redact_secrets(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in training sequences."""
    lengths = bpe_codec.count_documents(docs, *byte_bpe())
    return packing.pack(materialise(lengths, "lengths"))


STAGES = [("toxicity", drop_toxic), ("quality_rules", keep_good), ("ngram_jaccard_join", drop_near_duplicates),
          ("secret_scan", redact_secrets), ("best_fit_packing", pack_sequences)]

# No stage can be stated whole in SQL; tests compare each with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
