"""Registered queries of the operators: thin, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (bpe_codec, conversation_repair, edit_counts, html_text, jaccard_join, lm_score, nearest, packing, quality, secret_scan,
                        term_search, token_planes, toxicity)
from strata.llm.common import materialise
from strata.session import work_dir

END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe() -> tuple[str, str]:
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), jaccard_join.Rule(words=4, percent=85))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip_digests(table(spark, sf_dir, "documents"), *byte_bpe())


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digests(table(spark, sf_dir, "documents"))


def op5_one_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.self_search(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, by its byte-level BPE length."""
    lengths = bpe_codec.count_documents(table(spark, sf_dir, "documents"), *byte_bpe())
    return packing.pack(materialise(lengths, "lengths"))


REPLACEMENTS = ["", " revised wording,", "é1", "\n", " 2024", "'s"]


def sample_edits(docs: DataFrame) -> DataFrame:
    """Three edits for every document, at places that hashes of its id choose."""
    def edit(k: int):
        h = F.xxhash64("doc_id", F.lit(k))
        start = F.pmod(h, F.coalesce(F.length("text"), F.lit(0)) + 1)
        return F.struct(start.alias("start"), (start + F.pmod(F.shiftright(h, 20), F.lit(60))).alias("end"),
                        F.element_at(F.array(*map(F.lit, REPLACEMENTS)),
                                     (F.pmod(F.shiftright(h, 40), F.lit(len(REPLACEMENTS))) + 1).cast("int")).alias("text"))

    return docs.withColumn("edits", F.array(*(edit(k) for k in range(3))))


def op8_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of every document, then three edits of each."""
    trees = edit_counts.build_trees(table(spark, sf_dir, "documents"), *byte_bpe())
    edited = edit_counts.apply_edits(sample_edits(trees), *byte_bpe())
    return edited.select("doc_id", "n_before", "n_tokens", "n_edits", "chars_encoded",
                         F.length("text").cast("long").alias("n_chars"), F.size("leaf_tokens").alias("n_leaves"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.classify(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op10_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-files")
    token_planes.write_token_files(table(spark, sf_dir, "documents"), path,
                                   public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return token_planes.read_digests(spark, path)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(table(spark, sf_dir, "conversations"))


def op12_term_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_search.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), k=50)


def op13_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_html_text, op2_jaccard_join, op3_byte_bpe, op4_secret_scan, op5_one_bit_codes,
                                    op6_best_fit_packing, op7_quality_rules, op8_edit_aware_counts, op9_toxicity,
                                    op10_token_planes, op11_conversation_repair,
                                    op12_term_search, op13_ppm_score)}
# The others can't be stated whole in SQL: tests compare each with a
# brute-force version, an exact round trip or held-out labels.
TERM_SEARCH_SQL = r"""
WITH rows AS MATERIALIZED (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
lengths AS (SELECT row, doc_id, len(terms) AS n FROM rows WHERE len(terms) > 0),
whole AS (SELECT count(*) AS all_docs, sum(n)::BIGINT AS all_terms FROM lengths),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM rows) GROUP BY ALL),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(all_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM tf, whole WHERE term IN (SELECT term FROM asked) GROUP BY term),
scores AS (
    SELECT item_id, row, any_value(doc_id) AS doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * all_docs) // all_terms)))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (row), whole
    GROUP BY item_id, row)
SELECT item_id, rank, doc_id, score
FROM (SELECT item_id, doc_id, score,
             row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank
      FROM scores WHERE score > 0)
WHERE rank <= 50
"""
ORACLES: dict[str, str] = {"op12_term_search": TERM_SEARCH_SQL}
