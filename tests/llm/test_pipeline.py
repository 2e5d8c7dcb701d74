import re

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from strata.llm import bpe_codec, jaccard_join, quality, queries, secret_scan, toxicity

from .test_jaccard import brute
from .test_tokens import brute_base

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output, written and read as the contract says."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(P.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_stage_names_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "quality_rules", "ngram_jaccard_join", "secret_scan", "best_fit_packing"]
    assert all(after.columns == COLUMNS for _, after in stages[:-1])


def test_toxicity_stage(spark, stages):
    before, after = stages[0]
    model = toxicity.train(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert rows(after) == [r for r in rows(before) if model.scorer().score(r[1]) < 0.5]


def test_quality_stage(spark, stages):
    before, after = stages[1]
    model = quality.train(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert rows(after) == [r for r in rows(before) if model.judge(r[1], quality.KEEP_AT)["kept"]]


def test_near_duplicate_stage(stages):
    before, after = stages[2]
    found = brute([(r[0], r[1]) for r in rows(before)], jaccard_join.Rule(5, 80))
    keep = {d for d, n, c in found if c == d}
    assert rows(after) == [r for r in rows(before) if r[0] in keep]
    assert {c for _, _, c in found} == {r[0] for r in rows(after)}


def test_secret_stage(stages):
    before, after = stages[3]
    assert {r[0] for r in rows(before)} == {r[0] for r in rows(after)}
    old = {r[0]: r for r in rows(before)}
    for r in rows(after):
        text = old[r[0]][1]
        spans = secret_scan.scan(text)
        assert (r[1] == text) == (not spans) and r[4] == len(r[1])
        assert not re.search("AKIA[A-Z0-9]{16}", r[1]) and not [s for s in brute_base(r[1]) if not s.startswith("assign")]


def test_packing_stage(stages):
    before, after = stages[4]
    enc = bpe_codec.load_encoding(*queries.byte_bpe())
    want = {r[0]: len(enc.encode_ordinary(r[1])) for r in rows(before)}
    got = {r.doc_id: r.n for r in after.groupBy("doc_id").agg(F.sum("n").alias("n")).collect()}
    assert got == {d: n for d, n in want.items() if n}
    load = after.groupBy("bin_id", "bin_length").agg(F.sum("n").alias("n")).collect()
    assert all(r.n <= r.bin_length for r in load) and len({r.bin_id for r in load}) == len(load)


def test_run_equals_the_stages(spark, stages):
    got = P.run(spark, SF)
    assert got.columns == stages[-1][1].columns
    assert got.agg(F.sum("n"), F.count("*")).first() == stages[-1][1].agg(F.sum("n"), F.count("*")).first()


def test_stages_take_odd_and_empty_rows(spark, make_docs, odd_texts):
    for docs in (make_docs(odd_texts), make_docs([])):
        for _, stage in P.STAGES:
            stage(spark, docs, SF).collect()
