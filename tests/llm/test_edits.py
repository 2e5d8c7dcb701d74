import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import bpe_codec, edit_counts, queries

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
piece = st.text(alphabet=st.sampled_from(list("abz19 \n'sé.,!日 ")), max_size=25)


def apply_plainly(text, edits):
    for start, end, new in edits:
        start = min(max(start, 0), len(text))
        end = min(max(end, start), len(text))
        text = text[:start] + new + text[end:]
    return text


@settings(max_examples=300, deadline=None)
@given(st.lists(piece, max_size=8).map("".join), st.lists(st.tuples(st.integers(-3, 220), st.integers(-3, 220), piece), max_size=8))
def test_counts_follow_edits(text, edits):
    enc = bpe_codec.load_encoding(RANKS, PATTERN)
    size, edit_counts.LEAF_CHARS = edit_counts.LEAF_CHARS, 6
    try:
        tree = edit_counts.CountTree(enc, text)
        assert tree.n_tokens == len(enc.encode_ordinary(text))
        for i, e in enumerate(edits):
            tree.edit(*e)
            now = apply_plainly(text, edits[:i + 1])
            assert (tree.text(), tree.n_chars, tree.n_tokens) == (now, len(now), len(enc.encode_ordinary(now)))
        sizes, tokens = tree.state()
        again = edit_counts.CountTree(enc, tree.text(), tokens or [0], sizes or [0])
        assert again.n_tokens == tree.n_tokens and sum(sizes) == tree.n_chars
    finally:
        edit_counts.LEAF_CHARS = size


@pytest.mark.parametrize("words", ["word and number 12, ", "слово и число 12 ", "言葉と数。"])
def test_only_touched_leaves_are_encoded(words):
    enc = bpe_codec.load_encoding(RANKS, PATTERN)
    text = words * (400_000 // len(words))
    tree = edit_counts.CountTree(enc, text)
    tree.edit(200000, 200010, "changed")
    assert tree.encoded < 4 * edit_counts.LEAF_CHARS
    assert tree.n_tokens == len(enc.encode_ordinary(tree.text()))


def test_tables_and_edge_rows(spark, make_docs, odd_texts):
    enc = bpe_codec.load_encoding(RANKS, PATTERN)
    trees = edit_counts.build_trees(make_docs(odd_texts), RANKS, PATTERN)
    edits = [(2, 5, "new 1"), None, (None, None, None), (10**6, 10**7, " end"), (4, 1, "x")]
    rows = F.expr("array(named_struct('start', 2L, 'end', 5L, 'text', 'new 1'), null, named_struct('start', null, 'end', null, 'text', null),"
                  " named_struct('start', 1000000L, 'end', 10000000L, 'text', ' end'), named_struct('start', 4L, 'end', 1L, 'text', 'x'))")
    got = edit_counts.apply_edits(trees.withColumn("edits", rows), RANKS, PATTERN).collect()
    plain = [(e[0] or 0, e[1] or 0, e[2] or "") for e in edits if e]
    want = sorted((str(i), apply_plainly(t or "", plain)) for i, t in odd_texts)
    assert sorted((str(r.doc_id), r.text) for r in got) == want
    assert all(r.n_tokens == len(enc.encode_ordinary(r.text)) and r.n_edits == 4 for r in got)
    none = edit_counts.apply_edits(trees.withColumn("edits", F.lit(None)), RANKS, PATTERN).collect()
    assert all(r.n_tokens == r.n_before and r.chars_encoded == 0 for r in none) and len(none) == len(odd_texts)
    assert edit_counts.build_trees(make_docs([]), RANKS, PATTERN).collect() == []


def test_query_against_full_encoding(spark):
    sf = "/root/testdata/sf0.001"
    enc = bpe_codec.load_encoding(RANKS, PATTERN)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: (r.text, r.edits) for r in queries.sample_edits(docs).collect()}
    got = queries.QUERIES["op8_edit_aware_counts"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        text, edits = texts[r.doc_id]
        after = apply_plainly(text, [(e.start, e.end, e.text) for e in edits])
        assert (r.n_before, r.n_tokens, r.n_chars) == (len(enc.encode_ordinary(text)), len(enc.encode_ordinary(after)), len(after))
