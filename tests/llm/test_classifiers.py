import zlib
from types import SimpleNamespace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import quality, queries, toxicity

SF = "/root/testdata/sf0.01"


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# -- quality ------------------------------------------------------------------

def brute_repeat(words):
    from collections import defaultdict
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i:i + 8])].append(i)
    return len({i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40))
def test_repeat_words_brute_force(words):
    import xxhash
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    assert quality.repeat_words(hashes) == brute_repeat(words)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab#é \n\t\x0b\x0c\r\x1c\x85\xa0|")), max_size=40))
def test_counts_brute_force(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    got = quality.Judge(quality.Model(None, 0, 1, 0)).judge(text, 0.5)
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i])
    assert [got[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] == [
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, brute_repeat(words)]


def test_quality_edge_rows(spark, make_docs, odd_texts):
    docs = make_docs(odd_texts)
    model = quality.train(docs, labels_of(spark, []))
    out = {(r.doc_id, r.n_words): r for r in quality.judge_documents(docs, model).collect()}
    assert len(out) == len(set(odd_texts)) and not out[1, 0].kept and not out[2, 0].kept
    assert out[6, 60000].base_failed and out[1, 0].base_failed
    assert quality.judge_documents(make_docs([]), model).collect() == []
    assert quality.keep_good(docs, model).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_learns(spark):
    rng = np.random.default_rng(1)
    good = [" ".join(rng.choice(["river", "stone", "light", "wind"], 40)) + f" {i}" for i in range(60)]
    bad = [" ".join(rng.choice(["river%%%", "stone$$$", "light&&&", "wind***"], 40)) + f" {i}" for i in range(60)]
    model = quality.fit([SimpleNamespace(doc_id=i, text=t, y=int(t in good)) for i, t in enumerate(good[:50] + bad[:50])])
    keep = [model.judge(t, quality.KEEP_AT)["probability"] >= quality.KEEP_AT for t in good[50:] + bad[50:]]
    assert keep == [True] * 10 + [False] * 10


def test_quality_word_order():
    """Texts of the same words, told apart by their order alone."""
    rng = np.random.default_rng(2)
    pairs = [["red", "river"], ["old", "stone"], ["low", "light"], ["dry", "wind"]]

    def text(i, turned):
        return " ".join(w for k in rng.integers(0, 4, 20) for w in (pairs[k][::-1] if turned else pairs[k])) + f" {i}"

    sample = [SimpleNamespace(doc_id=i, text=text(i, i % 2), y=1 - i % 2) for i in range(160)]
    model = quality.fit(sample)
    right = [(model.judge(text(i, i % 2), 0.5)["probability"] >= 0.5) == (i % 2 == 0) for i in range(40)]
    assert np.mean(right) >= 0.95


def test_word_grams():
    h = np.array([5, 6, 7, 5, 6], np.uint64)
    two, three = quality.word_grams(h, 2), quality.word_grams(h, 3)
    assert two[0] == two[3] and len(set(two.tolist())) == 3 and len(three) == 3
    assert quality.word_grams(h[:1], 2).tolist() == [] and quality.word_grams(h[::-1].copy(), 2)[0] != two[0]


# -- toxicity -----------------------------------------------------------------

def test_noisy_or_and_sentences():
    z = np.array([-1.0, 0.5, 2.0])
    assert toxicity.noisy_or(z) == pytest.approx(1 - np.prod(1 - 1 / (1 + np.exp(-z))))
    tokens = toxicity.tokens_of("One two. Three\nfour " + "x " * 85)
    starts = toxicity.sentence_starts(np.array([toxicity.ends(t) for t in tokens]))
    assert starts.tolist() == [0, 2, 4, 44, 84]


def toxic_docs(n, seed=0):
    rng = np.random.default_rng(seed)
    plain = [f"plain{k}" for k in range(50)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choice(plain, 8)) + "." for _ in range(6)]
        if i % 3 == 0:
            parts[3] = "you " + rng.choice(["vilebo", "vilera", "grobnik"]) + " thing."
        rows.append((i, " ".join(parts), int(i % 3 == 0)))
    return rows


def test_toxicity_learns_and_locates(spark, make_docs):
    rows = toxic_docs(300)
    model = toxicity.train(make_docs([r[:2] for r in rows]), labels_of(spark, [(i, 1, y) for i, _, y in rows]))
    fresh = toxic_docs(60, seed=9)
    docs = make_docs([r[:2] for r in fresh])
    got = {r.doc_id: r for r in toxicity.classify(docs, model).collect()}
    assert all(got[i].predicted == y for i, _, y in fresh)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in fresh)
    where = {r.doc_id: r.sentences for r in toxicity.locate(docs, model).collect()}
    for i, text, y in fresh:
        assert [text[s.start:s.end].startswith("you ") for s in where[i]] == [True] * y
    assert {r.doc_id for r in toxicity.drop_toxic(docs, model).collect()} == {i for i, _, y in fresh if not y}


@pytest.fixture(scope="module")
def noisy_model():
    """A tenth of the texts of label 1 have no word to learn from."""
    rows = toxic_docs(300) + [(300 + k, chr(97 + k) * 8, 1) for k in range(11)]
    return toxicity.fit([SimpleNamespace(doc_id=i, text=t, y=y) for i, t, y in rows])


@pytest.mark.parametrize("text", ["Plain7 plain9 words. " * 100_000, "plain3 word\n" * 100_000, "plain1.\n\n\n" * 100_000])
def test_length_alone_raises_no_score(noisy_model, text):
    scorer = noisy_model.scorer()
    assert scorer.score(text) == pytest.approx(scorer.score("plain7")) and scorer.score(text) < 0.5
    assert scorer.offending(text, 0.5) == []
    bad = "You vilebo thing. "
    assert scorer.score(text + bad) == pytest.approx(scorer.score(bad)) and scorer.score(bad) >= 0.5
    assert [text[-1:] + bad.strip()] == [(text + bad)[s["start"] - 1:s["end"]] for s in scorer.offending(text + bad, 0.5)]


def test_line_ends_alone_are_no_sentence(noisy_model):
    assert {noisy_model.scorer().score(t) for t in ("\n", "\n" * 100_000, " \n\t\n ", "", None)} == {0.0}


def test_held_out_labels_are_not_read(spark, make_docs):
    rows = toxic_docs(120)
    docs = make_docs([r[:2] for r in rows])
    flip = [(i, 1, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, _, y in rows]
    a = toxicity.train(docs, labels_of(spark, [(i, 1, y) for i, _, y in rows]))
    b = toxicity.train(docs, labels_of(spark, flip))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_toxicity_edge_rows(spark, make_docs, odd_texts):
    rows = toxic_docs(120)
    model = toxicity.train(make_docs([r[:2] for r in rows] + odd_texts),
                           labels_of(spark, [(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (7, None, None), (8, 1, 0), (8, 1, 0)]))
    docs = make_docs(odd_texts)
    out = toxicity.classify(docs, model).collect()
    assert len(out) == len(odd_texts) and all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in out if r.doc_id in (1, 2)} == {0.0}
    assert toxicity.classify(make_docs([]), model).collect() == []
    none = toxicity.train(docs, labels_of(spark, []))
    assert {round(r.score, 6) for r in toxicity.classify(docs, none).collect()} == {0.5}
    assert toxicity.locate(docs, none).filter(F.size("sentences") > 0).count() == 0


def test_sample_is_bounded_under_a_hot_id(spark, make_docs):
    from strata.llm.learning import labelled_sample
    docs = make_docs([(5, f"text {i}") for i in range(400)] + [(i, "x") for i in range(100)])
    sample = labelled_sample(docs, labels_of(spark, [(i % 100, 1, i % 2) for i in range(300)]), "toxic", 10)
    assert len(sample) == 20 and len({r.doc_id for r in sample}) == 20


def test_held_out_accuracy(spark):
    """On given rows: labels of fold 0 are never read in training."""
    scored = queries.QUERIES["op9_toxicity"](spark, SF)
    truth = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = scored.filter("held_out").join(truth, "doc_id").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.93


def test_quality_query(spark):
    judged = queries.QUERIES["op7_quality_rules"](spark, SF)
    truth = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = judged.filter("NOT base_failed").join(truth, "doc_id").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) > 0.95
    assert judged.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


@pytest.mark.parametrize("times", [1, 20])
def test_joined_clean_texts_score_as_the_worst_of_them(spark, times):
    from strata.llm.queries import table
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scorer = toxicity.train(docs, labels).scorer()
    clean = [r.text for r in docs.join(labels.filter("toxic = 0"), "doc_id").collect() if r.text]
    clean = [t for t in clean if scorer.score(t) < 0.5]
    worst = max(map(scorer.score, clean))
    assert len(clean) > 200
    assert scorer.score("\n".join(clean * times)) == pytest.approx(worst)


def test_offending_spans_are_in_the_result(spark):
    from strata.llm.queries import op9_toxicity, table
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    rows = op9_toxicity(spark, sf_dir).collect()
    assert any(r.predicted for r in rows)
    for r in rows:
        spans = [tuple(map(int, x.split(":"))) for x in r.offending.split(",") if x]
        assert bool(spans) == bool(r.predicted)
        assert all(0 <= a < b <= len(texts[r.doc_id]) for a, b in spans)
