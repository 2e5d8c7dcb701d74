import math
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import queries
from strata.llm import term_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall((text or "").translate(str.maketrans(S.UPPER, S.LOWER)))


def plain(items, docs, k):
    counted = [(i, Counter(terms_of(t)), len(terms_of(t))) for i, t in docs]
    n_docs, n_terms = sum(n > 0 for _, _, n in counted), sum(n for _, _, n in counted)
    df = Counter(w for _, c, _ in counted for w in c)
    asked, out = {}, []
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    for item, words in asked.items():
        scores = []
        for i, c, n in counted:
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                        * ((1000000000 * c[w]) // (1000 * c[w] + 20 * (50 + (50 * n * n_docs) // n_terms))) for w in words & set(c))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def make_items(spark, pairs):
    return spark.createDataFrame(pairs, "item_id long, text string").withColumns({c: F.lit("lit") for c in ("rank", "slot", "bundle", "w")})


def test_against_plain_version(spark, make_docs):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choice(words, n, p=(p := 1 / np.arange(1, 61)) / p.sum()))
    docs = [(i, text(int(rng.integers(1, 40)))) for i in range(300)] + [(7, "w1 w59"), (7, "w1 w59"), (None, "w1 w59"), (400, None), (401, "")]
    items = [(i, text(6)) for i in range(9)] + [(0, "W3, w4"), (None, "w59"), (50, None), (51, "unheard"), (52, "w0" * 3)]
    for block_docs in (16, 8192):
        got = S.search(make_items(spark, items), make_docs(docs), k=5, block_docs=block_docs)
        assert rows_of(got) == plain(items, docs, 5)


def test_vocabulary_that_is_not_sent(spark, make_docs, odd_texts):
    items = [(1, "one word 12"), (2, "日本語 naïve a")]
    docs = odd_texts
    sent = rows_of(S.search(make_items(spark, items), make_docs(docs), k=3))
    assert sent == plain(items, docs, 3)
    assert rows_of(S.search(make_items(spark, items), make_docs(docs), k=3, vocabulary_bytes=0)) == sent


def test_empty_tables(spark, make_docs):
    assert S.search(make_items(spark, []), make_docs([(1, "a b")])).count() == 0
    assert S.search(make_items(spark, [(1, "a")]), make_docs([])).count() == 0
    assert S.search(make_items(spark, [(1, "a")]), make_docs([(1, None), (2, "")])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=30), st.lists(st.integers(0, 4), min_size=30, max_size=30), st.integers(1, 5))
def test_pruning_keeps_the_best(now, later, k):
    """With gains of at most 4 to come, a dropped accumulator is never among
    the k best, whatever it would still have got."""
    now = np.array([now], np.int64)
    final = now[0] + np.array(later[:now.shape[1]])
    keep = S.keep_promising(now, np.array([4]), k)[0]
    dropped = final[(now[0] > 0) & ~keep]
    assert not len(dropped) or dropped.max() < np.sort(final)[-k]


def test_query_equals_its_sql(spark, duck):
    got = rows_of(queries.op12_term_search(spark, "/root/testdata/sf0.001"))
    want = sorted(duck.execute(queries.ORACLES["op12_term_search"]).fetchall(), key=str)
    assert got == want and got
