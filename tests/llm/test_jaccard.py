import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import jaccard_join as J
from strata.llm import queries
from strata.llm.components import connected_components


def shingles(text, words):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(ws[i:i + words]) for i in range(max(1, len(ws) - words + 1))} if ws else set()


def brute(pairs, rule):
    """Every pair of texts is compared; for each row (doc_id, n, component)."""
    sets = [frozenset(shingles(t, rule.words)) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    at = defaultdict(list)
    for i, s in enumerate(sets):
        at[s].append(i)
        if s:
            root[find(i)] = find(at[s][0])
    for s, t in itertools.combinations([s for s in at if s], 2):
        if 100 * min(len(s), len(t)) >= rule.percent * max(len(s), len(t)):
            common = len(s & t)
            if 100 * common >= rule.percent * (len(s) + len(t) - common):
                root[find(at[s][0])] = find(at[t][0])
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            r = find(i)
            least[r] = d if least[r] is None else min(d, least[r])
    return sorted([(d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(pairs)], key=repr)


def run(make_docs, pairs, rule=J.Rule()):
    return sorted(map(tuple, J.jaccard_components(make_docs(pairs), rule).collect()), key=repr)


def families(n, seed):
    """Texts of many sizes with copies, near copies, and variants about the threshold."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(n):
        words = [r.choice(vocab) for _ in range(r.choice([1, 2, 3, 4, 5, 9, 12, 30, 60, 150, 400]))]
        out.append(" ".join(words))
        for _ in range(r.choice([0, 0, 1, 3, 8])):
            ws = list(words)
            for _ in range(max(1, int(len(ws) * r.choice([0.01, 0.02, 0.03, 0.04, 0.06])))):
                k = r.randrange(len(ws))
                ws[k:k + r.choice([0, 1])] = [r.choice(vocab)]
            out.append(" ".join(ws).upper() if r.random() < 0.2 else "\n".join(ws))
        if r.random() < 0.3:
            out.append("  ".join(words))
    r.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("seed,rule", [(1, J.Rule()), (2, J.Rule()), (3, J.Rule(5, 80)), (4, J.Rule(1, 60))])
def test_against_all_pairs(make_docs, seed, rule):
    pairs = families(60, seed)
    assert run(make_docs, pairs, rule) == brute(pairs, rule)


def test_one_large_family(make_docs, monkeypatch):
    """Over several blocks: variants of one text, each at its own distance."""
    monkeypatch.setattr(J, "BLOCK", 16)
    r = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    pairs = []
    for i in range(150):
        ws = list(base)
        for k in r.sample(range(200), r.randrange(1, 9)):
            ws[k] = f"x{i}.{k}"
        pairs.append((i, " ".join(ws)))
    assert run(make_docs, pairs) == brute(pairs, J.Rule())


def test_edge_rows(make_docs, odd_texts):
    pairs = odd_texts + [(20, "One"), (21, "a b c d"), (22, "A B C D"), (None, "a b c d"), (23, "é É"), (24, "É é"),
                         (25, "\x1c x"), (25, "\x1c x"), (26, None)]
    assert run(make_docs, pairs) == brute(pairs, J.Rule())
    assert run(make_docs, []) == []


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 900), st.integers(0, 10**6), st.sampled_from([J.Rule(), J.Rule(5, 80), J.Rule(1, 60), J.Rule(2, 95)]))
def test_every_pair_shares_a_key(size, seed, rule):
    """Pigeonhole: a pair at the very threshold agrees on an index key."""
    rng = np.random.default_rng(seed)
    pool = np.unique(rng.integers(0, 2**64, 2 * size + 8, dtype=np.uint64))
    rng.shuffle(pool)
    t = int(rng.integers(size, rule.largest(size) + 1))
    least = -(-rule.percent * (size + t) // (100 + rule.percent))  # tokens in common, at least
    common = pool[:least]
    x = np.sort(np.concatenate((common, pool[least:size])))
    y = np.sort(np.concatenate((common, pool[size:size + t - least])))
    if size == t == least:
        return
    keys = [{int(v) for f in J.families_of(rule, len(s)) for v in J.index_keys(s, f)} for s in (x, y)]
    assert keys[0] & keys[1]
    bits = [np.frombuffer(J.bitmap(rule, s), np.uint64) for s in (x, y)]
    assert J.may_link(rule, len(x), bits[0], len(y), bits[1])


def test_plan_counts():
    for rule in (J.Rule(), J.Rule(5, 80)):
        for number in range(45):
            f = J.plan(rule, number)
            if f:
                h = rule.difference(J.bands(rule, number)[1] + f.high)
                assert f.segments + f.deletions == h + 1 + f.slack and f.deletions <= f.segments


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(120)]
    got = {x.vertex: x.root for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    import collections
    near = collections.defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    for v, root in got.items():
        seen, todo = {v}, [v]
        while todo:
            for w in near[todo.pop()] - seen:
                seen.add(w)
                todo.append(w)
        assert root == min(seen)
    assert set(got) == {x for a, b in edges if a != b for x in (a, b)}


def test_keep_one_each(make_docs):
    base = " ".join(f"w{i}" for i in range(80))
    near = base.replace("w40", "zz")
    rows = [(3, base), (9, near), (5, base), (3, base), (5, "other text of the same id"), (None, base), (7, ""), (8, None), (2, "alone here")]
    kept = J.keep_one_each(make_docs(rows), J.Rule(5, 80))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(3, base), (5, "other text of the same id"), (None, base), (7, ""), (8, None), (2, "alone here")], key=repr)


def test_query_against_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(map(tuple, queries.QUERIES["op2_jaccard_join"](spark, sf).collect()), key=repr)
    assert got == brute(pairs, J.Rule())


def test_components_of_an_ascending_path_in_few_rounds(spark, monkeypatch):
    from strata.llm import components
    rounds = []
    plain = components.materialise
    monkeypatch.setattr(components, "materialise", lambda df, name: (rounds.append(name), plain(df, name))[1])
    edges = [(i, i + 1) for i in range(3000)] + [(5000, i) for i in range(5001, 5200)]
    got = {r.vertex: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(3001), 0), **dict.fromkeys(range(5000, 5200), 5000)}
    assert rounds.count("image") <= 20


def test_second_look_leaves_out_sets_that_named_all_their_pairs(make_docs, monkeypatch):
    """Many texts share a passage, and so a hub, without being linked; a few near
    copies among them need another look."""
    r = random.Random(7)
    passage = [f"p{i}" for i in range(60)]
    texts = [passage + [f"u{i}.{j}" for j in range(140)] for i in range(150)]
    for i in range(14):
        ws = list(texts[0])
        for k in r.sample(range(60, 200), 3):
            ws[k] = f"x{i}.{k}"
        texts.append(ws)
    pairs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    looks, plain = [], J.materialise

    def spy(df, name):
        out = plain(df, name)
        if name == "hub-rows":
            looks.append((out.count(), out.filter("NOT loose").count(), out.select("k").distinct().count()))
        return out

    monkeypatch.setattr(J, "materialise", spy)
    rule = J.Rule(5, 80)
    assert run(make_docs, pairs, rule) == brute(pairs, rule)
    assert looks and all(sets <= 15 for _, _, sets in looks), looks
