import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import packing


def plain_best_fit(sizes, lengths, choose):
    """Piece by piece; ``choose(size, rest)`` opens a bin."""
    rooms, used, caps = [], [], []
    for i, size in enumerate(sorted(sizes, reverse=True)):
        fits = [k for k, r in enumerate(rooms) if r >= size]
        if fits:
            k = min(fits, key=lambda k: rooms[k])
        else:
            k = len(rooms)
            cap = choose(size)
            rooms.append(cap), used.append(0), caps.append(cap)
        rooms[k] -= size
        used[k] += size
    return sorted(min(c for c in lengths if c >= u) for u in used), sorted(used)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 32), min_size=1, max_size=120))
def test_histogram_plan_equals_piece_by_piece(sizes):
    """With one permitted length no choice is open: same bins as plain best fit."""
    plan = packing.make_plan(dict(Counter(sizes)), [32])
    got = sorted(g.used for g in plan.bins for _ in range(g.n))
    assert got == plain_best_fit(sizes, [32], lambda size: 32)[1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=150))
def test_plan_is_whole_and_fits(sizes):
    counts = dict(Counter(sizes))
    plan = packing.make_plan(counts, (8, 16, 32, 64))
    fill, ranks = defaultdict(list), defaultdict(list)
    for size, rank, n, first, each, offset in plan.places:
        for i in range(n):
            ranks[size].append(rank + i)
            fill[first + i // each].append((offset + i % each * size, size))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(c)) for k, c in counts.items()}
    caps = {g.first + i: (g.capacity, g.used) for g in plan.bins for i in range(g.n)}
    assert set(caps) == set(fill)
    for b, items in fill.items():
        at = 0
        for offset, size in sorted(items):
            assert offset == at
            at += size
        cap, used = caps[b]
        assert at == used <= cap and cap == min(c for c in (8, 16, 32, 64) if c >= used)  # downsized


def test_joint_lengths_beat_one_length():
    r = random.Random(1)
    counts = dict(Counter(min(64, int(r.expovariate(1 / 12)) + 1) for _ in range(3000)))
    cost = packing.default_cost
    total = lambda p: sum(g.n * cost(g.capacity) for g in p.bins)
    joint = total(packing.make_plan(counts, (8, 16, 32, 64)))
    assert joint <= total(packing.make_plan(counts, (64,)))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, n_tokens long").withColumns({c: F.lit("x") for c in ("bin_id", "start", "n")})


@pytest.mark.parametrize("bucket_rows", [50_000, 7])
def test_pack(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(packing, "BUCKET_ROWS", bucket_rows)
    r = random.Random(2)
    rows = [(i, r.choice([5, 5, 5, 64, 200, r.randrange(1, 300)])) for i in range(400)]
    rows += [(None, 9), (500, None), (501, 0), (502, -4), (3, 11), (3, 11)]
    got = packing.pack(frame(spark, rows), (16, 32, 64)).collect()
    want = Counter((d, k, k * 64, min(64, n - 64 * k)) for d, n in rows if n and n > 0 for k in range((n + 63) // 64))
    assert Counter((x.doc_id, x.piece, x.start, x.n) for x in got) == want
    bins = defaultdict(list)
    for x in got:
        bins[x.bin_id, x.bin_length].append((x.bin_offset, x.n))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, length), items in bins.items():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert length == min(c for c in (16, 32, 64) if c >= at)


def test_pack_empty(spark):
    assert packing.pack(frame(spark, [])).collect() == []
