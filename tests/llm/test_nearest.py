import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import nearest, queries

SF = "/root/testdata/sf0.01"


def brute(rows, every=50, k=5):
    ok = {i: np.array(v, np.float64) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in ok:
        if q % every == 0:
            found = [(-(ok[q] @ v / np.sqrt((ok[q] @ ok[q]) * (v @ v))), i) for i, v in ok.items() if i != q and len(v) == len(ok[q])]
            out[q] = sorted(found)[:k]
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit("x") for c in ("code", "score", "vector", "dim")})


def recall(got, want):
    by = {}
    for r in got:
        by.setdefault(r.query_id, {})[r.rank] = r
    assert {q for q, f in want.items() if f} == set(by)
    hits = sum(len({i for _, i in want[q]} & {r.vec_id for r in by[q].values()}) for q in by)
    for q, rows in by.items():
        assert sorted(rows) == list(range(1, len(rows) + 1))
        assert [(-rows[k].score, rows[k].vec_id) for k in sorted(rows)] == sorted((-r.score, r.vec_id) for r in rows.values())
    return hits / max(1, sum(len(f) for f in want.values()))


def test_query_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute(rows)
    got = queries.QUERIES["op5_one_bit_codes"](spark, SF).collect()
    assert recall(got, want) >= 0.98
    scores = {(q, i): -s for q, f in want.items() for s, i in f}
    assert all(abs(scores[r.query_id, r.vec_id] - r.score) < 1e-12 for r in got if (r.query_id, r.vec_id) in scores)


@pytest.mark.parametrize("dim", [64, 10])
def test_recall_over_blocks(spark, monkeypatch, dim):
    monkeypatch.setattr(nearest, "ROW_BLOCK", 300)
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((20, dim))
    rows = [(i, (centres[i % 20] + 0.4 * rng.standard_normal(dim)).astype(np.float32).tolist()) for i in range(2000)]
    assert recall(nearest.self_search(table(spark, rows)).collect(), brute(rows)) >= 0.97


def test_double_vectors(spark):
    """Components that floats can't hold: digits, size."""
    rng = np.random.default_rng(6)
    base = rng.standard_normal(16)
    rows = [(i, (base + 1e-5 * rng.standard_normal(16)).tolist()) for i in range(200)]
    rows += [(1000, (base * 1e200).tolist()), (1001, (base * 1e-200).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    exact = {i: np.array(v) / np.abs(v).max() for i, v in rows}
    want = brute([(i, v.tolist()) for i, v in exact.items()])
    got = nearest.self_search(df).collect()
    assert {r.query_id for r in got} == {0, 50, 100, 150, 1000}
    best = {r.query_id: r for r in got if r.rank == 1}
    for q, found in want.items():
        assert abs(best[q].score + found[0][0]) < 1e-15 or best[q].vec_id == found[0][1]
        assert all(abs(r.score - exact[q] @ exact[r.vec_id] / np.sqrt((exact[q] @ exact[q]) * (exact[r.vec_id] @ exact[r.vec_id])))
                   < 4e-16 for r in got if r.query_id == q)
    assert best[1000].vec_id == 1001 and best[1000].score == pytest.approx(1, abs=1e-15)


def test_ties_and_edge_rows(spark):
    v = [0.3, -0.1, 0.7]
    rows = [(i, v) for i in range(0, 12)] + [(50, [0.6, -0.2, 1.4]), (100, None), (150, []), (200, [0.0, 0.0, 0.0]),
            (250, [float("nan"), 1.0, 0.0]), (300, [float("inf"), 1.0, 0.0]), (350, [None, 1.0, 0.0]), (None, v), (0, v),
            (400, [1.0, 0.0]), (450, [0.5, 0.5]), # of another length
            (500, [1e-30, 1e-30, 0.0])]
    got = nearest.self_search(table(spark, rows)).collect()
    ids = {}
    for r in sorted(got, key=lambda r: r.rank):
        ids.setdefault(r.query_id, []).append(r.vec_id)
    assert ids[0] == [1, 2, 3, 4, 5] and ids[50] == [0, 1, 2, 3, 4]
    assert ids[400] == [450] and ids[450] == [400] and set(ids) == {0, 50, 400, 450, 500}
    assert nearest.self_search(table(spark, [])).collect() == []


def test_error_bounds_hold():
    """The estimate is within the stated bound for nearly all pairs."""
    rng = np.random.default_rng(0)
    dim = 64
    x, q = nearest.units(rng.standard_normal((4000, dim))), nearest.units(rng.standard_normal((50, dim)))
    turned, asked = x @ nearest.rotation(dim).T, q @ nearest.rotation(dim).T
    f = np.abs(turned).sum(1) / np.sqrt(dim)
    estimate = np.sign(turned) @ asked.T / np.sqrt(dim) / f[:, None]
    width = nearest.EPSILON * np.sqrt((1 - f ** 2) / f ** 2 / (dim - 1))
    assert np.mean(np.abs(estimate - x @ q.T) <= width[:, None]) > 0.98
    assert np.allclose(nearest.rotation(dim) @ nearest.rotation(dim).T, np.eye(dim))
