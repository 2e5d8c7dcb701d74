"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector is brought to length 1, taken relative to a centre and rotated at
random; the signs of its coordinates are its code, one bit each.  With the
length of the difference and the inner product of code and rotated vector as
correction scalars, the code gives an unbiased estimate of the inner product
with any query, and the same scalars bound its error:
EPSILON * sqrt((1 - f^2) / f^2 / (d - 1)) for a product f.  Per query the
best estimates are reranked on the original vectors; the worst of those is a
threshold, and every vector whose estimate plus bound reaches it is reranked
too.

The centre is the mean of a bounded sample (``SAMPLE`` rows by id hash); every
row is in the index.  Rows and queries are dealt to blocks and meet block by
block, so a task holds ROW_BLOCK rows and QUERY_BLOCK queries at most (a hash
deals them, so these are means); what leaves it is the k best for each query.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component take no part, nor do null ids; components stay double
unless the table's are float, and all measures are taken in double; rows with one id are one
row (the least vector); vectors of different length are not compared; equal
scores are ordered by id; fewer candidates than k are all returned.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from strata.llm.common import arrow_map, materialise

SEED = 20240229
SAMPLE = 10_000
EPSILON = 2.5
ROW_BLOCK = 4096
QUERY_BLOCK = 1024
FIRST_RERANK = 4  # times k

INDEX_SCHEMA = "vec_id long, dim int, code binary, apart double, fidelity double, shift double, vector array<%s>"
NEAREST_SCHEMA = "query_id long, vec_id long, score double"


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def taking_part(vectors: DataFrame) -> DataFrame:
    """vec_id, vector: valid rows, one for each id."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kind = "float" if vectors.schema["embedding"].dataType.elementType == FloatType() else "double"
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("vector"))
            .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
            .filter(~bad & F.exists("vector", lambda x: x != 0))
            .groupBy("vec_id").agg(F.min("vector").alias("vector")))


def by_length(column: pa.Array) -> dict[int, np.ndarray]:
    """Positions of the vectors of each length."""
    sizes = np.diff(column.offsets.to_numpy())
    return {int(d): np.flatnonzero(sizes == d) for d in np.unique(sizes)}


def matrix(column: pa.Array, rows: np.ndarray, dim: int) -> np.ndarray:
    flat = column.values.to_numpy(zero_copy_only=False)
    return flat[column.offsets.to_numpy()[rows][:, None] + np.arange(dim)].astype(np.float64)


def scaled(v: np.ndarray) -> np.ndarray:
    """Brought near 1 by powers of two, which changes no digit of a cosine and
    keeps very large and very small components from leaving the doubles."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])


def units(v: np.ndarray) -> np.ndarray:
    v = scaled(v)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def fit_centres(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Mean unit vector of each length in the sample."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    groups: dict[int, list] = {}
    for r in sample:
        groups.setdefault(len(r.vector), []).append(r.vector)
    return {d: units(np.array(v)).mean(axis=0) for d, v in groups.items()}


def build_index(vectors: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """Code and correction scalars of every vector."""

    def rows(batch: pa.RecordBatch) -> dict:
        n = batch.num_rows
        dims, codes, scalars = np.zeros(n, np.int32), [b""] * n, np.zeros((3, n))
        vectors = batch.column("vector")
        for dim, at in by_length(vectors).items():
            centre = centres.get(dim, np.zeros(dim))
            rest = units(matrix(vectors, at, dim)) - centre
            apart = np.sqrt((rest * rest).sum(axis=1))
            turned = rest @ rotation(dim).T / np.maximum(apart, 1e-300)[:, None]
            dims[at] = dim
            scalars[:, at] = apart, np.abs(turned).sum(axis=1) / np.sqrt(dim), rest @ centre
            for k, code in zip(at, np.packbits(turned > 0, axis=1)):
                codes[k] = code.tobytes()
        return {"vec_id": batch.column("vec_id"), "dim": dims, "code": codes, "apart": scalars[0],
                "fidelity": scalars[1], "shift": scalars[2], "vector": vectors}

    kind = vectors.schema["vector"].dataType.elementType.simpleString()
    return arrow_map(vectors.select("vec_id", "vector"), rows, INDEX_SCHEMA % kind)


def search(index: DataFrame, queries: DataFrame, centres: dict[int, np.ndarray], k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each of ``queries``
    (vec_id, vector), without rows of the query's own id."""
    row_blocks = max(1, -(-index.count() // ROW_BLOCK))
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    def grid(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(n_own))).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)).cast("array<long>")))

    rows = grid(index, "row_block", row_blocks, "query_block", query_blocks)
    asked = grid(queries.select("vec_id", "vector"), "query_block", query_blocks, "row_block", row_blocks)

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            own, other = (one_chunk(t, "vector") for t in (left, right))
            wanted = by_length(other)
            for dim, at in by_length(own).items():
                if dim in wanted:
                    found += nearest(left, own, at, right, other, wanted[dim], dim)
        ids, vec, score = zip(*found) if found else ((), (), ())
        return pa.table({"query_id": pa.array(ids, pa.int64()), "vec_id": pa.array(vec, pa.int64()), "score": pa.array(score, pa.float64())})

    def nearest(left, own, at, right, other, asked_at, dim) -> list[tuple]:
        centre = centres.get(dim, np.zeros(dim))
        ids, query_ids = left["vec_id"].to_numpy()[at], right["vec_id"].to_numpy()[asked_at]
        original, query = scaled(matrix(own, at, dim)), scaled(matrix(other, asked_at, dim))
        codes = np.frombuffer(b"".join(left["code"].take(pa.array(at)).to_pylist()), np.uint8).reshape(len(at), -1)
        signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
        apart, fidelity, shift = (left[c].to_numpy()[at] for c in ("apart", "fidelity", "shift"))
        unit = units(query)
        away = unit - centre
        far = np.sqrt((away * away).sum(axis=1))
        turned = away @ rotation(dim).T
        fidelity = np.maximum(fidelity, 1e-9)
        scale = apart / fidelity
        width = EPSILON * scale * np.sqrt(np.maximum(1 - fidelity ** 2, 0) / max(dim - 1, 1))
        estimate = (signs @ turned.T.astype(np.float32)) / np.sqrt(dim) * scale[:, None] + shift[:, None] + (unit @ centre)[None, :]
        lengths = np.sqrt((original * original).sum(axis=1))
        query_lengths = np.sqrt((query * query).sum(axis=1))
        out = []

        def exact(rows: np.ndarray, q: int) -> np.ndarray:  # row by row, so that equal vectors score alike
            return (original[rows] * query[q]).sum(axis=1) / (lengths[rows] * query_lengths[q])

        for q, query_id in enumerate(query_ids):
            guess = np.where(ids == query_id, -np.inf, estimate[:, q])
            some = min(len(guess), FIRST_RERANK * k)
            best = np.argpartition(-guess, some - 1)[:some]
            best = best[ids[best] != query_id]
            if not len(best):
                continue
            scores = exact(best, q)
            least = np.sort(scores)[-k] if len(scores) >= k else -np.inf
            rows = np.flatnonzero((guess + far[q] * width >= least) & (ids != query_id))
            scores = exact(rows, q)
            order = np.lexsort((ids[rows], -scores))[:k]
            out += [(int(query_id), int(ids[rows[o]]), float(scores[o])) for o in order]
        return out

    local = (rows.groupBy("row_block", "query_block").cogroup(asked.groupBy("row_block", "query_block"))
             .applyInArrow(block, NEAREST_SCHEMA))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def one_chunk(table: pa.Table, name: str) -> pa.Array:
    return table[name].combine_chunks() if table[name].num_chunks != 1 else table[name].chunk(0)


def self_search(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """Queries: ids divisible by ``every``, against all rows."""
    valid = materialise(taking_part(vectors), "vectors")
    centres = fit_centres(valid)
    index = materialise(build_index(valid, centres), "codes")
    return search(index, index.filter(F.col("vec_id") % every == 0), centres, k)
