"""Best-fit packing into sequences of several permitted lengths.

Documents longer than the largest length are cut into pieces of that length
and a rest; no token is dropped.  Best fit decreasing runs on the histogram of
piece lengths and not on the pieces: at most one row a length, so its size is
bounded by the largest permitted length, whatever the table holds.  Bins alike
so far are handled as one range of bin numbers.  A piece goes to the open bin
with the least room that fits; if none fits, a bin is opened with the length
whose cost for each token it can be expected to hold, given the pieces still to
come, is least.  At the end each bin is downsized to the least permitted length
that holds its contents.

The plan says, for each length, which ranks of its pieces go to which bins.
Ranks are counted in Spark inside (length, bucket) groups of bounded size, so a
length that a third of all pieces have is spread.

Defined results: a null, zero or negative token count has no piece; equal
pieces are interchangeable; a null id is kept; an empty table gives no row.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import arrow_map, materialise, pick

LENGTHS = (512, 1024, 2048, 4096, 8192)
BUCKET_ROWS = 50_000


def default_cost(length: int) -> float:
    """Of a sequence: linear layers, and attention by the square."""
    return length * (1 + length / 16384)


@dataclass
class Bins:
    """Bins first .. first + n - 1, alike."""
    first: int
    n: int
    capacity: int
    used: int


@dataclass
class Plan:
    # (length, first rank, pieces, first bin, pieces a bin, offset in the bin)
    places: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    bins: list[Bins] = field(default_factory=list)


def make_plan(counts: dict[int, int], lengths: Sequence[int] = LENGTHS,
              cost: Callable[[int], float] = default_cost) -> Plan:
    lengths = sorted(lengths)
    plan, room, open_bins, n_bins = Plan(), [], {}, 0  # room: sorted room left of open bins; open_bins: room -> groups
    todo = sorted((k for k, c in counts.items() if c > 0), reverse=True)

    def put(group: Bins) -> None:
        left = group.capacity - group.used
        if left not in open_bins:
            bisect.insort(room, left)
            open_bins[left] = []
        open_bins[left].append(group)

    def cheapest(at: int) -> int:
        def per_token(capacity: int) -> float:
            left, k = capacity, at
            while left and (k := bisect.bisect_left(todo, -left, k, key=lambda x: -x)) < len(todo):
                left -= todo[k] * min(left // todo[k], counts[todo[k]])
                k += 1
            return cost(capacity) / (capacity - left)
        return min((c for c in lengths if c >= todo[at]), key=per_token)

    for at, size in enumerate(todo):
        rank, left = 0, counts[size]
        while left:
            k = bisect.bisect_left(room, size)
            if k < len(room):
                group = open_bins[room[k]].pop()
                if not open_bins[room[k]]:
                    del open_bins[room[k]]
                    del room[k]
            else:
                capacity = cheapest(at)
                group = Bins(n_bins, -(-left // (capacity // size)), capacity, 0)
                n_bins += group.n
            each = (group.capacity - group.used) // size
            full = min(group.n, left // each)
            for n, pieces in ((full, each), (min(group.n - full, 1), left - full * each if full < group.n else 0)):
                if n and pieces:
                    plan.places.append((size, rank, n * pieces, group.first, pieces, group.used))
                    put(Bins(group.first, n, group.capacity, group.used + pieces * size))
                    rank, left = rank + n * pieces, left - n * pieces
                    group = Bins(group.first + n, group.n - n, group.capacity, group.used)
            if group.n:
                put(group)
    plan.bins = sorted((g for groups in open_bins.values() for g in groups), key=lambda g: g.first)
    for g in plan.bins:
        g.capacity = next(c for c in lengths if c >= g.used)
    return plan


def pieces_of(lengths: DataFrame, largest: int) -> DataFrame:
    """doc_id, piece, start, n: every document in pieces of ``largest``."""
    return (pick(lengths, doc_id="long", n_tokens="long").filter("n_tokens > 0")
            .select("doc_id", "n_tokens", F.explode(F.expr(f"sequence(0L, (n_tokens - 1) div {largest})")).alias("piece"))
            .select("doc_id", "piece", (F.col("piece") * largest).alias("start"),
                    F.least(F.lit(largest), F.col("n_tokens") - F.col("piece") * largest).cast("long").alias("n")))


def pack(lengths: DataFrame, permitted: Sequence[int] = LENGTHS, cost: Callable[[int], float] = default_cost) -> DataFrame:
    """``lengths`` (doc_id, n_tokens) -> doc_id, piece, start, n, bin_id,
    bin_offset, bin_length."""
    pieces = materialise(pieces_of(lengths, max(permitted)), "pieces")
    counts = {r.n: r.times for r in pieces.groupBy("n").agg(F.count(F.lit(1)).alias("times")).collect()}  # one row a length at most
    plan = make_plan(counts, permitted, cost)
    buckets = max(1, -(-max(counts.values(), default=0) // BUCKET_ROWS))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = Window.partitionBy("n").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("n", "bucket").agg(F.count(F.lit(1)).alias("times")).select(
        "n", "bucket", F.coalesce(F.sum("times").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("n", "bucket").orderBy("doc_id", "piece")
    ranked = (dealt.withColumn("at", F.row_number().over(inside) - 1).join(offsets, ["n", "bucket"])
              .select("doc_id", "piece", "start", "n", (F.col("at") + F.col("offset")).alias("rank")))
    places = np.array(sorted(plan.places), np.int64).reshape(-1, 6)
    firsts = np.array([g.first for g in plan.bins], np.int64)
    capacities = np.array([g.capacity for g in plan.bins], np.int64)
    keys = (places[:, 0] << 44) + places[:, 1]

    def rows(batch: pa.RecordBatch) -> dict:
        n, rank = (batch.column(c).to_numpy() for c in ("n", "rank"))
        place = places[np.searchsorted(keys, (n << 44) + rank, "right") - 1]
        nth = rank - place[:, 1]
        bin_id = place[:, 3] + nth // place[:, 4]
        return {c: batch.column(c) for c in ("doc_id", "piece", "start", "n")} | {
            "bin_id": bin_id, "bin_offset": place[:, 5] + nth % place[:, 4] * n,
            "bin_length": capacities[np.searchsorted(firsts, bin_id, "right") - 1]}

    return arrow_map(ranked, rows, "doc_id long, piece long, start long, n long, bin_id long, bin_offset long, bin_length long")
