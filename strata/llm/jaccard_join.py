"""N-gram Jaccard join by a partition of the token universe.

A text's set holds the 64-bit hashes of its word n-grams.  Two sets of sizes s
and t with Jaccard similarity p percent or more differ in at most
(100-p)(s+t)/(100+p) tokens.  Sizes are dealt into bands; family f serves the
pairs whose smaller set lies in band f, and H(f) bounds their difference.  A
family cuts the hash range into m equal segments, so a set becomes m segment
sets, and every pair to be found agrees, or nearly agrees, on some segment:

* a segment with allocation 0 is indexed by the hash of its tokens and counts
  1: if it doesn't match, it holds at least one difference;
* a segment with allocation 1 is also indexed by all its one-deletion
  neighbours and counts 2: if it doesn't match, it holds two differences.

With d segments of allocation 1 the counts add up to m + d = H + 1 + e, so the
segments that match have a count of at least 1 + e.  ``plan`` picks d by cost:
index rows against the false candidates that small segments cause.  The slack e
leaves out segments without tokens (any set may have them, so they match
everywhere): a set whose empty segments count e or less does not index them.

Pairs of one index key are never listed.  Each key's least set is its hub;
hubs are found after combining each batch's rows, so a key with very many sets
spreads over the tasks.  All pairs to be found have a common hub.  They are
tested by size and bitmap (bit i holds the parity of the tokens hashed to it,
and the bits in which two bitmaps differ never outnumber the differing tokens,
so that no pair to be found is lost), and what passes is verified exactly on
the whole token sets.  First every set is compared with its hubs; the sets that
cannot be linked to a hub are compared with its other sets, in cells of bounded
size.  After components are formed, only hubs with sets still apart are looked
at again: sets in different components are compared, each with its nearest
first, in the end with all.  Pairs within one component need no test: the
result is the components.  Nothing is capped.

Equal sets form one class with a 64-bit key, and copies are not expanded.

Defined results: null or blank text has an empty set and links with nothing
(its component is itself); fewer words than n make one n-gram; repeated rows
are linked with each other; a null doc_id takes part but names no component; an
empty table gives no row.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import arrow_map, materialise, pick
from strata.llm.components import connected_components
from strata.llm.learning import TokenTable

# In ``plan``, against one index row: a false candidate, a set with empty segments in the index.
FALSE_COST, EMPTY_COST = 6.0, 50.0
BITS_PER_DIFFERENCE = 8
BLOCK = 4096
WORDS_AT_ONCE = 1 << 21  # of bitmaps, in a comparison
NEAREST = 4
COMBINED_DOCS = 2000
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Rule:
    words: int = 4
    percent: int = 85

    def difference(self, total: int) -> int:
        """Most differing tokens of two linked sets with so many tokens together."""
        return (100 - self.percent) * total // (100 + self.percent)

    def largest(self, size: int) -> int:
        """Size of the largest set that can be linked with one of ``size``."""
        return 100 * size // self.percent


@dataclass(frozen=True)
class Family:
    number: int
    low: int  # sizes served
    high: int
    segments: int
    deletions: int  # this many segments have allocation 1
    slack: int


@lru_cache(maxsize=None)
def plan(rule: Rule, number: int) -> Family | None:
    """None: sets of this band are linked only if equal."""
    low, top = bands(rule, number)
    high = rule.largest(top)
    h = rule.difference(top + high)
    if h == 0:
        return None
    best = None
    for d in range((h + 1) // 2 + 1):
        least = np.inf
        for slack in (*range(4), *(int(np.ceil(h / x)) for x in (96, 64, 48, 32, 24, 16))):
            m = h + 1 + slack - d
            k = low / m
            empty = np.exp(-k) * (m - d + 2 * d * (1 + k))  # expected count of segments that may be empty
            kept = empty if slack == 0 else min(empty, np.exp(slack - empty - slack * np.log(slack / empty))
                                                if slack > empty else 1.0)  # Chernoff: odds that they exceed the slack
            cost = m - d + d * (1 + k) + FALSE_COST * m * 2.0 ** -k + EMPTY_COST * kept
            least = min(least, cost)
            if m >= d and (best is None or cost < best[0]):
                best = (cost, Family(number, low, high, m, d, slack))
        if least > 1.2 * best[0]:
            break
    return best[1]


@lru_cache(maxsize=None)
def bands(rule: Rule, number: int) -> tuple[int, int]:
    low = 1 if number == 0 else bands(rule, number - 1)[1] + 1
    return low, max(low, rule.largest(low + 1) - 1)


@lru_cache(maxsize=1 << 16)
def families_of(rule: Rule, size: int) -> list[Family]:
    out, number = [], 0
    while bands(rule, number)[0] <= size:
        if size <= rule.largest(bands(rule, number)[1]) and (f := plan(rule, number)):
            out.append(f)
        number += 1
    return out


@lru_cache(maxsize=1 << 12)
def bounds(m: int) -> np.ndarray:
    return np.array([-(-(j << 64) // m) for j in range(1, m)], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def index_keys(tokens: np.ndarray, f: Family) -> np.ndarray:
    """Index keys of a set (its sorted tokens) in a family."""
    inner = np.searchsorted(tokens, bounds(f.segments))
    edges = np.concatenate(([0], inner, [len(tokens)]))
    values = mixed(tokens ^ MIX2)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values)))
    sums, counts = sums[edges[1:]] - sums[edges[:-1]], np.diff(edges)
    part = np.arange(f.segments)
    empties = int((counts[f.deletions:] == 0).sum() + 2 * (counts[:f.deletions] <= 1).sum())
    if f.deletions:
        n = edges[f.deletions]
        of = np.repeat(part[:f.deletions], counts[:f.deletions])
        sums = np.concatenate((sums, sums[of] - values[:n]))
        counts, part = np.concatenate((counts, counts[of] - 1)), np.concatenate((part, of))
    keys = mixed(mixed(sums + counts.astype(np.uint64) * MIX2)
                 + part.astype(np.uint64) * MIX + np.uint64((f.number + 1) * int(MIX2) % 2**64))
    return keys[counts > 0] if empties <= f.slack else keys


def bitmap(rule: Rule, tokens: np.ndarray) -> bytes:
    """Parities, in a power of two of bits by the size of the set."""
    n = bitmap_bits(rule, len(tokens))
    at = (mixed(tokens) & np.uint64(n - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=n) & 1).astype(np.uint8), bitorder="little").tobytes()


def bitmap_bits(rule: Rule, size: int) -> int:
    want = BITS_PER_DIFFERENCE * (rule.difference(2 * size) + 1)
    return max(64, 1 << (want - 1).bit_length())


def folded(bits: np.ndarray, to: int) -> np.ndarray:
    """Bitmap rows brought down to ``to`` words; parities add up."""
    while bits.shape[-1] > to:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def fold_once(bitmap: bytes) -> bytes:
    words = np.frombuffer(bitmap, np.uint64)
    return folded(words, max(1, len(words) // 2)).tobytes()


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which bitmap rows a and b (broadcast against each other) differ:
    at most the number of differing tokens."""
    to = min(a.shape[-1], b.shape[-1])
    return np.bitwise_count(folded(a, to) ^ folded(b, to)).sum(-1, dtype=np.int64)


def within(rule: Rule, na, nb, difference) -> np.ndarray:
    """Can sets of sizes na, nb that differ in so many tokens, or more, be linked?"""
    return ((100 + rule.percent) * difference <= (100 - rule.percent) * (na + nb)) & (
        100 * np.minimum(na, nb) >= rule.percent * np.maximum(na, nb))


def may_link(rule: Rule, na, a: np.ndarray, nb, b: np.ndarray) -> np.ndarray:
    return within(rule, na, nb, apart(a, b))


class Shingler:
    """Texts to sorted token arrays; words are hashed once a task."""

    def __init__(self, rule: Rule):
        self.rule = rule
        self.table = TokenTable(lambda w: (xxhash.xxh64_intdigest(w),), "Q", limit=500_000)

    def tokens(self, text: str | None) -> np.ndarray:
        words = text.encode().lower().split() if text else []  # both on ASCII alone
        if not words:
            return np.empty(0, np.uint64)
        hashes = self.table.take(0, self.table.positions(words))
        width = min(self.rule.words, len(words))
        n = len(words) - width + 1
        out = np.full(n, width, np.uint64)
        for k in range(width):
            out = mixed(out + hashes[k:k + n])
        return np.unique(out)


def set_key(tokens: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(tokens.tobytes()) - (1 << 63)


# Row kinds of the index table.
DOC, CELL, MORE = 0, 1, 2
INDEX_SCHEMA = "kind int, doc_id long, n long, k long, bitmap binary, key long, cell int, packed binary"
KEY_BYTES = 5  # of an index key, beside its cell


def cell_bits(spark) -> int:
    """Cells of the key space, a power of two by the session's partitions."""
    return min(24, max(4, (int(spark.conf.get("spark.sql.shuffle.partitions")) // 2).bit_length()))


def pack(keys: np.ndarray, sets: np.ndarray, more: np.ndarray) -> bytes:
    """Keys (their low KEY_BYTES), for each the least set that has it, and
    whether others do: about 8 bytes a key and 8 a set."""
    own, at = np.unique(sets, return_inverse=True)
    low = keys.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
    return b"".join((np.array([len(keys), len(own)], np.uint32).tobytes(), own.tobytes(), at.astype(np.uint16).tobytes(),
                     np.packbits(more).tobytes(), low.tobytes()))


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, n_sets = np.frombuffer(data, np.uint32, 2)
    at = 8 + 8 * int(n_sets)
    own = np.frombuffer(data, np.int64, n_sets, 8)
    sets = own[np.frombuffer(data, np.uint16, n, at)]
    at += 2 * int(n)
    flags = -(-int(n) // 8)
    more = np.unpackbits(np.frombuffer(data, np.uint8, flags, at), count=int(n)).astype(bool)
    keys = np.zeros((n, 8), np.uint8)
    keys[:, :KEY_BYTES] = np.frombuffer(data, np.uint8, KEY_BYTES * int(n), at + flags).reshape(-1, KEY_BYTES)
    return keys.view(np.uint64).reshape(-1), sets, more


def build_index(docs: DataFrame, rule: Rule) -> DataFrame:
    """One pass over the texts.  DOC: doc_id, key (hash of the text), n, k (the
    set's key), bitmap, packed (the bitmap folded once).  CELL: of COMBINED_DOCS documents, the index keys of
    one cell, each with its least set and whether there are more, packed.
    MORE: those others (key, k)."""
    bits = cell_bits(docs.sparkSession)

    def run(batches):
        shingler = Shingler(rule)
        for batch in batches:
            for at in range(0, batch.num_rows, COMBINED_DOCS):
                yield index_rows(batch.slice(at, COMBINED_DOCS), shingler, rule, bits)

    rows = pick(docs, doc_id="long", text="string").withColumn("row", F.xxhash64("text"))
    return rows.mapInArrow(run, INDEX_SCHEMA)


def index_rows(batch: pa.RecordBatch, shingler: Shingler, rule: Rule, bits: int) -> pa.RecordBatch:
    sizes, set_keys, bitmaps, keys, owners = [], [], [], [], []
    done: set[int] = set()
    for text in batch.column(1):
        tokens = shingler.tokens(text.as_py())
        k = set_key(tokens)
        sizes.append(len(tokens))
        set_keys.append(k)
        bitmaps.append(bitmap(rule, tokens) if len(tokens) else None)
        if k in done:
            continue
        done.add(k)
        for f in families_of(rule, len(tokens)):
            own = index_keys(tokens, f)
            keys.append(own)
            owners.append(np.full(len(own), k, np.int64))
    shift = np.uint64(64 - 8 * KEY_BYTES - bits)
    key = np.concatenate(keys) >> shift if keys else np.empty(0, np.uint64)
    owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
    order = np.lexsort((owner, key))
    key, owner = key[order], owner[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    other = np.zeros(len(key), bool)  # another set than the one before it, same index key
    other[1:] = ~first[1:] & (owner[1:] != owner[:-1])
    heads = np.flatnonzero(first)
    more = np.add.reduceat(other, heads) > 0 if len(heads) else np.empty(0, bool)
    cell, starts = np.unique(key[heads] >> np.uint64(8 * KEY_BYTES), return_index=True)
    stops = np.append(starts[1:], len(heads))
    packed = [pack(key[heads[i:j]], owner[heads[i:j]], more[i:j]) for i, j in zip(starts, stops)]
    n_docs, n_cells, n_more = len(sizes), len(packed), int(other.sum())

    def column(dtype, docs=None, cells=None, others=None):
        parts = ((docs, n_docs), (cells, n_cells), (others, n_more))
        return pa.concat_arrays([pa.nulls(n, dtype) if v is None else v if isinstance(v, pa.Array) else pa.array(v, dtype)
                                 for v, n in parts])

    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat([DOC, CELL, MORE], [n_docs, n_cells, n_more]), pa.int32()), column(pa.int64(), batch.column(0)),
         column(pa.int64(), sizes), column(pa.int64(), set_keys, None, owner[other]), column(pa.binary(), bitmaps),
         column(pa.int64(), batch.column(2), None, key[other].view(np.int64)), column(pa.int32(), None, cell.astype(np.int32)),
         column(pa.binary(), [b and fold_once(b) for b in bitmaps], packed)],
        names=["kind", "doc_id", "n", "k", "bitmap", "key", "cell", "packed"])


def star_candidates(index: DataFrame) -> DataFrame:
    """hub, k: for each index key its least set, with every other set.  A task
    takes the packed keys of one cell: a fixed share of the key space, in which
    a key has one entry for each COMBINED_DOCS documents at most."""

    def shared_keys(frame: pa.Table) -> pa.Table:
        cell = frame["cell"][0].as_py()
        keys, sets, more = (np.concatenate(x) for x in zip(*(unpack(p.as_py()) for p in frame["packed"])))
        order = np.lexsort((sets, keys))
        keys, sets, more = keys[order], sets[order], more[order]
        heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.append(heads, len(keys)))
        hub = np.repeat(sets[heads], sizes)
        any_more = np.repeat(np.logical_or.reduceat(more, heads), sizes)
        found = (sets != hub) | any_more
        return pa.table({"key": (keys[found] | np.uint64(cell << (8 * KEY_BYTES))).view(np.int64), "k": sets[found], "hub": hub[found]})

    shared = materialise(index.filter(F.col("kind") == CELL).select("cell", "packed")
                         .groupBy("cell").applyInArrow(shared_keys, "key long, k long, hub long"), "shared-keys")
    hubs = shared.filter("k = hub").select("key", "hub").distinct()
    others = index.filter(F.col("kind") == MORE).select("key", "k").join(hubs, "key").select("hub", "k")
    return materialise(shared.select("hub", "k").unionByName(others).filter("hub <> k").distinct(), "star")


def bitmap_words(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b.as_buffer(), np.uint64) for b in column]


def pass_bitmaps(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) that may be linked by size and bitmap; ``sets``: k, n, bitmap.
    The pairs name few of the sets: the list of those is written first, so that
    Spark broadcasts it where its size allows and shuffles no other sets."""
    wanted = materialise(pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct(), "bitmap-ids")
    some = sets.join(wanted, "k", "left_semi")

    def side(x):
        return some.select(F.col("k").alias(x), F.col("n").alias(f"n_{x}"), F.col("bitmap").alias(f"bits_{x}"))

    def rows(batch: pa.RecordBatch) -> dict:
        na, nb = (batch.column(f"n_{x}").to_pylist() for x in "ab")
        ok = pa.array([bool(may_link(rule, *r)) for r in zip(na, bitmap_words(batch.column("bits_a")), nb,
                                                             bitmap_words(batch.column("bits_b")))])
        return {x: batch.column(x).filter(ok) for x in "ab"}

    return arrow_map(pairs.join(side("a"), "a").join(side("b"), "b"), rows, "a long, b long")


def verify(pairs: DataFrame, docs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) that are linked, by their whole token sets.  Texts are read
    again for the sets in question alone: the list of their documents is
    written first, so that Spark broadcasts it where its size allows."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct()
    ids = materialise(classes.join(wanted, "k", "left_semi").select(F.coalesce("rep.doc_id", F.lit(NO_ID)).alias("doc_id")).distinct(),
                      "wanted")
    shinglers: list[Shingler] = []

    def token_rows(batch: pa.RecordBatch) -> dict:
        if not shinglers:
            shinglers.append(Shingler(rule))
        tokens = [shinglers[0].tokens(t.as_py()) for t in batch.column(0)]
        return {"k": [set_key(t) for t in tokens], "tokens": [t.view(np.int64) for t in tokens]}

    texts = (pick(docs, doc_id="long", text="string").withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
             .join(ids, "doc_id", "left_semi").select("text"))
    sets = arrow_map(texts, token_rows, "k long, tokens array<long>")
    sets = materialise(sets.groupBy("k").agg(F.first("tokens").alias("tokens")), "token-sets")

    def side(x):
        return sets.select(F.col("k").alias(x), F.col("tokens").alias(f"tokens_{x}"))

    common, size = F.size(F.array_intersect("tokens_a", "tokens_b")), F.size("tokens_a") + F.size("tokens_b")
    return materialise(pairs.join(side("a"), "a").join(side("b"), "b")
                       .filter(100 * common >= rule.percent * (size - common)).select("a", "b"), "links")


# Roles of a row in a cell: compared with (RIGHT), compared (LEFT), both, or the hub itself.
RIGHT, LEFT, BOTH, HUB = range(4)
PAIRS_SCHEMA = "hub long, k long, other long, state int"  # a pair that was given for the set k
# State of a pair: all of the set's pairs are given; not all; the pair with the hub was taken for all.
GIVEN, NEARER, TAKEN = range(3)
SURE = 10 / 7  # a set so much nearer to its hub than needed is taken for linked until verified


def cell_pairs(rule: Rule, hub: int, k: np.ndarray, root: np.ndarray, n: np.ndarray, bitmaps: list[bytes],
               role: np.ndarray, most: int | None) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(k, other, state) of pairs in a cell that may be linked, given for set k.
    With the hub there, sets that are surely linked with it give that pair
    alone, and all others are compared with all; without it, sets of different
    components are.  A set with over ``most`` pairs gives the nearest ones."""
    rows = [np.frombuffer(b, np.uint64) for b in bitmaps]
    width = min(map(len, rows))
    bits = np.stack([folded(r, width) for r in rows])
    left, right = np.flatnonzero((role == LEFT) | (role == BOTH)), np.flatnonzero((role == RIGHT) | (role == BOTH))
    out = []

    def give(own, other, state):
        out.append((own, other, np.full(len(own), state, np.int32)))

    for h in np.flatnonzero(role == HUB)[:1]:
        distance = apart(bits[h], bits[left])
        ok = within(rule, n[h], n[left], distance)
        sure = within(rule, n[h], n[left], distance * SURE)
        give(k[left[sure]], np.full(int(sure.sum()), hub), TAKEN)
        give(k[left[ok & ~sure]], np.full(int((ok & ~sure).sum()), hub), GIVEN)
        left = left[~sure]
    step = max(1, WORDS_AT_ONCE // (max(1, len(right)) * width))
    for at in range(0, len(left), step):
        some = left[at:at + step]
        distance = apart(bits[some][:, None], bits[right])
        ok = within(rule, n[some][:, None], n[right], distance) & (root[some][:, None] != root[right])
        full = ok.sum(axis=1) > (most or len(right))
        i, j = np.nonzero(ok & ~full[:, None])
        give(k[some[i]], k[right[j]], GIVEN)
        for i in np.flatnonzero(full):
            j = np.flatnonzero(ok[i])
            share = distance[i, j] / (n[some[i]] + n[right[j]])
            j = j[np.argsort(share, kind="stable")[:most]]
            give(np.full(len(j), k[some[i]]), k[right[j]], NEARER)
    return out


def compare_cells(cells: DataFrame, rule: Rule, most: int | None) -> DataFrame:
    """``cells`` (CELL_COLUMNS) -> PAIRS_SCHEMA; rows of
    one (hub, block) are a cell, and a task takes the cells of a bin."""
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 8

    def compare(table: pa.Table) -> pa.Table:
        cols = {c: table[c].to_numpy() for c in ("hub", "block", "k", "root", "n", "role")}
        bitmaps = table["bitmap"].to_pylist()
        order = np.lexsort((cols["block"], cols["hub"]))
        cols = {c: v[order] for c, v in cols.items()}
        new = (np.diff(cols["hub"]) != 0) | (np.diff(cols["block"]) != 0)
        edges = np.concatenate(([0], np.flatnonzero(new) + 1, [len(order)]))
        found = [(np.empty(0, np.int64),) * 3 + (np.empty(0, np.int32),)]
        for i, j in zip(edges[:-1], edges[1:]):
            own = {c: v[i:j] for c, v in cols.items()}
            hub = int(own.pop("hub")[0])
            own.pop("block")
            for k, other, state in cell_pairs(rule, hub, bitmaps=[bitmaps[x] for x in order[i:j]], most=most, **own):
                found.append((np.full(len(k), hub), k, other, state))
        return pa.table(dict(zip(("hub", "k", "other", "state"), (np.concatenate(x) for x in zip(*found)))))

    return (cells.withColumn("bin", F.pmod(F.xxhash64("hub", "block"), F.lit(parts))).groupBy("bin")
            .applyInArrow(lambda table: compare(table), PAIRS_SCHEMA))


CELL_COLUMNS = ("hub", "block", "k", "root", "n", "bitmap", "role")


def small_groups(star: DataFrame, sizes: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Hubs with at most BLOCK sets, each in one cell with the hub itself; on
    folded bitmaps, as every set moves once for each of its hubs."""
    small = sizes.filter(F.col("n_all") <= BLOCK).select("hub")
    rows = star.join(small, "hub", "left_semi").select("hub", "k", F.lit(BOTH).alias("role")).unionByName(
        small.select("hub", F.col("hub").alias("k"), F.lit(HUB).alias("role")))
    cells = rows.join(sets.select("k", "n", "bitmap"), "k").withColumn("root", F.col("k")).withColumn("block", F.lit(0).cast("long"))
    return compare_cells(cells.select(*CELL_COLUMNS), rule, NEAREST)


def open_rows(rows: DataFrame, hubs: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` (hub, k) of the given ``hubs``, with the root of k and whether it
    is loose: not in its hub's component."""
    def root_of(name, to):
        return roots.select(F.col("vertex").alias(name), F.col("root").alias(to))

    found = (rows.join(hubs, "hub", "left_semi").join(root_of("hub", "hub_root"), "hub", "left").join(root_of("k", "root"), "k", "left")
             .select("hub", "k", F.coalesce("root", "k").alias("root"),
                     (F.coalesce("root", "k") != F.coalesce("hub_root", "hub")).alias("loose")))
    return materialise(found, "hub-rows")


def loose_groups(rows: DataFrame, sets: DataFrame, rule: Rule, most: int | None) -> DataFrame:
    """Of ``rows`` (from open_rows): loose sets (left) meet all sets of their
    hub (right) in cells of BLOCK by BLOCK sets."""
    sizes = (rows.groupBy("hub").agg(F.count(F.lit(1)).alias("n_all"), F.sum(F.col("loose").cast("long")).alias("n_loose"))
             .filter("n_all > 1 AND n_loose > 0")
             .select("hub", F.ceil(F.col("n_all") / BLOCK).alias("right_blocks"), F.ceil(F.col("n_loose") / BLOCK).alias("left_blocks")))
    sized = materialise(rows.join(sizes, "hub"), "sized-rows")
    sized = sized.join(sets.select("k", "n", "bitmap"), "k").withColumn("h", F.xxhash64("k"))
    one = (F.col("left_blocks") == 1) & (F.col("right_blocks") == 1)
    single = sized.filter(one).select(
        "*", F.lit(0).cast("long").alias("block"), F.when(F.col("loose"), F.lit(BOTH)).otherwise(F.lit(RIGHT)).alias("role"))
    split = sized.filter(~one)
    left = split.filter("loose").select("*", F.expr("explode(sequence(0L, right_blocks - 1))").alias("other")).select(
        "*", (F.expr("pmod(h, left_blocks)") * F.col("right_blocks") + F.col("other")).alias("block"), F.lit(LEFT).alias("role"))
    right = split.select("*", F.expr("explode(sequence(0L, left_blocks - 1))").alias("other")).select(
        "*", (F.col("other") * F.col("right_blocks") + F.expr("pmod(h, right_blocks)")).alias("block"), F.lit(RIGHT).alias("role"))
    cells = single.select(*CELL_COLUMNS).unionByName(left.select(*CELL_COLUMNS)).unionByName(right.select(*CELL_COLUMNS))
    return compare_cells(cells, rule, most)


def apart_still(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Hubs whose sets need another look: a pair that was taken for linked
    turned out not to be, or not all pairs were given."""
    def root_of(x):
        return roots.select(F.col("vertex").alias(x), F.col("root").alias(f"root_{x}"))

    own = pairs.filter(F.col("state") != GIVEN).join(root_of("k"), "k", "left").join(root_of("other"), "other", "left")
    return own.filter((F.col("state") == NEARER) | (F.coalesce("root_k", "k") != F.coalesce("root_other", "other"))).select("hub").distinct()


def not_done(pairs: DataFrame) -> DataFrame:
    """(hub, k) of sets that gave some of their pairs alone.  A set that gave all
    of them is done with its hub: what it may be linked with was named, so the
    next look, which compares the others among themselves, loses no link."""
    return pairs.filter(F.col("state") != GIVEN).select("hub", "k").distinct()


def component_rows(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, row (hash of the text), n and first (doc_id, row: the least of
    the component; null without words) of every row of ``docs``."""
    index = materialise(build_index(docs, rule), "jaccard-index")
    rows = index.filter(F.col("kind") == DOC).select("doc_id", F.col("key").alias("row"), "n", "k", "bitmap", "packed")
    named_row = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "row"))
    classes = materialise(rows.filter("n > 0").groupBy("k", "n").agg(F.min(named_row).alias("rep"), F.min("bitmap").alias("bitmap"),
                                                                F.min("packed").alias("folded")), "classes")
    sets, small = classes.select("k", "n", "bitmap"), classes.select("k", "n", F.col("folded").alias("bitmap"))
    star = star_candidates(index)
    sizes = materialise(star.groupBy("hub").agg(F.count(F.lit(1)).alias("n_all")), "hub-sizes")
    large = sizes.filter(F.col("n_all") > BLOCK).select("hub")
    with_hub = pass_bitmaps(star.join(large, "hub", "left_semi").select(F.col("hub").alias("a"), F.col("k").alias("b")), sets, rule)
    pairs = small_groups(star, sizes, small, rule).unionByName(
        with_hub.select(F.col("a").alias("hub"), F.col("b").alias("k"), F.col("a").alias("other"), F.lit(TAKEN).alias("state")))
    # of hubs in cells, the sets that are not done; of large ones all, as each was compared with its hub alone
    links, roots, rows_open = None, None, None
    for most in (NEAREST, NEAREST, None):  # then, with the components that gives, what is left; in the end all
        if links is not None:
            rows_open = open_rows(rows_open, left, roots)
            pairs = loose_groups(rows_open, sets, rule, most)  # whole bitmaps: fewer pairs
        pairs = materialise(pairs, "pairs")
        near = pass_bitmaps(pairs.select(F.least("k", "other").alias("a"), F.greatest("k", "other").alias("b")).distinct(), sets, rule)
        found = verify(materialise(near, "near-pairs"), docs, classes, rule)
        links = found if links is None else links.unionByName(found)
        roots = connected_components(links)
        left = apart_still(pairs, roots)
        if links is found:
            left = left.unionByName(large).distinct()
            rows_open = not_done(pairs.join(large, "hub", "left_anti")).unionByName(star.join(large, "hub", "left_semi").select("hub", "k"))
        else:
            rows_open = not_done(pairs).unionByName(rows_open.filter("NOT loose").select("hub", "k"))
        left = materialise(left, "hubs-left")
        if left.isEmpty():
            break
    rooted = classes.select("k", "n", "rep").join(roots.withColumnRenamed("vertex", "k"), "k", "left").withColumn(
        "root", F.coalesce("root", "k"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("first"))
    named = rooted.join(least, "root").select("k", "n", "first")
    return rows.select("doc_id", "row", "n", "k").join(named, ["k", "n"], "left").drop("k")


def jaccard_components(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``."""
    return component_rows(docs, rule).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one_each(docs: DataFrame, rule: Rule) -> DataFrame:
    """Rows of documents, one of each component: the least by doc_id and text
    hash.  Rows without an id or without words are in no group and stay.  What
    goes is listed first, so that Spark can broadcast the list where small."""
    cols = pick(docs, doc_id="long", text="string", lang="string", source="string", n_chars="long")
    found = component_rows(docs, rule).filter("n > 0 AND doc_id IS NOT NULL")
    listed = materialise(found.groupBy("doc_id", "row").agg(
        F.first("first").alias("first"), F.count(F.lit(1)).alias("times")).withColumn(
        "gone", (F.col("first.doc_id") != F.col("doc_id")) | (F.col("first.row") != F.col("row")))
        .filter("gone OR times > 1").select("doc_id", "row", "gone"), "repeated-rows")
    ids = materialise(listed.select("doc_id").distinct(), "repeated-ids")
    untouched = cols.join(ids, "doc_id", "left_anti").select(*cols.columns)
    rows = materialise(cols.join(ids, "doc_id", "left_semi").withColumn("row", F.xxhash64("text")), "rows-of-ids")
    once = rows.join(listed, ["doc_id", "row"], "left_anti")
    same = (rows.join(listed.filter("NOT gone"), ["doc_id", "row"], "left_semi")
            .dropDuplicates(["doc_id", "row"]))  # equal rows of one document
    return untouched.unionByName(once.unionByName(same).select(*cols.columns))
