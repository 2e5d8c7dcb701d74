"""Ranked lexical search by pipelined term partitioning.

The query terms are dealt to a few owners.  Items travel in bundles, one for
each block of documents, with a sparse accumulator (item, document -> score so
far); every owner in turn is cogrouped with the bundles, adds the integer
contributions of its own postings and passes the bundles on; after the last
owner each bundle gives its best documents, from which the best of the whole
table are taken.  Owners are ordered by falling weight, so that rare terms come
first, and an accumulator is let go when even the most that the later owners
could add leaves it below the k-th best of its block: exact, ties included.

Documents are read once.  A task cuts what it reads into blocks of at most
BLOCK_DOCS documents and writes their lengths and, for each term, the posting
(documents, frequencies).  Query terms are sent to the tasks only if they take
less than VOCABULARY_BYTES; beyond that, all terms are posted and the join with
the query terms selects.  A cogroup holds one block and one bundle: at most
BLOCK_DOCS accumulators for each of about BUNDLE_ITEMS items.

A document's score for an item is the sum over the item's distinct terms of
w * ((10^9 tf) div (1000 tf + 20 m)), with w = floor(1000 ln((2N + 2) / (2 df + 1)))
and m = 50 + (50 n N) div L; see :func:`search`.

Defined results: A-Z count as a-z; null and empty texts have no terms; rows of
one item id are one item with the terms of all; a null item id is an item;
repeated documents are documents of their own (equal scores by ascending
doc_id, a null id last); an item without a document above 0 has no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialise, pick

BLOCK_DOCS = 8192
BUNDLE_ITEMS = 64
OWNERS = 4
VOCABULARY_BYTES = 32 << 20
IMPACT = 1_000_000  # (10^9 tf) div (1000 tf + 20 m) stays below this
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# bytes of a text with everything but terms as a blank; bytes beyond ASCII belong to terms
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def item_bundles(items: DataFrame) -> DataFrame:
    """item_id, terms (distinct, binary), bundle and the item's slot in it."""
    words = F.split(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), NO_TERM)
    each = (pick(items, item_id="long", text="string")
            .select("item_id", F.explode_outer(F.array_remove(words, "")).alias("term")).distinct()
            .groupBy("item_id").agg(F.collect_list(F.col("term").cast("binary")).alias("terms")))
    bundles = -(-max(1, each.count()) // BUNDLE_ITEMS)
    return (each.withColumn("bundle", F.pmod(F.xxhash64("item_id"), F.lit(bundles)).cast("long"))
            .withColumn("slot", F.row_number().over(Window.partitionBy("bundle").orderBy("item_id")) - 1))


INDEX = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("term", pa.binary()),
                   ("df", pa.int64()), ("docs", pa.binary()), ("tf", pa.binary())])


def index_documents(docs: DataFrame, vocabulary: frozenset[bytes] | None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Per block one row with its documents' ids and lengths (``doc_ids``, ``n``),
    and a row for each of its terms: ``df``, ``docs`` (positions in the block)
    and ``tf``, packed.  Written to the shared folder, so block numbers stay."""
    spark = docs.sparkSession
    shared = None if vocabulary is None else spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if shared is None else shared.value
        number = TaskContext.get().partitionId() << 33
        rows = ((i, t.as_py()) for b in batches for i, t in zip(b.column(0).to_pylist(), b.column(1)))
        while part := list(islice_texts(rows, wanted, block_docs)):
            found: dict[bytes, tuple[list, list]] = defaultdict(lambda: ([], []))
            for at, (_, _, counts) in enumerate(part):
                for term, tf in counts.items():
                    docs, tfs = found[term]
                    docs.append(at)
                    tfs.append(tf)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([[p[0] for p in part]], INDEX.field("doc_ids").type),
                 pa.array([[p[1] for p in part]], INDEX.field("n").type), *(pa.nulls(1, INDEX.field(c).type) for c in ("term", "df", "docs", "tf"))],
                schema=INDEX)
            terms = iter(found.items())
            while some := list(islice(terms, 10_000)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(some), pa.int64()), *(pa.nulls(len(some), INDEX.field(c).type) for c in ("doc_ids", "n")),
                     pa.array([t for t, _ in some], pa.binary()), pa.array([len(d) for _, (d, _) in some], pa.int64()),
                     pa.array([np.array(d, np.uint16).tobytes() for _, (d, _) in some], pa.binary()),
                     pa.array([np.array(f, np.uint32).tobytes() for _, (_, f) in some], pa.binary())], schema=INDEX)
            number += 1

    source = pick(docs, doc_id="long", text="string").select("doc_id", F.col("text").cast("binary").alias("text"))
    return materialise(source.mapInArrow(run, "block long, doc_ids array<long>, n array<long>, term binary, df long, docs binary, tf binary"),
                       "term-index")


def islice_texts(rows: Iterator, wanted: frozenset[bytes] | None, many: int) -> Iterator[tuple[int | None, int, Counter]]:
    """Of the next documents: id, number of terms, frequencies of the wanted ones."""
    for doc_id, text in islice(rows, many):
        terms = (text or b"").translate(TERM_BYTES).split()
        yield doc_id, len(terms), Counter(terms if wanted is None else filter(wanted.__contains__, terms))


STATE = ("block long, bundle long, doc_ids array<long>, n array<long>, item_ids array<long>, rest array<array<long>>, "
         "slots binary, docs binary, scores binary")
STATE_ARROW = pa.schema([("block", pa.int64()), ("bundle", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())),
                         ("item_ids", pa.list_(pa.int64())), ("rest", pa.list_(pa.list_(pa.int64()))),
                         ("slots", pa.binary()), ("docs", pa.binary()), ("scores", pa.binary())])
FOUND_ARROW = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def length_norms(n: list[int], documents: int, terms: int) -> np.ndarray:
    """m of every document; whole numbers of any size."""
    return np.array([50 + 50 * x * documents // terms for x in n], np.int64)


def add_postings(state: dict, postings: pa.Table, documents: int, terms: int) -> np.ndarray:
    """The accumulators as a matrix (item slot, document) with the owner's
    contributions added."""
    total = np.zeros((len(state["item_ids"]), len(state["n"])), np.int64)
    total[np.frombuffer(state["slots"], np.uint16), np.frombuffer(state["docs"], np.uint16)] = np.frombuffer(state["scores"], np.int64)
    m = length_norms(state["n"], documents, terms)
    for row in postings.select(["w", "uses", "docs", "tf"]).to_pylist():
        at, tf = np.frombuffer(row["docs"], np.uint16), np.frombuffer(row["tf"], np.uint32).astype(np.int64)
        gain = row["w"] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[at]))
        for slot in row["uses"]:
            total[slot, at] += gain
    return total


def keep_promising(total: np.ndarray, rest: np.ndarray, k: int) -> np.ndarray:
    """Which accumulators can still be among the k best of the block."""
    keep = total > 0
    if total.shape[1] > k:
        kth = np.partition(total, total.shape[1] - k, axis=1)[:, total.shape[1] - k]
        keep &= total + rest[:, None] >= kth[:, None]
    return keep


def best_documents(scores: np.ndarray, ids: list[int | None], k: int) -> list[tuple[int | None, int]]:
    """The k best documents above 0: highest first, then ascending id, null last."""
    at = np.flatnonzero(scores > 0)
    if len(at) > k:
        kth = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= kth]
    chosen = sorted(at.tolist(), key=lambda i: (-scores[i], ids[i] is None, ids[i] or 0))[:k]
    return [(ids[i], int(scores[i])) for i in chosen]


def owner_stage(o: int, last: bool, documents: int, terms: int, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """What owner ``o`` does with a bundle and its own postings for it: adds
    them and passes the bundle on; the last owner gives the best documents."""
    def own(bundle: pa.Table, mine: pa.Table) -> pa.Table:
        out: dict = {name: [] for name in (FOUND_ARROW if last else STATE_ARROW).names}
        for row in bundle.to_pylist():
            total = add_postings(row, mine, documents, terms)
            if last:
                for item_id, scores in zip(row["item_ids"], total):
                    for doc_id, score in best_documents(scores, row["doc_ids"], k):
                        out["item_id"].append(item_id)
                        out["doc_id"].append(doc_id)
                        out["score"].append(score)
                continue
            slots, at = np.nonzero(keep_promising(total, np.array([r[o] for r in row["rest"]], np.int64), k))
            row.update(slots=slots.astype(np.uint16).tobytes(), docs=at.astype(np.uint16).tobytes(), scores=total[slots, at].tobytes())
            for name, values in out.items():
                values.append(row[name])
        return pa.table(out, schema=FOUND_ARROW if last else STATE_ARROW)

    return own


def search(items: DataFrame, docs: DataFrame, k: int = 50, owners: int = OWNERS, block_docs: int = BLOCK_DOCS,
           vocabulary_bytes: int = VOCABULARY_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item.

    N is the number of documents with a term, L that of all their terms, n that
    of one document's, df the number of documents with a term, tf a term's
    occurrences in the document."""
    bundles = materialise(item_bundles(items), "item-bundles")
    query = bundles.select("bundle", "slot", F.explode("terms").alias("term"))
    vocabulary = query.select("term").distinct()
    size = vocabulary.agg(F.coalesce(F.sum(F.octet_length("term") + 64), F.lit(0))).first()[0]
    sent = frozenset(bytes(r.term) for r in vocabulary.collect()) if size <= vocabulary_bytes else None
    index = index_documents(docs, sent, block_docs)
    blocks, postings = index.filter("term IS NULL").select("block", "doc_ids", "n"), index.filter("term IS NOT NULL").drop("doc_ids", "n")
    documents, terms = blocks.select(F.explode("n").alias("n")).agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    terms = max(1, terms)

    weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1)))
    weights = materialise(postings.join(vocabulary, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
                          .select("term", weight.alias("w")).filter("w > 0"), "term-weights")
    edges = weights.agg(F.percentile_approx("w", [i / owners for i in range(owners - 1, 0, -1)])).first()[0] or []
    owner = sum((F.when(F.col("w") < e, 1).otherwise(0) for e in edges), F.lit(0))
    uses = (query.join(weights.withColumn("owner", owner), "term").groupBy("owner", "bundle", "term")
            .agg(F.first("w").alias("w"), F.collect_list("slot").alias("uses")))
    uses = materialise(uses, "term-uses")

    # what the owners after each one could add to an item, at most
    later = [F.coalesce(F.sum(F.when(F.col("owner") > o, F.col("w") * IMPACT)), F.lit(0)).cast("long") for o in range(owners)]
    rests = (uses.select("owner", "bundle", "w", F.explode("uses").alias("slot")).groupBy("bundle", "slot")
             .agg(F.array(*later).alias("rest")))
    riders = (bundles.join(rests, ["bundle", "slot"], "left")
              .select("bundle", F.struct("slot", "item_id", F.coalesce("rest", F.array(*[F.lit(0).cast("long")] * owners)).alias("rest")).alias("item"))
              .groupBy("bundle").agg(F.sort_array(F.collect_list("item")).alias("items"))
              .select("bundle", F.col("items.item_id").alias("item_ids"), F.col("items.rest").alias("rest")))
    n_bundles = bundles.agg(F.coalesce(F.max("bundle") + 1, F.lit(0))).first()[0]
    empty = F.lit(b"").cast("binary")
    state = (blocks.withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(n_bundles - 1)).cast("array<long>")) if n_bundles else F.lit(0).cast("long"))
             .join(riders, "bundle").withColumns({c: empty for c in ("slots", "docs", "scores")}))

    for o in range(owners):
        last = o == owners - 1
        owned = (postings.join(uses.filter(F.col("owner") == o), "term")
                 .select(F.col("block").alias("at_block"), F.col("bundle").alias("at_bundle"), "w", "uses",
                         F.col("docs").alias("docs"), "tf"))
        state = (state.groupBy("block", "bundle").cogroup(owned.groupBy("at_block", "at_bundle"))
                 .applyInArrow(owner_stage(o, last, documents, terms, k), "item_id long, doc_id long, score long" if last else STATE))

    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return state.withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
