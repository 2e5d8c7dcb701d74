"""Token-id files: ids in byte planes, zstandard-compressed, with an index.

A chunk holds whole documents, about ``CHUNK_IDS`` ids.  Its ids, little-endian
unsigned 32-bit, are cut into blocks of ``BLOCK_IDS``; each block is transposed
so that the first bytes of all its ids come first, then the second bytes, and
so on (:func:`to_planes`), or, with ``bits=True``, bit by bit.  The planes of
one rank of all blocks are joined and compressed as one frame: the high planes
are nearly constant and cost almost nothing.

The files are written by Spark's own writer (atomic task commit, any
filesystem): a row is one chunk with its planes and the ids and lengths of its
documents, and ``index`` has one small row for each chunk with the position of
its first id in the whole corpus and the sizes of its planes.  Shards follow
the order of doc_id: range partitions on (doc_id, hash of the text), so that
one id with many rows can still be split.

Defined results: null text counts as empty; an empty text has the end id
alone; null doc_ids come first; rows with equal doc_id are ordered by the hash
of their text; an empty table gives no chunk.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import arrow_map, pick

BLOCK_IDS = 4096
CHUNK_IDS = 1 << 18
CACHE_WORDS = 700_000

CHUNK_SCHEMA = ("shard int, chunk int, local_start long, n_ids long, bits boolean, planes array<binary>, "
                "doc_ids array<long>, lengths array<long>")


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Planes of the ids, lowest first; the last block is filled with zeros."""
    n_blocks = -(-len(ids) // BLOCK_IDS)
    padded = np.zeros(n_blocks * BLOCK_IDS, "<u4")
    padded[:len(ids)] = ids
    by_byte = padded.view(np.uint8).reshape(n_blocks, BLOCK_IDS, 4)
    if not bits:
        return [np.ascontiguousarray(by_byte[:, :, k]).tobytes() for k in range(4)]
    each = np.unpackbits(by_byte, axis=2, bitorder="little")
    return [np.packbits(each[:, :, k], axis=1, bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n_ids: int, bits: bool = False) -> np.ndarray:
    if bits:
        each = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little") for p in planes], axis=1)
        by_byte = np.packbits(each, axis=1, bitorder="little")
    else:
        by_byte = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    return np.ascontiguousarray(by_byte).view("<u4").reshape(-1)[:n_ids]


# A Latin word and the signs after it: two matches of the splitting pattern,
# both stable under NFC.  (The apostrophe starts contractions and is left out.)
LATIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class WordIds(dict):
    """Word -> its ids as little-endian bytes.  The tokenizer's splitting
    pattern never joins characters across a blank or a line end and drops
    both, so a text's ids are the ids of its words one after another.  The
    letters of a Latin word, lower-cased, go straight to the merges of the
    tokenizer's model; all else takes the tokenizer's whole path.  When full,
    the table becomes ``old`` and words still in use come back from there."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer, pre_tokenizers
        super().__init__()
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.merge = self.tokenizer.model.tokenize
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {k: as_bytes(chr(k))[0][0] for k in range(0xC0, 0x100)}
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.old = self.copy()
            self.clear()
        ids = self.old.get(word)
        if ids is None:
            ids = self.compute(word)
        self[word] = ids
        return ids

    def compute(self, word: str) -> bytes:
        if not word:
            return b""
        latin = LATIN_WORD.fullmatch(word)
        if latin is None:
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        letters, signs = latin.groups()
        low = letters.lower()
        if signs or low != letters:
            return self[low] + (self[signs] if signs else b"")
        spelled = low if low.isascii() else low.translate(self.spelling)
        return array("I", [t.id for t in self.merge(spelled)]).tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=2)
def load_words(tokenizer_file: str) -> WordIds:
    return WordIds(tokenizer_file)


def encode_chunks(docs: DataFrame, tokenizer_file: str, end_id: int, shards: int | None = None,
                  bits: bool = False, level: int = 3) -> DataFrame:
    """One row a chunk, in shards by ascending doc_id."""
    n = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (pick(docs, doc_id="long", text="string").withColumn("tie", F.xxhash64("text"))
               .repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = load_words(tokenizer_file), zstandard.ZstdCompressor(level=level)
        end = np.array([end_id], "<u4").tobytes()
        shard, number, start = TaskContext.get().partitionId(), 0, 0
        held: list[bytes] = []
        doc_ids: list[int | None] = []
        lengths: list[int] = []

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            planes = [packer.compress(p) for p in to_planes(ids, bits)]
            return pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "chunk": pa.array([number], pa.int32()),
                 "local_start": pa.array([start], pa.int64()), "n_ids": pa.array([len(ids)], pa.int64()),
                 "bits": pa.array([bits]), "planes": pa.array([planes], pa.list_(pa.binary())),
                 "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                 "lengths": pa.array([lengths], pa.list_(pa.int64()))})

        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = words.encode(text.as_py()) + end
                held.append(ids)
                doc_ids.append(doc_id)
                lengths.append(len(ids) // 4)
                size += lengths[-1]
                if size >= CHUNK_IDS:
                    yield flush()
                    number, start, size = number + 1, start + size, 0
                    held, doc_ids, lengths = [], [], []
        if doc_ids:
            yield flush()

    return ordered.select("doc_id", "text").mapInArrow(run, CHUNK_SCHEMA)


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, **options) -> None:
    """``path``/chunks and ``path``/index.  The index gives each chunk its
    position in the corpus: totals of the shards (one row a shard) are summed
    up in order and added to the chunks' positions inside their shard."""
    spark = docs.sparkSession
    (encode_chunks(docs, tokenizer_file, end_id, **options)
     .write.mode("overwrite").option("compression", "none").parquet(f"{path}/chunks"))
    chunks = spark.read.parquet(f"{path}/chunks")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = (chunks.groupBy("shard").agg(F.sum("n_ids").alias("total"))
            .select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")))
    (chunks.select("shard", "chunk", "local_start", "n_ids", F.element_at("doc_ids", 1).alias("first_doc_id"),
                   F.element_at("doc_ids", -1).alias("last_doc_id"), F.size("doc_ids").alias("n_docs"),
                   F.transform("planes", F.length).alias("plane_bytes"))
     .join(base, "shard").withColumn("start", F.col("base") + F.col("local_start"))
     .drop("base", "local_start").write.mode("overwrite").parquet(f"{path}/index"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids (binary, little-endian unsigned 32-bit) of every
    document, chunk by chunk; a filter on the index prunes chunks before
    their planes are read."""
    chunks = spark.read.parquet(f"{path}/chunks").drop("local_start")
    index = spark.read.parquet(f"{path}/index").select("shard", "chunk", "start")
    return _unpack(chunks.join(index, ["shard", "chunk"]), "doc_id long, start long, ids binary",
                   lambda ids: ids.tobytes(), "ids")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files."""
    chunks = spark.read.parquet(f"{path}/chunks").drop("local_start")
    index = spark.read.parquet(f"{path}/index").select("shard", "chunk", "start")
    return _unpack(chunks.join(index, ["shard", "chunk"]),
                   "doc_id long, start long, n_tokens long, ids_crc32 long",
                   lambda ids: zlib.crc32(ids.tobytes()), "ids_crc32")


def _unpack(chunks: DataFrame, schema: str, value, name: str) -> DataFrame:
    def rows(batch: pa.RecordBatch) -> dict:
        unpack = zstandard.ZstdDecompressor()
        out: dict = {"doc_id": [], "start": [], "n_tokens": [], name: []}
        for i in range(batch.num_rows):
            chunk = {c: batch.column(c)[i].as_py() for c in ("n_ids", "bits", "planes", "doc_ids", "lengths", "start")}
            ids = from_planes([unpack.decompress(p) for p in chunk["planes"]], chunk["n_ids"], chunk["bits"])
            at = 0
            for doc_id, n in zip(chunk["doc_ids"], chunk["lengths"]):
                out["doc_id"].append(doc_id)
                out["start"].append(chunk["start"] + at)
                out["n_tokens"].append(n)
                out[name].append(value(ids[at:at + n]))
                at += n
        return out

    cols = chunks.select("n_ids", "bits", "planes", "doc_ids", "lengths", "start")
    return arrow_map(cols, rows, schema)
