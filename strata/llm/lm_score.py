"""Language-model scoring by prediction by partial matching (PPM).

The model is a trie of byte contexts of up to ``ORDER`` bytes, pretrained on
the training documents: at a context, a symbol with count c of a total T has
probability (2c - 1) / 2T, and the escape to the context one byte shorter
q / 2T with q the number of symbols seen (escape method D).  Symbols seen at
the longer context are excluded from the shorter one's T and q, and counts of
shorter contexts are those of update exclusion (the number of longer contexts
the symbol followed), so the probabilities of all symbols sum to 1.  Below the
empty context, symbols never seen share the rest evenly.  The score of a text
is the log10 probability of its bytes and of its end.

Spark holds the trie: blocks of documents list their distinct (context, byte)
keys, a shuffle sums the training counts, subtries (each with all contexts that
share their last two bytes) are turned into log probabilities of whole keys (escapes and
exclusions included), and these go back to the blocks that need them.  No task
and no broadcast holds the trie: a block needs the keys of its own texts and
ends when these are many, a subtrie has at most 256^3 keys, and what is sent to
every task are the counts of the contexts of one byte and none (at most 65,536).
Words of the base score take the same way, by a 63-bit hash ("the same word" is
up to its collisions); words themselves are kept for one stored row at a time.

Defined results: A-Z count as a-z for words and bytes alike; null text counts
as empty, which has one token, the end; a null id hashes as ''; every row gives
one row, repeated rows too; without training documents every byte has
probability 1/255 and base_score is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import crc_fold, materialise, pick

ORDER = 4
START, END = 0xFE, 0xFF  # bytes that no UTF-8 text has
SYMBOLS = 255            # all bytes but START
BLOCK_BYTES = 32 << 20   # texts of one block
BLOCK_KEYS = 1 << 20     # distinct keys of one block
SUBTRIES = 256           # groups of subtries
CHUNK_BYTES = 1 << 19    # texts of one stored row, and the bytes whose keys are made at a time
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SPACE = re.compile(rb"[\x20\x09-\x0D]")
WORD_BIT = np.uint64(1 << 63)
END_WORD = b""           # stands for the end token


def word_keys(words: Collection[bytes]) -> np.ndarray:
    """Negative keys: the words' hashes with the sign bit set."""
    return (np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) | WORD_BIT).view(np.int64)


def pieces(text: bytes, size: int = CHUNK_BYTES) -> Iterator[tuple[bytes, bool]]:
    """The text as (context + bytes, is last): pieces of about ``size`` bytes,
    cut after white space, so that a word is never cut."""
    start, before = 0, bytes([START]) * ORDER
    while len(text) - start > size:
        cut = SPACE.search(text, start + size)
        if cut is None or cut.end() == len(text):
            break
        yield before + text[start:cut.end()], False
        before, start = (before + text[max(0, cut.end() - ORDER):cut.end()])[-ORDER:], cut.end()
    yield before + text[start:] + bytes([END]), True


def piece_words(piece: bytes, last: bool) -> list[bytes]:
    return piece[ORDER:-1].split() + [END_WORD] if last else piece[ORDER:].split()


def byte_keys(data: bytes, lengths: np.ndarray) -> np.ndarray:
    """The key (ORDER context bytes and the symbol, big endian) of every byte
    of the joined pieces behind their contexts."""
    raw = np.frombuffer(data, np.uint8)
    keys = np.zeros(max(len(raw) - ORDER, 0), np.int64)
    for j in range(ORDER + 1):
        keys <<= 8
        keys |= raw[j:len(raw) - ORDER + j]
    valid = np.ones(len(keys), bool)
    starts = np.cumsum(lengths)[:-1]  # windows that reach into the next piece's context are no keys
    valid[(starts[:, None] + np.arange(-ORDER, 0)).ravel()] = False
    return keys[valid]


def parts(data: bytes, lengths: list[int], size: int = CHUNK_BYTES) -> Iterator[tuple[bytes, np.ndarray, list[int]]]:
    """The joined pieces about ``size`` bytes at a time, as byte_keys takes
    them, and the piece that each belongs to: a longer piece (of a long word)
    comes in parts, each behind its context."""
    taken, owners, got, at = [], [], 0, 0
    for owner, length in enumerate(lengths):
        for start in range(0, length - ORDER, size):
            taken.append(data[at + start:at + min(start + size + ORDER, length)])
            owners.append(owner)
            got += len(taken[-1])
            if got > size:
                yield b"".join(taken), np.array([*map(len, taken)]), owners
                taken, owners, got = [], [], 0
        at += length
    if taken:
        yield b"".join(taken), np.array([*map(len, taken)]), owners


@dataclass
class Block:
    """Pieces of one block, gathered in rows of ``chunk`` bytes, and its keys."""
    number: int
    chunk: int = CHUNK_BYTES
    size: int = 0
    open_size: int = 0
    open: list = field(default_factory=list)
    counted: list = field(default_factory=list)

    def add(self, row: int, doc_id: int | None, held: bool, piece: bytes, last: bool) -> dict | None:
        self.open.append((row, doc_id, held, last, piece))
        self.size += len(piece)
        self.open_size += len(piece)
        return self.close() if self.open_size > self.chunk else None

    def close(self) -> dict | None:
        """The open pieces as one row; their keys are counted."""
        if not self.open:
            return None
        rows, ids, held, last, texts = map(list, zip(*self.open))
        self.open, self.open_size = [], 0
        for flag in (False, True):
            mine = [p for p, h in zip(texts, held) if h is flag]
            words = Counter(chain.from_iterable(piece_words(p, x) for p, x, h in zip(texts, last, held) if h is flag))
            self.count(word_keys(words), np.fromiter(words.values(), np.int64, len(words)), flag)
            for data, lengths, _ in parts(b"".join(mine), [*map(len, mine)]):
                self.count(*np.unique(byte_keys(data, lengths), return_counts=True), flag)
        data = zstandard.ZstdCompressor(level=1).compress(b"".join(texts))
        return {"block": self.number, "rows": rows, "doc_ids": ids, "held": held, "last": last,
                "lengths": [*map(len, texts)], "data": data}

    def count(self, keys: np.ndarray, n: np.ndarray, held: bool) -> None:
        """Adds keys; summed when the new ones outnumber the sums."""
        self.counted.append((keys, np.zeros_like(n) if held else n))
        if sum(len(k) for k, _ in self.counted[1:]) > len(self.counted[0][0]):
            self.keys()

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Every distinct key of the closed pieces with its training count."""
        if len(self.counted) != 1:
            keys, n = map(np.concatenate, zip(*self.counted, (np.zeros(0, np.int64),) * 2))
            self.counted.clear()
            self.counted.append(sum_counts(keys, n))
        return self.counted[0]

    def full(self, block_bytes: int, block_keys: int) -> bool:
        return self.size > block_bytes or (sum(len(k) for k, _ in self.counted) > block_keys and len(self.keys()[0]) > block_keys)


def sum_counts(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], (np.add.reduceat(n, first) if len(keys) else n)


BLOCKS = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("rows", T.ArrayType(T.LongType())),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("held", T.ArrayType(T.BooleanType())),
    T.StructField("last", T.ArrayType(T.BooleanType())), T.StructField("lengths", T.ArrayType(T.LongType())),
    T.StructField("data", T.BinaryType()), T.StructField("key", T.LongType()), T.StructField("n", T.LongType())])


def to_blocks(docs: DataFrame, held_out: Column, block_bytes: int = BLOCK_BYTES, chunk_bytes: int = CHUNK_BYTES,
              block_keys: int = BLOCK_KEYS) -> DataFrame:
    """Rows of texts (``data``) and rows of keys (``key``, ``n``) of each block,
    written to the shared folder.  A block is what one task reads, up to
    ``block_bytes`` of text and ``block_keys`` keys; a longer text goes on in
    the next block."""
    from pyspark.sql.pandas.types import to_arrow_schema
    want = to_arrow_schema(BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 33
        block, row = Block(task, chunk_bytes), task

        def text_row(values: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in want], schema=want)

        def end_block() -> Iterator[pa.RecordBatch]:
            values = block.close()
            if values:
                yield text_row(values)
            keys, n = block.keys()
            for at in range(0, len(keys), 100_000):
                part = slice(at, at + 100_000)
                known = {"block": pa.array(np.full(len(keys[part]), block.number)), "key": pa.array(keys[part]), "n": pa.array(n[part])}
                yield pa.RecordBatch.from_arrays(
                    [known.get(f.name, pa.nulls(len(keys[part]), f.type)) for f in want], schema=want)

        for batch in batches:
            for doc_id, text, held in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                for piece, last in pieces((text.as_py() or b"").translate(LOWER), chunk_bytes):
                    values = block.add(row, doc_id, held, piece, last)
                    if values:
                        yield text_row(values)
                    if block.full(block_bytes, block_keys):
                        yield from end_block()
                        block = Block(block.number + 1, chunk_bytes)
                row += 1
        if block.size:
            yield from end_block()

    source = pick(docs, doc_id="long", text="string").select("doc_id", F.col("text").cast("binary").alias("text"))
    return materialise(source.withColumn("held", held_out).mapInArrow(run, BLOCKS), "lm-blocks")


# ---------------------------------------------------------------- the trie

@dataclass(frozen=True)
class Level:
    """Counts of one context length: sorted keys (context and symbol), and per
    sorted context its total and number of symbols."""
    keys: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    totals: np.ndarray
    symbols: np.ndarray

    @staticmethod
    def of(keys: np.ndarray, counts: np.ndarray) -> Level:
        contexts, first = np.unique(keys >> 8, return_index=True)
        totals = np.add.reduceat(counts, first) if len(keys) else counts
        return Level(keys, counts, contexts, totals, np.diff(np.r_[first, len(keys)]))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _find(self.keys, keys)

    def excluded(self, shorter: Level, mask: int) -> np.ndarray:
        """Per context: what its symbols count at the context one byte shorter."""
        if not len(self.keys):
            return np.zeros(0, np.int64)
        at, _ = shorter.find(self.keys & mask)  # always found: nested
        return np.add.reduceat(shorter.counts[at], np.searchsorted(self.keys >> 8, self.contexts))


def _find(have: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of each wanted key (any, if missing) and whether it is there."""
    if not len(have):
        return np.zeros(len(want), np.int64), np.zeros(len(want), bool)
    at = np.minimum(np.searchsorted(have, want), len(have) - 1)
    return at, have[at] == want


def shorter_level(level: Level, order: int) -> Level:
    """The level of ``order`` context bytes under update exclusion: a symbol
    counts once for each longer context it followed."""
    return Level.of(*np.unique(level.keys & ((1 << 8 * (order + 1)) - 1), return_counts=True))


def log_probabilities(keys: np.ndarray, counts: np.ndarray, low: list[Level]) -> np.ndarray:
    """log10 probability of every key of a subtrie; ``counts`` are training
    counts (0: needed only), ``low`` the levels of the shortest contexts, from
    the empty one, counted over the whole trie."""
    levels = {k: level for k, level in enumerate(low)}
    seen = counts > 0
    levels[ORDER] = Level.of(keys[seen], counts[seen])
    for k in range(ORDER - 1, len(low) - 1, -1):
        levels[k] = shorter_level(levels[k + 1], k)

    out = np.zeros(len(keys))
    todo = np.arange(len(keys))
    less_total = less_symbols = np.zeros(len(keys), np.int64)
    for k in range(ORDER, -1, -1):
        level, g = levels[k], keys[todo] & ((1 << 8 * (k + 1)) - 1)
        at, known = _find(level.contexts, g >> 8)
        total = symbols = np.zeros(len(todo), np.int64)
        if len(level.contexts):
            total = np.where(known, level.totals[at] - less_total, 0)
            symbols = np.where(known, level.symbols[at] - less_symbols, 0)
        key_at, hit = level.find(g)
        if hit.any():
            out[todo[hit]] += np.log10(2 * level.counts[key_at[hit]] - 1) - np.log10(2 * total[hit])
        escape = ~hit & (symbols > 0)
        out[todo[escape]] += np.log10(symbols[escape]) - np.log10(2 * total[escape])
        if k:
            mass, many = level.excluded(levels[k - 1], (1 << 8 * k) - 1), level.symbols
            less_total = np.where(known, mass[at], 0)[~hit] if len(mass) else np.zeros((~hit).sum(), np.int64)
            less_symbols = np.where(known, many[at], 0)[~hit] if len(mass) else np.zeros((~hit).sum(), np.int64)
        todo = todo[~hit]
    out[todo] -= np.log10(SYMBOLS - len(levels[0].keys))
    return out


def low_levels(counts: DataFrame) -> list[Level]:
    """The levels of no and of one context byte: at most 256 * 256 rows."""
    two = F.col("key").bitwiseAND(F.lit((1 << 24) - 1))
    rows = (counts.filter("key >= 0 AND n > 0").select(two.alias("key")).distinct()
            .groupBy(F.col("key").bitwiseAND(F.lit((1 << 16) - 1)).alias("key")).agg(F.count("*").alias("n"))
            .orderBy("key").toPandas())
    one = Level.of(rows["key"].to_numpy(np.int64), rows["n"].to_numpy(np.int64))
    return [shorter_level(one, 0), one]


def gram_values(counts: DataFrame) -> DataFrame:
    """key, value (log10 probability), of every byte key."""
    low = low_levels(counts)

    def subtrie(table: pa.Table) -> pa.Table:
        keys, n = sum_counts(table.column("key").to_numpy(), table.column("n").to_numpy())
        return pa.table({"key": keys, "value": log_probabilities(keys, n, low)})

    suffix = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF))
    return (counts.filter("key >= 0").select("key", "n").groupBy(F.pmod(F.xxhash64(suffix), F.lit(SUBTRIES)))
            .applyInArrow(subtrie, "key long, value double"))


def word_values(counts: DataFrame) -> tuple[DataFrame, int]:
    """key, value (log10 of the smoothed share) and known of every word, and
    the number of training tokens."""
    words = counts.filter("key < 0")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    value = F.log10((F.col("n") + 1) / F.lit(float(total + distinct + 1)))
    return words.select("key", value.alias("value"), (F.col("n") > 0).alias("known")), total


# ---------------------------------------------------------------- scoring

class KeyTable:
    """Finds sorted keys through a hash table of their positions; keys that
    share a slot with another are searched for."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint64(64 - max(4, int(8 * len(keys)).bit_length()))
        self.slots = np.zeros(1 << int(64 - self.shift), np.int32)
        self.slots[self._slot(keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def positions(self, keys: np.ndarray) -> np.ndarray:
        at = self.slots[self._slot(keys)]
        wrong = np.flatnonzero(self.keys[at] != keys)
        at[wrong] = np.searchsorted(self.keys, keys[wrong])
        return at


SCORES = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
SCORES_ARROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                          ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def score_block(texts: pa.Table, values: pa.Table) -> pa.Table:
    """Scores of the pieces of one block; its keys' values are all there."""
    keys = values.column("key").to_numpy()
    order = np.argsort(keys)
    keys, value = keys[order], values.column("value").to_numpy()[order]
    known = values.column("known").to_numpy(zero_copy_only=False)[order]
    grams_from = int(np.searchsorted(keys, 0))
    words, grams, gram_value = keys[:grams_from], KeyTable(keys[grams_from:]), value[grams_from:]
    out: dict = {name: [] for name in SCORES_ARROW.names}
    names = ("rows", "doc_ids", "held", "last", "lengths", "data")
    for rows, ids, held, last, lengths, packed in zip(*(texts.column(c) for c in names)):
        data, sizes, scores = zstandard.ZstdDecompressor().decompress(packed.as_py()), lengths.as_py(), np.zeros(len(lengths))
        for part, part_sizes, owners in parts(data, sizes):
            n_bytes = part_sizes - ORDER
            np.add.at(scores, owners, np.add.reduceat(gram_value[grams.positions(byte_keys(part, part_sizes))],
                                                      np.cumsum(n_bytes) - n_bytes))
        out["score"] += scores.tolist()
        ends = np.cumsum(sizes).tolist()
        found = [piece_words(data[end - size:end], is_last) for end, size, is_last in zip(ends, sizes, last.as_py())]
        place = dict.fromkeys(chain.from_iterable(found))
        place = dict(zip(place, np.searchsorted(words, word_keys(place)).tolist()))
        for tokens in found:
            at = np.fromiter(map(place.__getitem__, tokens), np.int64, len(tokens))
            out["n_tokens"].append(len(tokens))
            out["n_known"].append(int(np.count_nonzero(known[at])))
            out["base_score"].append(float(value[at].sum()))
        out["row"] += rows.as_py()
        out["doc_id"] += ids.as_py()
        out["held_out"] += held.as_py()
    return pa.table(out, schema=SCORES_ARROW)


def score_documents(docs: DataFrame, folds: int = 7, held_fold: int = 2, block_bytes: int = BLOCK_BYTES,
                    chunk_bytes: int = CHUNK_BYTES, block_keys: int = BLOCK_KEYS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every document; documents of fold ``held_fold`` train nothing."""
    blocks = to_blocks(docs, crc_fold(F.col("doc_id"), folds) == held_fold, block_bytes, chunk_bytes, block_keys)
    listed = blocks.filter("key IS NOT NULL")
    counts = materialise(listed.groupBy("key").agg(F.sum("n").alias("n")), "lm-counts")
    words, train_tokens = word_values(counts)
    values = gram_values(counts).withColumn("known", F.lit(False)).unionByName(words)
    needed = listed.select(F.col("block").alias("needed_by"), "key").join(values, "key")
    texts = blocks.filter("key IS NULL").drop("key", "n")
    scored = texts.groupBy("block").cogroup(needed.groupBy("needed_by")).applyInArrow(score_block, SCORES)
    return scored.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"),
        F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        F.sum("base_score").alias("base_score"), F.sum("score").alias("score")).drop("row")
