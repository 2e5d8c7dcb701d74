"""Byte-level BPE encoding and decoding with a local rank file.

The ``tiktoken`` library does the merges.  Long texts are first cut at
positions where the splitting pattern always ends a match, so that no call
sees more than about ``CHUNK_CHARS`` characters and the ids are those of the
whole text.  Decoding goes through raw bytes: an id sequence may start or end
inside a character and still gives back its exact bytes.

Defined results: null text counts as empty; empty text has no ids (the hash
of no bytes); a null id is kept; every row gives one row.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from strata.llm.common import arrow_map, pick

CHUNK_CHARS = 1 << 16
# By the classes of the pattern, in any script: no match of it holds white space
# behind something else, nor a letter beside a number, nor a letter or number
# followed by anything else; a cut there leaves the matches on both sides as they are.
SAFE_CUT = regex.compile(r"(?<=\P{White_Space})(?=\p{White_Space})|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})"
                         r"|(?<=[\p{L}\p{N}])(?=[^\p{White_Space}\p{L}\p{N}])")


@lru_cache(maxsize=4)
def load_encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def chunks(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    """Cut at the first safe position after every ``size`` characters; a text
    without one stays whole."""
    start = 0
    while len(text) - start > size:
        cut = SAFE_CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def encode(enc: tiktoken.Encoding, text: str | None, size: int = CHUNK_CHARS) -> list[int]:
    if not text:
        return []
    if len(text) <= size:
        return enc.encode_ordinary(text)
    return [i for chunk in chunks(text, size) for i in enc.encode_ordinary(chunk)]


def decode(enc: tiktoken.Encoding, ids: list[int]) -> bytes:
    return enc.decode_bytes(ids)


def encode_documents(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, ids (array<int>) of every text."""

    def rows(batch: pa.RecordBatch) -> dict:
        enc = load_encoding(rank_file, pattern)
        return {"doc_id": batch.column(0), "ids": [encode(enc, t) for t in batch.column(1).to_pylist()]}

    return arrow_map(pick(docs, doc_id="long", text="string"), rows, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, bytes (binary) of every id sequence; null ids give no bytes."""

    def rows(batch: pa.RecordBatch) -> dict:
        enc = load_encoding(rank_file, pattern)
        return {"doc_id": batch.column(0), "bytes": [decode(enc, i or []) for i in batch.column(1).to_pylist()]}

    return arrow_map(pick(encoded, doc_id="long", ids="array<int>"), rows, "doc_id long, bytes binary")


def count_documents(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens of every text, without carrying the ids."""

    def rows(batch: pa.RecordBatch) -> dict:
        enc = load_encoding(rank_file, pattern)
        return {"doc_id": batch.column(0), "n_tokens": [len(encode(enc, t)) for t in batch.column(1).to_pylist()]}

    return arrow_map(pick(docs, doc_id="long", text="string"), rows, "doc_id long, n_tokens long")


def round_trip_digests(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Encode and decode every text in one pass over the table: doc_id,
    n_tokens, ids_sha256 (of the comma-joined ids), decoded_sha256."""

    def rows(batch: pa.RecordBatch) -> dict:
        enc = load_encoding(rank_file, pattern)
        names = decimal_names(enc.n_vocab)
        out: dict = {"doc_id": batch.column(0), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in batch.column(1):
            ids = encode(enc, text.as_py())
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(decode(enc, ids)).hexdigest())
        return out

    return arrow_map(pick(docs, doc_id="long", text="string"), rows,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@lru_cache(maxsize=2)
def decimal_names(n: int) -> list[str]:
    return list(map(str, range(n)))
