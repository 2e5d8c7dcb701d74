"""Edit-aware token counts.

A document is kept as leaves, runs of its text cut where the splitting pattern
always ends a match, and a segment tree over them with sums of characters and
tokens.  An edit goes down the tree to the leaves it touches, with the
characters just before and after it as context; only those leaves are encoded
again, and the sums above them updated.  The cuts at both ends of the touched
leaves depend on unchanged characters alone, so the count stays that of the
whole edited text.

Edits are (start, end, text): code points [start, end) are replaced; an
array is applied in its order, each to the text as the one before left it, and
positions beyond the text are moved to its end.

Defined results: null text counts as empty; a null array has no edits; null
members (edit, position or text) count as no edit, 0 and empty; an end before
its start counts as the start; every row gives one row.
"""

from __future__ import annotations

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from strata.llm.bpe_codec import chunks, encode, load_encoding
from strata.llm.common import arrow_map, pick

LEAF_CHARS = 512
EDITS = "array<struct<start:long,end:long,text:string>>"


class CountTree:
    """Sums of characters and tokens over leaves, in two heap-ordered lists."""

    def __init__(self, enc: tiktoken.Encoding, text: str, tokens: list[int] | None = None, sizes: list[int] | None = None):
        self.enc = enc
        if sizes is None:
            self.leaves = list(chunks(text, LEAF_CHARS))
        else:
            self.leaves, at = [], 0
            for n in sizes:
                self.leaves.append(text[at:at + n])
                at += n
        self.encoded = 0  # characters encoded by edits
        self.layout(tokens or [len(encode(enc, x)) for x in self.leaves])

    def layout(self, tokens: list[int]) -> None:
        self.width = 1 << max(0, len(self.leaves) - 1).bit_length()
        fill = [0] * (self.width - len(self.leaves))
        self.chars = [0] * self.width + [len(x) for x in self.leaves] + fill
        self.tokens = [0] * self.width + tokens + fill
        for i in range(self.width - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def leaf_at(self, position: int) -> tuple[int, int]:
        """Leaf that holds a character, and the leaf's start."""
        i, start = 1, 0
        while i < self.width:
            i *= 2
            if position >= start + self.chars[i]:
                start += self.chars[i]
                i += 1
        return i - self.width, start

    def set_leaf(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        i = leaf + self.width
        self.chars[i], self.tokens[i] = len(text), tokens
        while i > 1:
            i //= 2
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def edit(self, start: int, end: int, text: str) -> None:
        start = min(max(start, 0), self.n_chars)
        end = min(max(end, start), self.n_chars)
        if not self.n_chars:
            first = last = begin = 0
        else:
            first, begin = self.leaf_at(max(start - 1, 0))
            last, _ = self.leaf_at(min(end, self.n_chars - 1))
        old = "".join(self.leaves[first:last + 1])
        new = old[:start - begin] + text + old[end - begin:]
        pieces = list(chunks(new, LEAF_CHARS))
        counts = [len(encode(self.enc, x)) for x in pieces]
        self.encoded += len(new)
        room = last + 1 - first
        if len(pieces) <= room:
            for k in range(room):
                self.set_leaf(first + k, pieces[k] if k < len(pieces) else "", counts[k] if k < len(pieces) else 0)
        else:  # more leaves than before: lay the tree out anew, without encoding the others
            tokens = self.tokens[self.width:self.width + len(self.leaves)]
            self.leaves[first:last + 1] = pieces
            tokens[first:last + 1] = counts
            self.layout(tokens)

    def text(self) -> str:
        return "".join(self.leaves)

    def state(self) -> tuple[list[int], list[int]]:
        """Characters and tokens of the leaves that hold text."""
        kept = [(len(x), t) for x, t in zip(self.leaves, self.tokens[self.width:]) if x]
        return [c for c, _ in kept], [t for _, t in kept]


def build_trees(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, text, leaf_chars, leaf_tokens: the kept state of every document."""

    def rows(batch: pa.RecordBatch) -> dict:
        enc = load_encoding(rank_file, pattern)
        states = [CountTree(enc, t.as_py() or "").state() for t in batch.column("text")]
        return {"doc_id": batch.column("doc_id"), "text": batch.column("text"),
                "leaf_chars": [c for c, _ in states], "leaf_tokens": [t for _, t in states]}

    return arrow_map(pick(docs, doc_id="long", text="string"), rows,
                     "doc_id long, text string, leaf_chars array<int>, leaf_tokens array<int>")


def apply_edits(trees: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``trees`` with a column ``edits`` -> the edited state, with n_before,
    n_tokens, n_edits and chars_encoded (by the edits)."""

    def rows(batch: pa.RecordBatch) -> dict:
        enc = load_encoding(rank_file, pattern)
        out: dict = {c: [] for c in ("text", "leaf_chars", "leaf_tokens", "n_before", "n_tokens", "n_edits", "chars_encoded")}
        for text, sizes, tokens, edits in zip(*(batch.column(c) for c in ("text", "leaf_chars", "leaf_tokens", "edits"))):
            tree = CountTree(enc, text.as_py() or "", tokens.as_py() or [0], sizes.as_py() or [0])
            edits = [e for e in edits.as_py() or [] if e is not None]
            out["n_before"].append(tree.n_tokens)
            for e in edits:
                tree.edit(e["start"] or 0, e["end"] or 0, e["text"] or "")
            sizes, tokens = tree.state()
            for c, v in (("text", tree.text()), ("leaf_chars", sizes), ("leaf_tokens", tokens), ("n_tokens", tree.n_tokens),
                         ("n_edits", len(edits)), ("chars_encoded", tree.encoded)):
                out[c].append(v)
        return {"doc_id": batch.column("doc_id"), **out}

    cols = pick(trees, doc_id="long", text="string", leaf_chars="array<int>", leaf_tokens="array<int>", edits=EDITS)
    return arrow_map(cols, rows, "doc_id long, text string, leaf_chars array<int>, leaf_tokens array<int>, n_before long, "
                                 "n_tokens long, n_edits long, chars_encoded long")
