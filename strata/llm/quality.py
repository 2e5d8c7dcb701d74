"""Quality rules: fixed counts and a calibrated linear classifier.

The classifier is a logistic regression over hashed words, character 3-grams
(case and signs kept) and word 2- and 3-grams, trained on a bounded sample of
labelled rows; a document's logit is a bias plus the mean weight of its words,
each the mean of its own features, plus the mean weights of its word 2-grams
and of its word 3-grams.  Word n-grams of one training text alone have no
weight, so that no text is learnt by heart.  The model's probabilities are calibrated by Platt scaling on a third of the sample that
the weights have not seen.  Scoring runs in Arrow batches over whole texts,
and ``keep_at`` is a fixed threshold.

Counts: words are maximal runs of characters other than blank, \\t, \\n, \\v,
\\f, \\r.  ``n_repeat_words`` compares windows of 8 words by 64-bit hashes.

Defined results: a null text has no words, fails the base rules and is not
kept; so does an empty one; without labels of both classes the base rules
alone decide; a null id is kept as it is.
"""

from __future__ import annotations

import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from strata.llm.common import arrow_map, pick
from strata.llm.learning import Adam, TokenTable, labelled_sample

BITS = 18
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
KEEP_AT = 0.25
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
with np.errstate(over="ignore"):
    ROLL = np.uint64(0x9E3779B97F4A7C15) ** np.arange(1, WINDOW + 1, dtype=np.uint64)
GRAMS = (2, 3)  # words


@dataclass
class Model:
    weights: np.ndarray | None  # of words and characters, then of each of GRAMS: 1 << BITS each
    bias: float
    slope: float  # calibration: probability = sigmoid(slope * logit + offset)
    offset: float
    kept: Judge | None = None

    def judge(self, text: str | None, keep_at: float) -> dict:
        """By one judge for each task, with its table of words."""
        self.kept = self.kept or Judge(self)
        return self.kept.judge(text, keep_at)


def features(word: bytes) -> list[int]:
    mask = (1 << BITS) - 1
    marked = b"\x02" + word + b"\x03"
    return [zlib.crc32(word, 7) & mask, *(zlib.crc32(marked[i:i + 3]) & mask for i in range(len(marked) - 2))]


def word_grams(hashes: np.ndarray, width: int) -> np.ndarray:
    """``hashes``: uint64, one a word.  The hashed features of its n-grams of ``width`` words."""
    n = max(0, len(hashes) - width + 1)
    with np.errstate(over="ignore"):
        mixed = np.zeros(n, np.uint64)
        for k in range(width):
            mixed = (mixed ^ hashes[k:k + n]) * ROLL[0]
            mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int32)


def repeat_words(hashes: np.ndarray) -> int:
    """``hashes``: uint64, one a word.  Words covered by a window of WINDOW words that is found twice or more."""
    n = len(hashes) - WINDOW + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        rolled = hashes[:n] * ROLL[0]
        for k in range(1, WINDOW):
            rolled += hashes[k:k + n] * ROLL[k]
    order = np.argsort(rolled, kind="stable")
    same = rolled[order[1:]] == rolled[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    edge = np.zeros(len(hashes) + 1, np.int64)
    starts = np.flatnonzero(hit)
    edge[starts] += 1
    np.add.at(edge, starts + WINDOW, -1)
    return int((edge.cumsum()[:-1] > 0).sum())


def text_counts(text: str, n_words: int, hashes: np.ndarray) -> dict:
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return {"n_words": n_words, "word_chars": len(text) - sum(map(text.count, BLANKS)),
            "n_symbols": sum(map(text.count, SYMBOLS)), "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": repeat_words(hashes)}


def gram_table(hashes: list[np.ndarray], seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weight's place, text, share of the text's n-grams) of the word n-grams
    that two or more of the ``seen`` texts have."""
    parts = []
    for k, width in enumerate(GRAMS, 1):
        for at, own in enumerate(hashes):
            found, times = np.unique(word_grams(own, width), return_counts=True)
            parts.append((found + (k << BITS), np.full(len(found), at, np.int32), (times / max(1, times.sum())).astype(np.float32)))
    gram, doc, share = (np.concatenate(x) for x in zip(*parts))
    common = np.bincount(gram, seen[doc], (1 + len(GRAMS)) << BITS) >= 2
    return gram[common[gram]], doc[common[gram]], share[common[gram]]


def fit(sample: list, steps: int = 200, rate: float = 0.05, l2: float = 1e-6) -> Model:
    y = np.array([r.y for r in sample], float)
    fold = np.array([xxhash.xxh32_intdigest(str(r.doc_id)) % 3 for r in sample])
    if any(len(set(y[part])) < 2 for part in (fold == 0, fold != 0)):
        return Model(None, 0.0, 1.0, 0.0)
    grams = array("i")

    def make(word: bytes) -> tuple[int, int]:
        own = features(word)
        grams.extend(own)
        return len(own), xxhash.xxh64_intdigest(word)

    table = TokenTable(make, "iQ", limit=1 << 40)
    rows = [table.positions(r.text.encode().split()) for r in sample]
    size = np.array([max(1, len(r)) for r in rows])
    doc, word = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows]), np.concatenate(rows)
    share = 1.0 / size[doc]
    flat, of = np.array(grams), np.repeat(np.arange(len(table), dtype=np.int32), table.column(0))
    per = np.bincount(of)
    seen = fold != 0
    gram, gram_doc, gram_share = gram_table([table.take(1, r) for r in rows], seen)
    weight, bias = np.zeros((1 + len(GRAMS)) << BITS), np.zeros(1)
    adam = Adam([weight, bias], rate)
    balance = np.where(y == 1, 0.5 / y[seen].mean(), 0.5 / (1 - y[seen].mean())) * seen / seen.sum()

    def logits():
        by_word = np.bincount(of, weight[flat]) / per
        return (bias[0] + np.bincount(doc, by_word[word] * share, len(rows))
                + np.bincount(gram_doc, weight[gram] * gram_share, len(rows)))

    for _ in range(steps):
        dz = (1 / (1 + np.exp(-logits())) - y) * balance
        by_word = np.bincount(word, dz[doc] * share, len(per)) / per
        adam.step([np.bincount(flat, by_word[of], len(weight))
                   + np.bincount(gram, dz[gram_doc] * gram_share, len(weight)) + l2 * weight, np.array([dz.sum()])])
    z, target = logits()[fold == 0], y[fold == 0]
    n1, n0 = target.sum(), (1 - target).sum()
    soft = np.where(target == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))  # Platt's smoothed targets
    line = np.array([1.0, 0.0])
    for _ in range(50):  # Newton steps on slope and offset
        p = 1 / (1 + np.exp(-(line[0] * z + line[1])))
        grad = np.array([((p - soft) * z).sum(), (p - soft).sum()])
        w = p * (1 - p)
        hess = np.array([[(w * z * z).sum(), (w * z).sum()], [(w * z).sum(), w.sum()]]) + 1e-6 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        line -= move / max(1.0, np.abs(move).max())
    return Model(weight.astype(np.float32), float(bias[0]), float(line[0]), float(line[1]))


class Judge:
    def __init__(self, model: Model):
        self.model = model
        weight = (model.weights if model.weights is not None else np.zeros(1 << BITS))[:1 << BITS].tolist().__getitem__

        def make(word: bytes) -> tuple[int, float]:
            grams = features(word)
            return xxhash.xxh64_intdigest(word), sum(map(weight, grams)) / len(grams)

        self.table = TokenTable(make, "Qd")

    def judge(self, text: str | None, keep_at: float) -> dict:
        text = text or ""
        words = text.encode().split()
        at = self.table.positions(words)
        hashes = self.table.take(0, at)
        out = text_counts(text, len(words), hashes)
        if self.model.weights is None or not words:
            p = 1.0
        else:
            logit = self.model.bias + float(self.table.take(1, at).mean())
            for k, width in enumerate(GRAMS, 1):
                if len(words) >= width:
                    logit += float(self.model.weights[word_grams(hashes, width) + (k << BITS)].mean())
            p = float(1 / (1 + np.exp(-(self.model.slope * logit + self.model.offset))))
        out["probability"] = p
        out["base_failed"] = (out["n_words"] < MIN_WORDS
                              or 100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
        out["kept"] = not out["base_failed"] and p >= keep_at
        return out


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1500) -> Model:
    return fit(labelled_sample(docs, labels, "quality", per_class))


VERDICT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, probability double, kept boolean")


def judge_documents(docs: DataFrame, model: Model, keep_at: float = KEEP_AT) -> DataFrame:
    """doc_id, the counts, base_failed, probability (of quality 1), kept."""

    def rows(batch: pa.RecordBatch) -> dict:
        found = [model.judge(t.as_py(), keep_at) for t in batch.column(1)]
        return {"doc_id": batch.column(0)} | {c: [f[c] for f in found] for c in found[0]}

    return arrow_map(pick(docs, doc_id="long", text="string"), rows, f"doc_id long, {VERDICT}")


def keep_good(docs: DataFrame, model: Model, keep_at: float = KEEP_AT) -> DataFrame:
    """Rows of documents that are kept."""
    cols = pick(docs, doc_id="long", text="string", lang="string", source="string", n_chars="long")

    def rows(batch: pa.RecordBatch) -> dict:
        keep = pa.array([model.judge(t.as_py(), keep_at)["kept"] for t in batch.column("text")])
        return {c: batch.column(c).filter(keep) for c in batch.schema.names}

    return arrow_map(cols, rows, "doc_id long, text string, lang string, source string, n_chars long")
