"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's logit is a bias plus the
weights of its distinct words' hashed features (the word and its prefixes).  The
weights are trained from document labels alone, by the noisy-or of the sentences,
1 - (1 - b) * prod((1 - sigmoid(logit)) / (1 - b)) with the background rate
b = sigmoid(bias), which counts once a document.  A document is scored by the
noisy-or of its different offending sentences, those of a probability of at least
``OFFENDING``; one without any has the score of its worst sentence.  The bias is
set so that the worst sentence of a share ``CLEAN`` of the clean training texts
stays below it.  So doubtful sentences don't add up, and joined texts without an offending one have the score of the worst of
them, however many they are.  Sentences end at . ! ? and line ends, and after
``SENTENCE_WORDS`` words; a blank line is none.

The model is trained on the driver from a bounded sample of labelled texts
(``per_class`` texts of each label); its weights (2**18 floats at most, 1 MB)
go to the tasks with the function, and every whole text is scored in Arrow
batches.  A word's weight is computed once a task and kept.

Defined results: null and empty texts and those of white space alone have no
sentence, and score 0; with no
label of one of the classes, all texts get the share of label 1, smoothed;
repeated rows are scored alike; a null id is kept.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import arrow_map, crc_fold, pick
from strata.llm.learning import Adam, TokenTable, labelled_sample

BITS = 18
PREFIXES = (3, 4, 5, 6)
WIDTH = len(PREFIXES) + 1
SENTENCE_WORDS = 40
OFFENDING = 0.5
CLEAN = 0.995  # share of clean training texts whose worst sentence is below OFFENDING
EDGES = "".join(map(chr, (*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)))) + "«»“”„’‘…¿¡–—"
LINE_END = "\0"


@dataclass
class Model:
    weights: np.ndarray | None  # None: constant
    bias: float
    kept: Scorer | None = None

    def scorer(self) -> Scorer:
        """One for each task, with its table of words."""
        self.kept = self.kept or Scorer(self)
        return self.kept


def features(token: str) -> list[int]:
    """Hashed features of a token; 0 stands for none and has weight 0."""
    word = token.strip(EDGES).lower().encode()
    if not word or word == b"\0":
        return [0] * WIDTH
    mask = (1 << BITS) - 1
    out = [zlib.crc32(word, 7) & mask or 1]
    for n in PREFIXES:
        out.append((zlib.crc32(word[:n], n) & mask or 1) if len(word) > n else 0)
    return out


def tokens_of(text: str | None) -> list[str]:
    return text.replace("\n", " \0 ").split() if text else []


def ends(token: str) -> bool:
    return token == LINE_END or token.rstrip("\"')»”’").endswith((".", "!", "?"))


def sentence_starts(end: np.ndarray) -> np.ndarray:
    """Positions where sentences start, from the marks of tokens that end one."""
    at = np.arange(len(end))
    first = np.concatenate(([True], end[:-1]))
    begun = np.maximum.accumulate(np.where(first, at, 0))
    return np.flatnonzero((at - begun) % SENTENCE_WORDS == 0)


def is_blank(tokens: list[str], starts: np.ndarray) -> np.ndarray:
    """Of sentences, whether they are a line end alone."""
    return np.array([tokens[a] == LINE_END for a in starts], bool)


def noisy_or(logits: np.ndarray, base: float = 0.0) -> float:
    """``base``: -log(1 - background rate), which counts once."""
    return float(-np.expm1(-base - (np.logaddexp(0, logits) - base).sum()))


def fit(sample: list, steps: int = 200, rate: float = 0.1, l1: float = 1e-4, min_docs: int = 4) -> Model:
    """``sample``: rows with text and y.  Weights are at least 0 and shrunk
    towards it: ordinary words end at exactly 0 and the bias counts once a
    text, so that neither length nor repetition alone raises a score, and only
    features found in ``min_docs`` texts can get a weight."""
    y = np.array([r.y for r in sample], float)
    if len(set(y)) < 2:
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Model(None, float(np.log(share / (1 - share))))
    table = TokenTable(lambda t: (ends(t), *features(t)), "b" + "i" * WIDTH, limit=1 << 40)
    words, sentence, doc, n_sentences = [], [], [], 0
    for i, r in enumerate(sample):
        tokens = tokens_of(r.text)
        at = table.positions(tokens)
        if not len(at):
            continue
        starts = sentence_starts(table.take(0, at) != 0)
        starts = starts[~is_blank(tokens, starts)]
        if not len(starts):
            continue
        mark = np.zeros(len(at), np.int64)
        mark[starts] = 1
        words.append(at[starts[0]:])
        sentence.append(n_sentences + mark[starts[0]:].cumsum() - 1)
        doc += [i] * len(starts)
        n_sentences += len(starts)
    if not words:
        return Model(None, -20.0)
    words, sentence, doc = np.concatenate(words), np.concatenate(sentence), np.array(doc, np.int32)
    feats = np.stack([table.column(k).astype(np.int64) for k in range(1, WIDTH + 1)], axis=1)
    once = np.unique(sentence * np.int64(len(feats)) + words)  # each word once a sentence
    sentence, words = (x.astype(np.int32) for x in np.divmod(once, len(feats)))
    del once
    pairs = np.unique(doc[sentence] * np.int64(len(feats)) + words)  # each word once a text
    by_text = np.unique((pairs // len(feats) << BITS)[:, None] + feats[pairs % len(feats)])
    common = np.bincount(by_text & (1 << BITS) - 1, minlength=1 << BITS) >= min_docs
    common[0] = False
    used = np.flatnonzero(common)  # weights of these alone are trained; position 0 stands for the rest
    place = np.zeros(1 << BITS, np.int64)
    place[used] = np.arange(1, len(used) + 1)
    feats = place[feats]
    flat, n_words = feats.ravel(), len(feats)
    weight, bias = np.zeros(len(used) + 1), np.array([-4.0])
    adam = Adam([weight, bias], rate)
    some = np.bincount(doc, minlength=len(y)) > 0  # texts with a sentence
    for _ in range(steps):
        z = bias[0] + np.bincount(sentence, weight[feats].sum(1)[words], n_sentences)
        base, rate_0 = np.logaddexp(0, bias[0]), 1 / (1 + np.exp(-bias[0]))
        mass = np.where(some, base + np.bincount(doc, np.logaddexp(0, z) - base, len(y)), 0)  # -log(1 - score)
        pull = np.where(y == 1, -np.exp(-mass) / np.maximum(-np.expm1(-mass), 1e-9), 1.0) / len(y)
        p = 1 / (1 + np.exp(-z))
        dz = pull[doc] * p
        by_word = np.bincount(words, dz[sentence], n_words)
        grad = np.bincount(flat, np.repeat(by_word, WIDTH), len(weight)) + l1
        adam.step([grad, np.array([rate_0 * pull[some].sum() + (pull[doc] * (p - rate_0)).sum()])])
        np.maximum(weight, 0, out=weight)
        weight[0] = 0
    full = np.zeros(1 << BITS, np.float32)
    full[used] = np.where(weight[1:] < 0.1 * weight.max(), 0, weight[1:])  # traces would add up
    raw = Scorer(Model(full, float(bias[0])))
    worst = [z.max() if len(z := raw.logits(r.text)[0]) else bias[0] for r in sample if not r.y]
    cut = max(np.quantile(worst, CLEAN) + 1e-6, bias[0] / 2)  # never beside the background
    return Model(full, float(bias[0] - cut))


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        weight = (model.weights if model.weights is not None else np.zeros(1 << BITS)).tolist().__getitem__
        self.table = TokenTable(lambda t: (sum(map(weight, features(t))), ends(t)), "db")

    def logits(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
        """Of each sentence with a weighted word; the positions of the tokens
        they start with, and of those after their last; whether the text has
        any sentence."""
        tokens = tokens_of(text)
        if not tokens:
            return np.empty(0), np.empty(0, int), np.empty(0, int), False
        words = self.table.positions(tokens)
        weights = self.table.take(0, words)
        some = np.flatnonzero(weights)
        if not len(some):
            return np.empty(0), np.empty(0, int), np.empty(0, int), any(t != LINE_END for t in tokens)
        starts = sentence_starts(self.table.take(1, words) != 0)
        sentence = np.searchsorted(starts, some, "right") - 1
        _, first = np.unique(sentence * np.int64(len(self.table)) + words[some], return_index=True)  # each word once a sentence
        z = np.zeros(len(starts))
        np.add.at(z, sentence[first], weights[some[first]])
        weighted = np.unique(sentence)
        return self.model.bias + z[weighted], starts[weighted], np.append(starts, len(tokens))[weighted + 1], True

    def score(self, text: str | None) -> float:
        if self.model.weights is None:
            return float(1 / (1 + np.exp(-self.model.bias)))
        z, starts, stops, some = self.logits(text)
        if not some:
            return 0.0
        base = np.logaddexp(0, self.model.bias)
        if not len(z):
            return noisy_or(z, base)
        bad = np.flatnonzero(z >= np.log(OFFENDING / (1 - OFFENDING)))
        if len(bad) < 2:
            return noisy_or(z[[z.argmax()]], base)
        tokens = tokens_of(text)
        different = {tuple(tokens[starts[i]:stops[i]]): i for i in bad}
        return noisy_or(z[list(different.values())], base)

    def offending(self, text: str | None, threshold: float) -> list[dict]:
        """Spans of the sentences at or over ``threshold``: code points, end
        exclusive, with their probability."""
        if self.model.weights is None:
            return []
        z, starts, stops, _ = self.logits(text)
        if not len(z) or z.max() < np.log(threshold / (1 - threshold)):
            return []
        spans = [m.span() for m in re.finditer(r"\S+|\n", text)]
        prob = 1 / (1 + np.exp(-z))
        return [{"start": spans[a][0], "end": spans[b - 1][1], "probability": float(p)}
                for a, b, p in zip(starts, stops, prob) if p >= threshold]


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1500, folds: int = 5) -> Model:
    """From labels of rows outside fold 0 of ``crc_fold`` alone."""
    return fit(labelled_sample(docs, labels, "toxic", per_class, crc_fold(F.col("doc_id"), folds) != 0))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every text."""

    def rows(batch: pa.RecordBatch) -> dict:
        scorer = model.scorer()
        return {"doc_id": batch.column(0), "score": [scorer.score(t.as_py()) for t in batch.column(1)]}

    return arrow_map(pick(docs, doc_id="long", text="string"), rows, "doc_id long, score double")


def locate(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, sentences array<struct<start, end, probability>>."""

    def rows(batch: pa.RecordBatch) -> dict:
        scorer = model.scorer()
        return {"doc_id": batch.column(0), "sentences": [scorer.offending(t.as_py(), threshold) for t in batch.column(1)]}

    return arrow_map(pick(docs, doc_id="long", text="string"), rows,
                     "doc_id long, sentences array<struct<start:long,end:long,probability:double>>")


def classify(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, and the offending sentences as
    start:end in code points, end exclusive, joined by commas."""

    def rows(batch: pa.RecordBatch) -> dict:
        scorer, texts = model.scorer(), [t.as_py() for t in batch.column(1)]
        scores = [scorer.score(t) for t in texts]
        spans = [scorer.offending(t, threshold) if s >= threshold else [] for t, s in zip(texts, scores)]
        return {"doc_id": batch.column(0), "score": scores, "offending": [",".join(f"{x['start']}:{x['end']}" for x in d) for d in spans]}

    scored = arrow_map(pick(docs, doc_id="long", text="string"), rows, "doc_id long, score double, offending string")
    return scored.select("doc_id", (crc_fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "offending")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Rows of documents whose score is under ``threshold``."""
    cols = pick(docs, doc_id="long", text="string", lang="string", source="string", n_chars="long")

    def rows(batch: pa.RecordBatch) -> dict:
        scorer = model.scorer()
        keep = pa.array([scorer.score(t.as_py()) < threshold for t in batch.column("text")])
        return {c: batch.column(c).filter(keep) for c in batch.schema.names}

    return arrow_map(cols, rows, "doc_id long, text string, lang string, source string, n_chars long")
