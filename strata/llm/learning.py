"""Bounded labelled samples and the Adam steps of the two classifiers."""

from __future__ import annotations

from array import array

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from strata.llm.common import pick


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int,
                    where: Column | None = None) -> list[Row]:
    """At most ``per_class`` texts of each label (doc_id, text, y), those with
    the smallest hash of doc_id; the bound is on labels, so it holds at any
    size of the tables.  One text stands for a doc_id with many rows (the
    least one), and the largest label if they differ; null ids, labels and
    texts are left out."""
    ids = pick(labels, doc_id="long", **{label: "int"}).dropna()
    if where is not None:
        ids = ids.filter(where)
    ids = ids.groupBy("doc_id").agg(F.max(label).alias("y")).withColumn("h", F.xxhash64("doc_id"))
    picked = [ids.filter(F.col("y") == y).orderBy("h", "doc_id").limit(per_class) for y in (0, 1)]
    chosen = picked[0].unionByName(picked[1]).select("doc_id", "y")
    return (pick(docs, doc_id="long", text="string").dropna()
            .join(F.broadcast(chosen), "doc_id")  # at most 2 * per_class rows
            .groupBy("doc_id", "y").agg(F.min("text").alias("text")).orderBy("doc_id").collect())


class Adam:
    """Plain Adam on a list of float arrays."""

    def __init__(self, params: list[np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = [np.zeros_like(p) for p in params]
        self.v = [np.zeros_like(p) for p in params]

    def step(self, grads: list[np.ndarray]) -> None:
        self.t += 1
        for p, g, m, v in zip(self.params, grads, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.999 ** self.t)) + 1e-8)


class TokenTable(dict):
    """Token -> position; what ``make`` returns for a token is computed on
    first sight and kept in one typed column a value.  The table is emptied
    when full; positions hold until the next call of :meth:`positions`."""

    def __init__(self, make, types: str, limit: int = 200_000):
        super().__init__()
        self.make, self.limit = make, limit
        self.columns = [array(t) for t in types]

    def __missing__(self, token):
        for column, value in zip(self.columns, self.make(token)):
            column.append(value)
        self[token] = at = len(self)
        return at

    def positions(self, tokens: list) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
            self.columns = [array(c.typecode) for c in self.columns]
        return np.fromiter(map(self.__getitem__, tokens), np.int32, len(tokens))

    def column(self, k: int) -> np.ndarray:
        return np.array(self.columns[k])

    def take(self, k: int, positions: np.ndarray) -> np.ndarray:
        return np.frombuffer(self.columns[k], self.columns[k].typecode)[positions]
