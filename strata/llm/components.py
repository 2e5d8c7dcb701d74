"""Connected components of an edge table by repeated contraction.

Each round orders the vertices anew by a hash of the round and the vertex, maps
every vertex to its least neighbour (or itself) in that order and replaces the
edges by those between the images.  An order that no input can foresee leaves
only a share of the vertices that still have edges, on a path under a half, so
rounds grow with the logarithm of the component.  In the end every component is
named by its least vertex.  Every round is written to the shared folder.  A vertex with very many edges
is combined on the map side and, in the joins, split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b, long) -> vertex, root: the least vertex of its component."""
    left = materialise(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    labels, turn = None, 0
    while not left.isEmpty():
        turn += 1

        def place(vertex: str):
            return F.struct(F.xxhash64(F.col(vertex), F.lit(turn)).alias("h"), F.col(vertex).alias("vertex"))

        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy(F.col("a").alias("vertex")).agg(F.min(place("b")).alias("least"))
        image = materialise(nearest.select("vertex", F.least(place("vertex"), F.col("least"))["vertex"].alias("to")), "image")
        to_a = image.select(F.col("vertex").alias("a"), F.col("to").alias("x"))
        to_b = image.select(F.col("vertex").alias("b"), F.col("to").alias("y"))
        left = materialise(left.join(to_a, "a").join(to_b, "b").filter("x <> y")
                           .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        step = image.select(F.col("vertex").alias("root"), "to")
        labels = image.select("vertex", F.col("to").alias("root")) if labels is None else materialise(
            labels.join(step, "root", "left").select("vertex", F.coalesce("to", "root").alias("root")), "labels")
    if labels is None:
        return edges.sparkSession.createDataFrame([], "vertex long, root long")
    names = labels.groupBy("root").agg(F.min("vertex").alias("least"))
    return materialise(labels.join(names, "root").select("vertex", F.col("least").alias("root")), "components")
