"""Connected components by contraction, all distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b); label is the component's smallest node.

    Each round every node joins the neighbour of least hash (or stays, if that is
    itself), edges move to the new nodes, and those within one node or seen twice
    go. The hash changes each round, so that a chain shrinks by a constant
    factor whatever its order, and the edges of a dense group collapse at once.
    Nulls are no nodes; no edges give no rows.
    """
    edges = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = materialize(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    turn = 0
    while not edges.isEmpty():
        turn += 1
        first, second = (F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("to")) for c in ("a", "b"))
        best = edges.select(F.least(first, second).alias("p"), F.explode(F.array("a", "b")).alias("_n"))
        parents = best.groupBy("_n").agg(F.min("p").alias("p")).select("_n", F.col("p.to").alias("_to"))
        parents = materialize(parents, "parents")
        labels = materialize(labels.join(parents, F.col("label") == F.col("_n"), "left").select("node", F.coalesce("_to", "label").alias("label")), "labels")
        moved = edges.join(parents.select(F.col("_n").alias("a"), F.col("_to").alias("_a")), "a").join(parents.select(F.col("_n").alias("b"), F.col("_to").alias("_b")), "b")
        edges = materialize(moved.where("_a != _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "edges")
    least = labels.groupBy("label").agg(F.min("node").alias("_least"))
    return materialize(labels.join(least, "label").select("node", F.col("_least").alias("label")), "labels")
