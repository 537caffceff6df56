"""Dependency graphs: closure, trees, PageRank, components, contraction.

Loops run on the driver over distributed tables. What changes in a round is
checkpointed in spark.checkpoint.dir, so that plans stay small and lost executors
cost one round; what stays (the edges) is dealt out by its key once and kept, so
that only the frontier or the ranks move.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewright.lineage import cut


@contextmanager
def _kept_by(df: DataFrame, key: str):
    """df, dealt out by key and kept by the executors; what is lost is made again from df."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = df.repartition(n, key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def _frontiers(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, depth) from edges (src, dst) that are dealt out by src; a checkpoint for each depth."""
    found = [cut(seeds.select("node").where("node is not null").distinct().withColumn("depth", F.lit(0)))]
    while True:
        reached = reduce(DataFrame.unionByName, found)
        step = edges.join(found[-1].select(F.col("node").alias("src")), "src", "left_semi").select(F.col("dst").alias("node")).distinct()
        fresh = cut(step.join(reached, "node", "left_anti").withColumn("depth", F.lit(len(found))))
        if fresh.isEmpty():
            return reached
        found.append(fresh)


def closure(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, depth): everything reachable from seeds (node) over edges (src, dst), at its least distance."""
    pairs = edges.select("src", "dst").where("src is not null and dst is not null").distinct()
    with _kept_by(pairs, "src") as kept:
        return _frontiers(seeds, kept)


def counted_edges(edges: DataFrame, none: str | None = "__none__") -> DataFrame:
    """Edges (src, dst and any attributes) with `copies`, how often each occurs; rows whose dst is blank or the marker of no dependency go."""
    text = F.trim(F.col("dst").cast("string"))
    real = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull() & (text != "") & (text != F.lit(none) if none is not None else F.lit(True)))
    return real.groupBy(*(F.col("`" + c.replace("`", "``") + "`") for c in edges.columns)).agg(F.count("*").alias("copies"))


def dependency_tree(seeds: DataFrame, edges: DataFrame, keep_unknown: bool = True, known: DataFrame | None = None, none: str | None = "__none__", repeats: bool = False) -> DataFrame:
    """The edges that leave reachable nodes, with their attributes.

    A blank dst and the marker of no dependency are no edge. Targets that nothing
    is known about are kept unless keep_unknown is off, when those outside known
    (node) go, and nothing is reached through them. With repeats an edge comes as
    often as the input has it, else once. The closure runs over counted edges, so
    that repeats never travel.
    """
    counted = cut(counted_edges(edges, none))
    if not keep_unknown and known is not None:
        counted = cut(counted.join(known.select(F.col("node").alias("dst")).distinct(), "dst", "left_semi").select(*counted.columns))
    with _kept_by(counted, "src") as kept:
        reached = _frontiers(seeds, kept.select("src", "dst"))
        tree = cut(kept.join(reached.select(F.col("node").alias("src")), "src", "left_semi").select(*counted.columns))
    if repeats:
        tree = tree.withColumn("copies", F.explode(F.sequence(F.lit(1), "copies")))
    return tree.drop("copies")


def pagerank(edges: DataFrame, vertices: DataFrame, alpha: float = 0.85, rounds: int | None = None, tolerance: float = 1e-6, self_loops: bool = False) -> DataFrame:
    """(node, rank): personalised PageRank over the simple digraph of edges (src, dst).

    vertices: node and weight (personalisation; a missing weight counts 0, a zero
    total means uniform). Nodes are those of vertices and edges. With `rounds`
    unset, iterates until the ranks' total change is below N times the
    tolerance, 100 times at most.
    """
    edges = edges.select("src", "dst").where("src is not null and dst is not null").distinct()
    edges = cut(edges if self_loops else edges.where("src != dst"))
    given = vertices.where("node is not null").groupBy("node").agg(F.sum("weight").alias("w"))
    out = edges.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("out"))
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).union(given.select("node")).distinct()
    nodes = cut(nodes.join(given, "node", "left").join(out, "node", "left").select("node", F.coalesce("w", F.lit(0.0)).cast("double").alias("w"), "out"))
    n, total = nodes.agg(F.count("*"), F.sum("w")).first()
    if not n:
        return nodes.select("node", F.lit(0.0).alias("rank"))
    share = F.col("w") / float(total) if total else F.lit(1.0 / n)
    ranks = nodes.select("node", share.alias("p"), "out", F.lit(1.0 / n).alias("rank"))
    links = edges.join(out.select(F.col("node").alias("src"), "out"), "src").select("src", "dst", (1.0 / F.col("out")).alias("part"))
    with _kept_by(links, "src") as links:
        loose = nodes.where("out is null").count() / n
        for _ in range(rounds or 100):
            sent = links.join(ranks.select(F.col("node").alias("src"), "rank"), "src").groupBy(F.col("dst").alias("node")).agg(F.sum(F.col("rank") * F.col("part")).alias("got"))
            rank = alpha * (F.coalesce("got", F.lit(0.0)) + loose * F.col("p")) + (1 - alpha) * F.col("p")
            after = cut(ranks.withColumnRenamed("rank", "old").join(sent, "node", "left").select("node", "p", "out", "old", rank.alias("rank")))
            loose, moved = after.agg(F.coalesce(F.sum(F.when(F.col("out").isNull(), F.col("rank"))), F.lit(0.0)), F.sum(F.abs(F.col("rank") - F.col("old")))).first()
            ranks = after.drop("old")
            if rounds is None and moved < n * tolerance:
                break
    return ranks.select("node", "rank")


def _key(c: str, turn: int) -> Column:
    """A node with its hash of this round in front."""
    return F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("to"))


def _joined_in_one_task(pairs: DataFrame) -> DataFrame:
    """(node, to) for the nodes of pairs (a, b), which one task puts together: for a bounded number of pairs."""
    kind = pairs.schema["a"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, number, above, types = [], {}, [], None

        def find(i: int) -> int:
            while above[i] != i:
                above[i] = above[above[i]]
                i = above[i]
            return i

        for batch in batches:
            types = batch.schema.field("a").type
            for pair in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                roots = []
                for node in pair:
                    key = repr(node) if isinstance(node, dict | list) else node
                    if key not in number:
                        number[key] = len(nodes)
                        nodes.append(node)
                        above.append(len(above))
                    roots.append(find(number[key]))
                above[max(roots)] = min(roots)
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(nodes, types), pa.array([nodes[find(i)] for i in range(len(nodes))], types)], ["node", "to"])

    return pairs.coalesce(1).mapInArrow(run, StructType().add("node", kind).add("to", kind))


def contractions(edges: DataFrame, few: int = 1 << 17) -> list[DataFrame]:
    """Rounds of contraction: (node, to, least) for the nodes each round still had, until no edge is left.

    Every node follows the neighbour of least hash for two steps (a pair that
    follows each other meets in one of both); edges move to the nodes reached, and
    what then lies within one node or is there twice goes. The hash changes each
    round, so that a chain shrinks by a constant factor whatever its order, and a
    star collapses at once. At most `few` edges are a
    last round of one task. least: the smallest of the original nodes that a
    node stands for.
    """
    pairs = edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).where("src is not null and dst is not null and src <> dst")
    pairs, stands, rounds = cut(pairs.distinct()), None, []
    while left := pairs.count():
        turn = len(rounds)
        if left <= few:
            moved = _joined_in_one_task(pairs)
        else:
            both = pairs.select(F.explode(F.array(*(F.struct(F.col(x).alias("node"), _key(y, turn).alias("k")) for x, y in ("ab", "ba")))).alias("e")).select("e.*")
            first = both.groupBy("node").agg(F.min("k").alias("k")).select("node", F.col("k.to").alias("to"))
            moved = first.join(first.select(F.col("node").alias("to"), F.col("to").alias("_to")), "to")
            back = F.when(F.col("_to") == F.col("node"), F.least(_key("node", turn), _key("to", turn))["to"]).otherwise(F.col("_to"))  # two that follow each other meet in one
            moved = moved.select("node", back.alias("to"))
        moved = cut(moved.withColumn("least", F.col("node")) if stands is None else moved.join(stands, "node"))
        rounds.append(moved)
        if left <= few:
            break
        stands = moved.groupBy(F.col("to").alias("node")).agg(F.min("least").alias("least"))
        a, b = (moved.select(F.col("node").alias(c), F.col("to").alias(f"_{c}")) for c in ("a", "b"))
        pairs = cut(pairs.join(a, "a").join(b, "b").where("_a <> _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct())
    return rounds


def components(edges: DataFrame, nodes: DataFrame | None = None, few: int = 1 << 17) -> DataFrame:
    """(node, label): label is the smallest node of the component; nodes without edges are their own.

    Labels go back from the last contraction to the first, so that every round
    costs what it still had of the graph.
    """
    label = edges.select(F.col("src").alias("node"), F.col("src").alias("label")).limit(0)
    for moved in reversed(contractions(edges, few)):
        ends = moved.groupBy(F.col("to").alias("_end")).agg(F.min("least").alias("_least"))
        # an end that the next round no longer has stands for what it holds
        ends = ends.join(label.withColumnRenamed("node", "_end"), "_end", "left").select("_end", F.coalesce("label", "_least").alias("label"))
        label = cut(moved.join(ends, F.col("to") == F.col("_end")).select("node", "label"))
    alone = edges.where("src = dst").select(F.col("src").alias("node"))
    alone = alone if nodes is None else alone.union(nodes.select("node"))
    return alone.where("node is not null").distinct().join(label, "node", "full_outer").select("node", F.coalesce("label", "node").alias("label"))


def alias_components(rows: DataFrame, node: str, alias: str) -> DataFrame:
    """(node, label) of nodes whose identifiers meet; label is the smallest. Each alias is a star around its smallest node."""
    rows = rows.select(F.col(node).alias("node"), F.col(alias).alias("tag")).where("node is not null")
    tags = rows.where("tag is not null").distinct()
    hubs = tags.groupBy("tag").agg(F.min("node").alias("dst"))
    stars = tags.join(hubs, "tag").where("node <> dst").select(F.col("node").alias("src"), "dst")
    return components(stars, rows.select("node"))


def merge_aliases(rows: DataFrame, node: str, alias: str, at: str) -> DataFrame:
    """(label, ids, first) of rows whose identifiers meet: the smallest node, how many nodes, the earliest date.

    Rows outside a window must be filtered before: afterwards they would have
    connected others.
    """
    dates = rows.where(F.col(node).isNotNull()).groupBy(F.col(node).alias("node")).agg(F.min(at).alias("at"))
    return alias_components(rows, node, alias).join(dates, "node").groupBy("label").agg(F.count("*").alias("ids"), F.min("at").alias("first"))


def contract(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """Edges between groups: both ends mapped by (node, group), unmapped ends as they are, repeats and loops dropped."""
    src = mapping.select(F.col("node").alias("src"), F.col("group").alias("_s"))
    dst = mapping.select(F.col("node").alias("dst"), F.col("group").alias("_d"))
    mapped = edges.join(src, "src", "left").join(dst, "dst", "left").select(F.coalesce("_s", "src").alias("src"), F.coalesce("_d", "dst").alias("dst"))
    return mapped.where("src != dst").distinct()


def of_known(ranks: DataFrame, known: DataFrame) -> DataFrame:
    """Ranks of nodes that known (node) has; the others have passed their mass on and go."""
    return ranks.join(known.select("node").distinct(), "node", "left_semi")
