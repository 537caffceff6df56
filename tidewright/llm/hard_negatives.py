"""Hard negatives of anchors, by a full sort of integer scores.

Every anchor is scored against every row. Rows stay where they are, in blocks;
anchors go to them in waves of bounded size. A block's scores of an anchor are
sorted by score (higher first) and id; each positive's upper limit is found by
binary search, and rows of another label are read from there down to the lower
limit. A task gives k rows at most for each anchor and positive, so that what is
merged grows with the tasks and not with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import materialize, ship, tidy

BLOCK_ROWS, CHUNK_SCORES = 8192, 1 << 21
LONG = np.iinfo(np.int64)


@dataclass(frozen=True)
class Limits:
    """positives: how many an anchor has; most: negatives of each; a negative's score lies between these hundredths of the positive's."""

    positives: int = 5
    most: int = 10
    low: int = 30
    high: int = 90


@dataclass(frozen=True)
class Anchors:
    """One wave: ids, labels, components (a row an anchor); with positives: their scores, in the order of rank, for each anchor."""

    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray
    positives: list[list[int]]


def whole_components(rows: np.ndarray) -> np.ndarray:
    """floor(256 x) of each component, as doubles."""
    with np.errstate(over="ignore"):
        return np.floor(np.clip(rows * 256.0, -np.finfo(float).max, np.finfo(float).max))


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of `width` doubles; shorter vectors go on with zeros, what is longer meets zeros anyway."""
    offsets = np.asarray(vectors.offsets).astype(np.int64)
    flat = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == width).all():
        return flat[offsets[0] : offsets[-1]].reshape(-1, width)
    out = np.zeros((len(sizes), width))
    for i, (lo, n) in enumerate(zip(offsets[:-1].tolist(), sizes.tolist(), strict=True)):
        out[i, : min(n, width)] = flat[lo : lo + min(n, width)]
    return out


def scores_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole components, as longs; beyond the range of a long they stand at its end."""
    top = a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if top < 2**53:
        return (a @ b.T).astype(np.int64)
    if top < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = np.array([[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in b] for p in a], dtype=object).reshape(len(a), len(b))
    return np.clip(exact, LONG.min, LONG.max).astype(np.int64)


def _sorted_blocks(batches: Iterator[pa.RecordBatch], anchors: Anchors):
    """(anchor, scores, ids, labels) of every anchor and block, sorted by score (descending) and id."""
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK_ROWS):
            block = batch.slice(lo, BLOCK_ROWS)
            ids, labels = (block.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
            values = whole_components(matrix(block.column("vector"), anchors.values.shape[1]))
            step = max(1, CHUNK_SCORES // max(1, len(ids)))
            for first in range(0, len(anchors.ids), step):
                table = scores_of(anchors.values[first : first + step], values)
                for i, scores in enumerate(table, first):
                    order = np.lexsort((ids, ~scores))  # ~s is -s - 1: larger scores first, without overflow
                    yield i, scores[order], ids[order], labels[order]


def _merge(found: dict, key, scores: np.ndarray, ids: np.ndarray, most: int) -> None:
    """Keep the first `most` of what the key has and these; all are sorted by score (descending) and id."""
    if key in found:
        scores, ids = (np.concatenate(p) for p in zip(found[key], (scores, ids), strict=True))
        order = np.lexsort((ids, ~scores))[:most]
        scores, ids = scores[order], ids[order]
    found[key] = scores, ids


def _batches(found: dict, names: list[str]) -> Iterator[pa.RecordBatch]:
    keys = list(found)
    for lo in range(0, len(keys), 4096):
        part = keys[lo : lo + 4096]
        n = [len(found[k][0]) for k in part]
        heads = [np.repeat(np.array(c, np.int64), n) for c in zip(*part, strict=True)]
        yield pa.RecordBatch.from_arrays([*map(pa.array, heads), *(pa.array(np.concatenate([found[k][c] for k in part])) for c in (0, 1))], names)


def _positives(sent, most: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, found = sent(), {}
        for i, scores, ids, labels in _sorted_blocks(batches, anchors):
            same = np.flatnonzero((labels == anchors.labels[i]) & (ids != anchors.ids[i]))[:most]
            if len(same):
                _merge(found, (i,), scores[same], ids[same], most)
        yield from _batches(found, ["anchor", "score", "id"])

    return run


def _negatives(sent, limits: Limits):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, found = sent(), {}
        for i, scores, ids, labels in _sorted_blocks(batches, anchors):
            rising, other = scores[::-1], labels != anchors.labels[i]
            for place, positive in enumerate(anchors.positives[i]):
                upper, lower = limits.high * positive // 100, -(-limits.low * positive // 100)
                if upper < lower:
                    continue
                begin = len(scores) - int(np.searchsorted(rising, upper, "right"))
                end = len(scores) - int(np.searchsorted(rising, lower, "left"))
                mine = begin + np.flatnonzero(other[begin:end])[: limits.most]
                if len(mine):
                    _merge(found, (i, place), scores[mine], ids[mine], limits.most)
        yield from _batches(found, ["anchor", "place", "score", "id"])

    return run


def _first(df: DataFrame, keys: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _waves(anchors: DataFrame, limit: int) -> Iterator[Anchors]:
    """Anchors in waves of about `limit` bytes; the driver holds one wave."""

    def wave(rows: list) -> Anchors:
        width = max((len(r["vector"]) for r in rows), default=0)
        values = np.zeros((len(rows), width))
        for i, r in enumerate(rows):
            values[i, : len(r["vector"])] = r["vector"]
        return Anchors(np.array([r["id"] for r in rows], np.int64), np.array([r["label"] for r in rows], np.int64), whole_components(values), [])

    rows, size = [], 0
    for r in anchors.toLocalIterator():
        rows.append(r)
        size += 32 + 8 * len(r["vector"])
        if size >= limit:
            yield wave(rows)
            rows, size = [], 0
    if rows:
        yield wave(rows)


def hard_negatives(rows: DataFrame, is_anchor: Column, limits: Limits = Limits(), wave_bytes: int = 16 << 20) -> DataFrame:
    """For each anchor among rows (id, vector, label) and each of its positives, the highest scored rows of another label.

    Gives anchor_id, positive_id, rank (from 1), negative_id, positive_score and
    negative_score. A row with a null id or label, a null vector, or a null,
    NaN or infinite component takes no part. Positives are the first rows of
    the anchor's label with another id. Rows are taken as they are: an id that is
    there twice is two rows, and two anchors. No anchors or no rows give no rows.
    """
    spark = rows.sparkSession
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"), F.col("label").cast("long").alias("label"), is_anchor.alias("_anchor"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~odd)
    plain, done = rows.select("id", "vector", "label"), []
    for wave in _waves(rows.where("_anchor").select("id", "vector", "label"), wave_bytes):
        best = _first(plain.mapInArrow(_positives(ship(spark, wave), limits.positives), "anchor long, score long, id long"), ["anchor"], limits.positives)
        positives = sorted(tuple(r) for r in best.select("anchor", F.col("rank").cast("long"), "score", "id").toLocalIterator())  # so many a wave's anchor at most
        scores: list[list[int]] = [[] for _ in wave.ids]
        for anchor, _, score, _ in positives:
            scores[anchor].append(score)
        known = spark.createDataFrame([(a, r - 1, int(wave.ids[a]), i, s) for a, r, s, i in positives], "anchor long, place long, anchor_id long, positive_id long, positive_score long")
        sent = ship(spark, Anchors(wave.ids, wave.labels, wave.values, scores))
        found = _first(plain.mapInArrow(_negatives(sent, limits), "anchor long, place long, score long, id long"), ["anchor", "place"], limits.most)
        out = found.join(known, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        done.append(materialize(out, "negatives"))
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return reduce(DataFrame.unionByName, done) if done else empty
