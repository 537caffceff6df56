"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text.
A window is one word, written three times so that a block's fixed cost does not
hide what a short word saves. The pair (ordinary length minus toxic length,
toxic length) of a window is its cell; how much more often a cell occurs in
toxic than in ordinary text is learned as a log ratio. A text's distance is the
largest sum, over its runs of 200 windows, of the ratios that clearly speak for
toxicity, less the logarithm of how many such runs it has room for, so that
ordinary words do not add up with a text's length and one toxic passage counts
in a text of any length. A threshold calibrated across halves of the learning
rows, of all lengths, turns it into a score.

The toxic dictionary is trained on words that stand in many different contexts
of toxic texts and in no ordinary one; copies of a text give one context.
"""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import ship, tidy

CELL_DIFF, CELL_LENGTH, REPEATS, MEMO = (-4, 8), 30, 3, 200_000
TOXIC_LEVEL, ORDINARY_LEVEL = 9, 3
RUN = 200


@dataclass(frozen=True)
class Limits:
    """Bounds of what is learned from, whatever the input's size; texts of every length are taken, in the order of a hash."""

    toxic_docs: int = 1500
    ordinary_docs: int = 4000
    toxic_bytes: int = 8_000_000
    ordinary_bytes: int = 16_000_000
    dictionary_bytes: int = 112_640
    dictionary_samples: int = 60_000  # of 16 words, spread evenly over the ordinary sample
    context_share: float = 0.01  # of the toxic texts; a word needs as many different contexts, 3 at least
    clear_ratio: float = 0.7


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


class Distance:
    """Cells of words under a pair of dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        kept = []
        for data, level in ((toxic, TOXIC_LEVEL), (ordinary, ORDINARY_LEVEL)):
            d = zstandard.ZstdCompressionDict(data)
            d.precompute_compress(level=level)
            kept.append(zstandard.ZstdCompressor(level=level, dict_data=d, **plain))
        self._toxic, self._ordinary = kept
        self._memo: dict[bytes, tuple[int, int]] = {}
        self._same: dict[tuple[int, int], tuple[int, int]] = {}

    def cell(self, word: bytes) -> tuple[int, int]:
        found = self._memo.get(word)
        if found is None:
            window = (b" " + word + b" ") * REPEATS
            n = len(self._toxic.compress(window))
            diff = len(self._ordinary.compress(window)) - n
            found = (min(max(diff, CELL_DIFF[0]), CELL_DIFF[1]), min(n, CELL_LENGTH))
            if len(self._memo) >= MEMO:
                self._memo.clear()
            self._memo[word] = found = self._same.setdefault(found, found)
        return found

    def cells(self, text: bytes) -> list[tuple[int, int]]:
        return list(map(self.cell, words_of(text)))


def worst_run(cells: list[tuple[int, int]], ratio: dict[tuple[int, int], float]) -> float:
    """Largest sum of ratios over RUN windows in a row, less log(windows / RUN) for the choice among so many runs."""
    v = [ratio.get(c, 0.0) for c in cells]
    if len(v) <= RUN:
        return sum(v)
    upto = np.concatenate([[0.0], np.cumsum(v)])
    return float((upto[RUN:] - upto[:-RUN]).max()) - math.log(len(v) / RUN)


def _dictionary(samples: list[bytes], size: int, k: int, d: int) -> bytes:
    """A trained dictionary; text that is too short to train on becomes the dictionary's content as it is."""
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=d).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] or b"        "


@dataclass(frozen=True)
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    ratio: dict[tuple[int, int], float]
    threshold: float

    def score(self, distance: Distance, text: bytes) -> float:
        z = worst_run(distance.cells(text), self.ratio)
        return 1 / (1 + math.exp(min(60.0, -1.2 * (z - self.threshold) - math.log(7 / 3))))


def _fit(toxic: list[bytes], ordinary: list[bytes], limits: Limits) -> tuple[bytes, bytes, dict[tuple[int, int], float]]:
    """(toxic dictionary, ordinary dictionary, log ratio of each cell that clearly speaks for toxicity)."""
    usual = Counter()
    for text in ordinary:
        usual.update(words_of(text))
    contexts: dict[bytes, set[bytes]] = {}
    for text in sorted(set(toxic)):
        words = words_of(text)
        for before, word in zip([b"", *words], words, strict=False):
            if word not in usual:
                contexts.setdefault(word, set()).add(before)
    least = max(3, math.ceil(limits.context_share * len(toxic)))
    marked = {w: len(c) for w, c in sorted(contexts.items()) if len(c) >= least}
    draw = random.Random(20)
    pool = [b" " + w + b" " for w, n in marked.items() for _ in range(min(n, 50))]
    draw.shuffle(pool)
    size = min(limits.dictionary_bytes, max(1024, 2 * sum(len(w) + 2 for w in marked)))
    toxic_dict = _dictionary([b"".join(pool[i : i + 8]) for i in range(0, len(pool), 8)], size, 24, 6)
    running = [w for text in ordinary for w in words_of(text)]
    step = 16 * max(1, -(-len(running) // (16 * limits.dictionary_samples)))
    ordinary_dict = _dictionary([b" ".join(running[i : i + 16]) for i in range(0, len(running), step)], limits.dictionary_bytes, 64, 8)
    distance = Distance(toxic_dict, ordinary_dict)
    totals = [Counter(c for t in texts for c in distance.cells(t)) for texts in (ordinary, toxic)]
    sums = [max(1, sum(t.values())) for t in totals]
    ratio = {c: math.log((totals[1][c] + 0.5) / (sums[1] + 1) / ((totals[0][c] + 0.5) / (sums[0] + 1))) for c in totals[1]}
    return toxic_dict, ordinary_dict, {c: r for c, r in ratio.items() if r > limits.clear_ratio}


def _distances(fitted: tuple, texts: list[bytes]) -> list[float]:
    distance = Distance(*fitted[:2])
    return [worst_run(distance.cells(t), fitted[2]) for t in texts]


def train(toxic: list[bytes], ordinary: list[bytes], ordinary_weight: float = 1.0, limits: Limits = Limits()) -> ToxicityModel | None:
    """None if either kind is missing. ordinary_weight: ordinary texts for each one in the sample.

    The threshold is calibrated on texts that the dictionaries it is used with have not seen: each half of
    the sample is measured under dictionaries of the other half. Equal texts go to one half.
    """
    if not toxic or not ordinary:
        return None
    fitted = _fit(toxic, ordinary, limits)
    halves = [[[t for t in texts if zlib.crc32(t) >> 16 & 1 == half] for half in (0, 1)] for texts in (ordinary, toxic)]
    z: list[list[float]] = [[], []]
    for half in (0, 1):
        other = [kind[1 - half] for kind in halves]
        under = _fit(other[1], other[0], limits) if all(other) else fitted
        for out, kind in zip(z, halves, strict=True):
            out += _distances(under, kind[half])
    z = [sorted(x) for x in z]
    best, plateau = -1.0, []
    for t in sorted({0.5, *(round(v - 0.01, 3) for v in z[1] if v > 0.5), *(round(v + 0.01, 3) for v in z[0] if v > 0.5)}):
        hit, false = sum(v >= t for v in z[1]), sum(v >= t for v in z[0]) * ordinary_weight
        f1 = 2 * hit / (hit + false + len(z[1]))
        if f1 > best + 1e-12:
            best, plateau = f1, [t]
        elif f1 > best - 1e-12:
            plateau.append(t)
    return ToxicityModel(*fitted, min((plateau[0] + plateau[-1]) / 2, plateau[0] + 2))


def learn(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> ToxicityModel | None:
    """Train on a bounded sample of labelled documents.

    labels: doc_id and toxic (0 or 1; others and nulls are left out). Ids are
    thinned by a hash at a rate known from counts; only the chosen ids (a
    bounded number) are joined to docs, and only their texts reach the driver.
    If these hold too many bytes, the rate is lowered until they fit, whatever
    the length of the single text; the first text is always taken.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_toxic")).distinct()
    counts = {r["_toxic"]: r["n"] for r in known.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    want = {0: limits.ordinary_docs, 1: limits.toxic_docs}
    if not all(counts.get(k) for k in want):
        return None
    draw = F.pmod(F.xxhash64("_id", F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    rate = F.when(F.col("_toxic") == 1, min(1.0, want[1] / counts[1])).otherwise(min(1.0, want[0] / counts[0]))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())

    def of(chosen: DataFrame) -> DataFrame:
        chosen = F.broadcast(chosen)
        return texts.join(chosen, texts["doc_id"] == chosen["_id"])

    sizes = of(known.where(draw < rate)).select("_toxic", draw.alias("draw"), F.octet_length("text").alias("n")).collect()
    cut = {}
    for kind, room in ((0, limits.ordinary_bytes), (1, limits.toxic_bytes)):
        mine = sorted((r["draw"], r["n"]) for r in sizes if r["_toxic"] == kind)
        ends = itertools.accumulate(n for _, n in mine)
        cut[kind] = next((d for (d, _), end in zip(mine, ends, strict=True) if end > room and d > mine[0][0]), 1.0)
    rate = F.least(rate, F.when(F.col("_toxic") == 1, cut[1]).otherwise(cut[0]))
    rows = of(known.where(draw < rate)).select("_id", "_toxic", F.encode("text", "UTF-8").alias("t")).collect()
    split: dict[int, list[bytes]] = {0: [], 1: []}
    for r in sorted(rows, key=lambda r: (r["_id"], bytes(r["t"]))):
        split[r["_toxic"]].append(bytes(r["t"]).lower())
    return train(split[1], split[0], counts[0] / max(1, len(split[0])), limits)


def score_toxicity(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 if score >= 0.7) of every row's whole text.

    A null or empty text has distance 0 and so a low score; without a model
    every score is 0. Repeated rows give repeated results, an empty table an
    empty result; other columns are ignored.
    """
    shared = ship(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared()
        distance = Distance(m.toxic, m.ordinary) if m else None
        for batch in batches:
            scores = [m.score(distance, t.as_py() or b"") if m else 0.0 for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array([int(s >= 0.7) for s in scores], pa.int32())], ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.encode(F.col("text").cast("string"), "UTF-8").alias("text")).mapInArrow(tidy(run), f"doc_id {kind}, score double, predicted int")


def drop_toxic(docs: DataFrame, model: ToxicityModel | None, threshold: float = 0.7) -> DataFrame:
    """The rows of docs whose text scores below the threshold, with all their columns; nothing is shuffled."""
    shared = ship(docs.sparkSession, model)
    at = docs.schema.fieldNames().index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared()
        distance = Distance(m.toxic, m.ordinary) if m else None
        for batch in batches:
            yield batch if m is None else batch.filter(pa.array([m.score(distance, (t.as_py() or "").encode()) < threshold for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
