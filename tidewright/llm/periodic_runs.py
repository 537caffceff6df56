"""Periodic runs of words: where a text repeats a passage back to back.

By the runs theorem every run holds a root that is the longest Lyndon word at
its place under one of two orders of the words, one the reverse of the other.
Longest Lyndon words end at the next smaller (for the reverse order the next
larger) value of the inverse suffix array. A root is extended to the right by
the longest common extension of its two ends, the least entry of the LCP array
between them (a sparse table), and to the left by the same over the reversed
words. Documents are worked on many at a time: the number of the document is the
first key of the suffix order, so suffixes of different documents never meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import spans_of, tidy

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


@dataclass(frozen=True)
class Suffixes:
    """order: suffixes, sorted; place: its inverse; shared: words that a suffix has in common with the one before it."""

    order: np.ndarray
    place: np.ndarray
    shared: np.ndarray


def sort_suffixes(codes: np.ndarray, ends: np.ndarray) -> Suffixes:
    """Suffixes by document, then by words; a suffix that is a prefix of another comes first.

    codes: the words' numbers; ends: where each word's document ends. Each round
    doubles the words compared and sorts only suffixes that still have equals.
    """
    n = len(codes)
    key = ends * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable")
    first = np.ones(n + 1, bool)
    first[1:-1] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first[:-1], np.arange(n), 0))
    levels, words = [rank.astype(np.int32)], 1
    while len(slots := np.flatnonzero(~(first[:-1] & first[1:]))):
        mine = order[slots]
        after = mine + words
        key = rank[mine] * (n + 1) + np.where(after < ends[mine], rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        mine, key = mine[by], key[by]
        order[slots] = mine
        first[slots[1:]] |= key[1:] != key[:-1]
        rank[mine] = np.maximum.accumulate(np.where(first[slots], slots, 0))
        levels.append(rank.astype(np.int32))
        words *= 2
    return Suffixes(order, rank, _shared_words(order, ends, levels))


def _shared_words(order: np.ndarray, ends: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """LCP of neighbours: steps of halving length, as long as the ranks by that many words are equal."""
    out = np.zeros(len(order), np.int32)
    pairs = [np.arange(1, len(order))]
    for rank in levels:
        last = pairs[-1]
        pairs.append(last[rank[order[last - 1]] == rank[order[last]]])
    for k in range(len(levels) - 1, -1, -1):
        at = pairs[k + 1]  # of these the first 2**k words are equal
        a, b = order[at - 1] + out[at], order[at] + out[at]
        more = (a < ends[order[at - 1]]) & (b < ends[order[at]])
        a, b = np.where(more, a, 0), np.where(more, b, 0)
        out[at] += (more & (levels[k][a] == levels[k][b])).astype(np.int32) << k
    return out


def common_words(s: Suffixes, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common extension of the suffixes at a and b (different ones): the least LCP between them, by a sparse table."""
    if not len(a):
        return np.zeros(0, np.int64)
    x, y = s.place[a], s.place[b]
    lo, size = np.minimum(x, y) + 1, np.abs(x - y)
    level = np.frexp(size.astype(np.float64))[1] - 1
    table, out = s.shared, np.zeros(len(a), np.int64)
    for k in range(int(level.max()) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        now = np.flatnonzero(level == k)
        out[now] = np.minimum(table[lo[now]], table[lo[now] + size[now] - (1 << k)])
    return out


def lyndon_ends(place: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """End of the longest Lyndon word at each place: under the order (next smaller value), and under its reverse (next larger; the document's end if there is none)."""
    values, stops = place.tolist(), ends.tolist()
    n = len(values)
    smaller, larger = [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        v, stop = values[i], stops[i]
        j = k = i + 1
        while j < stop and values[j] > v:
            j = smaller[j]
        smaller[i] = j
        while k < stop and values[k] < v:
            k = larger[k]
        larger[i] = k
    return np.array(smaller, np.int64), np.array(larger, np.int64)


def runs_of(codes: np.ndarray, offsets: np.ndarray, min_length: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the maximal runs in documents [offsets[i], offsets[i + 1]) of codes, by start and period."""
    none = np.zeros(0, np.int64)
    if not len(codes):
        return none, none, none
    sizes = np.diff(offsets)
    ends, begins = np.repeat(offsets[1:], sizes), np.repeat(offsets[:-1], sizes)
    forward = sort_suffixes(codes, ends)
    place = np.arange(len(codes))
    root, stop = [], []
    for k, end in enumerate(lyndon_ends(forward.place, ends)):
        inside = end < ends
        # a root that ends with its document has nothing after it: no run of several roots starts there
        fits = np.flatnonzero(inside & (codes == codes[np.where(inside, end, place)]))
        root.append(fits)
        stop.append(end[fits])
    a, b = np.concatenate(root), np.concatenate(stop)
    right = b + common_words(forward, a, b)
    period = b - a
    far = right - a > (min_exponent - 1) * period  # holds for the first root of every run that is long enough
    a, b, right, period = a[far], b[far], right[far], period[far]
    if not len(a):
        return none, none, none
    # to the left: the same over the reversed words of the documents that are left
    rows = np.unique(np.searchsorted(offsets, a, "right") - 1)
    kept = sizes[rows]
    base = np.cumsum(kept) - kept
    source = np.repeat(offsets[rows + 1] - 1 + base, kept) - np.arange(kept.sum())
    backward = sort_suffixes(codes[source], np.repeat(base + kept, kept))
    row = np.searchsorted(offsets[rows], a, "right") - 1
    turned = offsets[rows[row] + 1] - 1 + base[row]
    left, free = a.copy(), np.flatnonzero(a > begins[a])
    left[free] -= common_words(backward, turned[free] - (a[free] - 1), turned[free] - (b[free] - 1))
    long = right - left >= np.maximum(min_length, min_exponent * period)
    found = np.unique(np.stack([left[long], period[long], right[long]], 1), axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


def _find(min_length: int, min_exponent: int, limit: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            offsets = np.asarray(lists.offsets).astype(np.int64)
            flat, offsets = lists.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]
            for lo, hi in spans_of(np.diff(offsets), limit):
                words, at = flat.slice(offsets[lo], offsets[hi] - offsets[lo]), offsets[lo : hi + 1] - offsets[lo]
                codes = words.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
                start, end, period = runs_of(codes, at, min_length, min_exponent)
                row = np.searchsorted(at, start, "right") - 1
                edge = np.zeros(len(codes) + 1, np.int64)
                np.add.at(edge, start + period, 1)
                np.add.at(edge, end, -1)
                keep = np.cumsum(edge[:-1]) == 0
                left = np.concatenate([[0], np.cumsum(keep)])[at]
                kept = pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.filter(pa.array(keep)))
                fields = {"start": start - at[row], "length": end - start, "period": period}
                inside = pa.StructArray.from_arrays([pa.array(x) for x in fields.values()], list(fields))
                found = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(hi - lo + 1)), pa.int32()), inside)
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(lo, hi - lo), found, pc.binary_join(kept, " ")], ["row", "runs", "collapsed"])

    return run


def find_runs(docs: DataFrame, words: Column, min_length: int = 6, min_exponent: int = 4, batch_words: int = 1 << 17) -> DataFrame:
    """docs with `runs` and `collapsed`; words: an array<string> over docs' columns.

    A run (start, length, period; by start, then period) is a stretch of words
    with that smallest period, at least min_length and min_exponent periods (2 or
    more) long, that no neighbouring word continues. collapsed: the words, joined
    by a space, without those that a run holds after its first period. A null
    array is an empty one; columns of docs of these two names are replaced.
    """
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")
    kept = [c for c in docs.columns if c not in ("runs", "collapsed")]
    row = F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in kept))
    given = docs.select(row.alias("row"), F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda w: F.coalesce(w, F.lit(""))).alias("words"))
    kind = given.select("row", F.lit(None).cast(RUNS).alias("runs"), F.lit(None).cast("string").alias("collapsed")).schema
    return given.mapInArrow(_find(min_length, min_exponent, batch_words), kind).select("row.*", "runs", "collapsed")


def split_words(text: Column) -> Column:
    """The words of a text: what stands between spaces, tabs and line ends; null for null."""
    return F.regexp_extract_all(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def digest_runs(found: DataFrame) -> DataFrame:
    """doc_id, the number of runs, the longest run (ties: least start, then period) and sha256 of all runs and of the collapsed text."""
    longest = F.sort_array(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    best = F.try_element_at(longest, F.lit(1))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))), "")
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.s").alias("start"), (-F.col("_best.l")).alias("length"), F.col("_best.p").alias("period"),
        F.expr("(1000 * -_best.l) div _best.p").cast("long").alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
