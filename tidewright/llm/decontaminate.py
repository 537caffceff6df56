"""Benchmark decontamination by a prefix-filtered containment join.

A window is ten consecutive words of a benchmark item (a shorter item is one
window). Containment in a text must be exact, so one token is the necessary
prefix of a window: its rarest by the number of texts that hold it, counted over
all documents. Only texts with that token are looked at, only where the token's
place leaves room for the window (positional and length bounds), and the words
of the whole window are compared.

The benchmark is a stated query set: it goes to the executors in blocks of a
bounded size, each against all rows, so neither side is shuffled.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import materialize, ship

#: A-Z lower-cased; 0-9, a-z and bytes from 128 are kept; all others end a word.
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


def windows_of(words: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    if len(words) <= size:
        return [tuple(words)] if words else []
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


def window_index(items: list[tuple], size: int, rarity: dict[bytes, int]) -> dict[bytes, list[tuple[int, tuple[bytes, ...], tuple]]]:
    """By rarest token: (its place in the window, the window, the items that have it). Ties: the first by bytes, then by place."""
    owners: dict[tuple[bytes, ...], list] = {}
    for item, text in items:
        for window in dict.fromkeys(windows_of(words_of(text), size)):
            owners.setdefault(window, []).append(item)
    index: dict[bytes, list] = {}
    for window, ids in owners.items():
        place = min(range(len(window)), key=lambda i: (rarity.get(window[i], 0), window[i], i))
        index.setdefault(window[place], []).append((place, window, tuple(ids)))
    return index


def find_hits(words: list[bytes], index: dict) -> tuple[list[tuple[int, int]], set]:
    """Runs of hit words as [start, end), joined, and the items with occurring windows."""
    found, items = [], set()
    n = len(words)
    for at, word in enumerate(words):
        if word in index:
            for place, window, ids in index[word]:
                start = at - place
                end = start + len(window)
                if start >= 0 and end <= n and tuple(words[start:end]) == window:
                    found.append((start, end))
                    items.update(ids)
    runs: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return runs, items


def token_rarity(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """In how many rows of docs each token of a bounded vocabulary stands."""
    shared = ship(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = shared(), Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen.update(wanted.intersection(words_of(text.as_py() or b"")))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["token", "n"])

    rows = docs.select(F.encode(F.col("text").cast("string"), "UTF-8").alias("text")).mapInArrow(run, "token binary, n long")
    return {bytes(r["token"]): r["n"] for r in rows.groupBy("token").agg(F.sum("n").alias("n")).collect()}


def benchmark_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """The items with words, in runs of about block_bytes; one block at a time is on the driver."""
    block, size = [], 0
    for row in benchmark.select("item_id", F.encode(F.col("text").cast("string"), "UTF-8").alias("t")).where(F.col("t").isNotNull()).toLocalIterator():
        block.append((row["item_id"], bytes(row["t"])))
        size += len(block[-1][1])
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", window: int = 10, block_bytes: int = 4 << 20) -> DataFrame:
    """For every row of docs: key, n_words, runs (hit words as start, end, start, end, ...) and items (sorted as strings).

    Null and wordless texts have no words and no hits; null and wordless items
    hit nothing; an item with a null id counts under the id `null`. Repeated
    rows give repeated results, however many blocks the benchmark has; empty
    tables are fine; other columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(F.lit(0).cast("long").alias("row"), F.col(key).alias("key"), F.col("text").cast("string").alias("text"))
    several = (benchmark.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0) >= block_bytes
    if several:  # rows are put together again by a number of their own, which is stored so that it stays
        texts = materialize(texts.withColumn("row", F.monotonically_increasing_id()), "numbered")
    texts = texts.withColumn("text", F.encode("text", "UTF-8"))
    spec = f"row long, key {kind}, n_words long, runs array<long>, items array<string>"

    def against(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared()
            for batch in batches:
                sizes, runs, items = [], [], []
                for text in batch.column("text"):
                    words = words_of(text.as_py() or b"")
                    hit, ids = find_hits(words, index)
                    sizes.append(len(words))
                    runs.append([x for r in hit for x in r])
                    items.append(sorted("null" if i is None else str(i) for i in ids))
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("key"), pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))], ["row", "key", "n_words", "runs", "items"])

        return run

    parts = []
    for block in benchmark_blocks(benchmark, block_bytes):
        rarity = token_rarity(docs, {w for _, t in block for w in words_of(t)})
        parts.append(texts.mapInArrow(against(ship(spark, window_index(block, window, rarity))), spec))
    if not parts:
        parts = [texts.mapInArrow(against(ship(spark, {})), spec)]
    found = parts[0]
    if several:
        stored = reduce(DataFrame.unionByName, [materialize(p, "hits") for p in parts])
        found = stored.groupBy("row").agg(F.first("key").alias("key"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("runs")).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return found.select(F.col("key").alias(key), "n_words", "runs", "items")


def count_hit_words(runs: pa.Array) -> list[int]:
    """How many different words runs cover; runs of several blocks may overlap."""
    out = []
    for r in runs.to_pylist():
        total, last = 0, 0
        for start, end in sorted(zip(r[::2], r[1::2], strict=True)):
            total += max(0, end - max(start, last))
            last = max(last, end)
        out.append(total)
    return out


def digest_hits(hits: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and digests of find_contamination()'s rows."""
    kind = hits.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_hit = np.array(count_hit_words(batch.column("runs")), np.int64)
            items = batch.column("items").to_pylist()
            digests = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("n_words"), pa.array(n_hit), pa.array([len(i) for i in items], pa.int64()), pa.array(digests, pa.string()), pa.array(n_hit > 0)], [key, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return hits.mapInArrow(run, f"{key} {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 4 << 20) -> DataFrame:
    """The rows of docs without a benchmark window in their text, with all their columns; nothing is shuffled."""
    spark = docs.sparkSession
    schema = docs.schema
    at = schema.fieldNames().index("text")

    def without(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared()
            for batch in batches:
                yield batch.filter(pa.array([not find_hits(words_of((t.as_py() or "").encode()), index)[1] for t in batch.column(at)], pa.bool_()))

        return run

    kept = docs
    for block in benchmark_blocks(benchmark, block_bytes):
        rarity = token_rarity(docs, {w for _, t in block for w in words_of(t)})
        kept = kept.mapInArrow(without(ship(spark, window_index(block, window, rarity))), schema)
    return kept
