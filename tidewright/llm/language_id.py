"""Language identification by prediction by partial matching (PPM) over bytes.

For each language a variable-order context tree is counted over training bytes
(orders 0 to `order`). Escape probabilities follow method C with exclusion: a
symbol not seen after a context takes the escape share times the shorter
context's probability, renormalised over symbols that the longer one has not
seen. With the statistics frozen, the code length of a byte is a function of its
context, so every context and every symbol seen after it has its exact cost in
a hash table: memory grows with the contexts seen, and none is left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import LOWER, ship, tidy, utf8_view

_LETTER = re.compile(r"[^\W\d_]")
_BITS = 9  # of a symbol: a byte, or _EDGE before the text's start
_EDGE = 256


class Index:
    """Where a key stands in an array of distinct keys, -1 if it does not: linear probing, over whole arrays at once."""

    def __init__(self, keys: np.ndarray) -> None:
        size = max(4, (4 * len(keys)).bit_length())
        self.keys, self.shift, self.mask = keys, np.uint64(64 - size), (1 << size) - 1
        self.slots = np.full(1 << size, -1, np.int32)
        todo, at = np.arange(len(keys), dtype=np.int32), self._home(keys)
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]
            lost = self.slots[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        at = self._home(keys)
        out = self.slots[at]
        todo = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            here = self.slots[at[todo]]
            out[todo] = here
            todo = todo[(here >= 0) & (self.keys[here] != keys[todo])]
        return out


@dataclass(frozen=True)
class Level:
    """One order. grams: context and symbol, cost: their bits by language; contexts, escape: bits of leaving them."""

    grams: Index
    cost: np.ndarray
    contexts: Index
    escape: np.ndarray


@dataclass(frozen=True)
class Ppm:
    langs: tuple[str, ...]
    levels: tuple[Level, ...]


def _mask(order: int) -> int:
    return (1 << _BITS * (order + 1)) - 1


def _keys(symbols: np.ndarray, order: int) -> np.ndarray:
    """Of each symbol after the first `order`: itself in the lowest bits, then those before it, the nearest first."""
    n = len(symbols) - order
    out = symbols[order:].copy()
    for back in range(1, order + 1):
        out |= symbols[order - back : order - back + n] << (_BITS * back)
    return out


def train_ppm(samples: dict[str, list[bytes]], order: int = 4) -> Ppm:
    """Count every context tree of orders 0 to order (6 at most) and cost all that any language has seen."""
    langs = tuple(sorted(samples))
    counted = {}
    for lang in langs:
        grams = [np.zeros(0, np.int64)]
        for text in samples[lang]:
            grams.append(_keys(np.concatenate([np.full(order, _EDGE, np.int64), LOWER[np.frombuffer(text, np.uint8)].astype(np.int64)]), order))
        counted[lang] = np.unique(np.concatenate(grams), return_counts=True)
    before = {lang: (np.zeros(0, np.int64), np.zeros(0)) for lang in langs}
    levels: list[Level] = []
    for k in range(order + 1):
        seen = {}
        for lang in langs:
            keys, back = np.unique(counted[lang][0] & _mask(k), return_inverse=True)
            counts = np.bincount(back, counted[lang][1], len(keys))
            contexts, first, row = np.unique(keys >> _BITS, return_index=True, return_inverse=True)
            if k:
                lower_keys, lower = before[lang]
                lower = lower[np.searchsorted(lower_keys, keys & _mask(k - 1))]
            else:
                lower = np.full(len(keys), 1 / 256)
            total, kinds = np.bincount(row, counts, len(contexts)), np.diff(np.append(first, len(keys)))
            left = np.maximum(1 - np.bincount(row, lower, len(contexts)), 1e-12)
            share = np.where(kinds < 256, kinds / (total + kinds), 0)  # nothing is left to escape to after all 256
            p = counts / np.where(kinds < 256, total + kinds, total)[row]
            seen[lang] = keys, p, contexts, np.maximum(share, 1e-12) / left
            before[lang] = keys, p
        grams = np.unique(np.concatenate([s[0] for s in seen.values()]))
        contexts = np.unique(np.concatenate([s[2] for s in seen.values()]))
        escape = np.zeros((len(contexts), len(langs)), np.float32)
        for j, lang in enumerate(langs):
            escape[np.searchsorted(contexts, seen[lang][2]), j] = -np.log2(seen[lang][3])
        cost = escape[np.searchsorted(contexts, grams >> _BITS)]
        cost += levels[-1].cost[np.searchsorted(levels[-1].grams.keys, grams & _mask(k - 1))] if k else 8
        for j, lang in enumerate(langs):
            cost[np.searchsorted(grams, seen[lang][0]), j] = -np.log2(seen[lang][1])
        levels.append(Level(Index(grams), cost, Index(contexts), escape))
    return Ppm(langs, tuple(levels))


def costs(fitted: Ppm, keys: np.ndarray) -> np.ndarray:
    """Bits of each key's symbol after its context, by language."""
    out = np.zeros((len(keys), len(fitted.langs)), np.float32)
    rest = np.arange(len(keys))
    for k in range(len(fitted.levels) - 1, -1, -1):
        level, wanted = fitted.levels[k], keys[rest] & _mask(k)
        at = level.grams.find(wanted)
        hit = at >= 0
        out[rest[hit]] += level.cost[at[hit]]
        rest, wanted = rest[~hit], wanted[~hit]
        if not len(rest):
            return out
        at = level.contexts.find(wanted >> _BITS)
        known = at >= 0
        out[rest[known]] += level.escape[at[known]]
    out[rest] += 8
    return out


def code_lengths(fitted: Ppm, data: np.ndarray, off: np.ndarray, chunk: int = 1 << 19) -> np.ndarray:
    """Bits of each text (rows of off) under each language."""
    out = np.zeros((len(off) - 1, len(fitted.langs)))
    order = len(fitted.levels) - 1
    for a in range(int(off[0]), int(off[-1]), chunk):
        b = min(a + chunk, int(off[-1]))
        lead = min(order, a - int(off[0]))
        symbols = np.concatenate([np.full(order - lead, _EDGE, np.int64), LOWER[data[a - lead : b]].astype(np.int64)])
        keys = _keys(symbols, order)
        first = np.searchsorted(off, a, side="right") - 1
        last = np.searchsorted(off, b, side="left")
        starts = off[first:last]
        for d in range(order):  # what stands before a text's start is not its context
            at = (starts + d - a)[(starts + d >= a) & (starts + d < b)]
            edges = sum(_EDGE << (_BITS * back) for back in range(d + 1, order + 1))
            keys[at] = (keys[at] & _mask(d)) | edges
        begin = np.maximum(starts, a) - a
        full = np.flatnonzero(np.diff(np.append(begin, b - a)) > 0)
        out[first:last][full] += np.add.reduceat(costs(fitted, keys), begin[full], axis=0, dtype=np.float64)
    return out


def identify(fitted: Ppm | None, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, bits per byte of the best) of each text. Ties go to the first language by name."""
    n = len(texts)
    raw, off, valid = utf8_view(texts)
    lettered = np.fromiter((bool(t and _LETTER.search(t)) for t in texts.to_pylist()), bool, n)
    if fitted is None or not fitted.langs or not n:
        return ["und"] * n, np.zeros(n), np.zeros(n)
    lengths = code_lengths(fitted, raw, off)
    best = lengths.argmin(1)
    least = lengths[np.arange(n), best]
    share = 1 / np.exp2(np.maximum(least[:, None] - lengths, -60)).sum(1)
    known = lettered & valid
    langs = [fitted.langs[b] if ok else "und" for b, ok in zip(best.tolist(), known.tolist(), strict=True)]
    return langs, np.where(known, share, 0.0), np.where(known, least / np.maximum(np.diff(off), 1), 0.0)


def training_sample(labelled: DataFrame, docs_per_lang: int, max_doc_bytes: int, sample_bytes: int) -> dict[str, list[bytes]]:
    """At most docs_per_lang whole texts a language, each of at most max_doc_bytes and of about sample_bytes together, chosen by a hash of their id.

    A language whose texts are all longer gives its shortest one. The bound holds
    whatever the input's size: ids are thinned by a rate known from a count, then
    ranked, and only the chosen texts come to the driver.
    """
    size = F.octet_length("text")
    usable = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    short = F.when(size <= max_doc_bytes, size)
    found = usable.groupBy("lang").agg(F.count(short).alias("n"), F.coalesce(F.avg(short), F.lit(0.0)).alias("mean")).collect()
    quota = sample_bytes / max(len(found), 1)
    take = {r["lang"]: max(1, min(docs_per_lang, int(quota / max(r["mean"], 1)))) for r in found}
    counts = {r["lang"]: r["n"] for r in found if r["n"]}
    samples: dict[str, list[tuple[float, bytes]]] = {}
    if counts:
        rate = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, (1.5 * take[k] + 10) / n)))])
        draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
        for r in usable.where((size <= max_doc_bytes) & (draw < rate[F.col("lang")])).select("lang", draw.alias("u"), F.encode("text", "UTF-8").alias("t")).collect():
            samples.setdefault(r["lang"], []).append((r["u"], bytes(r["t"])))
    missing = [k for k in take if k not in samples]
    if missing:
        least = F.min_by(F.encode("text", "UTF-8"), F.struct(size, F.xxhash64("text"), "text"))
        for r in usable.where(F.col("lang").isin(missing)).groupBy("lang").agg(least.alias("t")).collect():
            samples[r["lang"]] = [(0.0, bytes(r["t"]))]
    return {k: [t for _, t in sorted(v)[: take[k]]] for k, v in samples.items()}


def detect_language(docs: DataFrame, labelled: DataFrame, docs_per_lang: int = 250, max_doc_bytes: int = 20_000, sample_bytes: int = 16 << 20, order: int = 4) -> DataFrame:
    """doc_id, lang_pred, score and bits_per_byte for every row of docs.

    labelled: rows (doc_id, text, lang) that may be learned from; a bounded
    sample of them is used (docs_per_lang texts of max_doc_bytes a language,
    fewer where all languages together would pass sample_bytes).
    A null or letterless text is `und` with score 0, as are all texts when there
    is nothing to learn from. Equal code lengths: the first language by name.
    Repeated rows give repeated results; an empty table gives an empty result;
    other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    samples = training_sample(labelled.select("doc_id", "text", "lang"), docs_per_lang, max_doc_bytes, sample_bytes)
    shared = ship(spark, train_ppm(samples, order) if samples else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared()
        for batch in batches:
            langs, score, rate = identify(fitted, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64())], ["doc_id", "lang_pred", "score", "bits_per_byte"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), f"doc_id {kind}, lang_pred string, score double, bits_per_byte double")
