"""Removal of long repeats by a distributed difference-cover suffix sort.

Suffixes must meet to be compared, and sending every suffix with what follows it
would multiply the input. Two facts cut that down without losing a match:

1. Every `length`-byte window has an anchor, its k-gram of least hash; equal
   windows have equal anchors. Windows whose anchor stands in one document only
   have no partner. Only hashes of anchors are shuffled to find that out.
2. The runs of windows that share one anchor (`contexts`) are sent to the bucket
   of the anchor's hash, so equal windows meet in one bucket. There the suffixes of
   all contexts are sorted by difference cover, neighbours in suffix order are
   compared over `length` bytes, and each run of equal prefixes yields the least
   document that holds it.

A bucket is a partition of its own, so that a worker holds one at a time. Before
both shuffles each task merges what it has seen twice, so that a frequent
passage is sent a few times by each task and not once by each document. Equal
texts are settled by a 128-bit fingerprint beforehand, and contexts of an anchor
that has one context only, however often, by that alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import Rolling, materialize, mix64, spans_of, tidy, utf8_view
from tidewright.llm.suffix_array import equal_runs, suffix_order


@dataclass(frozen=True)
class Repeats:
    length: int = 50
    gram: int = 19
    anchors_in_bucket: int = 500_000
    flush_bytes: int = 8 << 20
    broadcast_ids: int = 500_000

    @property
    def reach(self) -> int:
        return self.length - self.gram + 1


def anchors(data: np.ndarray, starts: np.ndarray, p: Repeats, rolling: Rolling) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: (first window, last window, hash of the anchor's k-gram). Windows do not cross starts."""
    n = len(data)
    if n < p.length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    grams = rolling.windows(rolling.prefix(data), p.gram)
    low = np.uint64((1 << 24) - 1)
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)  # place breaks ties: the leftmost
    span, least = 1, key
    while span < p.reach:
        step = min(span, p.reach - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    place = (least & low).astype(np.int64)
    window = np.arange(len(place))
    inside = np.zeros(n + 1, bool)
    inside[starts[starts < n]] = True
    owner = np.cumsum(inside[:-1])
    whole = owner[window] == owner[window + p.length - 1]
    window, place = window[whole], place[whole]
    if not len(window):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1)]))
    last = np.append(new[1:], len(window)) - 1
    return window[new], window[last], mix64(grams[place[new]])


def _squeeze(raw: bytes) -> bytes:
    """A cell of a shuffled row; the shuffle's own compression does not code by frequency."""
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unsqueeze(cell: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(cell)


def _planes(x: np.ndarray) -> bytes:
    """Differences, byte by byte of equal weight: compresses well when values grow slowly."""
    d = np.diff(x, prepend=x.dtype.type(0)) if len(x) else x
    return _squeeze(d.view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes())


def _unplanes(b: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    d = np.ascontiguousarray(np.frombuffer(_unsqueeze(b), np.uint8).reshape(size, -1).T).reshape(-1).view(kind)
    return np.cumsum(d, dtype=kind)


def _texts(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int, int]]:
    for batch in batches:
        data, off, _ = utf8_view(batch.column("text"))
        for lo, hi in spans_of(np.diff(off), limit):
            yield batch.slice(lo, hi - lo), data, off[lo : hi + 1], lo, hi


def _pieces(data: np.ndarray, off: np.ndarray, p: Repeats, rolling: Rolling, at_once: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """anchors() over texts, a bounded number of bytes at once; places are those in data. Long texts are cut with overlap at window bounds."""
    lo = 0
    n = len(off) - 1
    while lo < n:
        hi = lo + 1
        while hi < n and off[hi + 1] - off[lo] <= at_once:
            hi += 1
        a, b = int(off[lo]), int(off[hi])
        for c in range(a, max(b, a + 1), 16 * at_once):
            d = min(b, c + 16 * at_once + p.length - 1)
            first, last, h = anchors(data[c:d], off[lo:hi] - c if c == a else np.zeros(0, np.int64), p, rolling)
            yield first + c, last + c, h
        lo = hi


def _anchor_rows(n_buckets: int, p: Repeats):
    """Batches of (doc_id, fp, text) to packed anchor hashes by bucket, and places that are shared within a task by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(3)
        held: list[tuple] = []
        size = 0
        for part, data, off, _, _ in _texts(batches, p.flush_bytes):
            ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            fps = part.column("fp").to_numpy(zero_copy_only=False).astype(np.int32)
            for first, _, h in _pieces(data, off, p, rolling):
                doc = np.searchsorted(off, first, side="right") - 1
                held.append((h, ids[doc], fps[doc], (first - off[doc]).astype(np.int32)))
            size += int(off[-1] - off[0])
            if size >= p.flush_bytes:
                yield _pack_anchors(held, n_buckets)
                held, size = [], 0
        if held:
            yield _pack_anchors(held, n_buckets)

    return run


def _pack_anchors(held: list[tuple], n_buckets: int) -> pa.RecordBatch:
    h, doc, fp, at = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(h, kind="stable")
    shared = _in_two_docs(h[order], doc[order])
    known = np.zeros(len(h), bool)
    known[order] = shared
    # of a hash that two documents share, the least and the greatest document stand for all
    keep = ~known
    s = order[shared]
    if len(s):
        s = s[np.lexsort((doc[s], h[s]))]
        edge = np.concatenate([[True], h[s][1:] != h[s][:-1]])
        keep[s[edge]] = True
        keep[s[np.append(edge[1:], True)]] = True
    rows: list[tuple] = []
    bucket = (h >> np.uint64(40)) % np.uint64(n_buckets)
    for flag, chosen in ((0, np.flatnonzero(keep)), (1, np.flatnonzero(known))):
        b = bucket[chosen]
        by = np.argsort(b, kind="stable")
        chosen, b = chosen[by], b[by]
        cuts = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]])) if len(b) else np.zeros(1, np.int64)
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            c = chosen[lo:hi]
            rows.append((int(b[lo]), flag, h[c].astype(np.uint32).tobytes() if not flag else b"", _planes(doc[c]), _planes(fp[c]), _planes(at[c])))
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["bucket", "known", "h", "doc", "fp", "at"])


def _in_two_docs(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For rows sorted by h: whether rows of equal h have different documents."""
    if not len(h):
        return np.zeros(0, bool)
    new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    differ = np.maximum.reduceat(doc, new) != np.minimum.reduceat(doc, new)
    return np.repeat(differ, np.diff(np.append(new, len(h))))


PACKED = "bucket int, doc binary, fp binary, lo binary, hi binary"


def _pack_by_doc(doc: np.ndarray, fp: np.ndarray, lo: np.ndarray, hi: np.ndarray, n_buckets: int) -> pa.RecordBatch:
    """Spans of documents as a few packed rows, by a bucket of the document: a row for each document would cost more than its content."""
    bucket = (mix64(doc.view(np.uint64)) % np.uint64(n_buckets)).astype(np.int64)
    order = np.lexsort((lo, fp, doc, bucket))
    b = bucket[order]
    cuts = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]])) if len(b) else np.zeros(1, np.int64)
    rows = []
    for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        c = order[x:y]
        rows.append((int(b[x]), _planes(doc[c]), _planes(fp[c]), _planes(lo[c]), _planes(hi[c])))
    kinds = (pa.int32(), *[pa.binary()] * 4)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["bucket", "doc", "fp", "lo", "hi"])


def _spans_by_doc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed spans of whole buckets to (_d, _f, runs): start, end, start, end, ..., sorted and joined where they overlap."""
    columns: list[list] = [[] for _ in range(4)]
    for batch in batches:
        for row in batch.to_pylist():
            for column, name in zip(columns, ("doc", "fp", "lo", "hi"), strict=True):
                column.append(_unplanes(row[name], np.int32 if name == "fp" else np.int64))
    if not columns[0]:
        return
    doc, fp, lo, hi = map(np.concatenate, columns)
    order = np.lexsort((lo, fp, doc))
    doc, fp, lo, hi = doc[order], fp[order], lo[order], hi[order]
    first = np.concatenate([[True], (doc[1:] != doc[:-1]) | (fp[1:] != fp[:-1])])
    group = np.cumsum(first)
    # a span starts a new run if it begins after everything before it in its document has ended
    wide = int(hi.max()) + 1
    reach = np.maximum.accumulate(group * wide + hi)
    start = first.copy()
    start[1:] |= group[1:] * wide + lo[1:] > reach[:-1]
    s = np.flatnonzero(start)
    runs = np.stack([lo[s], (reach - group * wide)[np.append(s[1:], len(lo)) - 1]], 1).reshape(-1)
    new = np.flatnonzero(first[s])
    for i in range(0, len(new), 50_000):
        some = new[i : i + 50_000]
        end = new[i + 50_000] if i + 50_000 < len(new) else len(s)
        cut = 2 * (np.append(some, end) - some[0])
        yield pa.RecordBatch.from_arrays([pa.array(doc[s[some]]), pa.array(fp[s[some]]), pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(runs[2 * some[0] : 2 * end]))], ["_d", "_f", "runs"])


def _shared_places(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _find_shared(batches)
        if found is not None:
            doc, fp, at = found
            yield _pack_by_doc(doc, fp, at.astype(np.int64), at.astype(np.int64) + 1, n_buckets)

    return run


def _find_shared(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Packed anchors of whole buckets to (document, fp, place) of those that two documents share."""
    keys, docs, fps, places, known = [], [], [], [], []
    for batch in batches:
        for row in batch.to_pylist():
            doc = _unplanes(row["doc"], np.int64)
            h = np.frombuffer(row["h"], np.uint32).astype(np.uint64) | np.uint64(row["bucket"] << 32) if not row["known"] else np.zeros(len(doc), np.uint64)
            keys.append(h)
            docs.append(doc)
            fps.append(_unplanes(row["fp"], np.int32))
            places.append(_unplanes(row["at"], np.int32))
            known.append(np.full(len(doc), bool(row["known"])))
    if not keys:
        return None
    h, doc, fp, at, sure = (np.concatenate(x) for x in (keys, docs, fps, places, known))
    del keys, docs, fps, places, known
    open_ = np.flatnonzero(~sure)
    open_ = open_[np.argsort(h[open_], kind="stable")]
    sure[open_[_in_two_docs(h[open_], doc[open_])]] = True
    return doc[sure], fp[sure], at[sure]


def _places(runs: np.ndarray) -> np.ndarray:
    """Every place in runs of places."""
    lo, n = runs[::2], runs[1::2] - runs[::2]
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _context_rows(n_buckets: int, p: Repeats):
    """Batches of (doc_id, fp, text, places) to packed contexts by bucket, and runs settled within the task by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(3)
        held: list[tuple] = []
        size = 0
        for part, data, off, _, _ in _texts(batches, p.flush_bytes):
            ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            fps = part.column("fp").to_numpy(zero_copy_only=False).astype(np.int32)
            wanted = np.concatenate([np.zeros(0, np.int64), *(_places(np.asarray(v.values)) + o for v, o in zip(part.column("places"), off[:-1], strict=True))])
            for first, last, h in _pieces(data, off, p, rolling):
                hit = np.isin(first, wanted)
                first, last, h = first[hit], last[hit], h[hit]
                doc = np.searchsorted(off, first, side="right") - 1
                texts = [data[a:b].tobytes() for a, b in zip(first.tolist(), (last + p.length).tolist(), strict=True)]
                held.append((h, ids[doc], fps[doc], (first - off[doc]).astype(np.int32), texts))
                size += sum(map(len, texts)) + 64 * len(texts)
            if size >= p.flush_bytes:
                yield _pack_contexts(held, n_buckets)
                held, size = [], 0
        if held:
            yield _pack_contexts(held, n_buckets)

    return run


def _pack_contexts(held: list[tuple], n_buckets: int) -> pa.RecordBatch:
    h, doc, fp, at = (np.concatenate([x[i] for x in held]) for i in range(4))
    texts = [t for x in held for t in x[4]]
    least: dict[bytes, int] = {}
    for t, d in zip(texts, doc.tolist(), strict=True):
        if d < least.get(t, 1 << 63):
            least[t] = d
    # a context that a smaller document has, byte for byte, is settled here
    settled = np.fromiter((least[t] < d for t, d in zip(texts, doc.tolist(), strict=True)), bool, len(texts))
    sizes = np.fromiter(map(len, texts), np.int32, len(texts))
    bucket = (h >> np.uint64(40)) % np.uint64(n_buckets)
    rows: list[tuple] = []
    for flag, chosen in ((0, np.flatnonzero(~settled)), (1, np.flatnonzero(settled))):
        b = bucket[chosen]
        by = np.lexsort((h[chosen], b))
        chosen, b = chosen[by], b[by]
        cuts = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]])) if len(b) else np.zeros(1, np.int64)
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            c = chosen[lo:hi]
            body = b"" if flag else _squeeze(b"".join(texts[i] for i in c.tolist()))
            rows.append((int(b[lo]), flag, b"" if flag else _planes(h[c]), _planes(doc[c]), _planes(fp[c]), _planes(at[c]), _planes(sizes[c]), body))
    kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 6)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["bucket", "known", "h", "doc", "fp", "at", "size", "body"])


def _removable(n_buckets: int, p: Repeats, sort_bytes: int = 1 << 19):
    """Packed contexts of whole buckets to packed spans of removable bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[] for _ in range(5)]
        bodies: list[bytes] = []
        spans: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                doc, fp, at, size = (_unplanes(row[c], k) for c, k in (("doc", np.int64), ("fp", np.int32), ("at", np.int32), ("size", np.int32)))
                if row["known"]:
                    spans.append((doc, fp, at.astype(np.int64), at.astype(np.int64) + size))
                    continue
                for column, x in zip(columns, (_unplanes(row["h"], np.uint64), doc, fp, at, size), strict=True):
                    column.append(x)
                bodies.append(_unsqueeze(row["body"]))
        if columns[0]:
            h, doc, fp, at, size = map(np.concatenate, columns)
            body = np.frombuffer(b"".join(bodies), np.uint8)
            del columns, bodies
            begin = np.cumsum(size, dtype=np.int64) - size
            order = np.argsort(h, kind="stable")
            h = h[order]
            new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            group = np.add.reduceat(size[order].astype(np.int64), new)
            for lo, hi in spans_of(group, sort_bytes):
                a, b = new[lo], new[hi] if hi < len(new) else len(h)
                spans += _sort_and_compare(body, begin, size, doc, fp, at, order[a:b], h[a:b], p)
        if not spans:
            return
        yield _pack_by_doc(*(np.concatenate(x) for x in zip(*spans, strict=True)), n_buckets)

    return run


def _sort_and_compare(body, begin, size, doc, fp, at, chosen, h, p: Repeats) -> list[tuple]:
    """Runs (doc, fp, start, end) of the windows of the chosen contexts (of anchors h) that a smaller document has."""
    texts: dict[bytes, int] = {}
    family = np.empty(len(chosen), np.int64)
    for n, (a, s) in enumerate(zip(begin[chosen].tolist(), size[chosen].tolist(), strict=True)):
        family[n] = texts.setdefault(body[a : a + s].tobytes(), len(texts))
    least = np.full(len(texts), np.iinfo(np.int64).max)
    np.minimum.at(least, family, doc[chosen])
    out = []
    # in every document but its family's least, a context goes as a whole
    later = doc[chosen] > least[family]
    c = chosen[later]
    out.append((doc[c], fp[c], at[c].astype(np.int64), at[c].astype(np.int64) + size[c]))
    # windows of different anchors differ: an anchor with one family has no more to compare
    anchor = np.zeros(len(texts), np.uint64)
    anchor[family] = h
    _, number, kinds = np.unique(anchor, return_inverse=True, return_counts=True)
    several = kinds[number] > 1
    if not several.any():
        return out
    renamed = np.cumsum(several) - 1
    texts = [t for t, ok in zip(texts, several.tolist(), strict=True) if ok]
    least = least[several]
    mine = several[family]
    chosen, family, later = chosen[mine], renamed[family[mine]], later[mine]
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.cumsum(sizes + 1) - sizes - 1
    order = suffix_order(data.astype(np.int64) + 1)
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    place = np.arange(len(data)) - np.repeat(first, sizes + 1)
    fits = place + p.length <= np.repeat(sizes, sizes + 1)
    starts = order[fits[order]]
    run = equal_runs(data, starts, p.length)
    new = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    smallest = np.full(len(data), np.iinfo(np.int64).max)
    smallest[starts] = np.repeat(np.minimum.reduceat(least[owner[starts]], new), np.diff(np.append(new, len(starts))))
    partly = fits & (smallest < least[owner])
    hit = np.flatnonzero(partly)
    if len(hit):
        edge = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])])
        lo, hi = hit[edge], hit[np.append(edge[1:], True)] + p.length
        in_family = owner[lo]
        members = np.flatnonzero(~later)
        by = np.argsort(family[members], kind="stable")
        members = members[by]
        a = np.searchsorted(family[members], in_family, side="left")
        b = np.searchsorted(family[members], in_family, side="right")
        rows = np.repeat(np.arange(len(lo)), b - a)
        who = chosen[members[np.concatenate([np.arange(x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True)])]]
        base = at[who].astype(np.int64) - first[in_family[rows]]
        out.append((doc[who], fp[who], base + lo[rows], base + hi[rows]))
    return out


def merged(runs) -> list[tuple[int, int]]:
    """Runs as start, end, start, end, ... joined where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(runs[::2], runs[1::2], strict=True)):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def find_repeats(docs: DataFrame, p: Repeats = Repeats()) -> DataFrame:
    """docs' rows as (doc_id long, text, copy boolean, runs array<long>, row: a struct of docs' columns but the text).

    runs covers the bytes of the UTF-8 text that lie in a string of p.length
    bytes which also starts in a row with a smaller doc_id; it may overlap itself.
    copy says that the whole text is one of a smaller doc_id: runs is then null.
    Texts shorter than p.length, null and empty ones have no runs. A null doc_id
    counts as larger than any other. Rows that repeat a doc_id do not affect each
    other. Empty tables give empty results; docs' columns may have any names.
    """
    row = F.struct(*(docs[c] for c in docs.columns if c != "text"))
    marked = docs.select(row.alias("row"), F.coalesce(docs["doc_id"].cast("long"), F.lit((1 << 63) - 1)).alias("doc_id"), docs["text"].cast("string").alias("text"))
    marked = marked.withColumns({"fp1": F.xxhash64("text"), "fp2": F.xxhash64(F.lit(1), "text"), "fp": F.hash("text"), "n": F.coalesce(F.octet_length("text"), F.lit(0))})
    ids = materialize(marked.where(F.col("n") >= p.length).groupBy("fp1", "fp2").agg(F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most"), F.max("n").alias("_size")), "texts")
    total, = ids.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()
    copied = ids.where("_least < _most").select(F.col("fp1").alias("_f1"), F.col("fp2").alias("_f2"), "_least")
    small = copied.count() <= p.broadcast_ids
    copied = F.broadcast(copied) if small else copied
    flagged = marked.join(copied, (F.col("fp1") == F.col("_f1")) & (F.col("fp2") == F.col("_f2")), "left").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("_least"), F.lit(False)))
    searched = ~F.col("copy") & (F.col("n") >= p.length)
    texts = flagged.where(searched).select("doc_id", "fp", F.col("text").cast("binary").alias("text"), "row")
    n_buckets = max(12, -(-int(total) // (16 * p.anchors_in_bucket)))
    packed = texts.select("doc_id", "fp", "text").mapInArrow(tidy(_anchor_rows(n_buckets, p)), "bucket int, known int, h binary, doc binary, fp binary, at binary")
    by_doc = "_d long, _f int, runs array<long>"  # fp only tells rows apart that repeat a doc_id
    one_each = lambda df: df.repartitionById(n_buckets, F.col("bucket"))
    places = one_each(one_each(packed).mapInArrow(tidy(_shared_places(n_buckets)), PACKED)).mapInArrow(tidy(_spans_by_doc), by_doc)
    # both joins take all columns of texts, so that its exchange is made once and read twice
    same = (F.col("doc_id") == F.col("_d")) & (F.col("fp") == F.col("_f"))
    involved = texts.join(places, same).select("doc_id", "fp", "text", "row", F.col("runs").alias("places"))
    contexts = involved.mapInArrow(tidy(_context_rows(n_buckets, p)), "bucket int, known int, h binary, doc binary, fp binary, at binary, size binary, body binary")
    runs = one_each(one_each(contexts).mapInArrow(tidy(_removable(n_buckets, p)), PACKED)).mapInArrow(tidy(_spans_by_doc), by_doc)
    given = F.col("row.doc_id").cast("long").alias("doc_id")
    found = texts.join(runs, same, "left").select(given, F.col("text").cast("string").alias("text"), F.lit(False).alias("copy"), "runs", "row")
    return found.unionByName(flagged.where(~searched).select(given, "text", "copy", F.lit(None).cast("array<long>").alias("runs"), "row"))


def _kept(raw: bytes, copy: bool, runs) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, maximal runs removed)."""
    if copy:
        return b"", len(raw), 1
    spans = merged(runs or [])
    left, at = [], 0
    for a, b in spans:
        left.append(raw[at:a])
        at = b
    left.append(raw[at:])
    return b"".join(left), sum(b - a for a, b in spans), len(spans)


def digest_repeats(found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of find_repeats()' rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, copy, runs in zip(batch.column("text"), batch.column("copy").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                raw = text.as_py() or b""
                left, n, spans = _kept(raw, copy, runs)
                out.append((len(raw), n, spans, hashlib.sha256(left).hexdigest()))
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return found.select("doc_id", F.col("text").cast("binary").alias("text"), "copy", "runs").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, p: Repeats = Repeats()) -> DataFrame:
    """docs with repeated bytes cut out of their texts, all columns kept; what a cut leaves of a character goes too."""
    found = find_repeats(docs, p)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, copies, runs, row = (batch.column(c) for c in ("text", "copy", "runs", "row"))
            left = [None if t is None else _kept(t.encode(), c, r)[0].decode(errors="ignore") for t, c, r in zip(texts.to_pylist(), copies.to_pylist(), runs.to_pylist(), strict=True)]
            others = dict(zip((f.name for f in row.type), row.flatten(), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.string()) if c == "text" else others[c] for c in columns], columns)

    return found.select("text", "copy", "runs", "row").mapInArrow(tidy(run), docs.schema)
