"""Near-duplicate groups: SuperMinHash signatures, banding, exact verification, components.

SuperMinHash gives each element of a set its own permutation of the registers
and offers rank + uniform to register permutation[rank], rank by rank; a set is
done as soon as every register holds a value below the next rank. Registers of
one element are correlated, which lowers the estimate's variance.

Equal sets become one class first. Signatures are cut into bands; a bucket of
classes that agree on a band has one pivot that a hash chooses, and every class
is paired with the few pivots of its buckets whose signatures are nearest, so
that pairs are in proportion to classes however large a group is. Pairs are
verified on the full sets of words. What is left are buckets that hold several
components. Two of their classes can only link if they share one of their rarest
shingles, at a place that leaves room for the overlap (the prefix and positional
bounds, which are exact); the pairs across components that do are verified too.
So every candidate pair is verified, already connected, or shown to be too
different, and classes that differ from a whole group cost nothing more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import LOWER, Rolling, materialize, mix64, spans_of, tidy, utf8_view, word_bounds
from tidewright.llm.components import connected_components

#: Bytes of texts that are cut into shingles at once; the arrays for them take about 40 times as much.
AT_ONCE = 1 << 19


@dataclass(frozen=True)
class NearDup:
    """A pair of similarity 0.8 misses all 46 bands of 6 registers with a chance of 9e-7."""

    words: int = 5
    percent: int = 80
    bands: int = 46
    rows: int = 6
    seed: int = 11
    broadcast_ids: int = 500_000
    pivot_rounds: int = 2
    pivots: int = 3


def shingle_hashes(data: np.ndarray, off: np.ndarray, k: int, rolling: Rolling) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every k-word shingle of lower-cased texts; a text of fewer words is one shingle."""
    base = int(off[0])
    body = LOWER[data[base : int(off[-1])]]
    starts = off[:-1] - base
    begin, end = word_bounds(body, starts)
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    prefix = rolling.prefix(body)
    word = rolling.between(prefix, begin, end)
    owner = np.searchsorted(starts, begin, side="right") - 1
    n_words = np.bincount(owner, minlength=len(starts))
    first = np.concatenate([[0], np.cumsum(n_words)])
    with np.errstate(over="ignore"):
        acc = word.copy()
        whole = {}
        for t in range(1, k + 1):
            short = np.flatnonzero(n_words == t)
            if t < k and len(short):
                whole[t] = (short, mix64(acc[first[short]] + np.uint64(t)))
            if t < k:
                acc = acc[: max(0, len(word) - t)]
                acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + word[t : t + len(acc)])
        left = first[owner + 1] - np.arange(len(word)) >= k
        left = left[: len(acc)]
    texts = [owner[: len(acc)][left], *(s for s, _ in whole.values())]
    hashes = [acc[left], *(h for _, h in whole.values())]
    return np.concatenate(texts), np.concatenate(hashes)


def distinct_by_text(texts: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): each text's distinct hashes, sorted."""
    order = np.lexsort((hashes, texts))
    t, h = texts[order], hashes[order]
    keep = np.ones(len(t), bool)
    keep[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    return h[keep], np.concatenate([[0], np.cumsum(np.bincount(t[keep], minlength=n))])


def super_minhash(elements: np.ndarray, offsets: np.ndarray, m: int, seed: int, at_once: int = 60_000) -> np.ndarray:
    """Signatures (sets x m, uint64: rank in the high, uniform in the low 32 bits); an empty set keeps all ones."""
    sizes = np.diff(offsets)
    out = np.full((len(sizes), m), np.iinfo(np.uint64).max, np.uint64)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    for lo, hi in spans_of(sizes[order], at_once):
        part = order[lo:hi]
        owner = np.repeat(np.arange(len(part)), sizes[part])
        at = np.concatenate([np.arange(offsets[p], offsets[p + 1]) for p in part])
        out[part] = _signatures(elements[at], owner, len(part), m, seed)
    return out


def _signatures(elements: np.ndarray, owner: np.ndarray, n: int, m: int, seed: int) -> np.ndarray:
    h = np.full(n * m, np.iinfo(np.uint64).max, np.uint64)
    moved: list[tuple[np.ndarray, np.ndarray]] = []  # (place, value) of each earlier swap: sparse permutations
    state = mix64(elements + np.uint64(seed))
    with np.errstate(over="ignore"):
        for j in range(m):
            x = mix64(state + np.uint64(j) * np.uint64(0x9E3779B97F4A7C15))
            place = (np.uint64(j) + (((x & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32))).astype(np.int32)
            if isinstance(moved, list):
                mine, theirs = np.full(len(place), j, np.int32), place.copy()
                for where, value in moved:
                    np.copyto(mine, value, where=where == j)
                    np.copyto(theirs, value, where=where == place)
                moved.append((place, mine))
            else:
                rows = np.arange(len(place))
                mine, theirs = moved[:, j].copy(), moved[rows, place]
                moved[rows, place] = mine
            np.minimum.at(h, owner * m + theirs, (np.uint64(j) << np.uint64(32)) | (x >> np.uint64(32)))
            unfinished = h.reshape(n, m).max(1) >= np.uint64(j + 1) << np.uint64(32)
            going = unfinished[owner]
            if not going.any():
                break
            if not going.all():
                owner, state = owner[going], state[going]
                moved = [(a[going], b[going]) for a, b in moved] if isinstance(moved, list) else moved[going]
            if isinstance(moved, list) and len(moved) >= 8:  # few elements are left: whole permutations
                whole = np.broadcast_to(np.arange(m, dtype=np.int16), (len(owner), m)).copy()
                rows = np.arange(len(owner))
                for where, value in moved:
                    whole[rows, where] = value
                moved = whole
    return h.reshape(n, m)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band."""
    s = signatures.reshape(len(signatures), bands, rows)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), s.shape[:2]).copy()
        for r in range(rows):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + s[:, :, r])
    return key


def sign_bits(signatures: np.ndarray) -> np.ndarray:
    """One bit of each register, packed into longs (sets x words)."""
    bits = (mix64(signatures) & np.uint64(1)).astype(np.uint8)
    pad = -bits.shape[1] % 64
    return np.packbits(np.pad(bits, ((0, 0), (0, pad))), axis=1).view(np.int64)


def sketch(docs: DataFrame, p: NearDup) -> DataFrame:
    """doc_id, n_shingles, fingerprint of the set (two longs), band keys, signs and hash of the text (two longs) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(p.seed)
        for batch in batches:
            data, off, _ = utf8_view(batch.column("text"))
            for lo, hi in spans_of(np.diff(off), AT_ONCE):
                texts, hashes = shingle_hashes(data, off[lo : hi + 1], p.words, rolling)
                elements, at = distinct_by_text(texts, hashes, hi - lo)
                with np.errstate(over="ignore"):
                    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(elements + np.uint64(s)), dtype=np.uint64)]) for s in (1, 2)]
                    fps = [(s[at[1:]] - s[at[:-1]]).view(np.int64) for s in sums]
                signatures = super_minhash(elements, at, p.bands * p.rows, p.seed)
                keys = band_keys(signatures, p.bands, p.rows).view(np.int64)
                signs = sign_bits(signatures)
                cuts = np.arange(0, signs.size + 1, signs.shape[1], dtype=np.int32)
                ends = np.arange(0, keys.size + 1, p.bands, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(at).astype(np.int64)), pa.array(fps[0]), pa.array(fps[1]), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1))), pa.ListArray.from_arrays(pa.array(cuts), pa.array(signs.reshape(-1))), *(batch.column(c).slice(lo, hi - lo) for c in ("text_a", "text_b"))], ["doc_id", "n_shingles", "fp_a", "fp_b", "keys", "signs", "text_a", "text_b"])

    return docs.select("doc_id", "text", *_text_key(F.col("text"))).mapInArrow(tidy(run), "doc_id long, n_shingles long, fp_a long, fp_b long, keys array<long>, signs array<long>, text_a long, text_b long")


def _text_key(text):
    return F.xxhash64(text).alias("text_a"), F.xxhash64(F.lit(1), text).alias("text_b")


def shingle_set(text: bytes, k: int) -> frozenset:
    words = text.lower().split()
    if len(words) < k:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*(words[i:] for i in range(k)), strict=False))


def verify(pairs: DataFrame, texts: DataFrame, p: NearDup) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. Joins are plain equi-joins, which AQE splits at hot pivots."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, frozenset] = {}
        held = 0
        for batch in batches:
            mask = []
            for x, y in zip(batch.column("text_a"), batch.column("text_b"), strict=True):
                sets = []
                for text in (x.as_py(), y.as_py()):
                    if text not in kept:
                        if held > 100_000:
                            kept.clear()
                            held = 0
                        kept[text] = shingle_set(text, p.words)
                        held += len(kept[text])
                    sets.append(kept[text])
                both = len(sets[0] & sets[1])
                mask.append(100 * both >= p.percent * (len(sets[0]) + len(sets[1]) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(mask, pa.bool_()))

    return pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(tidy(run), "a long, b long").distinct()


def _ordered(x, y):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def near_duplicates(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of docs (doc_id an integer).

    Words are runs of non-space bytes, A-Z lower-cased; a set is the distinct
    p.words-word shingles. component_id is the smallest doc_id reachable over
    links of at least p.percent; kept says whether it is the row's own. Null,
    empty and wordless texts have empty sets and link with nothing. Rows with a
    null doc_id link with nothing and have a null component. doc_id is a
    document's identity: of rows that repeat one with different texts all share
    a component, for which links of one of the texts, the one of least
    fingerprint, are looked for. Empty tables are fine; other columns are ignored.
    """
    return _judged(docs, p).select("doc_id", "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, p: NearDup) -> DataFrame:
    """near_duplicates() with the hash of each row's text."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = materialize(sketch(source, p), "sketches")
    usable = sketches.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    reps = materialize(usable.groupBy("fp_a", "fp_b").agg(F.min("doc_id").alias("rep")), "classes")
    mine = reps.select(F.col("fp_a").alias("_a"), F.col("fp_b").alias("_b"), "rep")
    firsts = usable.join(mine, (F.col("fp_a") == F.col("_a")) & (F.col("fp_b") == F.col("_b")) & (F.col("doc_id") == F.col("rep")), "left_semi")
    one = F.min(F.struct("fp_a", "fp_b", "text_a", "text_b", F.col("n_shingles").alias("size"), "signs", "keys"))
    facts = firsts.groupBy(F.col("doc_id").alias("rep")).agg(one.alias("_f")).select("rep", "_f.*")
    buckets = facts.select("rep", F.explode("keys").alias("key"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = materialize(buckets.join(shared, "key").select("key", "rep").distinct(), "buckets")
    facts = facts.select("rep", "size", "signs", "text_a", "text_b")
    edges = _links(source, members, facts, p)
    labels = connected_components(edges) if edges is not None else None
    owner = reps if labels is None else reps.join(labels, F.col("rep") == F.col("node"), "left").select("fp_a", "fp_b", F.coalesce("label", "rep").alias("rep"))
    owner = owner.select(F.col("fp_a").alias("_a"), F.col("fp_b").alias("_b"), F.col("rep").alias("_owner"))
    joined = sketches.join(owner, (F.col("fp_a") == F.col("_a")) & (F.col("fp_b") == F.col("_b")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), "left")
    component = F.coalesce("_owner", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "text_a", "text_b")


def keep_one(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """The rows of docs, all columns, that near_duplicates() keeps.

    Of rows that repeat both doc_id and text the one of least JSON stays; rows
    that repeat a doc_id with different texts are judged one by one. Rows with a
    null doc_id stay.
    """
    found = _judged(docs.select("doc_id", "text"), p).where("doc_id is not null")
    facts = found.groupBy(F.col("doc_id").alias("_id"), F.col("text_a").alias("_a"), F.col("text_b").alias("_b")).agg(F.min("kept").alias("_kept"), F.count("*").alias("_n"))
    facts = materialize(facts.where("not _kept or _n > 1"), "verdicts")
    facts = F.broadcast(facts) if facts.count() <= p.broadcast_ids else facts
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"), docs["doc_id"].cast("long").alias("_doc"), *_text_key(docs["text"].cast("string")))
    judged = rows.join(facts, (F.col("_doc") == F.col("_id")) & (F.col("text_a") == F.col("_a")) & (F.col("text_b") == F.col("_b")), "left").where(F.coalesce("_kept", F.lit(True)))
    if facts.where("_kept").isEmpty():
        return judged.select("_row.*")
    once = judged.where(F.coalesce("_n", F.lit(1)) == 1).select("_row")
    repeated = judged.where("_n > 1").groupBy("_id", "_a", "_b").agg(F.min_by("_row", F.to_json("_row")).alias("_row")).select("_row")
    return once.unionByName(repeated).select("_row.*")


def _differing(p: NearDup):
    """How many of the registers' bits differ between signs and _signs."""
    return sum((F.bit_count(F.col("signs")[i].bitwiseXOR(F.col("_signs")[i])) for i in range(-(-p.bands * p.rows // 64))), F.lit(0))


def _pivot_pairs(members: DataFrame, turn: int, p: NearDup) -> DataFrame:
    """Each class with the p.pivots nearest pivots of its buckets that are of another component."""
    chosen = members.select("key", F.struct(F.col("rep").alias("_rep"), F.col("label").alias("_label"), F.col("size").alias("_size"), F.col("signs").alias("_signs")).alias("_m"))
    pivot = chosen.groupBy("key").agg(F.min_by("_m", F.xxhash64("_m._rep", "key", F.lit(turn))).alias("_m")).select("key", "_m.*")
    close = 100 * F.least("size", "_size") >= p.percent * F.greatest("size", "_size")
    met = members.join(pivot, "key").where((F.col("label") != F.col("_label")) & close)
    best = met.groupBy("rep").agg(F.slice(F.array_sort(F.collect_set(F.struct(_differing(p).alias("d"), "_rep"))), 1, p.pivots).alias("_best"))  # one a band at most
    pairs = best.select("rep", F.explode("_best._rep").alias("_rep"))
    return pairs.select(*_ordered(F.col("rep"), F.col("_rep"))).distinct()


def _rare_pairs(texts: DataFrame, nodes: DataFrame, p: NearDup) -> DataFrame:
    """Pairs of different components among nodes (rep, label, size) that share a shingle of both prefixes within the positional bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(p.seed)
        for batch in batches:
            data, off, _ = utf8_view(batch.column("text"))
            for lo, hi in spans_of(np.diff(off), 1 << 20):
                owner, hashes = shingle_hashes(data, off[lo : hi + 1], p.words, rolling)
                elements, at = distinct_by_text(owner, hashes, hi - lo)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in ("rep", "label", "size")), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(elements.view(np.int64)))], ["rep", "label", "size", "tokens"])

    open_texts = texts.join(nodes, texts["doc_id"] == nodes["rep"]).select("rep", "label", "size", "text")
    tokens = materialize(open_texts.mapInArrow(tidy(run), "rep long, label long, size long, tokens array<long>"), "tokens").select("rep", "label", "size", F.explode("tokens").alias("token"))
    common = tokens.groupBy("token").agg(F.count("*").alias("n"), (F.min("label") < F.max("label")).alias("crossing")).where("n > 1")
    # shingles of one class only come first in the order; they take places of the prefix and meet nobody
    ranked = tokens.join(common, "token").groupBy("rep", "label", "size").agg(F.array_sort(F.collect_list(F.struct("n", "token", "crossing"))).alias("_t"))
    length = F.col("size") - F.ceil(F.col("size") * p.percent / 100) + 1
    alone = (F.col("size") - F.size("_t")).alias("alone")
    prefix = ranked.select("rep", "label", "size", alone, F.posexplode(F.slice("_t", 1, F.greatest((length - F.col("size") + F.size("_t")).cast("int"), F.lit(0)))))
    prefix = materialize(prefix.where("col.crossing").select("rep", "label", "size", F.col("col.token").alias("token"), (F.col("size") - F.col("alone") - F.col("pos")).alias("room")), "prefixes")
    other = prefix.select("token", *(F.col(c).alias(f"_{c}") for c in ("rep", "label", "size", "room")))
    close = 100 * F.least("size", "_size") >= p.percent * F.greatest("size", "_size")
    fits = (100 + p.percent) * F.least("room", "_room") >= p.percent * (F.col("size") + F.col("_size"))
    met = prefix.join(other, "token").where((F.col("label") != F.col("_label")) & (F.col("rep") < F.col("_rep")) & close & fits)
    return met.select(F.col("rep").alias("a"), F.col("_rep").alias("b")).distinct()


def _links(source: DataFrame, members: DataFrame, facts: DataFrame, p: NearDup) -> DataFrame | None:
    """Verified links between class representatives that connect all that any bucket's verified pairs connect."""
    ids = members.select(F.col("rep").alias("_id")).distinct()
    n_ids = ids.count()
    if not n_ids:
        return None
    few = F.broadcast if n_ids <= p.broadcast_ids else lambda df: df
    facts = materialize(facts.join(few(ids), F.col("rep") == F.col("_id"), "left_semi"), "facts")
    chosen = few(facts.select(F.col("rep").alias("_id"), F.col("text_a").alias("_a"), F.col("text_b").alias("_b")))
    texts = source.withColumns(dict(zip(("text_a", "text_b"), _text_key(F.col("text")), strict=True)))
    texts = texts.join(chosen, (F.col("doc_id") == F.col("_id")) & (F.col("text_a") == F.col("_a")) & (F.col("text_b") == F.col("_b")), "left_semi")
    texts = materialize(texts.select("doc_id", F.encode("text", "UTF-8").alias("text")).dropDuplicates(["doc_id"]), "texts")
    facts = facts.drop("text_a", "text_b")
    tried = edges = None
    open_members = members.withColumn("label", F.col("rep")).join(facts, "rep")
    for turn in range(p.pivot_rounds + 1):
        if turn < p.pivot_rounds:
            pairs = _pivot_pairs(open_members, turn, p)
        else:
            pairs = _rare_pairs(texts, open_members.select("rep", "label", "size").distinct(), p)
        pairs = materialize(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():  # pairs without a pivot may be left
            continue
        found = materialize(verify(pairs, texts, p), "links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        edges = found if edges is None else edges.unionByName(found)
        if turn < p.pivot_rounds:
            labels = connected_components(edges)
            edges = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))  # connects the same with fewer edges
            labelled = members.join(labels, F.col("rep") == F.col("node"), "left").select("key", "rep", F.coalesce("label", "rep").alias("label"))
            split = labelled.groupBy("key").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).where("_lo < _hi").select("key")
            open_members = materialize(labelled.join(split, "key", "left_semi").join(facts, "rep"), "open")
    return edges
