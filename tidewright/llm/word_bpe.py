"""Byte-level BPE through a table of distinct words, and its decoding.

Spark's tasks split texts into words by the vocabulary's pattern. The distinct
words are counted, each is encoded once, and the ids are joined back by
position: words of the frequent head, a table of bounded size, in a map-side
join; all others in a shuffled join that carries the key of their block of texts
and their place in it. Ids turn into text again through the table of pieces, which is as
large as the vocabulary.

A null or empty text has no tokens. Added tokens of the vocabulary that stand in
a text become their own ids. Equal rows give equal rows; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType
from tokenizers import pre_tokenizers

from tidewright.llm.common import Rolling, materialize, ship, spans_of, tidy, utf8_view

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
LETTER, DIGIT, OTHER, WHITE = range(4)
#: White space as the pattern of byte-level vocabularies knows it.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@dataclass(frozen=True)
class ByteBpe:
    """byte_id: id of each byte; merges: (left << 32 | right) to (rank, id); pieces: each id's bytes; added: other strings to ids."""

    byte_id: list[int]
    merges: dict[int, tuple[int, int]]
    pieces: list[bytes]
    added: dict[str, int]

    @property
    def width(self) -> type:
        return np.uint16 if len(self.pieces) <= 1 << 16 else np.uint32


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself where it is printable, else the next from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def load_vocabulary(path: str = DEFAULT_VOCABULARY) -> ByteBpe:
    """Read a byte-level BPE vocabulary; raises ValueError for one that needs more than splitting, merging and plain added tokens."""
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    body, split = given["model"], given["pre_tokenizer"] or {}
    plain = body["type"] == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not given["normalizer"]
    if not plain or body.get("ignore_merges") or body.get("continuing_subword_prefix") or body.get("end_of_word_suffix"):
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in given["added_tokens"]):
        raise ValueError(f"{path} has added tokens that depend on what is around them")
    letters, ids = _byte_letters(), body["vocab"]
    pieces = [b""] * (1 + max([*ids.values(), *(t["id"] for t in given["added_tokens"])]))
    for piece, i in ids.items():
        pieces[i] = bytes(letters[c] for c in piece)
    added = {t["content"]: t["id"] for t in given["added_tokens"]}
    for text, i in added.items():
        pieces[i] = text.encode()
    merges = {}
    for rank, pair in enumerate(body["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        merges[ids[a] << 32 | ids[b]] = (rank, ids[a + b])
    byte_id = [0] * 256
    for c, b in letters.items():
        byte_id[b] = ids[c]
    return ByteBpe(byte_id, merges, pieces, added)


@cache
def character_classes() -> bytes:
    """LETTER, DIGIT, WHITE or OTHER for every code point, as the tokenizers library's pattern has them."""
    splitter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    out = np.full(0x110000, OTHER, np.uint8)
    for lo in range(0, 0x40000, 0x2000):  # neither letters nor digits beyond
        codes = [c for c in range(lo, lo + 0x2000) if not 0xD800 <= c < 0xE000]
        for kind, beside in ((LETTER, "x"), (DIGIT, "1")):
            text = "".join(f" {beside}{chr(c)}{beside}" for c in codes)
            out[[ord(text[a + 2]) for _, (a, b) in splitter.pre_tokenize_str(text) if b - a == 4]] = kind
    out[WHITE_SPACE] = WHITE
    return out.tobytes()


def _added_edges(data: bytes, offsets: np.ndarray, added: list[bytes]) -> list[int]:
    """Where added tokens start and end; the longest of those at one place, none across texts."""
    if not any(t in data for t in added):
        return []
    pattern = re.compile(b"|".join(map(re.escape, sorted(added, key=lambda t: (-len(t), t)))))
    return [lo + x for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) for m in pattern.finditer(data[lo:hi]) for x in m.span()]


def word_starts(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray, added: list[bytes]) -> np.ndarray:
    """Where words start in texts data[offsets[i]:offsets[i + 1]] (UTF-8), which they fill without a gap.

    The pattern in terms of runs of letters, digits, white space and others: a
    run is a word and takes a space before it along; white space before another
    run leaves its last character; an apostrophe that starts a word makes one
    with s, t, re, ve, m, ll or d after it. An added token is a word, and what
    stands before it ends as a text does.
    """
    raw = data.tobytes()
    at = None
    if (data >= 0x80).any():
        at = np.flatnonzero((data & 0xC0) != 0x80)
        codes = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    else:
        codes = data
    n = len(codes)
    marks = np.array(_added_edges(raw, offsets, added), np.int64)
    edges = np.concatenate([offsets, marks])
    edge = np.zeros(n + 1, bool)
    edge[edges if at is None else np.searchsorted(at, edges)] = True
    kind = classes[codes]
    start = edge.copy()
    start[1:-1] |= kind[1:] != kind[:-1]
    white = np.flatnonzero((kind[:-1] == WHITE) & (kind[1:] != WHITE) & ~edge[1:-1])  # the last of a run that goes on in the same text
    start[white] = True
    start[white[codes[white] == 32] + 1] = False
    quote = np.flatnonzero((codes == 39) & start[:-1])
    for letters in ("s", "t", "re", "ve", "m", "ll", "d"):
        size = len(letters)
        fits = quote[quote + size < n]
        for i, c in enumerate(letters, 1):
            fits = fits[(codes[fits + i] == ord(c)) & ~edge[fits + i]]
        start[fits + 1] = False
        start[fits + 1 + size] = True
    if len(marks):
        pairs = (marks if at is None else np.searchsorted(at, marks)).reshape(-1, 2)
        for lo, hi in pairs.tolist():
            start[lo + 1 : hi] = False
    found = np.flatnonzero(start[:-1])
    return found if at is None else at[found]


@dataclass(frozen=True)
class Splitter:
    """What tasks need to split texts."""

    classes: bytes
    added: list[bytes]

    def spans(self, column: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int, pa.Array, np.ndarray]]:
        """(first row, end row, words, each row's first word and the end) for runs of texts of about `limit` bytes."""
        raw, offsets, _ = utf8_view(column)
        classes = np.frombuffer(self.classes, np.uint8)
        for lo, hi in spans_of(np.diff(offsets), limit):
            data, at = raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            starts = word_starts(data, at, classes, self.added) if len(data) else np.zeros(0, np.int64)
            ends = np.append(starts, len(data)).astype(np.int64)
            words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data)))
            yield lo, hi, words, np.searchsorted(starts, at)


def merge_word(word: bytes, v: ByteBpe) -> list[int]:
    """Ids of one word: the pair of least rank first, leftmost among equals, from an agenda."""
    ids = [v.byte_id[b] for b in word]
    n = len(ids)
    if n < 2:
        return ids
    merges, after, before = v.merges, list(range(1, n + 1)), list(range(-1, n - 1))
    agenda = [(m[0], i, m[1], ids[i], ids[i + 1]) for i in range(n - 1) if (m := merges.get(ids[i] << 32 | ids[i + 1]))]
    heapify(agenda)
    while agenda:
        _, i, new, left, right = heappop(agenda)
        j = after[i]
        if j >= n or ids[i] != left or ids[j] != right:
            continue
        ids[i], ids[j] = new, -1
        k = after[i] = after[j]
        after[j] = n
        if k < n:
            before[k] = i
            if m := merges.get(new << 32 | ids[k]):
                heappush(agenda, (m[0], i, m[1], new, ids[k]))
        h = before[i]
        if h >= 0 and (m := merges.get(ids[h] << 32 | new)):
            heappush(agenda, (m[0], h, m[1], ids[h], new))
    return [i for i in ids if i >= 0]


def _packed(words: pa.Table, buckets: int) -> pa.RecordBatch:
    """(bucket, words): the words of each bucket of their hash, with their counts, sorted and compressed."""
    flat = words.column("word").combine_chunks()
    bucket = (_hashes(flat) % np.uint64(buckets)).astype(np.int64)
    ordered = words.append_column("bucket", pa.array(bucket)).sort_by([("bucket", "ascending"), ("word", "ascending")]).combine_chunks()
    present, starts = np.unique(ordered.column("bucket").to_numpy(), return_index=True)
    ends, plain = np.append(starts[1:], len(ordered)), ordered.drop_columns(["bucket"])
    blobs = [zstandard.compress(_to_bytes(plain.slice(lo, hi - lo)), 3) for lo, hi in zip(starts.tolist(), ends.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(present), pa.array(blobs, pa.binary())], ["bucket", "words"])


def _to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _sums(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])


def _count_words(sent: Callable[[], Splitter], buckets: int, most: int = 1 << 20):
    """Counts of a task's distinct words, packed by bucket; what a task holds is given out when it has more than `most` words."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, held = sent(), []
        for batch in batches:
            for _, _, words, _ in splitter.spans(batch.column("text")):
                counts = words.value_counts()
                held.append(pa.table({"word": counts.field("values"), "n": counts.field("counts")}))
                if sum(map(len, held)) > 2 * most:
                    held = [_sums(held)]
                    if len(held[0]) > most:
                        yield _packed(held.pop(), buckets)
        if sum(map(len, held)):
            yield _packed(_sums(held), buckets)

    return run


def _encode_counted(sent: Callable[[], ByteBpe], most: int = 1 << 20):
    """(word, n, ids) of the buckets that a task has: their words counted together and each encoded once."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, held = sent(), []
        for batch in batches:
            for blob in batch.column("words").to_pylist():
                held.append(pa.ipc.open_stream(zstandard.decompress(blob)).read_all())
                if sum(map(len, held)) > 2 * most:
                    held = [_sums(held)]
        if held:
            for part in _sums(held).to_batches(1 << 16):
                ids = [np.array([v.added[w]] if w in v.added else merge_word(w.encode(), v), v.width).tobytes() for w in part.column("word").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("word").cast(pa.string()), part.column("n"), pa.array(ids, pa.binary())], ["word", "n", "ids"])

    return run


def word_table(docs: DataFrame, v: ByteBpe) -> DataFrame:
    """(word, n, ids): every distinct word of the texts, how often it occurs, its ids; written to the shared folder.

    Tasks count their words and send them packed by bucket; there are as many
    buckets as shuffle partitions, so that what meets in a task is its share of
    the distinct words.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = ship(spark, Splitter(character_classes(), [t.encode() for t in v.added]))
    packed = docs.select(_text().alias("text")).mapInArrow(_count_words(sent, buckets), "bucket long, words binary")
    return materialize(packed.repartition(buckets, "bucket").mapInArrow(_encode_counted(ship(spark, v)), "word string, n long, ids binary"), "words")


def _text() -> Column:
    return F.make_valid_utf8(F.coalesce(F.col("text").cast("string"), F.lit("")))


@dataclass(frozen=True)
class Head:
    """The most frequent words in the order of their hashes; rank: their places by frequency, from 1; starts, sizes: of their ids, by rank (0: no word)."""

    hashes: np.ndarray
    words: pa.Array
    rank: np.ndarray
    ids: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    def find(self, words: pa.Array) -> np.ndarray:
        """Each word's rank in the head, or 0: by hash, then by the word itself."""
        if not len(self.words) or not len(words):
            return np.zeros(len(words), np.int64)
        coded = words.dictionary_encode()
        near = np.minimum(np.searchsorted(self.hashes, hashes := _hashes(coded.dictionary)), len(self.hashes) - 1)
        same = (self.hashes[near] == hashes) & np.asarray(pc.equal(self.words.take(pa.array(near)), coded.dictionary))
        return np.where(same, self.rank[near], 0)[coded.indices.to_numpy(zero_copy_only=False)]


def _hashes(words: pa.Array) -> np.ndarray:
    raw, offsets, _ = utf8_view(words)
    rolling = Rolling()
    return rolling.between(rolling.prefix(raw[offsets[0] : offsets[-1]]), offsets[:-1] - offsets[0], offsets[1:] - offsets[0])


def _head(table: DataFrame, most: int, longest: int, width: type) -> tuple[Head, Column]:
    """The head of `most` words of at most `longest` bytes each, and the condition of the rows beyond it."""
    long = F.octet_length("word") > longest
    top = table.where(~long).orderBy(F.desc("n"), "word").limit(most).toArrow().combine_chunks()
    if not top.num_rows:
        nothing = np.zeros(0, np.int64)
        return Head(nothing.astype(np.uint64), pa.array([], pa.large_string()), nothing, nothing.astype(width), np.zeros(1, np.int64), np.zeros(1, np.int64)), long if most else F.lit(True)
    last = top.slice(top.num_rows - 1).to_pylist()[0]
    words = top.column("word").combine_chunks().cast(pa.large_string())
    hashes = _hashes(words)
    order = np.argsort(hashes, kind="stable")
    again = np.concatenate([[False], hashes[order][1:] == hashes[order][:-1]])
    left_out, order = words.take(pa.array(order[again])).to_pylist(), order[~again]  # of words with one hash only the first is in the head
    raw, offsets, _ = utf8_view(top.column("ids").combine_chunks())
    sizes = np.concatenate([[0], np.diff(offsets) // np.dtype(width).itemsize])
    head = Head(hashes[order], words.take(pa.array(order)), order + 1, raw[offsets[0] : offsets[-1]].view(width).copy(), np.cumsum(sizes) - sizes, sizes)
    beyond = F.lit(False) if top.num_rows < most else (F.col("n") < last["n"]) | ((F.col("n") == last["n"]) & (F.col("word") > F.lit(last["word"])))
    return head, long | beyond | (F.col("word").isin(left_out) if left_out else F.lit(False))


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def to_bytes(numbers: np.ndarray) -> bytes:
    """Numbers below 2**21 in one to three bytes of seven bits each; the last byte has its high bit clear."""
    n = 1 + (numbers >= 1 << 7) + (numbers >= 1 << 14)
    out, at = np.zeros(int(n.sum()), np.uint8), np.cumsum(n) - n
    for i in range(3):
        here = n > i
        out[at[here] + i] = (numbers[here] >> (7 * i)) & 127 | np.where(n[here] > i + 1, 128, 0)
    return out.tobytes()


def from_bytes(data: bytes) -> np.ndarray:
    """The numbers that to_bytes() has written."""
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    out = np.zeros(len(ends), np.int64)
    for i in range(3):
        here = starts + i <= ends
        out[here] |= (raw[starts[here] + i].astype(np.int64) & 127) << (7 * i)
    return out


def _blocks(splitter: Splitter, head: Head, batch: pa.RecordBatch) -> Iterator[tuple[int, int, tuple[int, int], pa.Array, np.ndarray, np.ndarray]]:
    """Runs of rows: first and end row, key (128 bits of the texts' hash), words, their ranks in the head, each text's first word and the end."""
    for lo, hi, words, offsets in splitter.spans(batch.column("text")):
        raw, _, _ = utf8_view(words)
        digest = hashlib.blake2b(raw, digest_size=16)
        digest.update(offsets.tobytes())
        yield lo, hi, struct.unpack("<qq", digest.digest()), words, head.find(words), offsets


def _find_gaps(splitter: Callable[[], Splitter], sent: Callable[[], Head]):
    """A row (key_a, key_b, place, word) for every word beyond the head; place: which word of the block."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, head = splitter(), sent()
        for batch in batches:
            for _, _, (a, b), words, ranks, _ in _blocks(split, head, batch):
                gap = np.flatnonzero(ranks == 0)
                keys = [pa.array(np.full(len(gap), k)) for k in (a, b)]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(gap.astype(np.int32)), words.take(pa.array(gap)).cast(pa.string())], ["key_a", "key_b", "place", "word"])

    return run


def _rank_words(splitter: Callable[[], Splitter], sent: Callable[[], Head]):
    """A row for each block: its rows, its words' ranks in the head (packed; 0 for a gap) and each text's first word (first).

    A block without gaps gets a key of its own, so that it is not sent where equal blocks are.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        split, head, number = splitter(), sent(), TaskContext.get().partitionId() << 40
        pack = zstandard.ZstdCompressor(6).compress
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        for batch in batches:
            for lo, hi, (a, b), _, ranks, offsets in _blocks(split, head, batch):
                number += 1
                keys = (a, b) if (ranks == 0).any() else (number, -1)
                columns = [one(batch.column("row").slice(lo, hi - lo)), *(pa.array([k], pa.int64()) for k in keys), pa.array([pack(to_bytes(ranks))], pa.binary()), one(pa.array(offsets.astype(np.int32)))]
                yield pa.RecordBatch.from_arrays(columns, ["rows", "key_a", "key_b", "ranks", "first"])

    return run


def _place_ids(sent: Callable[[], Head], width: type):
    """Puts ids in the place of words: those of the head by rank, the others from the block's fills (place, ids); gives the block's rows with their own."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, head = zstandard.ZstdDecompressor().decompress, sent()
        for batch in batches:
            for i in range(batch.num_rows):
                rows, first, fills = (batch.column(c)[i].values for c in ("rows", "first", "fills"))
                ranks = from_bytes(unpack(batch.column("ranks")[i].as_py()))
                gaps = np.flatnonzero(ranks == 0)
                if not np.array_equal(gaps, fills.field("place").to_numpy(zero_copy_only=False)):
                    raise ValueError(f"{len(gaps)} words of a block are not in the head, of which {len(fills)} came from the table of words")
                starts, sizes, pool = head.starts[ranks], head.sizes[ranks], head.ids
                if len(gaps):
                    raw, offsets, _ = utf8_view(fills.field("ids"))
                    own = (offsets - offsets[0]) // np.dtype(width).itemsize
                    starts[gaps], sizes[gaps] = len(pool) + own[:-1], np.diff(own)
                    pool = np.concatenate([pool, raw[offsets[0] : offsets[-1]].view(width)])
                ends = np.concatenate([[0], np.cumsum(sizes)])[first.to_numpy()]
                tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pool[_ragged(starts, sizes)].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([rows, tokens], ["row", "tokens"])

    return run


def encode_texts(docs: DataFrame, path: str = DEFAULT_VOCABULARY, head_words: int = 1 << 19, head_bytes: int = 64) -> DataFrame:
    """docs with `tokens` (array<int>) in place of `text`, which decode_tokens() gives back.

    head_words words of at most head_bytes bytes each are sent to all tasks; the
    others meet their ids in a shuffled join, from which they come back to their
    place in the block of texts that they stand in. A column of docs called
    `tokens` is replaced; bytes of a text that are no UTF-8 count as U+FFFD.
    """
    if head_words >= 1 << 21:
        raise ValueError("the head holds less than 2**21 words")
    v = load_vocabulary(path)
    spark = docs.sparkSession
    table = word_table(docs, v)
    head, beyond = _head(table, head_words, head_bytes, v.width)
    splitter, sent = ship(spark, Splitter(character_classes(), [t.encode() for t in v.added])), ship(spark, head)
    kept = [c for c in docs.columns if c not in ("text", "tokens")]
    row = F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in kept)) if kept else F.struct(F.lit(0).alias("_none"))
    rows = docs.select(row.alias("row"), _text().alias("text"))  # both passes read the same columns, so that their blocks are the same
    gaps = rows.mapInArrow(_find_gaps(splitter, sent), "key_a long, key_b long, place int, word string")
    found = gaps.join(table.where(beyond).select("word", "ids"), "word")
    # a set, since equal blocks give equal rows; a block's own words beyond the head
    fills = found.groupBy("key_a", "key_b").agg(F.array_sort(F.collect_set(F.struct("place", "ids"))).alias("fills"))
    kind = StructType().add("rows", ArrayType(rows.schema["row"].dataType)).add("key_a", "long").add("key_b", "long").add("ranks", "binary").add("first", ArrayType(IntegerType()))
    blocks = rows.mapInArrow(_rank_words(splitter, sent), kind)
    empty = F.array().cast("array<struct<place:int,ids:binary>>")
    whole = blocks.join(fills, ["key_a", "key_b"], "left").select("rows", "ranks", "first", F.coalesce("fills", empty).alias("fills"))
    out = whole.mapInArrow(_place_ids(sent, v.width), rows.select("row").schema.add("tokens", ArrayType(IntegerType())))
    return out.select("row.*", "tokens") if kept else out.select("tokens")


def decode_tokens(encoded: DataFrame, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Adds `decoded`: the pieces of tokens' ids, looked up in the table of pieces and put together; bytes that are no UTF-8 become U+FFFD, as do unknown ids."""
    pieces = load_vocabulary(path).pieces
    sent = ship(encoded.sparkSession, pieces)

    @F.arrow_udf("string")
    def decode(tokens: pa.Array) -> pa.Array:
        table = np.array([*sent(), "�".encode()], dtype=object)
        offsets = np.asarray(tokens.offsets)
        ids = tokens.values.to_numpy(zero_copy_only=False).astype(np.int64)
        ids = np.where((ids < 0) | (ids >= len(table) - 1), len(table) - 1, ids)
        return pa.array([b"".join(table[ids[a:b]]).decode("utf-8", "replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.string())

    return encoded.withColumn("decoded", decode(F.coalesce("tokens", F.array().cast("array<int>"))))


def digest_tokens(decoded: DataFrame) -> DataFrame:
    """doc_id, the number of tokens, and sha256 of the ids (decimal, joined by commas) and of the decoded text."""
    return decoded.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("tokens").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
