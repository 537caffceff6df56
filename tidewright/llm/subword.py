"""Merge-type subword encoding with seeded merge dropout, and its lossless decoding.

The vocabulary (pieces with scores, byte pieces for everything else) is an
existing one. Symbols are merged best score first, leftmost first among equals,
from an agenda of candidates. A candidate that comes up is skipped if a keyed
hash of the seed, the occurrence (text and number of the unit in it), the place
and the piece falls below the dropout rate; a skipped pair may still be merged
after a neighbour has changed. The hash makes a run repeatable; every occurrence
of a word is drawn on its own. Kept from one occurrence to the next is only how
a word merges without dropout: where no step of that is skipped, its ids hold.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import mix64, ship, spans_of, tidy, utf8_view

#: The vocabulary's mark for a space; in texts of its own it is spelt with byte pieces, so that decoding is exact.
MARK = "▁"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_UNIT = re.compile(r" *[^ ]+| +")
_MASK = (1 << 64) - 1
_BY_NUMBER, _BY_PLACE, _BY_PIECE, _FINAL = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93
NEVER, AT_ONCE, BLOCK = 1 << 30, 4096, 1 << 18


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each pair, count of them."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


@dataclass(frozen=True)
class Vocabulary:
    """rank: piece text (space for the mark) to (order of merging, id); data: each id's bytes; bytes_at: id of byte 0."""

    rank: dict[str, tuple[int, int]]
    data: list[bytes]
    bytes_at: int


def load_vocabulary(path: str = DEFAULT_MODEL) -> Vocabulary:
    """Read a merge vocabulary with byte pieces; raises ValueError if it has none."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.vocab_size()
    plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    bytes_at = next((i for i in range(size) if model.is_byte(i)), None)
    if bytes_at is None:
        raise ValueError(f"{path} has no byte pieces")
    order = sorted(plain, key=lambda i: (-model.get_score(i), i))
    position, last = {}, None
    for n, i in enumerate(order):  # equal scores merge from left to right
        last = n if last is None or model.get_score(i) != model.get_score(order[n - 1]) else last
        position[i] = last
    data = [b""] * size
    rank = {}
    for i in plain:
        piece = model.id_to_piece(i).replace(MARK, " ")
        rank[piece] = (position[i], i)
        data[i] = piece.encode()
    for b in range(256):
        data[bytes_at + b] = bytes([b])
    return Vocabulary(rank, data, bytes_at)


class Encoder:
    """Encodes texts; units of up to `remember` characters are kept with their merges without dropout, a bounded number of them."""

    def __init__(self, vocabulary: Vocabulary, dropout: float = 0.1, seed: int = 0, remember: int = 64, entries: int = 100_000) -> None:
        self.v = vocabulary
        self.limit = int(dropout * 2**32)
        self.seed = np.uint64(int.from_bytes(hashlib.blake2b(str(seed).encode(), digest_size=8).digest(), "little"))
        self.remember, self.entries = remember, entries
        self._forget()
        self.size = len(vocabulary.data)
        self.symbol = -3 - np.arange(0x110000, dtype=np.int32)  # ids of single characters; -3 - code of those that no piece has, -1 of those only in longer pieces
        self.symbol[[ord(c) for c in set().union(*vocabulary.rank)]] = -1
        splits = []
        for piece, (order, i) in vocabulary.rank.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
            for cut in range(1, len(piece)):
                a, b = vocabulary.rank.get(piece[:cut]), vocabulary.rank.get(piece[cut:])
                if a and b:
                    splits.append((a[1] * self.size + b[1], order, i))
        table = np.array(sorted(splits), np.int64).reshape(-1, 3)
        self.pair, self.pair_order, self.pair_id = table[:, 0].copy(), table[:, 1].astype(np.int32), table[:, 2].astype(np.int32)

    def _forget(self) -> None:
        """row: unit to its number; by number: whether _merge_rows can merge it, how many steps and ids it has, and where they start."""
        self.row: dict[str, int] = {}
        self.whole, self.n_steps, self.n_ids = np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.steps_at, self.ids_at = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.steps, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def _keys(self, occurrences) -> np.ndarray:
        return mix64(np.atleast_1d(np.asarray(occurrences, np.uint64)) ^ self.seed)

    def _skipped(self, key: np.ndarray, step: np.ndarray) -> np.ndarray:
        h = key + step
        h = (h ^ (h >> np.uint64(31))) * np.uint64(_FINAL)
        return (h >> np.uint64(32)) < np.uint64(self.limit)

    @staticmethod
    def _step(place: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return place.astype(np.uint64) * np.uint64(_BY_PLACE) + ids.astype(np.uint64) * np.uint64(_BY_PIECE)

    def _candidates(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, key: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(order or NEVER, id) of the pieces that pairs of symbols would make, without those that the dropout skips."""
        wanted = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair, wanted), len(self.pair) - 1)
        ids = self.pair_id[at]
        ok = (self.pair[at] == wanted) & (left >= 0) & (right >= 0)
        if key is not None:
            ok &= ~self._skipped(key, self._step(place, ids))
        return np.where(ok, self.pair_order[at], NEVER), ids

    def merge_many(self, units: list[str], occurrence) -> list[tuple[int, ...]]:
        """merge() of many short units at once; occurrence is one number for all or one each."""
        key = np.broadcast_to(self._keys(occurrence), len(units)) if self.limit else None
        flat, counts, whole, _ = self._merge_rows(units, key)
        flat, ends = flat.tolist(), np.cumsum(counts).tolist()
        return [tuple(flat[hi - n : hi]) if ok else self._merge(x, None if key is None else int(key[i])) for i, (x, n, hi, ok) in enumerate(zip(units, counts.tolist(), ends, whole.tolist(), strict=True))]

    def _merge_rows(self, units: list[str], key: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """Ids of all units, how many each has, which of them could be merged here (the others' ids are void), and the steps made.

        Each round makes the best merge of every unit; a step is (unit number, place, id). Without a key nothing is skipped.
        """
        n = np.array([len(u) for u in units])
        u, width = len(units), int(n.max())
        inside = np.arange(width) < n[:, None]
        sym = np.full((u, width + 1), -1, np.int32)
        sym[:, :width][inside] = self.symbol[np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)]
        known = (sym[:, :width] != -1) | ~inside
        nxt = np.broadcast_to(np.arange(1, width + 2, dtype=np.int32), sym.shape).copy()
        prv = np.broadcast_to(np.arange(-1, width, dtype=np.int32), sym.shape).copy()
        order = np.full((u, width), NEVER, np.int32)
        made = np.zeros((u, width), np.int32)
        order[:, :], made[:, :] = self._candidates(sym[:, :-1], sym[:, 1:], np.broadcast_to(np.arange(width), (u, width)), None if key is None else key[:, None])
        rows, steps = np.arange(u), []
        while len(rows):
            i = order[rows].argmin(1)
            going = order[rows, i] < NEVER
            rows, i = rows[going], i[going]
            if key is None:
                steps.append((rows, i, made[rows, i]))
            j = nxt[rows, i]
            sym[rows, i], sym[rows, j] = made[rows, i], -2
            order[rows, j] = NEVER
            k = nxt[rows, j]
            nxt[rows, i] = k
            prv[rows, np.minimum(k, width)] = i
            order[rows, i], made[rows, i] = self._candidates(sym[rows, i], sym[rows, np.minimum(k, width)], i, None if key is None else key[rows])
            before = prv[rows, i]
            some = before >= 0
            r, b = rows[some], before[some]
            order[r, b], made[r, b] = self._candidates(sym[r, b], sym[r, i[some]], b, None if key is None else key[r])
        alive = inside & (sym[:, :width] != -2)
        flat, counts = sym[:, :width][alive], alive.sum(1)
        if (flat < -2).any():  # spelt in bytes
            code = np.where(flat < -2, -3 - flat, 0)
            sizes = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
            owner = np.repeat(np.repeat(np.arange(u), counts), sizes)
            spelt = code[flat < -2].astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass").replace("\ud800", MARK).encode()
            flat = np.repeat(flat, sizes)
            flat[flat < -2] = np.frombuffer(spelt, np.uint8).astype(np.int32) + self.v.bytes_at
            counts = np.bincount(owner, minlength=u)
        return flat, counts, known.all(1), steps

    def merge(self, unit: str, occurrence: int) -> tuple[int, ...]:
        """Ids of one unit: some spaces and the characters up to the next space."""
        return self._merge(unit, int(self._keys(occurrence)[0]) if self.limit else None)

    def _merge(self, unit: str, key: int | None, steps: list[tuple[int, int]] | None = None) -> tuple[int, ...]:
        """merge() under a key, or without dropout; the places and ids of the merges made are added to steps."""
        rank, limit = self.v.rank, self.limit
        sym: list[str | None] = list(unit)
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(*r, i, p) for i, p in enumerate(map(str.__add__, unit, unit[1:])) if (r := rank.get(p))]
        heapify(agenda)
        while agenda:
            _, piece_id, i, piece = heappop(agenda)
            left = sym[i]
            if left is None or (j := nxt[i]) >= n or len(left) + len(sym[j]) != len(piece) or left + sym[j] != piece:
                continue
            if key is not None:
                h = (key + i * _BY_PLACE + piece_id * _BY_PIECE) & _MASK
                h = (h ^ h >> 31) * _FINAL & _MASK
                if h >> 32 < limit:
                    continue
            if steps is not None:
                steps.append((i, piece_id))
            sym[i], sym[j] = piece, None
            k = nxt[i] = nxt[j]
            if k < n:
                prv[k] = i
                if r := rank.get(p := piece + sym[k]):
                    heappush(agenda, (*r, i, p))
            if (k := prv[i]) >= 0 and (r := rank.get(p := sym[k] + piece)):
                heappush(agenda, (*r, k, p))
        out: list[int] = []
        for s in sym:
            if s is not None:
                if r := rank.get(s):
                    out.append(r[1])
                else:
                    out.extend(self.v.bytes_at + b for b in (MARK if s == "\ud800" else s).encode())
        return tuple(out)

    def encode_many(self, texts: list[str], block: int = BLOCK) -> list[list[int]]:
        """Ids of whole texts, a block of about so many characters at a time; an empty one has none."""
        out, part, size = [], [], 0
        for t in texts:
            if part and size + len(t) > block:
                out += self._encode_block(part)
                part, size = [], 0
            part.append(t)
            size += len(t)
        return out + self._encode_block(part)

    def _encode_block(self, texts: list[str]) -> list[list[int]]:
        """The occurrence of the k-th unit of a text is the text's hash plus a multiple of k."""
        lists = [_UNIT.findall(" " + t.replace(MARK, "\ud800")) if t else [] for t in texts]
        units = list(chain.from_iterable(lists))
        if len(self.row) > self.entries:
            self._forget()
        self._learn(sorted((u for u in set(units).difference(self.row) if len(u) <= self.remember), key=len))
        at = np.fromiter(map(self.row.get, units, repeat(-1)), np.int64, len(units))
        ends = np.cumsum([len(x) for x in lists], dtype=np.int64)
        again, key = at < 0, None
        if self.limit:
            n = np.diff(ends, prepend=0)
            hashes = np.array([int.from_bytes(hashlib.blake2b(t.encode(), digest_size=8).digest(), "little") for t in texts], np.uint64)
            key = self._keys(np.repeat(hashes, n) + _ragged(np.zeros(len(n), np.int64), n).astype(np.uint64) * np.uint64(_BY_NUMBER))
            known = np.flatnonzero(~again)
            n = self.n_steps[at[known]]
            owner = np.repeat(known, n)
            again[owner[self._skipped(key[owner], self.steps[_ragged(self.steps_at[at[known]], n)])]] = True
        counts, parts = np.zeros(len(units), np.int64), []
        kept = np.flatnonzero(~again)
        counts[kept] = self.n_ids[at[kept]]
        parts.append((kept, self.ids[_ragged(self.ids_at[at[kept]], counts[kept])]))
        again = np.flatnonzero(again)
        fast = (at[again] >= 0) & np.append(self.whole, False)[at[again]]
        for i in again[~fast].tolist():
            got = self._merge(units[i], None if key is None else int(key[i]))
            counts[i] = len(got)
            parts.append((np.array([i]), np.array(got, np.int32)))
        again = again[fast]
        again = again[np.argsort(at[again], kind="stable")]  # numbers go up with length among units learnt together
        for lo in range(0, len(again), AT_ONCE):
            mine = again[lo : lo + AT_ONCE]
            flat, counts[mine], _, _ = self._merge_rows([units[i] for i in mine.tolist()], key[mine])
            parts.append((mine, flat))
        starts = np.cumsum(counts) - counts
        ids = np.zeros(counts.sum(), np.int32)
        for which, flat in parts:
            ids[_ragged(starts[which], counts[which])] = flat
        ids, cuts = ids.tolist(), np.append(np.cumsum(counts), 0)[ends - 1].tolist() if len(units) else [0] * len(texts)
        return [ids[lo:hi] if n else [] for lo, hi, n in zip([0, *cuts], cuts, map(len, lists), strict=False)]

    def _learn(self, units: list[str], at_once: int = AT_ONCE) -> None:
        for lo in range(0, len(units), at_once):
            part = units[lo : lo + at_once]
            flat, n_ids, whole, made = self._merge_rows(part, None)
            who, place, piece = (np.concatenate(x) for x in zip(*made, strict=True)) if made else np.zeros((3, 0), np.int64)
            fine = whole[who]
            who, steps, ids = [who[fine]], [self._step(place, piece)[fine]], [flat[np.repeat(whole, n_ids)]]
            owner = [np.repeat(np.arange(len(part)), n_ids)[np.repeat(whole, n_ids)]]
            for i in np.flatnonzero(~whole).tolist():
                path: list[tuple[int, int]] = []
                got = self._merge(part[i], None, path)
                who.append(np.full(len(path), i))
                steps.append(self._step(*np.array(path, np.int64).reshape(-1, 2).T))
                owner.append(np.full(len(got), i))
                ids.append(np.array(got, np.int32))
            who, owner = np.concatenate(who), np.concatenate(owner)
            n_steps, n_ids = np.bincount(who, minlength=len(part)), np.bincount(owner, minlength=len(part))
            self.row.update(zip(part, range(len(self.row), len(self.row) + len(part)), strict=True))
            self.steps_at = np.append(self.steps_at, len(self.steps) + np.cumsum(n_steps) - n_steps)
            self.ids_at = np.append(self.ids_at, len(self.ids) + np.cumsum(n_ids) - n_ids)
            self.n_steps, self.n_ids, self.whole = np.append(self.n_steps, n_steps), np.append(self.n_ids, n_ids), np.append(self.whole, whole)
            self.steps = np.append(self.steps, np.concatenate(steps)[np.argsort(who, kind="stable")])
            self.ids = np.append(self.ids, np.concatenate(ids)[np.argsort(owner, kind="stable")].astype(np.int32))

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[0]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.v.data.__getitem__, ids))[1:]


def encode_texts(docs: DataFrame, model_path: str = DEFAULT_MODEL, dropout: float = 0.1, seed: int = 17) -> DataFrame:
    """doc_id, n_bytes, ids, n_tokens, decoded_sha256 and lossless (decoding gave the text back) for every row.

    A null or empty text has no ids and decodes to nothing. Equal texts get
    equal ids. Repeated rows give repeated results, an empty table an empty
    result; other columns are ignored. The vocabulary is read on the driver and
    sent, so executors need no file of it.
    """
    shared = ship(docs.sparkSession, load_vocabulary(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared(), dropout, seed)
        for batch in batches:
            lengths = np.diff(utf8_view(batch.column("text"))[1])
            for lo, hi in spans_of(lengths, BLOCK):  # by size: ids are Python numbers for a while, many times their text
                part = batch.slice(lo, hi - lo)
                sizes, ids, digests, exact = [], [], [], []
                texts = [t or "" for t in part.column("text").to_pylist()]
                for t, got in zip(texts, encoder.encode_many(texts), strict=True):
                    raw = t.encode()
                    back = encoder.decode(got)
                    sizes.append(len(raw))
                    ids.append(np.array(got, np.int32))
                    digests.append(hashlib.sha256(back).hexdigest())
                    exact.append(back == raw)
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = pa.array(np.concatenate([np.zeros(0, np.int32), *ids]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), flat), pa.array(np.diff(ends).astype(np.int64)), pa.array(digests, pa.string()), pa.array(exact, pa.bool_())], ["doc_id", "n_bytes", "ids", "n_tokens", "decoded_sha256", "lossless"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), f"doc_id {kind}, n_bytes long, ids array<int>, n_tokens long, decoded_sha256 string, lossless boolean")
