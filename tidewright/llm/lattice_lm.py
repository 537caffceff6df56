"""Language-model scores from a subword lattice.

An existing vocabulary's pieces span a lattice over each word; the scores of the
vocabulary give the first weights (a score is minus a rank; a piece weighs
1 / (10 + rank)), which expectation maximisation over the counts of all training
words turns into a unigram distribution over pieces and the end of a text. A
word's probability is the sum over all its segmentations, by forward recursion in
log space; a text's is the product over its words and its end. A word begins
with the vocabulary's space, so no piece crosses words; every byte is a piece, so
every word has a segmentation.

Every distinct word passes through the lattice once, in a table of words with
their counts. That table can outgrow any machine. Words that are frequent, a
bounded number of them, are sent to all executors with count and weight; the
others meet theirs in a shuffled join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import Rolling, materialize, ship, spans_of, tidy
from tidewright.llm.subword import DEFAULT_MODEL, Vocabulary, load_vocabulary

LOG10_E = math.log10(math.e)
#: Longer words are summed a run of so many bytes at a time, so that memory does not grow with a word.
LONG_WORD = 1 << 16


def tokens_of(text: bytes) -> list[bytes]:
    return text.lower().split()


class Lattice:
    """All segmentations of words (a space and their bytes) into pieces."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.rolling = Rolling(5)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by_length: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            by_length.setdefault(len(piece), []).append(i)
        for length, ids in sorted(by_length.items()):
            data = np.frombuffer(b"".join(pieces[i] for i in ids), np.uint8)
            starts = np.arange(len(ids)) * length
            hashes = self.rolling.between(self.rolling.prefix(data), starts, starts + length)
            order = np.argsort(hashes)
            self.tables[length] = hashes[order], np.array(ids, np.int64)[order]

    def edges(self, words: list[bytes], lead: bytes = b" ") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece, place of the start in its word, first node of each word). A word of n bytes has n + 2 nodes."""
        data = np.frombuffer(b"".join(lead + w + b"\0" for w in words), np.uint8)  # the last byte stands for the last node
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        first = np.concatenate([[0], np.cumsum(sizes)])
        place = np.arange(len(data)) - np.repeat(first[:-1], sizes)
        left = np.repeat(sizes, sizes) - 1 - place
        prefix = self.rolling.prefix(data)
        starts, ends, ids = [], [], []
        for length, (table, piece) in self.tables.items():
            at = np.flatnonzero(left >= length)
            if not len(at):
                break
            h = self.rolling.between(prefix, at, at + length)
            found = np.minimum(np.searchsorted(table, h), len(table) - 1)
            hit = table[found] == h
            starts.append(at[hit])
            ends.append(at[hit] + length)
            ids.append(piece[found[hit]])
        start, end, piece = np.concatenate(starts), np.concatenate(ends), np.concatenate(ids)
        return start, end, piece, place, first

    @staticmethod
    def _sum(into: np.ndarray, target: np.ndarray, other: np.ndarray, weight: np.ndarray, step: np.ndarray) -> None:
        """into[target] = log of the sum of exp(into[other] + weight), in order of step."""
        order = np.lexsort((target, step))
        target, other, weight, step = target[order], other[order], weight[order], step[order]
        new = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
        bounds = np.flatnonzero(np.concatenate([[True], step[1:] != step[:-1], [True]]))
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            groups = new[np.searchsorted(new, lo) : np.searchsorted(new, hi)]
            into[target[groups]] = np.logaddexp.reduceat(into[other[lo:hi]] + weight[lo:hi], groups - lo)

    def forward(self, words: list[bytes], *logps: np.ndarray) -> list[np.ndarray]:
        """Natural log of each word's probability, under each of logps."""
        out = [np.zeros(len(words)) for _ in logps]
        short = [i for i, w in enumerate(words) if len(w) <= LONG_WORD]
        if short:
            start, end, piece, place, first = self.edges([words[i] for i in short])
            for x, logp in zip(out, logps, strict=True):
                alpha = np.zeros(first[-1])
                self._sum(alpha, end, start, logp[piece], place[end])
                x[short] = alpha[first[1:] - 1]
        for i, word in enumerate(words):
            if len(word) > LONG_WORD:
                for x, logp in zip(out, logps, strict=True):
                    x[i] = self._forward_long(word, logp)
        return out

    def _forward_long(self, word: bytes, logp: np.ndarray, block: int = LONG_WORD) -> float:
        """forward() of one word by runs of its nodes; only the last nodes of a run are carried on."""
        reach = max(self.tables)
        s = b" " + word
        tail = np.zeros(1)  # of the nodes just before and at the run's start
        for at in range(0, len(s), block):
            back = len(tail) - 1
            part = s[at - back : at + block]
            start, end, piece, _, _ = self.edges([part[1:]], part[:1])
            new = end > back
            start, end, piece = start[new], end[new], piece[new]
            alpha = np.zeros(len(part) + 1)
            alpha[: back + 1] = tail
            self._sum(alpha, end, start, logp[piece], end)
            tail = alpha[-min(reach, len(alpha)) :]
        return float(tail[-1])

    def expected(self, words: list[bytes], counts: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words, which occur counts times."""
        start, end, piece, place, first = self.edges(words)
        alpha, beta = np.zeros(first[-1]), np.zeros(first[-1])
        w = logp[piece]
        self._sum(alpha, end, start, w, place[end])
        self._sum(beta, start, end, w, -place[start])
        word = np.searchsorted(first, start, side="right") - 1
        share = np.exp(alpha[start] + w + beta[end] - alpha[first[word + 1] - 1])
        return np.bincount(piece, share * counts[word], len(logp))


def usable_pieces(vocabulary: Vocabulary) -> tuple[list[bytes], np.ndarray]:
    """Pieces that may stand in a word (a space at most in front) and all single bytes, with their first weights."""
    best: dict[bytes, float] = {bytes([b]): 1 / (10 + len(vocabulary.rank)) for b in range(256)}
    for text, (rank, _) in vocabulary.rank.items():
        piece = text.encode().lower()
        if b" " not in piece[1:] and piece == text.encode():
            best[piece] = max(best.get(piece, 0.0), 1 / (10 + rank))
    pieces = sorted(best)
    return pieces, np.array([best[p] for p in pieces])


def count_words(docs: DataFrame, entries: int = 300_000) -> DataFrame:
    """(word, n) of the words of docs (text binary, learns boolean): how often each stands in texts that are learned from.

    Words of the other texts only have n 0. Each task sums up what it can hold before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text, learns in zip(batch.column("text"), batch.column("learns").to_pylist(), strict=True):
                words = tokens_of(text.as_py() or b"")
                if learns:
                    seen.update(words)
                else:
                    for w in words:
                        seen[w] += 0
                if len(seen) > entries:
                    yield _counts(seen)
                    seen.clear()
        yield _counts(seen)

    return docs.select("text", "learns").mapInArrow(tidy(run), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counts(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])


def _by_length(words: list[bytes]) -> Iterator[list[int]]:
    """Places of words, shortest first, in runs that pass through the lattice at once."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for lo, hi in spans_of(np.array([len(words[i]) + 2 for i in order]), 200_000):
        yield order[lo:hi]


def fit(counts: DataFrame, n_texts: int, vocabulary: Vocabulary, rounds: int = 2, smoothing: float = 0.05) -> tuple[list[bytes], list[tuple[np.ndarray, float]]]:
    """(pieces, [(natural log of their probabilities, that of the end)]): the vocabulary's own weights, then the fitted ones.

    counts are words of learning texts. One number a piece and task reaches the driver.
    """
    spark = counts.sparkSession
    pieces, weight = usable_pieces(vocabulary)
    total = weight.sum()
    logp, end = np.log(weight / total * 0.99), math.log(0.01)
    own = logp, end
    for _ in range(rounds):
        shared = ship(spark, (pieces, logp))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, now = shared()
            lattice, sums = Lattice(names), np.zeros(len(names))
            for batch in batches:
                words, n = batch.column("word").to_pylist(), batch.column("n").to_pylist()
                # a very long word counts by runs, which bounds memory
                runs = [(w[i : i + LONG_WORD], k) for w, k in zip(words, n, strict=True) for i in range(0, len(w), LONG_WORD)]
                words, n = [w for w, _ in runs], np.array([k for _, k in runs], float)
                for some in _by_length(words):
                    sums += lattice.expected([words[i] for i in some], n[some], now)
            some = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(sums[some])], ["piece", "n"])

        got = counts.mapInArrow(tidy(run), "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        expected = np.full(len(pieces), smoothing)
        for r in got:
            expected[r["piece"]] += r["n"]
        total = expected.sum() + n_texts + smoothing
        logp, end = np.log(expected / total), math.log((n_texts + smoothing) / total)
    return pieces, [own, (logp, end)]


def weigh_words(words: DataFrame, pieces: list[bytes], logps: list[np.ndarray]) -> DataFrame:
    """words with own and fitted: log10 of each word's probability under the two weights."""
    shared = ship(words.sparkSession, (pieces, logps))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, now = shared()
        lattice = Lattice(names)
        for batch in batches:
            words = batch.column("word").to_pylist()
            out = np.zeros((2, len(words)))
            for some in _by_length(words):
                out[:, some] = lattice.forward([words[i] for i in some], *now)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), *(pa.array(x * LOG10_E) for x in out)], ["word", "n", "own", "fitted"])

    return words.mapInArrow(tidy(run), "word binary, n long, own double, fitted double")


def score_texts(docs: DataFrame, learns: Column, model_path: str = DEFAULT_MODEL, head_words: int = 100_000, rounds: int = 2) -> DataFrame:
    """n_tokens, n_known, train_tokens, base_score, score and vocabulary_score of every row's whole text, after docs' other columns but the text.

    The rows for which learns holds are learned from. Tokens are lower-cased
    (A-Z) words and one end; a null text is empty and has just the end.
    base_score is the additive-smoothing baseline over words, score the log10 of
    the lattice model's probability, vocabulary_score the same under the
    vocabulary's own weights, without what was learned. If nothing is learned
    from, no token is known and score is vocabulary_score. Repeated rows
    give repeated results; an empty table gives an empty result. A column of
    docs that has the name of a result gives way to it.
    """
    spark = docs.sparkSession
    results = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "vocabulary_score")
    rest = [c for c in docs.columns if c not in ("text", *results)]
    given = docs.select(F.struct(F.lit(0).alias("_"), *(docs[c] for c in rest)).alias("rest"), F.col("text").cast("string").cast("binary").alias("text"), F.coalesce(learns, F.lit(False)).alias("learns"))
    counts = materialize(count_words(given), "counts")
    n_texts = given.where("learns").count()
    n_words, kinds = counts.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_all, v = n_words + n_texts, kinds + (n_texts > 0)
    z = n_all + 0.1 * (v + 1)
    pieces, weights = fit(counts.where("n > 0"), n_texts, load_vocabulary(model_path), rounds)
    ends = [end * LOG10_E for _, end in (weights if n_all else [weights[0]] * 2)]
    words = materialize(weigh_words(counts, pieces, [logp for logp, _ in (weights if n_all else [weights[0]] * 2)]), "words")
    # the least count at which at most head_words words are left
    tally = words.groupBy(F.least(F.col("n"), F.lit(5000)).alias("n")).agg(F.count("*").alias("kinds")).collect()
    least, held = 5001, 0
    for r in sorted(tally, key=lambda r: -r["n"]):
        held += r["kinds"]
        if held > head_words:
            break
        least = r["n"]
    # head_words rows at most
    head = {bytes(r["word"]): (math.log10((r["n"] + 0.1) / z), r["n"] > 0, r["own"], r["fitted"]) for r in words.where(F.col("n") >= least).collect()}
    shared = ship(spark, head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared()
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in spans_of(np.array([len(t) if t else 0 for t in texts.to_pylist()]), 1 << 20):
                columns: list[list] = [[] for _ in range(7)]
                for text in texts.slice(lo, hi - lo):
                    found = Counter(tokens_of(text.as_py() or b""))
                    known, base, own, fitted, tail, tail_n = 0, 0.0, 0.0, 0.0, [], []
                    for w, n in found.items():
                        facts = frequent.get(w)
                        if facts is None:
                            tail.append(w)
                            tail_n.append(n)
                        else:
                            base += n * facts[0]
                            known += n * facts[1]
                            own += n * facts[2]
                            fitted += n * facts[3]
                    for column, value in zip(columns, (sum(found.values()) + 1, known, base, own, fitted, tail, tail_n), strict=True):
                        column.append(value)
                kinds_ = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(lo, hi - lo) for c in ("row", "rest")] + [pa.array(c, k) for c, k in zip(columns, kinds_, strict=True)], ["row", "rest", "tokens", "known", "base", "own", "fitted", "tail", "tail_n"])

    rows = given.select(F.monotonically_increasing_id().alias("row"), "rest", "text")
    spec = f"row long, rest {rows.schema['rest'].dataType.simpleString()}, tokens long, known long, base double, own double, fitted double, tail array<binary>, tail_n array<long>"
    scored = materialize(rows.mapInArrow(tidy(run), spec), "scored")
    tail = scored.select("row", F.explode(F.arrays_zip("tail", "tail_n")).alias("t")).select("row", F.col("t.tail").alias("word"), F.col("t.tail_n").alias("k"))
    k = F.col("k")
    sums = (F.sum(k * F.log10((F.col("n") + 0.1) / z)).alias("_b"), F.sum(F.when(F.col("n") > 0, k).otherwise(0)).alias("_k"), F.sum(k * F.col("own")).alias("_o"), F.sum(k * F.col("fitted")).alias("_f"))
    tail = tail.join(words.where(F.col("n") < least), "word").groupBy(F.col("row").alias("_r")).agg(*sums)
    out = scored.drop("tail", "tail_n").join(tail, F.col("row") == F.col("_r"), "left")
    zero = F.lit(0.0)
    return out.select(
        *(F.col(f"rest.`{c}`") for c in rest),
        F.col("tokens").alias("n_tokens"),
        (F.col("known") + F.coalesce("_k", F.lit(0)) + int(n_texts > 0)).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_b", zero) + math.log10((n_texts + 0.1) / z)).alias("base_score"),
        (F.col("fitted") + F.coalesce("_f", zero) + ends[1]).alias("score"),
        (F.col("own") + F.coalesce("_o", zero) + ends[0]).alias("vocabulary_score"),
    )
