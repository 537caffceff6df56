"""Distinct-word BPE, periodic runs and hard negatives against the library, brute force and exact rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewright.llm import hard_negatives, periodic_runs, word_bpe
from tidewright.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"
TOKENIZER = Tokenizer.from_file(word_bpe.DEFAULT_VOCABULARY)
CLASHING = "doc_id long, text string, `a.b` int, tokens string, row string, key_a int, words string, gaps int, runs int, collapsed int"
ODD = [
    None, "", " ", "  \n\t ", "solo", "a  b\r\n c\x1cd\x85e　f", "it's we'll DON'T 's''t end  ", "x" * 30_000, "ünï ☃🫠ࡰ١٢½ " * 300, "ab<|endoftext|>  <|endoftext|>c<|endoftext|><|endoftext|>",
    "  lead​zero﻿", "same text", "same text", "1234567 12.5e-7 a1b2", "\U0001e5d0x\U0001ccf01\U00016d40",
]


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def odd_docs(spark, texts):
    return spark.createDataFrame([(i if i % 5 else None, t, 1, "t", "r", 2, "w", 3, 4, 5) for i, t in enumerate(texts)], CLASHING)


@pytest.mark.parametrize("head_words", [1 << 18, 3, 0])
def test_word_bpe_equals_the_library(spark, head_words):
    draw = random.Random(4)
    alphabet = "ab 'st\n\té漢🙂12.!\xa0"
    texts = ODD + ["".join(draw.choices(alphabet, k=draw.randint(1, 40))) for _ in range(150)]
    encoded = word_bpe.encode_texts(odd_docs(spark, texts), head_words=head_words)
    assert encoded.columns == ["doc_id", "a.b", "row", "key_a", "words", "gaps", "runs", "collapsed", "tokens"]
    got = word_bpe.decode_tokens(encoded).select("doc_id", "tokens", "decoded").collect()
    key = lambda r: (str(r[0]), r[2], r[1])
    want = [(i if i % 5 else None, ids(t), t or "") for i, t in enumerate(texts)]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_word_bpe_of_no_rows_and_of_only_long_words(spark):
    assert word_bpe.decode_tokens(word_bpe.encode_texts(odd_docs(spark, ODD[:1]).limit(0))).count() == 0
    assert word_bpe.decode_tokens(word_bpe.encode_texts(odd_docs(spark, [None]).select("text"))).collect() == [([], "")]
    long = ["y" * 200, "z" * 200]
    got = word_bpe.encode_texts(odd_docs(spark, long), head_bytes=8).collect()
    assert sorted(r["tokens"] for r in got) == sorted(map(ids, long))


def test_each_distinct_word_is_encoded_once(spark):
    v = word_bpe.load_vocabulary()
    rows = word_bpe.word_table(odd_docs(spark, ["the cat the cat", "the dog"]), v).collect()
    assert {r["word"]: r["n"] for r in rows} == {"the": 2, " cat": 2, " the": 1, " dog": 1}
    assert all(np.frombuffer(r["ids"], v.width).tolist() == ids(r["word"]) for r in rows)


def test_merging_a_word_equals_the_library():
    v, draw = word_bpe.load_vocabulary(), random.Random(8)
    words = ["".join(draw.choices("aeinrst", k=draw.randint(1, 60))) for _ in range(300)] + ["a" * n for n in range(1, 40)]
    assert [word_bpe.merge_word(w.encode(), v) for w in words] == list(map(ids, words))


def test_unknown_ids_and_broken_bytes_decode_to_replacement_marks(spark):
    some = spark.createDataFrame([([-1, 10**6, 64],), (None,), ([ids("é")[0] if len(ids("é")) > 1 else 129],)], "tokens array<int>")
    v = word_bpe.load_vocabulary()
    first, none, lone = (r["decoded"] for r in word_bpe.decode_tokens(some).collect())
    assert first == "��" + v.pieces[64].decode() and none == "" and (lone == "�" or len(ids("é")) == 1)


def test_packed_numbers_come_back():
    numbers = np.array([0, 1, 127, 128, 129, 16383, 16384, 2**21 - 1, 0, 5])
    assert word_bpe.from_bytes(word_bpe.to_bytes(numbers)).tolist() == numbers.tolist()
    assert word_bpe.from_bytes(word_bpe.to_bytes(numbers[:0])).tolist() == []


def test_vocabularies_of_another_kind_are_refused(tmp_path):
    with pytest.raises(ValueError, match="not a plain byte-level"):
        word_bpe.load_vocabulary("/opt/tokenizers/word_bpe_49k.json")


def test_word_bpe_query(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = QUERIES["op11_word_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = ids(texts[r["doc_id"]])
        assert tuple(r)[1:] == (len(want), sha(",".join(map(str, want))), sha(TOKENIZER.decode(want, skip_special_tokens=False)))


def plain_runs(words, min_length, min_exponent):
    n, out = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            start, size = i, j + q - i
            if j > i and size >= max(min_length, min_exponent * q):
                inside = words[start : start + size]
                if not any(inside[d:] == inside[:-d] for d in range(1, q)):
                    out.append((start, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize(("min_length", "min_exponent"), [(6, 4), (2, 2), (3, 3)])
def test_runs_equal_brute_force(min_length, min_exponent):
    draw = random.Random(min_length)
    for _ in range(400):
        docs = []
        for _ in range(draw.randint(1, 5)):
            n = draw.randint(0, 40)
            words = draw.choices(range(draw.choice([1, 2, 3, 5])), k=n)
            if n > 3 and draw.random() < 0.5:
                a = draw.randrange(n)
                p = 1 + (n - a) // draw.randint(3, 8)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            docs.append(words)
        offsets = np.cumsum([0, *map(len, docs)])
        got = list(zip(*(x.tolist() for x in periodic_runs.runs_of(np.array(sum(docs, []), np.int64), offsets, min_length, min_exponent)), strict=True))
        assert got == [(offsets[i] + s, offsets[i] + s + n, q) for i, d in enumerate(docs) for s, n, q in plain_runs(d, min_length, min_exponent)]


def test_runs_on_odd_rows(spark):
    texts = [*ODD, "a " * 5, "a " * 6, "x " + "a b " * 4 + "a", "la la la la la la tra " * 9, "w " * 20_000]
    docs = odd_docs(spark, texts)
    for batch_words in (1 << 17, 3):
        found = periodic_runs.find_runs(docs, periodic_runs.split_words(F.col("text")), batch_words=batch_words)
        assert found.columns == [*docs.columns[:-2], "runs", "collapsed"]
        rows = found.select("text", "runs", "collapsed").collect()
        assert len(rows) == len(texts)
        for r in rows:
            words = [w.decode() for w in (r["text"] or "").encode().split()]
            want = plain_runs(words, 6, 4) if len(words) < 1000 else [(0, len(words), 1)]
            assert [tuple(x) for x in r["runs"]] == want
            assert r["collapsed"] == collapsed(words, want)
    assert periodic_runs.find_runs(docs.limit(0), F.lit(None).cast("array<string>")).count() == 0
    with pytest.raises(ValueError, match="two periods"):
        periodic_runs.find_runs(docs, F.array(), min_exponent=1)


def test_runs_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op12_periodic_runs"](spark, SF).collect()
    assert len(rows) == len(texts) and sum(r["n_runs"] > 0 for r in rows) > 5
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        words = (texts[r["doc_id"]] or "").encode().split()
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        words = [w.decode() for w in words]
        runs = plain_runs(words, 6, 4) if n < 1500 or h % 10 == 0 else [(0, 0, 0)] * r["n_runs"]
        if runs and runs[0][2] == 0:
            continue
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == sha("".join(f"{s},{k},{q}\n" for s, k, q in runs))
        assert r["collapsed_sha256"] == sha(collapsed(words, runs))


def plain_negatives(rows, is_anchor, limits):
    rows = [(i, [float(x) for x in v], y) for i, v, y in rows if None not in (i, v, y) and all(x is not None and np.isfinite(x) for x in v)]
    rows = [(i, [int(np.floor(256 * x)) for x in v], y) for i, v, y in rows]
    out = []
    for i, v, y in rows:
        if not is_anchor(i):
            continue
        scored = sorted((-max(min(sum(a * b for a, b in zip(v, w)), 2**63 - 1), -(2**63)), j, z) for j, w, z in rows)  # noqa: B905
        for s, j, _ in [x for x in scored if x[2] == y and x[1] != i][: limits.positives]:
            other = [x for x in scored if x[2] != y and limits.low * -s <= 100 * -x[0] <= limits.high * -s][: limits.most]
            out += [(i, j, n, k, -s, -t) for n, (t, k, _) in enumerate(other, 1)]
    return sorted(out)


def test_hard_negatives_equal_brute_force(spark):
    draw = random.Random(2)
    rows = [(i, [draw.choice([-1.0, 0.25, 0.5, 1.0]) for _ in range(4)], draw.randrange(3)) for i in range(-30, 240)]
    rows += [(500, None, 1), (510, [1.0, None, 1.0, 1.0], 1), (520, [1.0, float("nan"), 0.0, 0.0], 1), (530, [float("inf"), 0.0, 0.0, 0.0], 1), (540, [1.0] * 4, None), (None, [1.0] * 4, 1)]
    rows += [(550, [], 1), (560, [1.0, 1.0], 2), (570, [1.0] * 6, 0), (30, [1.0, 0.5, 0.5, 1.0], 1)]
    df = spark.createDataFrame(rows, "id long, vector array<double>, label int").repartition(5)
    for limits in (hard_negatives.Limits(), hard_negatives.Limits(positives=2, most=3, low=10, high=70)):
        for wave in (16 << 20, 100):
            got = hard_negatives.hard_negatives(df, F.col("id") % 10 == 0, limits, wave)
            unique = [r for r in rows if r[0] != 30 or r[1] is None]
            want = plain_negatives(rows, lambda i: i % 10 == 0, limits)
            assert sorted(map(tuple, got.collect())) == want and len(want) > 100 and len(unique) < len(rows)
    none = hard_negatives.hard_negatives(df, F.lit(False))
    assert none.count() == 0 and none.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert hard_negatives.hard_negatives(df.limit(0), F.lit(True)).count() == 0


def test_hard_negatives_of_huge_components(spark):
    rows = [(i, [x, 1.0], i % 2) for i, x in enumerate([1e3, 2.0**40, 2.0**41, 1e30, -1e30, 1.7e308, 3.0, 2.0**30])]
    df = spark.createDataFrame(rows, "id long, vector array<double>, label int")
    clipped = [(i, [min(max(x, -1.7976931348623157e308 / 256), 1.7976931348623157e308 / 256) for x in v], y) for i, v, y in rows]
    for end in (8, 3):
        got = hard_negatives.hard_negatives(df.where(F.col("id") < end), F.lit(True), hard_negatives.Limits(low=0, high=100)).collect()
        assert sorted(map(tuple, got)) == plain_negatives(clipped[:end], lambda i: True, hard_negatives.Limits(low=0, high=100))


def test_hard_negatives_with_ties_over_many_tasks(spark):
    rows = [(i, [1.0, 0.5], int(i > 5)) for i in range(6)] + [(i, [0.5, 0.25], 1) for i in range(6, 400)]
    got = hard_negatives.hard_negatives(spark.createDataFrame(rows, "id long, vector array<float>, label int").repartition(16), F.col("id") == 0)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, lambda i: i == 0, hard_negatives.Limits())
