"""Operators of the training-data pipeline against plain versions, round trips and held-out rows."""

import hashlib
import itertools
import math
import random
import tracemalloc
import zlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from tests.parity import connect, same
from tidewright.llm import chat_trees, components, decontaminate, kd_sharding, language_id, lattice_lm, near_dedup, ogg_media, repeat_removal, subword, suffix_array, toxicity
from tidewright.llm.queries import ORACLES, QUERIES, table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id string, key int"


def docs_of(spark, rows):
    """Documents with extra columns whose names clash with what operators give."""
    return spark.createDataFrame([(i, t, "xx", None, None, 1.0, "c", 7) for i, t in rows], SCHEMA)


WORDS = [f"w{i}" for i in range(60)]
BASE = " ".join(random.Random(3).choices(WORDS, k=60))
ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "solo"), (5, "solo"), (None, BASE), (6, BASE), (6, BASE), (7, BASE.upper()), (8, BASE + " extra tail"), (9, "ünï " * 400), (10, "x" * 30_000), (11, "a b"), (12, "b a")]


def test_language_id_on_odd_rows_and_held_out(spark):
    got = language_id.detect_language(docs_of(spark, ODD), docs_of(spark, [])).collect()
    assert len(got) == len(ODD) and {r["lang_pred"] for r in got} == {"und"}
    rows = QUERIES["op1_language_id"](spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)


@pytest.mark.parametrize("order", [0, 1, 3, 4])
def test_code_lengths_equal_a_plain_coder(order):
    samples = {"en": [b"The cat sat on the mat", b"", b"that cat"], "de": ["der Hund und die K\u00e4tze".encode()], "none": [b""]}
    texts = [b"the cats", b"", b"ZZ \xc3\xa4 the hund", b"t", b"that cat sat on the mat" * 9]
    fitted = language_id.train_ppm(samples, order)
    off = np.cumsum([0, *map(len, texts)])
    for chunk in (1 << 19, 7, 1):
        got = language_id.code_lengths(fitted, np.frombuffer(b"".join(texts), np.uint8), off, chunk)
        for i, t in enumerate(texts):
            for j, lang in enumerate(fitted.langs):
                assert got[i, j] == pytest.approx(brute.ppm_bits(samples[lang], t, order), rel=1e-5, abs=1e-4)


def test_language_sample_is_bounded_and_leaves_no_language_out(spark):
    rows = [(i, "a b " * 40, "xx") for i in range(300)] + [(900, "long " * 900, "yy"), (901, "long " * 800, "yy"), (902, None, "zz"), (903, "t", None)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.training_sample(labelled, 20, 1000, 1 << 20)
    assert {k: len(v) for k, v in got.items()} == {"xx": 20, "yy": 1} and got["yy"] == [b"long " * 800]
    assert len(language_id.training_sample(labelled, 200, 1000, 3200)["xx"]) == 10


def test_near_duplicates_equal_brute_force(spark):
    draw = random.Random(1)
    rows = list(ODD)
    for g in range(12):
        words = draw.choices(WORDS, k=draw.randint(3, 80))
        for c in range(draw.randint(1, 5)):
            rows.append((100 + 10 * g + c, " ".join(w if draw.random() > 0.04 else "zz" for w in words)))
    for k in (2, 5):
        got = near_dedup.near_duplicates(docs_of(spark, rows), near_dedup.NearDup(words=k)).collect()
        want = brute.components({i: t for i, t in rows if i is not None}, k)
        assert len(got) == len(rows)
        for r in got:
            if r["doc_id"] is None:
                assert r["component_id"] is None and r["kept"]
            else:
                assert (r["component_id"], r["kept"]) == (want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])
    kept = near_dedup.keep_one(docs_of(spark, rows), near_dedup.NearDup(words=2))
    assert kept.columns == docs_of(spark, []).columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted({v for v in brute.components({i: t for i, t in rows if i is not None}, 2).values()})
    assert near_dedup.near_duplicates(docs_of(spark, [])).count() == 0


def test_a_fruitless_pivot_does_not_end_the_search_for_links(spark):
    near = BASE.rsplit(" ", 1)[0] + " w1"
    members = spark.createDataFrame([(7, i) for i in (1, 2, 3)], "key long, rep long")
    source = spark.createDataFrame([(1, "a b c d e"), (2, BASE), (3, near)], "doc_id long, text string")
    hashes = source.select(F.col("doc_id").alias("rep"), *near_dedup._text_key(F.col("text")))
    facts = hashes.selectExpr("rep", "CASE WHEN rep = 1 THEN 1000L ELSE 56L END AS size", "array(0L, 0L, 0L, 0L, 0L) AS signs", "text_a", "text_b")
    for pivots in (1, 3):
        links = near_dedup._links(source, members, facts, near_dedup.NearDup(pivots=pivots, pivot_rounds=1))
        assert {(r["node"], r["label"]) for r in components.connected_components(links).collect()} == {(2, 2), (3, 2)}
    links = near_dedup._links(source, members, facts, near_dedup.NearDup(pivot_rounds=0))
    assert [(r["a"], r["b"]) for r in links.collect()] == [(2, 3)]


def test_near_duplicates_just_over_the_line(spark):
    """Recall at similarities of 0.80 to 0.82 and for small sets, against all pairs."""
    draw = random.Random(9)
    rows, n = [], 0
    for size in [*range(2, 21), *[40, 120] * 8]:
        for c in range(4):
            words = [f"g{n}x{i}" for i in range(size + 1)]
            n += 1
            for keep in (0.80, 0.81, 0.9):
                shingles = size + 0.0
                changed = max(1, round((1 - keep) / (1 + keep) * shingles))  # a changed tail word changes one shingle
                rows.append((10 * n + int(100 * keep) % 10, " ".join(words[: size + 1 - changed] + [f"h{n}{keep}{i}" for i in range(changed)])))
    draw.shuffle(rows)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    want = brute.components(dict(rows), 2)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs_of(spark, rows), near_dedup.NearDup(words=2)).collect()}
    assert len({i for i, c in want.items() if c != i}) > 50
    assert got == want


def test_keep_one_with_repeated_ids_and_clashing_columns(spark):
    rows = [(1, BASE, 5, 1), (1, BASE, 4, 2), (1, "something else entirely " * 3, 3, 3), (2, BASE, 2, 4), (None, BASE, 1, 5), (None, BASE, 1, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _n int, _kept int").withColumn("_id", F.lit(1)).withColumn("text_a", F.lit("x"))
    got = near_dedup.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(r["_kept"] for r in got.collect()) == [2, 3, 5, 6]


def test_super_minhash_is_a_permutation_and_estimates():
    draw = np.random.default_rng(0)
    one = near_dedup.super_minhash(np.array([5], np.uint64), np.array([0, 1]), 64, 1)
    assert sorted((one[0] >> np.uint64(32)).tolist()) == list(range(64))
    pool = draw.integers(0, 2**63, 300, dtype=np.uint64)
    a, b = pool[:240], pool[60:]
    s = near_dedup.super_minhash(np.concatenate([a, b]), np.array([0, 240, 480]), 512, 1)
    assert abs((s[0] == s[1]).mean() - 180 / 300) < 0.08
    assert (near_dedup.super_minhash(np.zeros(0, np.uint64), np.array([0, 0]), 8, 1) == np.iinfo(np.uint64).max).all()


def test_components(spark):
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100 + draw.randrange(30), 100 + draw.randrange(30)) for _ in range(25)] + [(None, 3), (7, 7)]
    got = {r["node"]: r["label"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        if a is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for n in near:
        seen, todo = {n}, [n]
        while todo:
            todo += [m for m in near[todo.pop()] if m not in seen and not seen.add(m)]
        assert got[n] == min(seen)
    assert set(got) == set(near)


def test_decontamination_equals_brute_force(spark):
    items = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Short, item!"), (3, None), (4, ""), (5, "one two three four five six seven eight nine ten"), (None, "null id item here")]
    rows = [*ODD, (20, "x ONE two-three four five six seven eight nine ten; eleven y"), (21, "short item short item"), (22, "two three four five six seven eight nine ten eleven"), (23, "null id item here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (4 << 20, 10):
        found = decontaminate.find_contamination(docs_of(spark, rows), bench, block_bytes=size)
        got = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"], r["items_sha256"]) for r in decontaminate.digest_hits(found).collect()]
        want = []
        for i, t in rows:  # repeated and null ids too
            n, hit, ids = brute.hits(t, items)
            ids = sorted("null" if x == "None" else x for x in ids)
            want.append((i, n, hit, len(ids), hit > 0, hashlib.sha256(",".join(ids).encode()).hexdigest()))
        assert sorted(map(repr, got)) == sorted(map(repr, want))
    left = decontaminate.drop_contaminated(docs_of(spark, rows), bench)
    assert {r["doc_id"] for r in left.collect()} == {i for i, t in rows if not brute.hits(t, items)[1]}
    assert decontaminate.find_contamination(docs_of(spark, rows), bench.where("false")).where("size(items) > 0").count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, name):
    same(QUERIES[name](spark, SF), connect(SF), ORACLES[name])


def test_sharding_is_whole_gapless_and_even(spark):
    rows = QUERIES["op4_kd_sharding"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    total, by = [0] * 16, [[] for _ in range(16)]
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        total[r["shard"]] += r["size"]
        by[r["shard"]].append(r["slot"])
    assert len(rows) == len(texts) and all(sorted(s) == list(range(len(s))) for s in by)
    assert max(total) - min(total) <= 2 * max(r["size"] for r in rows)
    odd = kd_sharding.kd_shards(docs_of(spark, ODD), {"lang": kd_sharding.category("lang"), "n": F.col("n_chars")}, target_bytes=8000).collect()
    assert len(odd) == len(ODD) and {r["doc_id"] for r in odd} == {i for i, _ in ODD}
    assert kd_sharding.kd_shards(docs_of(spark, []), {}, n_shards=4).count() == 0
    many = kd_sharding.kd_shards(docs_of(spark, [(i, "same") for i in range(400)]), {}, n_shards=4).groupBy("shard").count().collect()
    assert len(many) == 4 and max(r["count"] for r in many) <= 2 * min(r["count"] for r in many)


@pytest.mark.parametrize("size", [0, 1, 254, 255, 256, 4799, 4800, 65_025, 200_000])
def test_ogg_round_trip_and_damage(size):
    payload = bytes(random.Random(size).randrange(256) for _ in range(size))
    media = ogg_media.store_samples(payload, size)
    read = ogg_media.read_samples(media)
    assert read["payload"] == payload and read["n_bytes"] == size and read["n_streams"] == 2
    assert read["times"][-1] == size / 8000
    for at in {5, 22, len(media) // 2, len(media) - 1}:
        bad = bytearray(media)
        bad[at] ^= 1
        with pytest.raises(ogg_media.OggError):
            ogg_media.read_samples(bytes(bad))
    with pytest.raises(ogg_media.OggError):
        ogg_media.read_samples(media[:-3])


def test_ogg_checksum_of_a_known_page():
    """Bit by bit, as the format defines it."""
    page = ogg_media.store_samples(b"abc", 3)[:40]
    crc = 0
    for byte in page:
        crc ^= byte << 24
        for _ in range(8):
            crc = (crc << 1 ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    assert ogg_media.page_checksum(page) == crc


def test_media_columns(spark):
    rows = ogg_media.text_to_media(docs_of(spark, ODD), keep_media=True).collect()
    for r, (i, t) in zip(sorted(rows, key=lambda r: (r["doc_id"] or 0, r["n_bytes"])), sorted(ODD, key=lambda x: (x[0] or 0, len((x[1] or "").encode()))), strict=True):
        raw = (t or "").encode()
        full = raw.ljust(max(192, -(-len(raw) // 192) * 192))
        assert (r["doc_id"], r["n_bytes"], r["payload_bytes"]) == (i, len(raw), len(full))
        assert r["payload_sha256"] == hashlib.sha256(full).hexdigest() and r["tail_crc32"] == zlib.crc32(full[-16:])
        assert r["media_sha256"] == hashlib.sha256(r["media"]).hexdigest() and r["media_bytes"] == len(r["media"])


@pytest.fixture(scope="module")
def vocabulary():
    return subword.load_vocabulary()


def test_subword_without_dropout_is_the_library(vocabulary):
    model = sentencepiece.SentencePieceProcessor(model_file=subword.DEFAULT_MODEL)
    texts = ["a  b", "  lead", "", "x\ty\n", "the <s> </s>", "é\x00 ñ", "   ", "a   ", "日本語 テスト", "hello world, this is a test", "a" * 300, "Ünïcödé 12345"]
    assert subword.Encoder(vocabulary, 0.0).encode_many(texts) == [model.encode(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_subword_round_trip(texts):
    vocabulary = _loaded()
    encoder = subword.Encoder(vocabulary, 0.3, seed=5)
    for t, ids in zip(texts, encoder.encode_many(texts), strict=True):
        assert encoder.decode(ids) == t.encode()


_KEPT = []


def _loaded():
    if not _KEPT:
        _KEPT.append(subword.load_vocabulary())
    return _KEPT[0]


def test_subword_dropout_varies_repeats_and_agrees(vocabulary):
    text = "segmentation of international words " * 30
    a, b = subword.Encoder(vocabulary, 0.1, 1), subword.Encoder(vocabulary, 0.1, 2)
    assert a.encode(text) == subword.Encoder(vocabulary, 0.1, 1).encode(text) != b.encode(text)
    assert a.encode(text) != subword.Encoder(vocabulary, 0.0).encode(text)
    units = [" segmentation", " international", "▁", " a", "  x", " 12é"]
    assert a.merge_many(units, 1) == [a.merge(u, 1) for u in units]


def test_subword_dropout_draws_every_occurrence(vocabulary):
    encoder = subword.Encoder(vocabulary, 0.1, 3)
    texts = [f"{i} segmentation" for i in range(400)]
    last = [tuple(ids[-1:]) if len(ids) < 3 else tuple(ids[2:]) for ids in encoder.encode_many(texts)]
    assert len(set(last)) > 4
    one = encoder.encode(" ".join(["the"] * 4000))
    whole = subword.Encoder(vocabulary, 0.0).encode("the")[0]
    left = sum(i == whole for i in one) / 4000
    assert 0.75 < left < 0.95 and len(set(one)) > 2
    texts = ["the segmentation of 日本語テスト \u2603\u2603 snow " * 5, "", "a" * 300, "x \u2581 y"]
    assert encoder.encode_many(texts) == encoder.encode_many(texts, block=1) == [encoder.encode(t) for t in texts]
    assert [encoder.decode(i) for i in encoder.encode_many(texts)] == [t.encode() for t in texts]
    units = [" segmentation", " international", " snow", " \u2603 ok"] * 50
    assert encoder.merge_many(units, range(200)) == [encoder.merge(u, k) for k, u in enumerate(units)]


def test_subword_columns(spark):
    rows = subword.encode_texts(docs_of(spark, ODD)).collect()
    assert len(rows) == len(ODD) and all(r["lossless"] for r in rows)
    assert {r["n_tokens"] for r in rows if r["n_bytes"] == 0} == {0}


def test_subword_memory_stays_bounded_over_many_different_words():
    encoder = subword.Encoder(subword.load_vocabulary(), 0.1, 3)
    tracemalloc.start()
    for n in range(5):
        encoder.encode_many([" ".join(hashlib.md5(b"%d" % i).hexdigest()[:7] for i in range(n * 30_000, n * 30_000 + 30_000))])
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 15e6


def test_lattice_sums_all_segmentations():
    pieces = [b" ", b"a", b"b", b" a", b"ab", b" ab", b"ba"]
    logp = np.log(np.array([0.1, 0.2, 0.1, 0.2, 0.15, 0.05, 0.2]))
    lattice = lattice_lm.Lattice(pieces)
    for word in (b"a", b"ab", b"aba", b"abab", b"bbaab"):
        s, total = b" " + word, 0.0
        for cuts in itertools.product([0, 1], repeat=len(s) - 1):
            parts, last = [], 0
            for i, c in enumerate(cuts, 1):
                if c:
                    parts.append(s[last:i])
                    last = i
            parts.append(s[last:])
            if all(p in pieces for p in parts):
                total += math.exp(sum(logp[pieces.index(p)] for p in parts))
        assert lattice.forward([word], logp)[0][0] == pytest.approx(math.log(total))
        assert all(lattice._forward_long(word, logp, block) == pytest.approx(math.log(total)) for block in (3, 4, 7))
    words = [b"ab", b"aba", b"b"]
    expected = lattice.expected(words, np.array([2, 1, 3]), logp)
    assert (expected * np.array([len(p) for p in pieces])).sum() == pytest.approx(2 * 3 + 4 + 3 * 2)


def test_lm_scores(spark):
    rows = [*ODD, *((200 + i, " ".join(random.Random(i).choices(WORDS, k=30))) for i in range(40))]
    learn = [r for r in rows if r[0] is not None and r[0] % 3]
    docs = docs_of(spark, rows).withColumns({"n_tokens": F.lit("x"), "_row": F.lit(1), "rest": F.lit(2)})
    scored = lattice_lm.score_texts(docs, F.col("doc_id") % 3 > 0, head_words=10)
    assert len(set(scored.columns)) == len(scored.columns)
    got = scored.collect()
    counts = {}
    for _, t in learn:
        for w in (t or "").encode().lower().split() + [None]:
            counts[w] = counts.get(w, 0) + 1
    n = sum(counts.values())
    z = n + 0.1 * (len(counts) + 1)
    want = []
    for i, t in rows:
        w = (t or "").encode().lower().split() + [None]
        want.append((i, len(w), sum(x in counts for x in w), n, round(sum(math.log10((counts.get(x, 0) + 0.1) / z) for x in w), 6)))
    key = lambda r: (r[0] is None, r)
    assert sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=key) == sorted(want, key=key)
    assert all(r["score"] < 0 and r["vocabulary_score"] < 0 for r in got)
    # score is the sum of its words' and its end's, whichever way a word takes
    whole = {r["doc_id"]: r["score"] for r in lattice_lm.score_texts(docs_of(spark, rows), F.col("doc_id") % 3 > 0, head_words=10_000).collect()}
    assert all(whole[r["doc_id"]] == pytest.approx(r["score"]) for r in got)
    none = lattice_lm.score_texts(docs_of(spark, rows).select("doc_id", "text"), F.lit(False)).collect()
    assert len(none) == len(rows) and all(r["n_known"] == 0 and r["score"] == r["vocabulary_score"] for r in none)
    assert lattice_lm.score_texts(docs_of(spark, []), F.lit(True)).count() == 0


def test_a_very_long_word_has_bounded_memory():
    lattice = lattice_lm.Lattice([bytes([b]) for b in range(256)] + [b"abc", b" ab"])
    logp = np.log(np.full(258, 1 / 258))
    word = b"abc" * 40_000
    per = lattice.forward([b"abc" * 100, b"abc" * 200, word], logp)[0]
    assert per[2] == pytest.approx(per[0] + (per[1] - per[0]) / 100 * 39_900, rel=1e-6)


def test_toxicity_on_held_out_and_odd_rows(spark):
    draw = random.Random(2)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 7))) for _ in range(300)]
    bad = ["vilename", "scumword", "nastyterm"]

    def text(toxic):
        w = draw.choices(words, k=60)
        for _ in range(3 * toxic):
            w.insert(draw.randrange(60), draw.choice(bad))
        return " ".join(w)

    data = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(400)]
    labels = spark.createDataFrame([(i, t) for i, _, t in data[:300]] + [(None, 1), (5000, 0), (3, None)], "doc_id long, toxic int")
    docs = docs_of(spark, [(i, t) for i, t, _ in data])
    model = toxicity.learn(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, model).collect()}
    assert sum(got[i]["predicted"] == t for i, _, t in data[300:]) >= 97
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    odd = toxicity.score_toxicity(docs_of(spark, ODD), model).collect()
    assert len(odd) == len(ODD) and not any(r["predicted"] for r in odd)
    assert toxicity.learn(docs, labels.where("toxic = 0")) is None
    kept = {r["doc_id"] for r in toxicity.drop_toxic(docs, model).collect()}
    assert kept == {i for i, r in got.items() if not r["predicted"]}


def test_toxicity_does_not_grow_with_length(spark):
    distance = toxicity.Distance(b"vilename scumword nastyterm " * 40, b"plain words of ordinary text " * 40)
    mild, vile = distance.cell(b"ordinaryish"), distance.cell(b"vilename")
    assert len({mild, vile, distance.cell(b"of")}) == 3
    model = toxicity.ToxicityModel(b"vilename scumword nastyterm " * 40, b"plain words of ordinary text " * 40, {mild: 1.0, vile: 4.0}, 5.0)
    part = b"of " * 199 + b"ordinaryish "
    assert all(model.score(distance, part * n) < 0.7 for n in (1, 5, 25, 100))
    passage = b"of vilename " * 4
    assert all(model.score(distance, part * n + passage + part * n) >= 0.7 for n in (0, 1, 25, 100))


def test_toxicity_learns_from_texts_of_all_lengths(spark):
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 7))) for _ in range(300)]
    bad = ["vilename", "scumword", "nastyterm"]
    data = []
    for i in range(40):
        w = draw.choices(words, k=6000)
        for _ in range(90 * (i % 2)):
            w.insert(draw.randrange(6000), draw.choice(bad))
        data.append((i, " ".join(w)))
    docs = docs_of(spark, data)
    assert min(len(t) for _, t in data) > 20_000
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, toxic int")
    for limits in (toxicity.Limits(), toxicity.Limits(toxic_bytes=300_000, ordinary_bytes=300_000)):
        got = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(docs, toxicity.learn(docs, labels, limits)).collect()}
        assert sum(got[i] == i % 2 for i in range(30, 40)) >= 9
    assert toxicity.learn(docs, labels, toxicity.Limits(toxic_bytes=1, ordinary_bytes=1)) is not None


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_suffix_order(values):
    order = suffix_array.suffix_order(np.array(values, np.int64))
    assert order.tolist() == sorted(range(len(values)), key=lambda i: values[i:])


def test_repeats_equal_brute_force(spark):
    draw = random.Random(4)
    passage = "".join(draw.choices("abcdefgh ", k=130))
    other = "ÄÖ" * 40
    rows = [*[r for r in ODD if r[0] is not None], (30, passage), (31, "x" + passage[10:100] + "y" * 10 + passage[40:]), (32, passage), (33, other), (34, "q" + other[3:60] + passage[:49]), (35, passage[:50]), (36, "ab" * 60), (37, "ab" * 40)]
    rows += [(40 + i, "".join(draw.choices("ab", k=20)) + passage + "".join(draw.choices("ab", k=20))) for i in range(20)]
    got = repeat_removal.digest_repeats(repeat_removal.find_repeats(docs_of(spark, rows))).collect()
    want = []
    for (i, t), mask in zip(rows, brute.repeats(rows), strict=True):
        b = (t or "").encode()
        spans = sum(1 for k in range(len(mask)) if mask[k] and not (k and mask[k - 1]))
        want.append((i, len(b), sum(mask), spans, hashlib.sha256(bytes(c for c, m in zip(b, mask, strict=True) if not m)).hexdigest()))
    assert sorted(map(tuple, got)) == sorted(want)
    small = repeat_removal.Repeats(anchors_in_bucket=5, flush_bytes=300, broadcast_ids=0)
    assert sorted(map(tuple, repeat_removal.digest_repeats(repeat_removal.find_repeats(docs_of(spark, rows), small)).collect())) == sorted(want)
    cut = repeat_removal.remove_repeats(docs_of(spark, rows))
    assert cut.columns == docs_of(spark, []).columns and cut.count() == len(rows)
    assert repeat_removal.find_repeats(docs_of(spark, [])).count() == 0
    clash = docs_of(spark, rows).withColumns({c: F.lit(i) for i, c in enumerate(("copy", "runs", "row", "fp", "_least", "places"))})
    again = repeat_removal.remove_repeats(clash)
    assert again.columns == clash.columns
    assert sorted(map(repr, again.select("doc_id", "text", "copy", "places").collect())) == sorted(map(repr, cut.selectExpr("doc_id", "text", "0 AS copy", "5 AS places").collect()))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="\\<|>startend/ms[INST]_im", max_size=40))
def test_escape_is_reversible(text):
    safe = chat_trees.escape(text)
    assert chat_trees.unescape(safe) == text
    assert not any(c in safe for c in chat_trees.CONTROLS)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|end|>", ""]), st.text(max_size=20)), max_size=5))
def test_format_round_trip(turns):
    text, spans = chat_trees.format_turns(turns)
    assert chat_trees.parse_turns(text) == turns
    assert [chat_trees.unescape(text[a:b]) for a, b in zip(spans[::2], spans[1::2], strict=True)] == [t for r, t in turns if r == "assistant"]


def test_best_paths_rank_branches(spark):
    rows = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "a", 1.0), ("t", 3, 1, "assistant", "b", 5.0), ("t", 4, 2, "user", "c", 9.0), ("t", 5, 3, "user", None, None), ("u", 1, 77, None, "root", 1.0), ("v", 1, 2, "user", "loop", 1.0), ("v", 2, 1, "user", "loop", 1.0), (None, 1, None, "user", "n", 1.0)]
    m = spark.createDataFrame(rows, "tree string, node int, parent int, role string, text string, score double")
    got = {}
    for r in chat_trees.best_paths(m, n_paths=2).collect():
        got.setdefault((r["tree"], r["path"]), {})[r["depth"]] = r["text"]
    assert got == {("t", 1): {1: "q", 2: "a", 3: "c"}, ("t", 2): {1: "q", 2: "b", 3: None}, ("u", 1): {1: "root"}, (None, 1): {1: "n"}}
    assert chat_trees.best_paths(m.where("false")).count() == 0


def test_chat_query(spark):
    got = {r["conv_id"]: r for r in QUERIES["op10_chat_trees"](spark, SF).collect()}
    convs = {}
    for r in sorted(table(spark, SF, "conversations").collect(), key=lambda r: r["turn"]):
        convs.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    convs[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    assert set(got) == set(convs)
    for c, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["loss_chars"] == len(loss)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_sketch_holds_little_beside_its_batch(spark, monkeypatch):
    """A batch of 4 MB in one worker; with 2 MB at once it held 80 MB."""
    import pyarrow as pa

    runs = []
    monkeypatch.setattr(near_dedup, "tidy", lambda run: runs.append(run) or run)
    near_dedup.sketch(spark.createDataFrame([], "doc_id long, text string"), near_dedup.NearDup())
    texts = [" ".join(hashlib.md5(b"%d" % i).hexdigest()[:7] for i in range(n * 400, n * 400 + 400)) for n in range(1250)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1250)), pa.array(texts), *[pa.array([0] * 1250)] * 2], ["doc_id", "text", "text_a", "text_b"])
    tracemalloc.start()
    rows = sum(b.num_rows for b in runs[0](iter([batch])))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert rows == 1250 and peak < 30e6


def test_pipeline_stages_hand_python_small_batches(spark):
    """17 MB of texts in one partition came as one batch."""
    import corpus_pipeline
    import pyarrow as pa

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    texts = spark.range(0, 350, 1, 1).select(F.expr("repeat('words ', 8000)").alias("text"))

    def sizes(batches):
        yield from (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)

    for name, stage in corpus_pipeline.STAGES:
        spark.conf.unset(key)
        stage(spark, table(spark, SF, "documents").where("false"), SF)
        n = [r["n"] for r in texts.mapInArrow(sizes, "n long").collect()]
        assert sum(n) > 16e6 and max(n) < 5e6, name
    spark.conf.set(key, before)


def test_pipeline_equals_plain_stages(spark):
    """What toxicity keeps, then brute-force versions of every later stage."""
    import corpus_pipeline

    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    docs = table(spark, SF, "documents")
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.reject_toxic(spark, docs, SF).collect()}
    first = {i: kept[i] for i, c in brute.components(kept, 5).items() if i == c}
    rows = sorted(first.items())
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    want = {}
    for (i, t), mask in zip(rows, brute.repeats(rows), strict=True):
        left = bytes(c for c, m in zip(t.encode(), mask, strict=True) if not m).decode(errors="ignore")
        if not brute.hits(left, items)[1]:
            want[i] = hashlib.sha256(left.encode()).hexdigest()
    assert {i: r["decoded_sha256"] for i, r in got.items()} == want
    assert all(r["lossless"] for r in got.values())
