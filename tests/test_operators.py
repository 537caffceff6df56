"""Exact values of single operators, with ties, gaps, NULLs and empty input."""

import math

import pytest
from pyspark.sql import functions as F

from tidewright.config import Params
from tidewright.functions import licenses, numbers, packages, urls
from tidewright.operators import graph, joins, quality, reshape, stats, windows
from tidewright.sources import readers, sinks
from tidewright.streaming import incremental


def column(spark, values, kind="double"):
    return spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")


def by_i(df, name):
    return [r[name] for r in df.orderBy("i").collect()]


@pytest.mark.parametrize("values,worse,expected", [([1, 2, 3, 4], True, [25, 50, 75, 100]), ([1, 1, 2, 3], False, [100, 100, 50, 25]), ([0, 0, 0, 1], True, [75, 75, 75, 100]), ([5, 5], True, [None, None]), ([1, None, 2], True, [50, None, 100])])
def test_risk_percentile(spark, values, worse, expected):
    df = windows.risk_percentile(column(spark, [None if v is None else float(v) for v in values]), "v", "p", worse)
    assert by_i(df, "p") == expected


def test_floor_anchor(spark):
    df = windows.floor_anchored(column(spark, [0.0] * 8 + [3.0, 10.0, None]), "v", "p")
    assert by_i(df, "p") == [50.0] * 8 + [75.0, 100.0, None]


def test_composites(spark):
    df = spark.createDataFrame([(1.0, 100.0), (4.0, None)], "a double, b double")
    row = df.select(numbers.geometric_mean(F.col("a"), F.col("b")).alias("g"), numbers.worst_of(F.col("a"), F.col("b")).alias("s"), numbers.worst_present(F.col("a"), F.col("b")).alias("w"), numbers.pro_rata([(0.1, F.col("a") * 80), (0.1, F.col("a") * 60)], 2).alias("p")).collect()
    assert row[0]["g"] == pytest.approx(10) and row[0]["s"] == 100 and row[0]["p"] == pytest.approx(70)
    assert row[1]["g"] is None and row[1]["s"] is None and row[1]["w"] == 4


def test_bus_factor(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 3), ("a", 3, 2), ("b", 1, 7), ("c", 1, 0)], "g string, m int, n long")
    got = {r["g"]: (r["bus_factor"], r["hhi"]) for r in stats.bus_factor_hhi(df, "g", "m", "n").collect()}
    assert got == {"a": (1, 3800), "b": (1, 10000)}


def test_top_shares_tie_and_never_crossed(spark):
    df = spark.createDataFrame([("a", 50), ("b", 25), ("c", 25), ("d", 0)], "k string, v long")
    assert {r["k"] for r in windows.top_share_tied(df, "v", "k", 0.7).collect()} == {"a", "b", "c"}
    assert {r["k"] for r in windows.top_share_index(df, "v", "k", 0.7).collect()} == {"a", "b"}


def test_running_total_spans_ranges(spark):
    df = spark.createDataFrame([(i, (i * 7919) % 1000) for i in range(3000)], "k int, v long")
    got = windows.running_total(df, "v", "k").orderBy("place").collect()
    want = sorted(((i * 7919) % 1000, i) for i in range(3000))
    want.sort(key=lambda x: (-x[0], x[1]))
    total = 0
    for n, (r, (v, k)) in enumerate(zip(got, want, strict=True), 1):
        total += v
        assert (r["k"], r["cum"], r["place"]) == (k, total, n)


def test_running_total_cuts_a_hot_value_and_a_hot_key(spark):
    df = spark.createDataFrame([("hot" if i % 10 else f"k{i}", i, 0 if i % 9 else i) for i in range(4000)], "g string, k int, v long")
    got = windows.running_total(df, "v", "k", ["g"], ranges=16)
    assert got.where("g = 'hot'").count() == 3600
    rows = sorted(((r["v"], r["k"], r["cum"], r["place"], r["rows"]) for r in got.where("g = 'hot'").collect()), key=lambda r: r[3])
    total = 0
    for n, (r, (v, k)) in enumerate(zip(rows, sorted(((r[0], r[1]) for r in rows), key=lambda x: (-x[0], x[1])), strict=True), 1):
        total += v
        assert r == (v, k, total, n, 3600)
    ties = windows.tied(windows.running_total(df, "v", "k"), "v")
    assert ties.where("v = 0").agg({"cum_tied": "min"}).first()[0] == df.agg({"v": "sum"}).first()[0]


def test_a_complete_stream_of_several_batches_gives_its_last_result(spark, tmp_path):
    for i in range(3):
        spark.createDataFrame([("a", i), ("b", i)], "k string, v int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, v int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    counts = incremental.drain(stream.groupBy("k").count(), "complete")
    assert sorted(map(tuple, counts.collect())) == [("a", 3), ("b", 3)]


def test_closure_with_cycle_loop_and_unknown(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 3), (9, 1), (2, 77)], "src int, dst int")
    seeds = spark.createDataFrame([(1,), (50,)], "node int")
    assert {tuple(r) for r in graph.closure(seeds, e).collect()} == {(1, 0), (50, 0), (2, 1), (3, 2), (77, 2)}
    assert {tuple(r) for r in graph.dependency_tree(seeds, e).collect()} == {(1, 2), (2, 3), (3, 1), (3, 3), (2, 77)}


def reference_ranks(edges, weights, alpha=0.85):
    nodes = sorted({n for e in edges for n in e} | set(weights))
    total = sum(weights.values())
    p = {n: weights.get(n, 0) / total if total else 1 / len(nodes) for n in nodes}
    out = {n: [d for s, d in edges if s == n] for n in nodes}
    x = {n: 1 / len(nodes) for n in nodes}
    for _ in range(100):
        loose = sum(x[n] for n in nodes if not out[n])
        y = {n: alpha * (sum(x[m] / len(out[m]) for m in nodes if n in out[m]) + loose * p[n]) + (1 - alpha) * p[n] for n in nodes}
        done = sum(abs(y[n] - x[n]) for n in nodes) < len(nodes) * 1e-6
        x = y
        if done:
            break
    return x


@pytest.mark.parametrize("edges,weights", [([(1, 0), (2, 0), (3, 0)], {0: 1.0}), ([(0, 1), (1, 2), (2, 0)], {0: 1.0, 1: 1.0}), ([(0, 1), (5, 6)], {0: 3.0, 7: 1.0}), ([(0, 1), (1, 2)], {0: 0.0})])
def test_pagerank(spark, edges, weights):
    got = graph.pagerank(spark.createDataFrame(edges, "src int, dst int"), spark.createDataFrame(list(weights.items()), "node int, weight double"))
    want = reference_ranks(edges, weights)
    assert {r["node"] for r in got.collect()} == set(want)
    assert all(r["rank"] == pytest.approx(want[r["node"]], abs=1e-9) for r in got.collect())


def test_components(spark):
    e = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (9, 8), (1, 1)], "src int, dst int")
    got = {r["node"]: r["label"] for r in graph.components(e, spark.createDataFrame([(7,)], "node int")).collect()}
    assert got == {5: 2, 4: 2, 3: 2, 2: 2, 9: 8, 8: 8, 1: 1, 7: 7}


def test_presence_stops_fallback(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "a int, b int")
    dim = spark.createDataFrame([(1, 99, None), (7, 10, 5.0), (8, 20, 6.0)], "ka int, kb int, v double")
    loose = joins.two_key_fallback(df, dim, ("a", "b"), ("ka", "kb"), "v", "o").orderBy("a").collect()
    strict = joins.two_key_fallback(df, dim, ("a", "b"), ("ka", "kb"), "v", "o", stop_at_hit=True).orderBy("a").collect()
    assert [r["o"] for r in loose] == [5.0, 6.0, None] and [r["o"] for r in strict] == [None, 6.0, None]


def test_gates_raise(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    with pytest.raises(ValueError, match="no row for"):
        joins.anti_or_raise(df, df.where("k = 1"), "k", "verdicts")
    with pytest.raises(ValueError, match="small"):
        quality.gate(df, {"small": F.col("k") < 2}, "table")
    with pytest.raises(ValueError, match="without support"):
        Params(platforms=("sourcehut",))


def test_reshape(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0)], "k int, m string, v double")
    new = spark.createDataFrame([(1, "a", 9.0), (2, "a", None), (3, "b", 3.0)], "k int, m string, v double")
    assert {tuple(r) for r in reshape.upsert(old, new, ["k", "m"], "v").collect()} == {(1, "a", 9.0), (2, "a", 2.0), (3, "b", 3.0)}
    wide = reshape.long_to_wide(old, ["k"], "m", "v", ["a", "b"])
    assert {tuple(r) for r in wide.collect()} == {(1, 1.0, None), (2, 2.0, None)}
    cells = [r[0] for r in spark.createDataFrame([(2.0,), (2.5,), (math.nan,), (None,)], "v double").select(reshape.format_cell("v")).collect()]
    assert cells == ["2", "2.5", "", ""]


def test_readers(spark, tmp_path):
    schema = spark.createDataFrame([], "a string, b int").schema
    assert readers.read_or_empty(spark, str(tmp_path / "none"), schema).count() == 0
    sinks.write_csv(spark.createDataFrame([("x", 1), ("w", 2)], schema), str(tmp_path / "t"), ["a", "b"], F.col("a"))
    assert [tuple(r) for r in readers.read_or_empty(spark, str(tmp_path / "t"), schema).orderBy("a").collect()] == [("w", 2), ("x", 1)]
    (tmp_path / "p.csv").write_text("version https://git-lfs.github.com/spec/v1\noid 1\n")
    with pytest.raises(ValueError, match="pointers"):
        readers.reject_pointers(spark, str(tmp_path / "p.csv"))


def test_t64_and_bots(spark):
    df = spark.createDataFrame([("libfoo1t64", "libfoo1 (<< 2), x", None, "Dependabot[bot]"), ("libbart64", None, "other", "Ann")], "p string, r string, v string, n string")
    rows = df.select(packages.t64_alias(F.col("p"), F.col("r"), F.col("v")).alias("a"), packages.is_bot_name(F.col("n")).alias("b")).collect()
    assert [tuple(r) for r in rows] == [("libfoo1", True), (None, False)]


def test_license_text_and_repo_id(spark):
    df = spark.createDataFrame([("SPDX-License-Identifier: zlib",), ("GNU Lesser General Public License\n version 3",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(licenses.license_of_text(F.col("t"))).collect()] == ["Zlib", "LGPL-3.0", "", ""]
    ids = spark.createDataFrame([("gh/12",), ("gl/salsa-3",), ("gl/3",), ("gh/x",), ("12",)], "r string").select(urls.is_repo_id(F.col("r"))).collect()
    assert [r[0] for r in ids] == [True, True, True, False, False]
