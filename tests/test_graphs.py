"""Components, closure, trees and PageRank against plain loops; identities merged to persons."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.parity import connect
from tidewright.operators import graph, people
from tidewright.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_components(edges, nodes=()):
    label = {n: n for e in edges for n in e} | {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return label


@pytest.mark.parametrize("seed", range(4))
def test_components_equal_a_plain_loop(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(draw.choice([10, 40, 80]))] + [(7, 7)]
    extra = [100, 101]
    rows = spark.createDataFrame([*edges, (None, 3), (3, None)], "src int, dst int")
    nodes = spark.createDataFrame([(n,) for n in [*extra, None]], "node int")
    want = plain_components(edges, extra)
    for few in (1 << 17, 4) if seed < 2 else (1 << 17,):
        assert dict(map(tuple, graph.components(rows, nodes, few).collect())) == want


def test_components_without_edges(spark):
    none = spark.createDataFrame([], "src int, dst int")
    assert graph.components(none).count() == 0
    assert graph.components(none, spark.createDataFrame([(4,)], "node int")).collect() == [(4, 4)]
    assert graph.components(spark.createDataFrame([(5, 5)], "src int, dst int")).collect() == [(5, 5)]


def test_a_long_chain_takes_few_rounds(spark):
    chain = spark.range(100_000).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    rounds = graph.contractions(chain, few=1000)
    sizes = [r.count() for r in rounds]
    assert sizes[0] == 100_001 and len(sizes) < 12 and all(b < 0.6 * a for a, b in zip(sizes, sizes[1:], strict=False))
    assert graph.components(chain).agg(F.count("*"), F.max("label")).first() == (100_001, 0)


def test_a_star_collapses_at_once(spark):
    star = spark.range(1, 20_000).select(F.col("id").alias("src"), F.lit(0).cast("long").alias("dst"))
    assert len(graph.contractions(star, few=0)) <= 3
    assert graph.components(star, few=10).where("label <> 0").count() == 0


def test_dependency_tree_keeps_repeats_and_unknown_targets(spark):
    rows = [("a", "b", "1"), ("a", "b", "1"), ("a", "b", "2"), ("b", "__none__", "1"), ("b", "", "1"), ("b", None, "1"), ("b", "x", "3"), ("x", "a", "9"), ("q", "a", "1"), (None, "a", "1"), ("a", "a", "1")]
    edges = spark.createDataFrame(rows, "src string, dst string, version string")
    seeds = spark.createDataFrame([("a",), (None,), ("lonely",)], "node string")
    got = Counter(map(tuple, graph.dependency_tree(seeds, edges, repeats=True).collect()))
    assert got == Counter({("a", "b", "1"): 2, ("a", "b", "2"): 1, ("b", "x", "3"): 1, ("x", "a", "9"): 1, ("a", "a", "1"): 1})
    once = Counter(map(tuple, graph.dependency_tree(seeds, edges).collect()))
    assert once == Counter(dict.fromkeys(got, 1))
    known = spark.createDataFrame([("b",), ("a",)], "node string")
    few = {tuple(r) for r in graph.dependency_tree(seeds, edges, keep_unknown=False, known=known).collect()}
    assert few == {("a", "b", "1"), ("a", "b", "2"), ("a", "a", "1")}
    marked = {tuple(r) for r in graph.dependency_tree(seeds, edges, none=None).collect()}
    assert ("b", "__none__", "1") in marked


def plain_pagerank(edges, weights, alpha=0.85, tolerance=1e-6, rounds=None):
    edges = {e for e in edges if e[0] != e[1]}
    nodes = sorted({n for e in edges for n in e} | set(weights))
    total = sum(weights.values())
    p = {n: weights.get(n, 0) / total if total else 1 / len(nodes) for n in nodes}
    out = Counter(a for a, _ in edges)
    x = dict.fromkeys(nodes, 1 / len(nodes))
    for _ in range(rounds or 100):
        got = dict.fromkeys(nodes, 0.0)
        for a, b in edges:
            got[b] += x[a] / out[a]
        loose = sum(x[n] for n in nodes if not out[n])
        new = {n: alpha * (got[n] + loose * p[n]) + (1 - alpha) * p[n] for n in nodes}
        moved = sum(abs(new[n] - x[n]) for n in nodes)
        x = new
        if rounds is None and moved < len(nodes) * tolerance:
            break
    return x


@pytest.mark.parametrize("rounds", [None, 1, 7])
def test_pagerank_equals_a_plain_loop(spark, rounds):
    draw = random.Random(5)
    edges = [(draw.randrange(30), draw.randrange(40)) for _ in range(120)]
    weights = {n: draw.random() for n in range(0, 45, 5)}
    got = graph.pagerank(spark.createDataFrame([*edges, edges[0]], "src int, dst int"), spark.createDataFrame(list(weights.items()), "node int, weight double"), rounds=rounds)
    want = plain_pagerank(edges, weights, rounds=rounds)
    assert {r["node"]: round(r["rank"], 10) for r in got.collect()} == {n: round(x, 10) for n, x in want.items()}


def test_converged_query_equals_a_plain_loop(spark):
    con = connect(SF)
    edges = con.sql("SELECT DISTINCT a.l_partkey, b.l_partkey FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber WHERE a.l_partkey <> b.l_partkey").fetchall()
    weights = {n: 1.0 for (n,) in con.sql("SELECT p_partkey FROM part WHERE p_size = 11").fetchall()}
    want = plain_pagerank(edges, weights)
    got = {r["node"]: r["rank"] for r in QUERIES["pagerank_converged"](spark, SF).collect()}
    assert set(got) == set(want) and all(got[n] == pytest.approx(want[n], abs=2e-8) for n in want)


def test_aliases_merge_to_the_smallest_id_with_the_first_date(spark):
    rows = spark.createDataFrame([("C", "x", "2020"), ("B", "x", "2019"), ("B", "y", "2021"), ("A", "y", "2022"), ("D", "D", None), ("D", None, "2018")], "id string, alias string, at string")
    got = {tuple(r) for r in graph.merge_aliases(rows, "id", "alias", "at").collect()}
    assert got == {("A", 3, "2019"), ("D", 1, "2018")}


def test_reports_of_all_years_merge_and_those_without_an_order_still_connect(spark, tmp_path):
    lines = spark.createDataFrame([(1, 7, 3, "R"), (2, 7, 3, "R"), (2, 8, 3, "R"), (3, 8, 3, "R"), (3, 9, 3, "R"), (4, 9, 3, "R"), (5, 9, 3, "N")], "l_orderkey long, l_partkey long, l_suppkey long, l_returnflag string")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    dates = spark.createDataFrame([(1, "2000-05-01"), (2, "1995-02-01"), (4, "1991-03-01"), (5, "1990-01-01")], "o_orderkey long, d string")
    dates.select("o_orderkey", F.to_timestamp("d").alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    got = [(r["canonical"], r["ids"], str(r["published"])[:10]) for r in QUERIES["vuln_alias_components"](spark, str(tmp_path)).collect()]
    assert got == [(1, 3, "1991-03-01")]


PEOPLE = [
    ("r", "Ann Lee", "1+annl@users.noreply.github.com", 2020, 5), ("r", "annl", "ANNL@users.noreply.github.com", 2021, 7), ("r", "ann lee ", "ann@x.org", 2023, 2), ("r", "ci", "", 2020, 3),
    ("r", "ci", "ci@x.org", 2020, 4), ("r", "Bo Berg", "bo@x.org", 2021, 20), ("r", "web-flow", "noreply@github.com", 2022, 50), ("r", "Bo B", "bo@x.org", 2031, 99),
    ("dormant", "Cy", "cy@x.org", 2015, 9), ("future", "Di", "di@x.org", 2031, 9), ("bots", "dependabot[bot]", "x@y", 2021, 8), ("bots", "Ed", "ed@x.org", 2010, 1), ("other", "Ann Lee", "q@q", 2021, 1), ("zero", None, None, 2021, None),
]


def test_identities_concentration_and_authors(spark):
    rows = spark.createDataFrame(PEOPLE, "repo string, name string, email string, year int, commits int")
    persons = {(r["repo"], r["name"], r["email"]): tuple(r["person"]) for r in people.persons(rows).collect()}
    same = [("r", "Ann Lee", "1+annl@users.noreply.github.com"), ("r", "annl", "ANNL@users.noreply.github.com"), ("r", "ann lee", "ann@x.org")]
    assert len({persons[k] for k in same}) == 1
    assert persons["r", "ci", ""] != persons["r", "ci", "ci@x.org"]  # a handle merges nothing
    assert persons["other", "Ann Lee", "q@q"] == ("Ann Lee", "q@q")
    got = {r["repo"]: tuple(r)[1:] for r in people.concentration(rows, (2021, 2025), 2025).collect()}
    ann, bo, ci, ci2 = 14, 20, 3, 4
    total = ann + bo + ci + ci2
    assert got["r"] == (total + 50, 4, 2, round(sum((100 * x / total) ** 2 for x in (ann, bo, ci, ci2))), 9 + 20 + 50, 2, 1, round((100 * 9 / 29) ** 2 + (100 * 20 / 29) ** 2), None)
    assert got["dormant"] == (9, 1, 1, 10000, 0, 0, 1, 10000, "no commits in window")
    assert got["future"] == (0, 0, None, None, 0, 0, 1, 10000, "no commits through last complete year")
    assert got["bots"] == (9, 1, 1, 10000, 8, 0, 1, 10000, "no human commits in window")
    assert got["zero"][-1] == "no commits through last complete year"
    authors = {(r["repo"], r["name"]): (r["login"], r["commits"], r["identities"], r["is_bot"]) for r in people.authors(rows.where("year < 2030")).collect()}
    assert authors["r", "annl"] == ("annl", 14, 3, False)
    assert authors["r", "web-flow"] == ("noreply", 50, 1, True)


def test_per_active_ratios(spark):
    rows = spark.createDataFrame([(0, 10.0), (4, 10.0), (None, 10.0), (3, None)], "people_win int, loc double")
    got = [tuple(r)[2:] for r in people.workload(rows, {"loc_per": "loc"}).collect()]
    assert got == [(1, 10.0), (0, 2.5), (None, None), (0, None)]


def test_logins_in_scope(spark):
    members = spark.createDataFrame([("gh/1", " Ann "), ("gh/1", ""), ("gh/2", "bo"), ("gh/3", "ann")], "repo_id string, login string")
    scope = spark.createDataFrame([("gh/1",), ("gh/3",), ("gh/1",)], "repo_id string")
    assert [tuple(r) for r in people.logins_in_scope(members, scope).collect()] == [("ann",)]
