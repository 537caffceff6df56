"""Keyed commits, damaged lines, healing, differences and rules on small tables."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewright.operators import compare, healing, joins, rules, validation, value_rows, verdicts
from tidewright.sources import damaged, keyed
from tidewright.streaming import incremental

ROWS = StructType().add("repo", "string").add("login", "string").add("n", "integer")
STATUS = StructType().add("repo", "string").add("status", "string").add("n", "long").add("fetched_at", "string")


def state(tables):
    return sorted(map(tuple, tables.read("rows").collect()), key=str), sorted((r["repo"], r["status"], r["n"]) for r in tables.read("status").collect())


@pytest.fixture
def tables(spark, tmp_path):
    return keyed.KeyedTables(spark, f"file://{tmp_path}/fetches", "repo", {"rows": ROWS, "status": STATUS}, buckets=4)


def fetch(spark, rows):
    return spark.createDataFrame(rows, "repo string, login string, n int, failed boolean")


FIRST = [("a", "x", 1, False), ("a", "y", 2, False), ("b", "x", 3, False), ("c", None, None, False), ("d", "w", 4, False), (None, "z", 1, False)]


def test_data_and_status_move_together(spark, tables):
    assert state(tables) == ([], [])
    assert keyed.commit_fetch(tables, fetch(spark, FIRST), "failed", F.lit("t1"), stream="s", number=0)
    before = state(tables)
    assert before == ([("a", "x", 1), ("a", "y", 2), ("b", "x", 3), ("d", "w", 4)], [("a", "ok", 2), ("b", "ok", 1), ("c", "empty", 0), ("d", "ok", 1)])
    second = fetch(spark, [("a", "z", 9, False), ("b", None, None, True), ("d", None, None, False), ("e", "new", 5, False)])
    assert keyed.commit_fetch(tables, second, "failed", F.lit("t2"), stream="s", number=1)
    after = ([("a", "z", 9), ("e", "new", 5)], [("a", "ok", 1), ("b", "error", 0), ("c", "empty", 0), ("d", "empty", 0), ("e", "ok", 1)])
    assert state(tables) == after
    assert not keyed.commit_fetch(tables, second, "failed", F.lit("t3"), stream="s", number=1)  # tried again: nothing happens twice
    assert state(tables) == after and tables.committed("s") == 1 and tables.committed("other") == -1


def test_a_failure_between_the_two_writes_leaves_the_old_pair(spark, tables):
    keyed.commit_fetch(tables, fetch(spark, FIRST), "failed", F.lit("t1"), stream="s", number=0)
    before = state(tables)
    bad = spark.createDataFrame([("a", "ok", 1, "t")], STATUS).withColumn("status", F.when(F.col("n") == 1, F.raise_error(F.lit("the status table cannot be written"))).otherwise(F.col("status")))
    new = spark.createDataFrame([("a", "lost", 1)], ROWS)
    with pytest.raises(Exception, match="cannot be written"):
        tables.commit({"rows": new, "status": bad}, stream="s", batch=1)
    assert state(tables) == before and tables.committed("s") == 0
    written = glob.glob(f"{tables.root.removeprefix('file://')}/commits/*/rows/_bucket=*")
    assert len({os.path.dirname(os.path.dirname(w)) for w in written}) == 2  # the first table of the failed commit was written, but no manifest names it
    assert tables.commit({"rows": new, "status": spark.createDataFrame([("a", "ok", 1, "t")], STATUS)}, stream="s", batch=1)
    assert ("a", "lost", 1) in state(tables)[0] and tables.committed("s") == 1


def test_of_two_commits_at_once_the_later_fails(spark, tables, monkeypatch):
    keyed.commit_fetch(tables, fetch(spark, FIRST), "failed", F.lit("t1"))
    seen = tables._manifest()
    keyed.commit_fetch(tables, fetch(spark, [("a", "q", 1, False)]), "failed", F.lit("t2"))
    monkeypatch.setattr(keyed.KeyedTables, "_manifest", lambda self: seen)
    with pytest.raises(keyed.CommitConflict):
        keyed.commit_fetch(tables, fetch(spark, [("b", "q", 1, False)]), "failed", F.lit("t3"))
    monkeypatch.undo()
    assert ("a", "q", 1) in state(tables)[0] and ("b", "x", 3) in state(tables)[0]


def test_a_commit_rewrites_only_the_buckets_of_its_keys(spark, tables):
    keyed.commit_fetch(tables, fetch(spark, [(f"r{i}", "x", i, False) for i in range(40)]), "failed", F.lit("t1"))
    old = tables._manifest()[1]["tables"]["rows"]
    keyed.commit_fetch(tables, fetch(spark, [("r3", "y", 1, False)]), "failed", F.lit("t2"))
    new = tables._manifest()[1]["tables"]["rows"]
    assert sum(old[b] != new[b] for b in old) == 1 and tables.read("rows").count() == 40


def test_a_stream_in_update_mode_merges_batches_by_key(spark, tmp_path):
    kind = "k string, at int, v string"
    spark.createDataFrame([("a", 1, "old"), ("b", 1, "b1")], kind).coalesce(1).write.parquet(f"{tmp_path}/in/1")
    spark.createDataFrame([("a", 2, "new"), ("c", 1, "c1")], kind).coalesce(1).write.parquet(f"{tmp_path}/in/2")
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    got = incremental.drain(incremental.upsert_latest(stream, "k", "at", "v"), "update", "latest", "k")
    assert sorted(map(tuple, got.collect())) == [("a", "new"), ("b", "b1"), ("c", "c1")]
    with pytest.raises(ValueError, match="needs the key"):
        incremental.drain(stream, "update")


def test_damaged_lines_are_split_with_reasons(spark):
    schema = StructType().add("k", "long").add("n", "double").add("note", "string")
    lines = ["k,n,note", "1,2.5,fine", "2,,", ' 3 , 4 ,"a, b"', "4,5", "6,7,x,y", ",1,no key", "x,1,bad id", "7,many,z", "", "   ", "k,n,note", '8,9,"never ends', '9,1e3,"quoted ""q"""']
    got = damaged.split_lines(spark.createDataFrame([(x,) for x in lines], "value string"), schema, ["k"])
    assert got.good.schema == schema
    assert sorted(map(tuple, got.good.collect())) == [(1, 2.5, "fine"), (2, None, None), (3, 4.0, "a, b"), (9, 1000.0, 'quoted "q"')]
    reasons = {r["line"]: r["reason"] for r in got.rejected.collect()}
    assert reasons == {"4,5": "ragged", "6,7,x,y": "ragged", ",1,no key": "bad key", "x,1,bad id": "bad number", "7,many,z": "bad number", '8,9,"never ends': "ragged"}
    assert {tuple(r) for r in damaged.rejected_counts(got.rejected).collect()} == {("ragged", 3), ("bad key", 1), ("bad number", 2)}
    assert got.good.count() + got.rejected.count() == 10


def test_ids_are_healed_to_a_fixpoint(spark):
    current = spark.createDataFrame([("New/A", "gh/1"), ("b", "gl/salsa-2"), ("c", "gh/3"), ("moved", "gh/4"), (None, "gh/5"), ("e", "")], "slug string, repo_id string")
    renames = spark.createDataFrame([("old/a", "mid/a"), ("Mid/A", "new/a"), ("x", "y"), ("y", "x"), ("b", "elsewhere"), (None, "z")], "old string, new string")
    rows = [
        ("old/a", "99"), ("OLD/A", "gh/98"), ("b", "gh/2"), ("c", "gh/3"), ("c", "gh/33"), ("before", "gh/4"), ("gone", "gh/77"), ("x", "gh/78"), ("b", ""), (None, "gh/3"), ("e", "12"), (None, None),
    ]
    healed, report = healing.heal_ids({"t": spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "slug string, repo_id string, n int")}, current, renames)
    got = {r["n"]: (r["slug"], r["repo_id"]) for r in healed["t"].collect()}
    assert got == {
        0: ("new/a", "gh/1"), 1: ("new/a", "gh/1"), 2: ("b", "gl/salsa-2"), 3: ("c", "gh/3"), 4: ("c", "gh/33"), 5: ("moved", "gh/4"), 6: ("gone", "gh/77"), 7: ("x", "gh/78"),
        8: ("b", "gl/salsa-2"), 9: ("c", "gh/3"), 10: ("e", "gh/12"), 11: (None, ""),
    }
    done = {(r["slug"], r["action"]): r["rows"] for r in report.collect()}
    assert done["new/a", "restamped"] == 2 and done["moved", "renamed"] == 1 and done["gone", "vanished"] == 1 and done["x", "vanished"] == 1
    again, report = healing.heal_ids(healed, current, renames)
    assert {r["action"] for r in report.collect()} == {"vanished"}


def test_renames_are_followed_to_their_end(spark):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(37)] + [("p", "q"), ("q", "p"), ("p2", "p"), ("s", "t2"), ("s", "t1")]
    got = dict(map(tuple, healing.final_names(spark.createDataFrame(chain, "old string, new string")).collect()))
    assert got == {f"n{i}": "n37" for i in range(37)} | {"s": "t1"}
    assert healing.final_names(spark.createDataFrame([], "old string, new string")).count() == 0


def test_cell_differences(spark):
    kind = "k int, a string, b double"
    old = [(i, f"v{i}", float(i)) for i in range(500)] + [(7, "twice", 1.0), (None, "nul", 1.0)]
    new = [(i, f"v{i}", float(i)) for i in range(500) if i != 42] + [(7, "twice", 1.0), (None, "nul", None), (1000, "new", 0.0)]
    new[3] = (3, None, 3.0)
    a, b = spark.createDataFrame(new, kind), spark.createDataFrame(old, kind)
    got = {tuple(r) for r in compare.cell_differences(a, b, ["k"], ["a", "b"]).collect()}
    assert got == {("3", "a", None, "v3"), ("42", "stored_only", None, None), ("1000", "built_only", None, None), (None, "b", None, "1.0")}
    assert compare.unequal_buckets(a, a.repartition(7), ["k"], ["a", "b"]).count() == 0
    assert compare.unequal_buckets(a, b, ["k"], ["a", "b"]).count() == 4
    assert compare.cell_differences(a.limit(0), b.limit(0), ["k"], ["a"]).count() == 0
    swapped = spark.createDataFrame([(1, "x", "y")], "k int, a string, b string")
    assert compare.unequal_buckets(swapped, swapped.select("k", F.col("b").alias("a"), F.col("a").alias("b")), ["k"], ["a", "b"]).count() == 1


def test_rules_from_a_table(spark):
    df = spark.createDataFrame([("a", "5", "-3", "101", "2020-01-01"), ("b", "x", "2000", "50", "soon"), ("c", "", None, "0", "2024-06-01"), ("d", "nan", "0", "-1", "")], "repo string, score string, loc string, loc_p string, fetched_at string")
    given = rules.rules_table(spark, [("score", 1.0, 100.0, None, "score-range", "err"), ("loc", 0.0, 1000.0, None, "outlier", "warn"), ("*_p", 0.0, 100.0, None, "pct-range", "err"), ("*fetched_at", None, None, 90, "staleness", "info")])
    got = {tuple(r) for r in rules.anomalies(df, "repo", given, F.lit("2024-07-01").cast("timestamp")).collect()}
    assert got == {
        ("type", "err", "b", "score", "x"), ("type", "err", "d", "score", "nan"), ("negative", "err", "a", "loc", "-3"), ("outlier", "warn", "b", "loc", "2000"), ("pct-range", "err", "a", "loc_p", "101"),
        ("pct-range", "err", "d", "loc_p", "-1"), ("staleness", "info", "a", "fetched_at", "2020-01-01"), ("type", "err", "b", "fetched_at", "soon"),
    }
    zeros = spark.createDataFrame([("a", "0", "0", "0"), ("b", "0", "1", "0"), ("c", "0", "", "0")], "repo string, x string, y string, z string")
    assert [(r["key"], r["value"]) for r in rules.many_zeros(zeros, "repo", ["x", "y", "z"], 3).collect()] == [("a", "3/3")]
    lost = rules.missing_keys(spark.createDataFrame([("a",), ("q",)], "repo string"), df, "repo")
    assert [tuple(r)[:3] for r in lost.collect()] == [("coverage", "warn", "q")]
    counts = {(r["severity"], r["category"]): (r["n"], r["example"]) for r in rules.severity_counts(lost.unionByName(rules.many_zeros(zeros, "repo", ["x", "y", "z"], 3))).collect()}
    assert counts == {("warn", "coverage"): (1, "q"), ("info", "many-zeros"): (1, "a")}


def test_id_findings(spark):
    df = spark.createDataFrame([("A", "gh/1"), ("b", ""), ("out", ""), ("c", "12"), ("d", "gl/kde-4"), ("e", "gl/unheard-4"), ("f", "x/1"), ("g", "gl/3")], "repo string, repo_id string")
    got = {tuple(r) for r in rules.id_findings(df, "repo", "repo_id", spark.createDataFrame([("B",), ("a",)], "slug string")).collect()}
    assert got == {("blank", "b", ""), ("bare number", "c", "12"), ("unknown instance", "e", "gl/unheard-4"), ("shape", "f", "x/1")}


def test_ranges_hold_their_bound_whatever_the_values(spark):
    far = spark.createDataFrame([(i,) for i in range(300)] + [(2**55,), (None,), (-(2**60),)] + [(17,)] * 30, "x long")
    rows = sorted(map(tuple, verdicts.bounded_ranges(far, "x", 10).collect()))
    assert sum(r[2] for r in rows) == 332 and all(n <= 10 or (lo, hi) == (17, 18) for lo, hi, n in rows)
    assert all(a[1] <= b[0] for a, b in zip(rows, rows[1:], strict=False)) and len(rows) < 80
    assert verdicts.bounded_ranges(far.limit(0), "x", 10).count() == 0
    assert sorted(r["n"] for r in verdicts.bounded_ranges(far, "x", 1).collect())[-1] == 31


def test_an_exclusion_at_any_depth_beats_a_longer_match(spark):
    rows = spark.createDataFrame([(1, "a.b.example.org"), (2, "x.bad.org"), (3, "EXAMPLE.org"), (4, "notexample.org"), (5, None), (6, ""), (7, "a.example.net")], "n int, host string")
    given = spark.createDataFrame([("example.org", "short", False), ("b.example.org", "long", False), ("bad.org", None, True), ("x.bad.org", "never", False), ("Example.NET", "n2", False), ("example.net", "n1", None)], "domain string, label string, exclude boolean")
    got = {r["n"]: r["label"] for r in joins.match_suffix(rows, "host", given).collect()}
    assert got == {1: "long", 2: None, 3: "short", 4: None, 5: None, 6: None, 7: "n1"}


PACKAGES = "package string, ecosystem string, repo_id string, git_url string, canonical_url string, github_repo string, pagerank double"


def test_packages_collapse_to_repositories(spark):
    rows = [
        ("p1", "npm", "gh/1", "", None, "", 6.0), ("p2", "npm", "gh/1", "https://github.com/o/old.git", "https://up", "o/new", None), ("p3", "pypi", "gh/1", None, None, "o/new", 1.0),
        ("q", "npm", "gl/kde-5", "https://invent.kde.org/a/b/c.git", "https://x", "", 3.0), ("r", "crates", "", "https://sourceware.org/git/r.git", "", "who/b", 2.0), ("s", "crates", "", "https://sourceware.org/git/r.git", "", "who/a", 2.0),
        ("t", "cpp", "", "", "https://tar", "", None), ("t", "npm", "", "", "", "", 1.0),
    ]
    out = value_rows.repo_rows(spark.createDataFrame(rows, PACKAGES))
    assert out.columns == ["group_key", "repo", "platform", "repo_id", "git_url", "canonical_url", "git_valid", "ecosystems", "packages", "top_eco", "top_eco_pkg", "top_eco_pct", "pr_score", "class", "class_npm", "class_pypi", "class_crates", "class_cpp", "openssf_crit", "eco_crit", "value_score"]
    got = {r["group_key"]: r for r in out.collect()}
    a = got["gh/1"]
    assert (a["repo"], a["platform"], a["git_url"], a["canonical_url"], a["packages"], a["ecosystems"]) == ("o/new", "github", "https://github.com/o/new.git", "https://up", 3, "npm,pypi")
    assert (a["top_eco"], a["top_eco_pkg"], a["top_eco_pct"], a["class_npm"], a["class_pypi"], a["class"]) == ("npm", "p1", 40.0, "A", "C", "A")
    assert (got["gl/kde-5"]["repo"], got["gl/kde-5"]["platform"], got["gl/kde-5"]["canonical_url"]) == ("a/b/c", "gitlab", "")
    r = got["https://sourceware.org/git/r.git"]
    assert (r["repo"], r["platform"], r["top_eco_pkg"]) == ("who/a", "github", "r")
    t = got["__orphan__:cpp:t"]
    assert (t["repo"], t["platform"], t["canonical_url"], t["pr_score"], t["top_eco_pct"], t["class"]) == ("", "", "https://tar", None, 100.0, "A")
    assert value_rows.repo_rows(spark.createDataFrame([], PACKAGES)).count() == 0


def test_overrides_of_identity(spark):
    rows = [("p", "npm", "gl/5", "https://gitlab.com/lib/tiff", None, "", 1.0), ("q", "npm", "gl/salsa-6", "https://salsa.debian.org/x/gettext", None, "", 1.0), ("r", "npm", "gh/7", "https://github.com/w/r", None, "w/r", 1.0), ("s", "npm", "gl/8", "https://gitlab.com/a/s", None, "", 1.0), ("u", "npm", "gh/9", "https://github.com/w/u", None, "w/u", 1.0)]
    packages = spark.createDataFrame(rows, PACKAGES)
    kinds = "package string, ecosystem string, repo string, git_url string, canonical_url string, valid string, reason string"
    given = [("p", "npm", "", "https://gitlab.com/Lib/tiff.git", "", "", "same"), ("q", "npm", "", "https://git.savannah.gnu.org/git/gettext.git", "", "", "moved"), ("r", "npm", "Right/R", "https://sourceware.org/r.git", "", "", "wrong"), ("s", "npm", "now/s", "", "", "", "wrong"), ("u", "npm", "x/y", "", "", "", "  ")]
    out = value_rows.override_identity(value_rows.repo_rows(packages), packages, spark.createDataFrame(given, kinds))
    got = {r["group_key"]: (r["platform"], r["repo"], r["repo_id"], r["git_url"], r["canonical_url"]) for r in out.collect()}
    assert got == {
        "gl/5": ("gitlab", "lib/tiff", "gl/5", "https://gitlab.com/lib/tiff.git", ""), "gl/salsa-6": ("custom", "git/gettext", "", "https://git.savannah.gnu.org/git/gettext.git", ""),
        "gh/7": ("github", "right/r", "gh/7", "https://github.com/right/r.git", "https://sourceware.org/r.git"), "gl/8": ("github", "now/s", "", "https://github.com/now/s.git", ""), "gh/9": ("github", "w/u", "gh/9", "https://github.com/w/u.git", ""),
    }


def test_marginals_tell_a_total_from_a_blank(spark):
    rows = spark.createDataFrame([("A", "x", 1), ("A", None, 2), ("B", "x", 3)], "c string, e string, n int")
    got = {tuple(r) for r in value_rows.marginals(rows, ["c", "e"], {"n": F.sum("n")}).collect()}
    assert got == {(0, "A", "x", 1), (0, "A", "", 2), (0, "B", "x", 3), (1, "A", None, 3), (1, "B", None, 3), (2, None, "x", 4), (2, None, "", 2), (3, None, None, 6)}


def test_validation_gate_names_what_is_missing(spark):
    hub = spark.createDataFrame([("o/a", "o/new", "True", "2024"), ("o/b", "o/b", "False", "2024")], "repo string, full_name string, valid string, fetched_at string")
    urls = spark.createDataFrame([("https://codeberg.org/x/y.git", "true", "2024")], "url string, valid string, checked_at string")
    pins = spark.createDataFrame([("O/B", "", "True"), ("", "", "False")], "repo string, git_url string, valid string")
    checked = validation.verdicts(hub, urls, pins)
    rows = spark.createDataFrame([("github", "O/New", "", ""), ("github", "o/b", "", ""), ("custom", "y", "https://codeberg.org/x/y.git", ""), ("", "", "", ""), ("gitlab", "g", "https://codeberg.org/x/y.git", "gl/4")], "platform string, repo string, git_url string, repo_id string")
    got = {r["repo"]: r["git_valid"] for r in validation.validate(rows, checked).collect()}
    assert got == {"O/New": True, "o/b": True, "y": True, "": False, "g": True}
    more = rows.unionByName(spark.createDataFrame([("github", "o/unknown", "", "")], rows.schema))
    with pytest.raises(ValueError, match=r"1 targets have no verdict, among them o/unknown \[github_repo\]"):
        validation.validate(more, checked)
