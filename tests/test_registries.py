"""Registry names, pages, addresses and sets on small tables."""

from pyspark.sql import functions as F

from tidewright.operators import health, identity, joins, registries


def test_last_page(spark):
    links = [
        ('<https://a/x?page=9>; rel="last"', 9), ('<https://a/x?page=1>; rel="first", <https://a/x?per_page=5&page=12>; rel="last"', 12), ('<https://a/x?page=3>; rel="next"', None),
        ('<https://a/x?per_page=5>; rel="last"', None), ('<https://a/x?page=many>; rel="last"', None), ("", None), (None, None), ('<https://a/x?page=99999999999>; rel="last"', None),
    ]
    got = spark.createDataFrame(links, "link string, want int").select(registries.last_page(F.col("link")).alias("got"), "want").collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_injection_follows_its_own_order_of_platforms(spark):
    results = spark.createDataFrame([("a", "old"), ("b", "old"), ("c", "old")], "package string, git string")
    addresses = spark.createDataFrame([("a", "", None, "bb", "", "cb", ""), ("a", "", "gl", "", "", "", ""), ("b", None, None, None, None, " ", "")], "package string, github string, gitlab string, bitbucket string, sourcehut string, codeberg string, custom string")
    assert {r["package"]: r["git"] for r in registries.inject(results, addresses).collect()} == {"a": "bb", "b": "", "c": ""}


def test_names_of_binaries(spark):
    metadata = spark.createDataFrame([("libssl3t64", "openssl"), ("libcurl3t64-gnutls", "curl"), ("libcurl3-gnutls", "older"), ("libxt64", "x"), ("tool", ""), ("dup", "b"), ("dup", "a")], "package string, source string")
    aliases = spark.createDataFrame([("oldssl", "libssl3t64"), ("libz1t64", "dup"), ("dup", "libssl3t64"), ("lost", "nowhere")], "old string, current string")
    got = dict(map(tuple, registries.sources_of_binaries(metadata, aliases).collect()))
    assert got == {"libssl3t64": "openssl", "libssl3": "openssl", "libcurl3t64-gnutls": "curl", "libcurl3-gnutls": "older", "libxt64": "x", "dup": "a", "oldssl": "openssl", "libz1t64": "a", "libz1": "a"}


def test_two_registries_by_project(spark):
    kind = "project string, package string, downloads int, github_repo string, cpp boolean"
    debian = spark.createDataFrame([("p", "b", 5, "o/b", None), ("p", "a", 9, "", True), ("q", "c", 1, "", False)], kind)
    homebrew = spark.createDataFrame([("p", "h", 2, "o/h", None), ("r", "i", 3, "o/i", None)], kind)
    got = {r["project"]: tuple(r)[1:] for r in registries.combine_projects(debian, homebrew).collect()}
    assert got == {"p": (9, 2, 9 * 1.39 + 2, True, "o/b", "a|b", "h"), "q": (1, 0, 1.39, False, "", "c", ""), "r": (0, 3, 3.0, False, "o/i", "", "i")}


def test_sets_by_key_count_nulls_as_equal(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (1, None), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (1, None), (3, "z")], "k int, v string")
    assert {tuple(r) for r in joins.sets_by_key(a, b, ["k", "v"]).collect()} == {(1, "x", "both"), (1, None, "both"), (2, "y", "first"), (3, "z", "second")}


def test_gate_of_filled_cells(spark):
    df = spark.createDataFrame([("g", "1"), ("g", " "), ("x", None), (None, "")], "p string, v string")
    assert [tuple(r) for r in health.filled(df, F.col("p") == "g", "v", "v").collect()] == [("filled: v", False, "1 of 2 rows blank")]
    assert [tuple(r)[1] for r in health.filled(df.limit(0), F.lit(True), "v", "v").collect()] == [True]


def test_repeated_renames_and_names_are_settled_by_a_stated_order(spark):
    rows = spark.createDataFrame([("", "o/a"), ("", ""), (None, None)], "git string, slug string")
    renames = spark.createDataFrame([("o/a", "o/z"), ("O/A", "o/b"), (None, "o/q")], "old string, new string")
    repos = spark.createDataFrame([("O/B", 9, True, "up9"), ("o/b", 4, True, "up4"), ("o/b", 1, False, "no")], "full_name string, number long, valid boolean, upstream string")
    got = sorted((r["repo_id"], r["upstream"]) for r in identity.stamp_github(rows, renames, repos).collect())
    assert got == [("", ""), ("", ""), ("gh/4", "up4")]
