"""Links, funding files and work lists on odd values."""

import pytest
from pyspark.sql import functions as F

from tidewright.functions import channels
from tidewright.operators import scopes


def values(spark, f, cells, kind="string"):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {kind}").orderBy("i").select(f(F.col("c")).alias("v")).collect()
    return [tuple(r["v"]) if isinstance(r["v"], tuple) else r["v"] for r in rows]


def test_github_and_gitlab_links(spark):
    cells = ["https://github.com/a?q=x", "https://github.com/A/B.git", "github.com/a_b", "https://github.com/orgs/x", "https://gitlab.com/a/b", "", None]
    assert values(spark, channels.github_owner_repo, cells) == [("", ""), ("a", "b"), ("a_b", ""), ("", ""), ("", ""), ("", ""), ("", "")]
    cells = ["https://www.GitLab.com/a/b/c.git/", "salsa.debian.org/x/y/-/tree/z", "https://gitlab.com/a", "https://gitlab.com/users/a", "https://github.com/a/b", " ", None]
    assert values(spark, channels.gitlab_project, cells) == ["gitlab.com/a/b/c", "salsa.debian.org/x/y", "", "", "", "", ""]
    assert values(spark, channels.owner_page, ["https://github.com/Org/", "https://github.com/a/b", "https://github.com/sponsors", "https://github.com/x?y#z", None]) == ["org", "", "", "x", ""]
    assert values(spark, channels.host_path, ["HTTPS://GitLab.com/a/B.git/", "git://x/y", None]) == ["gitlab.com/a/b", "x/y", ""]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (None, []), ("", []), ("github: a", ["github"]), ("github:\n", []), ("github:\n- a", ["github"]), ("github:\n\n  # c\n  - a", ["github"]), ("github: []\nko_fi: null", []),
        ("other: x\n  - github", []), ("patreon:\nx: y\n- z", []), ("github: [a] # patreon: b\r\ncustom: ['x']", ["custom", "github"]), ("Github: a", []), ("  github: a", []),
    ],
)
def test_funding_file(spark, text, want):
    assert values(spark, channels.funding_file_platforms, [text]) == [want]


def test_funding_field(spark):
    assert values(spark, channels.funding_field, ['"u"', '{"url": " u "}', '{"type": "x"}', '["u", "v"]', '[{"url": "u"}]', '[{"type": "x"}]', "[]", "", None]) == ["u", "u", "", "u", "u", "", "", "", ""]


def test_budgets_and_scopes(spark):
    accounts = spark.createDataFrame([("a", '{"currency": "X", "stats": {"y2021": {"valueInCents": 250}, "y2022": {"valueInCents": 300, "currency": "Y"}}}'), ("b", None), ("c", "{}")], "slug string, json string")
    got = {r["slug"]: tuple(r)[1:] for r in scopes.yearly_budgets(accounts, "slug", [2021, 2022]).collect()}
    assert got == {"a": ("ok", "2.50", "3", "Y"), "b": ("not_found", "", "", ""), "c": ("ok", "", "", "")}
    issues = spark.createDataFrame([("r", "2021-05-01", None), ("r", "2020-05-01", "2022-01-01"), ("cut", "2021-01-01", None)], "k string, created string, closed string").withColumns({c: F.to_timestamp(c) for c in ("created", "closed")})
    targets = spark.createDataFrame([("r", True), ("quiet", True), ("cut", False), ("new", None)], "k string, complete boolean")
    got = sorted(map(tuple, scopes.issue_years(targets, issues, "k", [2021, 2022]).collect()))
    assert got == [("quiet", 2021, 0, 0), ("quiet", 2022, 0, 0), ("r", 2021, 1, 0), ("r", 2022, 0, 1)]
    none = scopes.composite_score(spark.createDataFrame([(1, None, 2.0), (2, 5.0, 1.0), (3, 6.0, 3.0)], "k int, a double, b double"), {"a": "high", "b": "high"}, "s", lambda a, b: a - b, {"a": 50.0})
    assert {r["k"]: (r["a_p"], r["s"]) for r in none.collect()} == {1: (50.0, 1.0), 2: (50.0, 16.67), 3: (100.0, 1.0)}
