"""Declared links, funding channels, work lists and yearly service measures over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions import channels as C
from tidewright.functions import numbers as N
from tidewright.operators import scopes as S
from tidewright.queries.registry import query, table


def _by(number: Column, *choices: Column | str | None) -> Column:
    """The choice at number modulo their count."""
    which = F.pmod(number, F.lit(len(choices)))
    out = F.lit(None).cast("string")
    for i, c in enumerate(choices):
        out = F.when(which == i, c if isinstance(c, Column) else F.lit(c)).otherwise(out)
    return out


def _nation() -> Column:
    return F.col("c_nationkey")


def _n() -> Column:
    return F.col("c_nationkey").cast("string")


@query("SELECT page_id, regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '/+$', ''), '^(https?|git)://', ''), '\\.git$', '') AS path FROM pages")
def host_paths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", C.host_path(F.col("url")).alias("path"))


@query("SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN 'org' || c_nationkey ELSE '' END AS org, CASE WHEN c_nationkey % 4 = 1 THEN 'org/r' || c_nationkey ELSE '' END AS slug FROM customer")
def owner_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of an owner, of a repository, under a reserved name and of another host."""
    c = table(spark, d, "customer")
    url = _by(_nation(), F.concat(F.lit("https://GitHub.com/Org"), _n(), F.lit("/?tab=x")), F.concat(F.lit("https://github.com/Org/R"), _n(), F.lit(".git")), "https://github.com/sponsors", "https://example.org/x")
    found = C.github_owner_repo(url)
    return c.select("c_custkey", C.owner_page(url).alias("org"), F.when(found["repo"] != "", F.concat_ws("/", found["owner"], found["repo"])).otherwise("").alias("slug"))


@query("""
SELECT c_custkey, CASE WHEN c_nationkey % 4 = 1 THEN 'owner' || c_nationkey WHEN c_mktsegment = 'BUILDING' THEN 'org' || c_nationkey ELSE '' END AS owner, CASE WHEN c_nationkey % 4 = 1 THEN 'repo' ELSE '' END AS repo,
CASE WHEN c_nationkey % 4 = 3 THEN 'gitlab.com/grp/sub' || c_nationkey ELSE 'salsa.debian.org/team/' || lower(c_mktsegment) END AS gitlab, (2 + (c_mktsegment = 'BUILDING')::INT + (c_nationkey % 4 <> 2)::INT)::INT AS links FROM customer
""")
def declared_links(spark: SparkSession, d: str) -> DataFrame:
    """A search page, a repository, nothing and a project's subpage as the first link; sponsor pages name no owner."""
    c = table(spark, d, "customer")
    repository = _by(_nation(), "https://github.com/apache?q=x", F.concat(F.lit(" https://GitHub.com/Owner"), _n(), F.lit("/Repo.git")), None, F.concat(F.lit("https://gitlab.com/grp/sub"), _n(), F.lit("/-/tree/x")))
    social = lambda kind, url: F.struct(F.lit(kind).alias("type"), url.alias("url"))
    socials = F.array(social("WEBSITE", F.lit("https://github.com/sponsors/a")), social("GITHUB", F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("https://github.com/org"), _n())).otherwise(" ")))
    website = F.concat(F.lit("https://salsa.debian.org/team/"), F.col("c_mktsegment"), F.lit(".git"))
    links, github = C.declared_links(repository, socials, website), C.best_github(repository, socials, website)
    return c.select("c_custkey", github["owner"].alias("owner"), github["repo"].alias("repo"), C.best_gitlab(links).alias("gitlab"), F.size(links).alias("links"))


@query("""
SELECT c_custkey, CASE c_nationkey % 3 WHEN 0 THEN 'patreon,bank' WHEN 1 THEN 'custom,bank' ELSE 'bank,ko_fi' END AS platforms, CASE c_nationkey % 3 WHEN 0 THEN 'patreon:me' || c_nationkey || ',patreon:you' WHEN 1 THEN 'custom:https://x.org/' || c_nationkey ELSE 'ko_fi:k' END AS handles FROM customer
""")
def channel_platforms(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    channel = lambda kind, url: F.struct(F.lit(kind).alias("type"), url.cast("string").alias("address"))
    first = channel("other", _by(_nation(), F.concat(F.lit("https://patreon.com/Me"), _n()), F.concat(F.lit("https://x.org/"), _n()), " "))
    last = channel(" ", _by(_nation(), "https://www.patreon.com/you", None, "https://ko-fi.com/K?x"))
    bank = channel("bank", F.lit(None))
    found = C.channel_platforms(F.when(_nation() % 3 == 2, F.array(bank, last)).otherwise(F.array(first, last, bank)))
    return c.select("c_custkey", F.array_join(found["platforms"], ",").alias("platforms"), F.array_join(F.transform(found["handles"], lambda h: F.concat_ws(":", h["platform"], h["handle"])), ",").alias("handles"))


@query("""
SELECT c_custkey, CASE c_nationkey % 3 WHEN 0 THEN 'custom,patreon' WHEN 1 THEN 'custom' ELSE '' END AS platforms, CASE c_nationkey % 3 WHEN 0 THEN 'https://patreon.com/a' WHEN 1 THEN 'https://x.org/give' ELSE '' END AS first,
CASE c_nationkey % 5 WHEN 0 THEN 'https://a.org/' || c_nationkey WHEN 1 THEN 'https://b.org' WHEN 2 THEN 'https://c.org' WHEN 3 THEN 'https://d.org' ELSE '' END AS field FROM customer
""")
def funding_fields(spark: SparkSession, d: str) -> DataFrame:
    """Named links, and a field that is a string, an object, a list of objects, a list of strings, or empty."""
    c = table(spark, d, "customer")
    pair = lambda *kv: F.create_map(*map(F.lit, kv))
    links = F.when(_nation() % 3 == 0, pair("Home", "https://a.org", "Support", "https://patreon.com/a", "Donate here", "https://x.org")).when(_nation() % 3 == 1, pair("Home", "https://a.org", "Giveaway", " https://x.org/give")).otherwise(pair("Home", "https://a.org"))
    field = _by(_nation(), F.concat(F.lit('"https://a.org/'), _n(), F.lit('"')), '{"type": "x", "url": " https://b.org"}', '[{"url": "https://c.org"}, "y"]', '["https://d.org", {"url": "z"}]', "[]")
    found = C.funding_links(links)
    return c.select("c_custkey", F.array_join(found["platforms"], ",").alias("platforms"), found["first"].alias("first"), C.funding_field(field).alias("field"))


@query("SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN 'custom,github' WHEN 1 THEN 'ko_fi' WHEN 2 THEN 'custom,liberapay,patreon' ELSE '' END AS platforms FROM customer")
def funding_files(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    text = _by(_nation(), "# funds\ngithub: [a, b] # us\n\ncustom:\n  # none yet\n  - https://x.org\n  - y\npatreon:\n", "ko_fi: me\r\npatreon: []\r\nother: x\r\n", "patreon: a\nliberapay:\n- b\n\tgithub: c\ncustom: https://x\ntidelift: ~\n", None)
    return c.select("c_custkey", F.array_join(C.funding_file_platforms(text), ",").alias("platforms"))


@query("""
SELECT 'class' AS list, count(*)::BIGINT AS n FROM part WHERE p_brand IN ('Brand#11', 'Brand#12', 'Brand#13') UNION ALL SELECT 'no address', count(*) FROM part WHERE p_size > 10 AND p_retailprice <= 910
UNION ALL SELECT 'no address, real', count(*) FROM part WHERE p_size > 10 AND p_retailprice <= 910 AND p_type NOT LIKE 'P%'
""")
def candidate_lists(spark: SparkSession, d: str) -> DataFrame:
    """Packages by class, packages without an address, and those of them that are no pseudo-packages."""
    rows = table(spark, d, "part").select(F.col("p_name").alias("package"), F.col("p_brand").alias("value_class"), F.when(F.col("p_size") <= 10, "o/r").otherwise(" ").alias("github"), F.when(F.col("p_retailprice") > 910, "x").alias("git"), "p_type")
    lists = {"class": S.candidates(rows, classes=["Brand#11", "Brand#12", "Brand#13"]), "no address": S.candidates(rows, without=("github", "git")), "no address, real": S.candidates(rows, without=("github", "git"), exclude=F.col("p_type").startswith("P"))}
    counts = [df.agg(F.lit(name).alias("list"), F.count("*").alias("n")) for name, df in lists.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("""
WITH v AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'https://github.com/o/r' || p_size ELSE 'https://x.org/' || upper(p_brand) END AS url, p_brand AS class, CASE WHEN p_size % 2 = 0 THEN 'npm' ELSE 'pypi' END AS ecosystem, p_name AS package FROM part WHERE p_brand <> 'Brand#11' AND p_size % 5 <> 0)
SELECT url, class, ecosystem, CASE ecosystem WHEN 'npm' THEN 'npmjs.org' ELSE 'pypi.org' END AS registry, CASE url WHEN 'https://github.com/o/r3' THEN 'three' ELSE package END AS package FROM v QUALIFY row_number() OVER (PARTITION BY lower(url) ORDER BY p_partkey) = 1
""")
def scoped_repos(spark: SparkSession, d: str) -> DataFrame:
    p, size = table(spark, d, "part"), F.col("p_size")
    eco = F.when(size % 5 == 0, "hex").when(size % 2 == 0, "npm").otherwise("pypi")
    rows = p.select("p_partkey", F.concat(F.lit("o/r"), size.cast("string")).alias("repo"), F.lit("GitHub").alias("platform"), F.when(size % 3 == 0, " ").otherwise(F.concat(F.lit("https://x.org/"), F.upper("p_brand"), F.lit(".git"))).alias("git_url"), F.col("p_brand").alias("class"), eco.alias("top_eco"), F.col("p_name").alias("top_eco_pkg"))
    brands = [f"Brand#{n}" for n in range(1, 26) if n != 11]
    return S.scoped_repos(rows, {"npm": "npmjs.org", "pypi": "pypi.org"}, F.col("p_partkey"), brands, {"https://github.com/o/r3": "three"})


@query("""
WITH i AS (SELECT o_custkey AS cust, o_orderdate AS created, CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 400 DAY END AS closed FROM orders)
SELECT c_custkey AS cust, y::INT AS year, coalesce(opened, 0)::BIGINT AS opened, coalesce(closed, 0)::BIGINT AS closed FROM (SELECT c_custkey FROM customer WHERE c_acctbal > 0) k CROSS JOIN range(1996, 1999) t(y)
LEFT JOIN (SELECT cust AS c1, year(created) AS y1, count(*) AS opened FROM i GROUP BY 1, 2) a ON c1 = c_custkey AND y1 = y LEFT JOIN (SELECT cust AS c2, year(closed) AS y2, count(*) AS closed FROM i GROUP BY 1, 2) b ON c2 = c_custkey AND y2 = y
""")
def issue_years(spark: SparkSession, d: str) -> DataFrame:
    """Opened and closed by the year of either date; targets whose listing was cut short have no rows."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("cust"), F.col("o_orderdate").alias("created"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL 400 DAY")).alias("closed"))
    targets = table(spark, d, "customer").select(F.col("c_custkey").alias("cust"), (F.col("c_acctbal") > 0).alias("complete"))
    return S.issue_years(targets, o, "cust", [1996, 1997, 1998])


@query("""
SELECT c_custkey, CASE WHEN c_nationkey % 4 = 3 THEN 'not_found' ELSE 'ok' END AS status, CASE WHEN c_nationkey % 4 = 3 THEN '' ELSE c_custkey::VARCHAR END AS raised_2021, CASE WHEN c_nationkey % 4 = 0 THEN c_custkey || '.05' ELSE '' END AS raised_2022,
CASE c_nationkey % 4 WHEN 3 THEN '' WHEN 0 THEN 'EUR' ELSE 'USD' END AS currency FROM customer
""")
def yearly_budgets(spark: SparkSession, d: str) -> DataFrame:
    key = (F.col("c_custkey") * 100).cast("string")
    second = F.when(_nation() % 4 == 0, F.concat(F.lit('{"valueInCents": '), (F.col("c_custkey") * 100 + 5).cast("string"), F.lit(', "currency": "EUR"}'))).otherwise("null")
    json = F.concat(F.lit('{"currency": "GBP", "stats": {"y2021": {"valueInCents": '), key, F.lit(', "currency": "USD"}, "y2022": '), second, F.lit("}}"))
    return S.yearly_budgets(table(spark, d, "customer").select("c_custkey", F.when(_nation() % 4 != 3, json).alias("json")), "c_custkey", [2021, 2022])


@query("""
WITH v AS (SELECT p_partkey, CASE WHEN p_size % 4 <> 0 THEN p_size END AS a, p_retailprice AS b FROM part),
p AS (SELECT p_partkey, CASE WHEN a IS NOT NULL THEN round(100 * cume_dist() OVER (PARTITION BY a IS NULL ORDER BY a DESC), 2) END AS a_p, round(100 * cume_dist() OVER (ORDER BY b), 2) AS b_p FROM v)
SELECT p_partkey, a_p, b_p, CASE WHEN a_p IS NOT NULL THEN round(greatest(1, a_p, b_p), 2) END AS worst FROM p
""")
def worst_composite(spark: SparkSession, d: str) -> DataFrame:
    """The worst percentile in place of their mean; none where one is missing."""
    v = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 4 != 0, F.col("p_size")).alias("a"), F.col("p_retailprice").alias("b"))
    return S.composite_score(v, {"a": "low", "b": "high"}, "worst", N.worst_of).select("p_partkey", "a_p", "b_p", "worst")
