"""Identity, end of life, budgets, freshness, links and health checks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions import funding
from tidewright.operators import health, identity, verdicts
from tidewright.queries.registry import query, table

OWNER = "lower(replace(p_brand, '#', ''))"


def owner() -> Column:
    return F.lower(F.regexp_replace("p_brand", "#", ""))


def parts(spark: SparkSession, d: str) -> DataFrame:
    """Packages with addresses of several kinds."""
    hub = F.concat(F.lit("https://github.com/"), F.when(F.col("p_size") % 7 == 0, "sponsors").otherwise(owner()), F.lit("/r"), F.col("p_size").cast("string"))
    lab = F.concat(F.lit("https://gitlab.com/g/"), owner(), F.lit("/p"), F.col("p_size").cast("string"), F.lit(".git"))
    return table(spark, d, "part").select("p_partkey", "p_size", "p_type", "p_name", owner().alias("owner"), hub.alias("hub"), lab.alias("lab"))


PARTS = f"parts AS (SELECT p_partkey, p_size, p_type, p_name, {OWNER} AS owner, 'https://github.com/' || CASE WHEN p_size % 7 = 0 THEN 'sponsors' ELSE {OWNER} END || '/r' || p_size AS hub, 'https://gitlab.com/g/' || {OWNER} || '/p' || p_size || '.git' AS lab FROM part)"


def bad_addresses(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = parts(spark, d)
    return rows.where("p_type = 'PROMO'").select(F.col("lab").alias("url")), rows.where("p_size > 40").select(F.concat("owner", F.lit("/R"), F.col("p_size").cast("string")).alias("slug"))


BAD = PARTS + ", bad_url AS (SELECT DISTINCT lab AS url FROM parts WHERE p_type = 'PROMO'), bad_slug AS (SELECT DISTINCT owner || '/r' || p_size AS slug FROM parts WHERE p_size > 40)"


@query(f"WITH {PARTS} SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN '' ELSE owner || '/r' || p_size END AS slug FROM parts")
def github_slugs(spark: SparkSession, d: str) -> DataFrame:
    return parts(spark, d).select("p_partkey", funding.github_repo(F.concat("hub", F.lit(".git"))).alias("slug"))


@query(f"WITH {BAD} SELECT p_partkey, lab IN (SELECT url FROM bad_url) AS lab_invalid, p_size % 7 <> 0 AND owner || '/r' || p_size IN (SELECT slug FROM bad_slug) AS hub_invalid FROM parts")
def known_invalid(spark: SparkSession, d: str) -> DataFrame:
    urls, slugs = bad_addresses(spark, d)
    rows = identity.mark_invalid(identity.mark_invalid(parts(spark, d), "lab", urls, slugs, "lab_invalid"), "hub", urls, slugs, "hub_invalid")
    return rows.select("p_partkey", "lab_invalid", "hub_invalid")


@query(f"""
WITH {BAD}, x AS (SELECT *, lab IN (SELECT url FROM bad_url) AS li, p_size % 7 <> 0 AND owner || '/r' || p_size IN (SELECT slug FROM bad_slug) AS hi,
 CASE WHEN p_name LIKE 'red%' THEN 'fix/me' ELSE '' END AS fs, CASE WHEN p_name LIKE 'small%' THEN 'https://codeberg.org/a/b' ELSE '' END AS fg, CASE WHEN p_name LIKE 'large%' THEN 'https://example.org/x' ELSE '' END AS fp FROM parts),
y AS (SELECT *, CASE WHEN p_type = 'ECONOMY' THEN lower(hub) || '.git' END AS strong_hub, 'https://github.com/old/' || owner || '.git' AS weak_hub FROM x),
z AS (SELECT *, coalesce(CASE WHEN strong_hub IS NOT NULL AND NOT hi THEN strong_hub END, weak_hub) AS hub_pick, CASE WHEN strong_hub IS NOT NULL AND NOT hi THEN 'eco_strong' ELSE 'eco_weak' END AS hub_via FROM y)
SELECT p_partkey,
 CASE WHEN fs <> '' THEN 'https://github.com/fix/me.git' WHEN fg <> '' THEN 'https://codeberg.org/a/b.git' WHEN fp <> '' THEN '' ELSE hub_pick END AS git,
 CASE WHEN fs <> '' THEN 'fix/me' WHEN fg <> '' OR fp <> '' THEN '' WHEN hub_via = 'eco_strong' THEN CASE WHEN p_size % 7 = 0 THEN '' ELSE owner || '/r' || p_size END ELSE 'old/' || owner END AS github,
 CASE WHEN fs <> '' OR fg <> '' THEN 'override' WHEN fp <> '' THEN '' ELSE hub_via END AS via FROM z
""")
def authority_chain(spark: SparkSession, d: str) -> DataFrame:
    """Strong addresses on GitHub, prior ones on GitLab, weak ones on GitHub, and what people have fixed."""
    fixed = {"fixed_slug": ("red%", "fix/me"), "fixed_git": ("small%", "https://codeberg.org/a/b"), "fixed_page": ("large%", "https://example.org/x")}
    rows = parts(spark, d).withColumns({c: F.when(F.col("p_name").like(like), value) for c, (like, value) in fixed.items()})
    weak = F.array(F.concat(F.lit("https://github.com/old/"), "owner"))
    rows = rows.withColumns({"strong": F.when(F.col("p_type") == "ECONOMY", F.array("hub")), "weak": weak, "prior_git": F.col("lab"), "prior_slug": F.lit("")})
    return identity.resolve_authority(rows, "p_partkey", *bad_addresses(spark, d))


@query(f"""
WITH {PARTS}, known AS (SELECT DISTINCT 'O' || owner || '/r' || p_size AS full_name, min(p_partkey) OVER (PARTITION BY owner, p_size) AS number, p_type FROM parts WHERE p_size <= 25)
SELECT p_partkey, CASE WHEN p_size % 7 = 0 OR p_size > 25 THEN '' ELSE 'gh/' || min(p_partkey) OVER (PARTITION BY owner, p_size) END AS repo_id,
 CASE WHEN p_size % 7 = 0 THEN hub WHEN p_size > 25 THEN 'https://github.com/' || owner || '/r' || p_size || '.git' ELSE 'https://github.com/O' || owner || '/r' || p_size || '.git' END AS git FROM parts
""")
def github_stamp(spark: SparkSession, d: str) -> DataFrame:
    """All names up to size 25 have moved to another owner, under which they are known."""
    rows = parts(spark, d)
    names = rows.where("p_size <= 25").groupBy("owner", "p_size").agg(F.min("p_partkey").alias("number"))
    slug = F.concat("owner", F.lit("/r"), F.col("p_size").cast("string"))
    renames = names.select(slug.alias("old"), F.concat(F.lit("o"), slug).alias("new"))
    repos = names.select(F.concat(F.lit("O"), slug).alias("full_name"), "number", F.lit(True).alias("valid"), F.lit(None).cast("string").alias("upstream"))
    stamped = identity.stamp_github(rows.select("p_partkey", F.col("hub").alias("git"), F.lit("").alias("slug")), renames, repos)
    return stamped.select("p_partkey", "repo_id", "git")


@query(f"""
WITH {PARTS} SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'gh/1' WHEN p_size <= 30 THEN 'gl/' || min(p_partkey) OVER (PARTITION BY owner, p_size) ELSE '' END AS repo_id FROM parts
""")
def gitlab_stamp(spark: SparkSession, d: str) -> DataFrame:
    """Where no GitHub id is; projects are asked for under an alias."""
    rows = parts(spark, d)
    known = rows.groupBy("owner", "p_size").agg(F.min("p_partkey").alias("n"))
    alias = F.concat(F.lit("other/x|gitlab.com/G/"), "owner", F.lit("/p"), F.col("p_size").cast("string"))
    projects = known.select(F.concat(F.lit("gitlab.com/new/"), F.col("n").cast("string")).alias("project"), F.lit("gitlab.com").alias("host"), F.concat(F.lit("new/"), F.col("n").cast("string")).alias("path"), alias.alias("aliases"), (F.col("p_size") <= 30).alias("valid"), F.concat(F.lit("gl/"), F.col("n").cast("string")).alias("repo_id"))
    projects = projects.withColumn("aliases", F.regexp_replace("aliases", "other/x", F.concat(F.lit("other/"), F.col("path"))))
    return identity.stamp_gitlab(rows.select("p_partkey", F.col("lab").alias("git"), F.when(F.col("p_size") % 2 == 0, "gh/1").otherwise("").alias("repo_id")), projects).select("p_partkey", "repo_id")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'value/' || s_suppkey WHEN s_suppkey % 3 = 1 THEN 'repos/' || s_suppkey WHEN s_nationkey > 12 THEN 'disk/' || s_suppkey ELSE '' END AS repo_id FROM supplier")
def backfill_precedence(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").withColumns({"old": F.concat(F.lit("Old/"), F.col("s_suppkey").cast("string")), "slug": F.concat(F.lit("new/"), F.col("s_suppkey").cast("string"))})
    layer = lambda name, rows: rows.select("slug", F.concat(F.lit(f"{name}/"), F.col("s_suppkey").cast("string")).alias("repo_id"))
    layers = [layer("value", s.where("s_suppkey % 3 = 0")), layer("repos", s.where("s_suppkey % 3 < 2")), layer("disk", s.where("s_nationkey > 12"))]
    renames = s.select("old", F.col("slug").alias("new"))
    return identity.backfill_ids(s.select("s_suppkey", "old"), "old", renames, layers).select("s_suppkey", "repo_id")


@query("""
WITH f AS (SELECT p_brand AS project, p_partkey::VARCHAR AS formula, p_size > 35 AS disabled, p_size > 2 AS deprecated FROM part),
g AS (SELECT project, bool_and(disabled OR deprecated) AS over, bool_or(disabled) AS hard, string_agg(formula || ': ' || CASE WHEN disabled THEN 'gone' ELSE 'deprecated' END, '; ' ORDER BY formula || ': ' || CASE WHEN disabled THEN 'gone' ELSE 'deprecated' END) AS why FROM f GROUP BY 1)
SELECT project, over AS is_eol, CASE WHEN NOT over THEN '' WHEN hard THEN 'homebrew_disabled' ELSE 'homebrew_deprecated' END AS method, CASE WHEN over THEN left(why, 500) ELSE '' END AS reason FROM g
""")
def formula_eol(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    formula = F.col("p_partkey").cast("string").alias("formula")
    facts = p.select(formula, (F.col("p_size") > 35).alias("disabled"), (F.col("p_size") > 2).alias("deprecated"), F.lit("gone").alias("disable_reason"), F.lit(None).cast("string").alias("deprecation_reason"))
    return verdicts.formula_eol(p.select(F.col("p_brand").alias("project"), formula), facts)


@query("""
WITH c AS (SELECT o_custkey AS product, CASE WHEN o_orderstatus = 'P' AND o_custkey % 2 = 0 THEN 'false' WHEN o_orderpriority LIKE '4%' THEN 'true' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS eol FROM orders),
g AS (SELECT product, bool_or(eol = 'false') AS open, max(try_cast(eol AS DATE)) AS last FROM c GROUP BY 1)
SELECT product, NOT open AND coalesce(last < DATE '1999-01-01', false) AS is_eol, CASE WHEN open THEN 'at least one cycle has eol=false' WHEN last IS NULL THEN 'no parseable eol dates' ELSE 'max eol=' || strftime(last, '%Y-%m-%d') || CASE WHEN last < DATE '1999-01-01' THEN ' < today' ELSE '' END END AS reason FROM g
""")
def cycles_eol(spark: SparkSession, d: str) -> DataFrame:
    eol = F.when((F.col("o_orderstatus") == "P") & (F.col("o_custkey") % 2 == 0), "false").when(F.col("o_orderpriority").startswith("4"), "true").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return verdicts.cycles_eol(table(spark, d, "orders").select(F.col("o_custkey").alias("product"), eol.alias("eol")), F.lit("1999-01-01").cast("date"))


@query("""
WITH v AS (SELECT l_orderkey AS version, bool_or(l_returnflag = 'R') AS yanked FROM lineitem GROUP BY 1),
dv AS (SELECT o_custkey AS id, max(o_orderkey) AS version FROM orders GROUP BY 1)
SELECT upper(c_name) AS package, coalesce(yanked, false) AS is_eol, CASE WHEN dv.id IS NULL THEN 'not in db dump' WHEN coalesce(yanked, false) THEN 'default version yanked' ELSE '' END AS reason, CASE WHEN dv.id IS NULL THEN 'not_found' ELSE 'db-dump' END AS source
FROM customer LEFT JOIN dv ON c_custkey = dv.id LEFT JOIN v ON dv.version = v.version
""")
def yank_verdict(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    versions = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("version")).agg(F.bool_or(F.col("l_returnflag") == "R").alias("yanked"))
    defaults = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderkey").alias("version"))
    return verdicts.yank_verdicts(c.select(F.upper("c_name").alias("package")), c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), defaults, versions)


@query("""
WITH y AS (SELECT o_custkey AS account, sum(CASE WHEN year(o_orderdate) = 1996 THEN round(o_totalprice * 100) END) AS a, sum(CASE WHEN year(o_orderdate) = 1997 THEN round(o_totalprice * 100) END) AS b, sum(CASE WHEN year(o_orderdate) = 1998 THEN round(o_totalprice * 100) END) AS c FROM orders GROUP BY 1)
SELECT account, round(coalesce((coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)) / 100 / nullif((a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT, 0), 0), 4) AS budget FROM y
""")
def mean_annual_budget(spark: SparkSession, d: str) -> DataFrame:
    """Cents of a year to units, then the mean over the years that have any."""
    cents = F.round(F.col("o_totalprice") * 100)
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("account")).agg(*(F.sum(F.when(F.year("o_orderdate") == y, cents)).alias(f"c{y}") for y in (1996, 1997, 1998)))
    o = verdicts.money(o, {f"raised_{y}": f"c{y}" for y in (1996, 1997, 1998)})
    return verdicts.mean_budget(o, "raised_", "budget").select("account", F.round("budget", 4).alias("budget"))


@query("""
WITH m AS (SELECT user_id AS repo, date_trunc('day', ts) AS sha, event_type AS metric, sum(value) AS value FROM events GROUP BY ALL)
SELECT repo, sha, count(DISTINCT CASE WHEN metric IN ('click', 'error', 'view') AND value IS NOT NULL THEN metric END) = 3 AND coalesce(bool_or(metric = 'click' AND value > 50), false) AS done FROM m GROUP BY 1, 2
""")
def snapshot_done(spark: SparkSession, d: str) -> DataFrame:
    day = F.date_trunc("day", F.col("ts").cast("timestamp_ntz")).alias("sha")
    m = table(spark, d, "events").groupBy(F.col("user_id").alias("repo"), day, F.col("event_type").alias("metric")).agg((F.sum("value")).alias("value"))
    return verdicts.snapshot_done(m.withColumn("value", F.when(F.col("metric") == "click", F.col("value") - 50).otherwise(F.col("value"))), ["repo", "sha"], ("click", "error", "view"), "click")


@query("""
WITH h AS (SELECT o_custkey AS k, max(CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END) AS newest FROM orders GROUP BY 1)
SELECT CASE WHEN h.k IS NULL THEN 'missing' WHEN newest >= TIMESTAMP '1998-06-01' THEN 'fresh' ELSE 'stale' END AS state, count(*)::BIGINT AS n FROM customer LEFT JOIN h ON c_custkey = h.k GROUP BY 1
""")
def stale_split(spark: SparkSession, d: str) -> DataFrame:
    have = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("at"))
    return verdicts.freshness(table(spark, d, "customer").select(F.col("c_custkey").alias("k")), have, "k", "at", F.lit("1998-06-01").cast("timestamp_ntz"))


@query("SELECT o_custkey AS project, bool_or(o_orderstatus IN ('F', 'O') AND (o_orderpriority LIKE '5%' OR o_orderdate >= TIMESTAMP '1999-01-01')) AS reuse FROM orders GROUP BY 1")
def done_cache_split(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumn("at", F.when(~F.col("o_orderpriority").startswith("5"), F.col("o_orderdate")))
    return verdicts.split_done(o.withColumnRenamed("o_custkey", "project"), "project", "o_orderstatus", "at", ("F", "O"), F.lit("1999-01-01").cast("timestamp_ntz"))


@query("""
WITH x AS (SELECT page_id, unnest(list_distinct(regexp_extract_all(coalesce(array_to_string(regexp_extract_all(coalesce(html, ''), '(?is)<nav[ >].*?</nav>'), ' '), ''), '(?i)<a [^>]*href="([^"]*)"', 1))) AS link FROM pages),
y AS (SELECT * FROM x WHERE NOT regexp_matches(link, '^[a-z]+://') OR regexp_matches(link, '^[a-z]+://[^/]*\\.[a-z]'))
SELECT page_id, link FROM y UNION ALL SELECT page_id, NULL FROM pages WHERE page_id NOT IN (SELECT page_id FROM y)
""")
def nav_links(spark: SparkSession, d: str) -> DataFrame:
    return verdicts.section_links(table(spark, d, "pages"), "page_id", "html", "nav").select("page_id", "link")


@query("""
WITH pts AS (SELECT datediff('day', DATE '1990-01-01', o_orderdate::DATE)::BIGINT AS x, count(*)::BIGINT AS n FROM orders GROUP BY 1),
r AS (SELECT x, n, n > 50 AS heavy, sum(n) OVER (ORDER BY x) - n AS before, sum((n > 50)::INT) OVER (ORDER BY x) AS part FROM pts)
SELECT min(x) AS lo, max(x) + 1 AS hi, sum(n)::BIGINT AS n FROM r GROUP BY part, CASE WHEN heavy THEN -1 ELSE before // 50 END
""")
def adaptive_ranges(spark: SparkSession, d: str) -> DataFrame:
    days = table(spark, d, "orders").select(F.datediff(F.col("o_orderdate").cast("date"), F.lit("1990-01-01").cast("date")).alias("x"))
    return verdicts.bounded_ranges(days, "x", 100)


@query("""
WITH p AS (SELECT p_partkey, ['https://github.com/sponsors/' || replace(p_name, ' ', '-'), CASE WHEN p_size % 2 = 0 THEN 'https://OpenCollective.com/' || p_type || '?x=1' END, 'https://ko-fi.com/' || p_type, 'https://www.ko-fi.com/b/c', 'https://example.org/' || p_size] AS links FROM part)
SELECT p_partkey, array_to_string(list_concat(['github=' || replace(split_part(links[1], '/', 5), ' ', '-')], CASE WHEN links[2] IS NOT NULL THEN ['open_collective=' || lower(split_part(split_part(links[2], '/', 4), '?', 1))] ELSE [] END,
 ['ko_fi=' || lower(split_part(links[3], '/', 4)) || ',b'], ['custom=' || links[5]]), ';') AS channels FROM p
""")
def handles_by_platform(spark: SparkSession, d: str) -> DataFrame:
    links = F.array(
        F.concat(F.lit("https://github.com/sponsors/"), F.replace("p_name", F.lit(" "), F.lit("-"))), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("https://OpenCollective.com/"), "p_type", F.lit("?x=1"))),
        F.concat(F.lit("https://ko-fi.com/"), "p_type"), F.lit("https://www.ko-fi.com/b/c"), F.concat(F.lit("https://example.org/"), F.col("p_size").cast("string")),
    )
    found = funding.handles_by_platform(links)
    shown = F.array_join(F.transform(found, lambda s: F.concat(s["platform"], F.lit("="), F.array_join(s["handles"], ","))), ";")
    return table(spark, d, "part").select("p_partkey", shown.alias("channels"))


@query("SELECT c_custkey, lower(c_mktsegment) AS slug, CASE c_nationkey % 3 WHEN 0 THEN 'gitlab.com' WHEN 1 THEN 'salsa.debian.org' ELSE '' END AS host, CASE c_nationkey % 3 WHEN 0 THEN 'https://gitlab.com/projects/' || c_custkey WHEN 1 THEN 'https://salsa.debian.org/projects/' || c_custkey ELSE 'https://github.com/' || c_mktsegment END AS link FROM customer")
def instance_links(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    number = F.col("c_custkey").cast("string")
    rid = F.when(F.col("c_nationkey") % 3 == 0, F.concat(F.lit("gl/"), number)).when(F.col("c_nationkey") % 3 == 1, F.concat(F.lit("gl/salsa-"), number)).otherwise(F.concat(F.lit("gh/"), number))
    slug = funding.collective_slug(F.concat(F.lit(" https://opencollective.com/"), "c_mktsegment", F.lit("/updates?x#y ")))
    return c.select("c_custkey", slug.alias("slug"), funding.instance_host(rid).alias("host"), funding.id_link(rid, F.col("c_mktsegment")).alias("link"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE year(o_orderdate) END::INT AS year, CASE WHEN o_orderkey % 4 IN (0, 1) THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders
""")
def published_dates(spark: SparkSession, d: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    kind = F.col("o_orderkey") % 4
    raw = F.when(kind == 0, F.concat(day, F.lit("T10:00:00Z"))).when(kind == 1, F.concat(day, F.lit(" or so"))).when(kind == 2, F.concat(F.year("o_orderdate").cast("string"), F.lit(", spring"))).otherwise("unknown")
    return table(spark, d, "orders").select("o_orderkey", funding.published(raw).alias("p")).select("o_orderkey", "p.year", "p.day")


@query("""
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN lower(p_type) WHEN p_size % 4 = 1 THEN 'mit' WHEN p_size % 4 = 2 THEN 'apache2.0' ELSE '' END AS license,
 CASE WHEN p_size % 3 = 0 THEN 'rust' WHEN p_size % 3 = 1 AND p_size % 2 = 0 THEN 'go' WHEN p_size % 3 = 1 AND p_size % 5 > 0 THEN 'python' ELSE 'c/c++' END AS language FROM part
""")
def license_and_language(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_size")
    expression = F.when(n % 4 == 0, F.col("p_type"))
    classifiers = F.when(n % 4 == 1, F.array(F.lit("Topic :: X"), F.lit("License :: OSI Approved :: MIT License")))
    text = F.when(n % 4 == 2, F.lit("Apache2.0\nand a long text")).otherwise("all rights reserved, MIT")
    build = F.when(n % 3 == 0, F.array(F.lit("rust"), F.lit("cmake"))).when(n % 3 == 1, F.array(F.lit("python@3.12"), F.when((n % 5 == 0) | (n % 2 == 0), "cmake").otherwise("pkgconf")))
    runtime = F.when((n % 3 == 1) & (n % 2 == 0), F.array(F.lit("go"))).otherwise(F.array(F.lit("python@3.12")))
    hints = [("python", r"^python(@|$)"), ("rust", "^rust$"), ("go", "^go$")]
    language = funding.guess_language(build, runtime, hints, ("python",), ("cmake", "meson"), "c/c++")
    return table(spark, d, "part").select("p_partkey", funding.resolve_license(expression, classifiers, {"mit license": "mit"}, text).alias("license"), language.alias("language"))


@query("""
SELECT 'coverage: orders' AS "check", count(*) = 0 AS ok, count(*) || ' keys missing' AS detail FROM (SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))
UNION ALL SELECT 'dates: at', count(*) = 0, count(*) || ' malformed or future dates' FROM orders WHERE o_orderkey % 50 = 0 OR (o_orderkey % 50 <> 1 AND o_orderdate > TIMESTAMP '2001-01-02')
UNION ALL SELECT 'schema: part', true, '0 columns missing or of another type'
UNION ALL SELECT 'sidecar', count(*) = 0, count(*) || ' keys differ' FROM supplier WHERE (s_acctbal > 100) <> (s_nationkey < 20)
""")
def health_checks(spark: SparkSession, d: str) -> DataFrame:
    c, o, s = (table(spark, d, t) for t in ("customer", "orders", "supplier"))
    at = F.when(F.col("o_orderkey") % 50 == 0, "yesterday").when(F.col("o_orderkey") % 50 == 1, " ").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    return health.all_of(
        health.covered(c.select(F.col("c_custkey").alias("k")), o.select(F.col("o_custkey").alias("k")), "k", "orders"),
        health.dates_sane(o.select(at.alias("at")), "at", F.lit("2001-01-01").cast("timestamp")),
        health.has_columns(table(spark, d, "part"), {"p_partkey": "bigint", "p_size": "int"}, "part"),
        health.sidecar_agrees(s.where("s_acctbal > 100").select("s_suppkey"), s.select("s_suppkey", (F.col("s_nationkey") < 20).alias("ok")), "s_suppkey", "ok"),
    )


@query("SELECT s_suppkey, CASE WHEN s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49) THEN 'used' WHEN s_acctbal < 0 THEN 'dormant' ELSE 'orphan' END AS state FROM supplier")
def override_states(spark: SparkSession, d: str) -> DataFrame:
    used = table(spark, d, "lineitem").where("l_quantity > 49").select(F.col("l_suppkey").alias("s_suppkey"))
    return health.overrides_used(table(spark, d, "supplier"), used, "s_suppkey", F.col("s_acctbal") < 0)


@query("SELECT c_nationkey AS name, count(DISTINCT c_mktsegment)::INT AS n FROM customer GROUP BY 1 HAVING count(DISTINCT c_mktsegment) > 1")
def id_disagreement(spark: SparkSession, d: str) -> DataFrame:
    return health.one_id_each(table(spark, d, "customer"), "c_nationkey", "c_mktsegment").select(F.col("c_nationkey").alias("name"), F.size("ids").alias("n"))
