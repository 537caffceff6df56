"""Packages as repository rows, their identity, and whether it holds: parts stand for packages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.operators import validation, value_rows
from tidewright.queries.registry import query, table

PACKAGE_COLUMNS = """
'pkg' || p_partkey AS package,
CASE p_type WHEN 'STANDARD' THEN 'npm' WHEN 'MEDIUM' THEN 'pypi' WHEN 'PROMO' THEN 'crates' WHEN 'LARGE' THEN 'cpp' WHEN 'SMALL' THEN 'npm' ELSE 'pypi' END AS ecosystem,
CASE WHEN p_size < 16 THEN 'gh/' || (p_size * 100 + length(p_brand)) WHEN p_size < 22 THEN 'gl/salsa-' || p_size ELSE '' END AS repo_id,
CASE WHEN p_size < 10 THEN 'https://github.com/Org' || p_size || '/Lib' WHEN p_size < 16 THEN '' WHEN p_size < 22 THEN 'https://salsa.debian.org/team/p' || p_size || '.git' WHEN p_size < 30 THEN 'https://sourceware.org/git/' || substr(p_brand, 7) || '.git' WHEN p_size < 36 THEN 'https://github.com/by/' || p_size || '.git' WHEN p_size < 38 THEN 'https://github.com/sponsors/x' || p_size ELSE '' END AS git_url,
CASE WHEN p_size BETWEEN 12 AND 40 AND p_brand LIKE '%3' THEN 'https://home.example.org/' || p_brand END AS canonical_url,
CASE WHEN p_size < 16 AND p_type <> 'PROMO' THEN 'org' || p_size || '/lib' || length(p_brand) WHEN p_size BETWEEN 24 AND 45 AND p_type <> 'LARGE' THEN 'who/' || lower(p_type) ELSE '' END AS github_repo,
CASE WHEN p_size > 44 THEN NULL ELSE (p_retailprice - 899) * p_size END AS pagerank
"""


def packages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").selectExpr(*_split(PACKAGE_COLUMNS))


def _split(text: str) -> list[str]:
    """The expressions of a select list, cut at commas outside brackets and quotes."""
    out, depth, last, quoted = [], 0, 0, False
    for i, c in enumerate(text):
        quoted ^= c == "'"
        depth += 0 if quoted else (c == "(") - (c == ")")
        if c == "," and not depth and not quoted:
            out.append(text[last:i])
            last = i + 1
    return [x.replace("\n", " ").strip() for x in [*out, text[last:]]]


ECO = "CASE ecosystem WHEN 'npm' THEN 1 WHEN 'pypi' THEN 2 WHEN 'crates' THEN 3 ELSE 4 END"
ROWS = f"""
pk AS (SELECT {PACKAGE_COLUMNS} FROM part),
k AS (SELECT *, coalesce(nullif(repo_id, ''), nullif(git_url, ''), '__orphan__:' || ecosystem || ':' || package) AS group_key, {ECO} AS e, row_number() OVER (ORDER BY {ECO}, package) AS ord FROM pk),
own AS (SELECT group_key, arg_min(repo_id, ord) FILTER (WHERE repo_id <> '') AS rid, arg_min(git_url, ord) FILTER (WHERE git_url <> '') AS url, arg_min(canonical_url, ord) FILTER (WHERE canonical_url <> '') AS canon, arg_min(github_repo, ord) FILTER (WHERE github_repo <> '') AS slug1, count(*) AS packages FROM k GROUP BY 1),
common AS (SELECT group_key, github_repo AS common FROM (SELECT group_key, github_repo, row_number() OVER (PARTITION BY group_key ORDER BY count(*) DESC, github_repo) AS r FROM k WHERE github_repo <> '' GROUP BY 1, 2) WHERE r = 1),
eco AS (SELECT group_key, ecosystem, e, sum(coalesce(pagerank, 0)) AS mass, arg_min(package, (-coalesce(pagerank, 0), package)) AS top FROM k GROUP BY 1, 2, 3),
sh AS (SELECT *, sum(mass) OVER (PARTITION BY e ORDER BY mass DESC, group_key) / sum(mass) OVER (PARTITION BY e) AS share FROM eco),
cl AS (SELECT *, CASE WHEN share <= 0.75 THEN 'A' WHEN share <= 0.95 THEN 'B' ELSE 'C' END AS class FROM sh),
tops AS (SELECT group_key, arg_min(ecosystem, (share, e)) AS top_eco, arg_min(top, (share, e)) AS top_pkg, min(share) AS share, min(class) AS class, string_agg(ecosystem, ',' ORDER BY e) AS ecosystems,
  coalesce(max(class) FILTER (WHERE e = 1), '') AS class_npm, coalesce(max(class) FILTER (WHERE e = 2), '') AS class_pypi, coalesce(max(class) FILTER (WHERE e = 3), '') AS class_crates, coalesce(max(class) FILTER (WHERE e = 4), '') AS class_cpp FROM cl GROUP BY 1),
nm AS (SELECT group_key, (ln(mass) - min(ln(mass)) OVER w) / coalesce(nullif(max(ln(mass)) OVER w - min(ln(mass)) OVER w, 0), 1) AS x FROM eco WHERE mass > 0 WINDOW w AS (PARTITION BY e)),
sc AS (SELECT group_key, sqrt(sum(x * x)) AS raw FROM nm GROUP BY 1),
pa AS (SELECT *, coalesce(url, '') AS u, CASE WHEN coalesce(rid, '') LIKE 'gh/%' THEN coalesce(slug1, '') WHEN coalesce(rid, '') LIKE 'gl/%' THEN '' ELSE coalesce(nullif(CASE WHEN url LIKE 'https://github.com/by/%' THEN regexp_extract(lower(url), '^https://github.com/(.+)\\.git$', 1) ELSE '' END, ''), common, '') END AS slug FROM own LEFT JOIN common USING (group_key)),
v AS (SELECT group_key,
  CASE WHEN coalesce(rid, '') LIKE 'gh/%' OR slug <> '' THEN slug WHEN u LIKE 'https://salsa%' OR u LIKE 'https://sourceware%' THEN regexp_extract(lower(u), '^https://[^/]+/(.*)\\.git$', 1) WHEN u <> '' THEN regexp_extract(lower(u), '^https://[^/]+/(.*)$', 1) ELSE '' END AS repo,
  CASE WHEN coalesce(rid, '') LIKE 'gh/%' OR slug <> '' THEN 'github' WHEN coalesce(rid, '') LIKE 'gl/%' THEN 'gitlab' WHEN u LIKE 'https://github%' THEN 'github' WHEN u <> '' THEN 'custom' ELSE '' END AS platform,
  coalesce(rid, '') AS repo_id, CASE WHEN coalesce(rid, '') LIKE 'gh/%' AND slug <> '' THEN 'https://github.com/' || slug || '.git' ELSE u END AS git_url, CASE WHEN coalesce(rid, '') LIKE 'gl/%' THEN '' ELSE coalesce(canon, '') END AS canonical_url,
  ecosystems, packages, top_eco, top_pkg AS top_eco_pkg, round(100.0 - 100.0 * share, 4) AS top_eco_pct, round(100.0 * raw / (SELECT max(raw) FROM sc), 2) AS pr_score, class, class_npm, class_pypi, class_crates, class_cpp
  FROM pa LEFT JOIN tops USING (group_key) LEFT JOIN sc USING (group_key))
"""


@query(f"WITH {ROWS} SELECT *, NULL AS git_valid, NULL AS openssf_crit, NULL AS eco_crit, NULL AS value_score FROM v")
def value_rows_of_packages(spark: SparkSession, d: str) -> DataFrame:
    """All columns of a repository's row: identity, classes, shares, score."""
    return value_rows.repo_rows(packages(spark, d))


OVERRIDE_COLUMNS = """
'pkg' || p_partkey AS package,
CASE p_type WHEN 'STANDARD' THEN 'npm' WHEN 'MEDIUM' THEN 'pypi' WHEN 'PROMO' THEN 'crates' WHEN 'LARGE' THEN 'cpp' WHEN 'SMALL' THEN 'npm' ELSE 'pypi' END AS ecosystem,
CASE WHEN p_brand LIKE '%1' THEN 'Right/Repo' || p_size ELSE '' END AS repo,
CASE WHEN p_brand LIKE '%4' THEN 'https://SALSA.debian.org/team/p' || p_size || '/' WHEN p_brand LIKE '%2' OR p_brand LIKE '%21' THEN 'https://git.example.org/' || p_size || '.git' ELSE '' END AS git_url,
CASE WHEN p_brand LIKE '%5' THEN 'https://example.org/x.tar' ELSE '' END AS canonical_url, '' AS valid,
CASE WHEN p_size IN (3, 27) THEN ' ' ELSE 'wrong upstream' END AS reason
"""
OVERRIDDEN = f"""
{ROWS}, o AS (SELECT package, ecosystem, lower(repo) AS repo, lower(git_url) AS git_url FROM (SELECT {OVERRIDE_COLUMNS}, p_size, p_retailprice FROM part) WHERE p_retailprice > 960 AND trim(reason) <> '' AND (repo <> '' OR git_url <> '' OR canonical_url <> '')),
g AS (SELECT group_key, arg_max(o.repo, ord) AS o_repo, arg_max(o.git_url, ord) AS o_url FROM k JOIN o USING (package, ecosystem) GROUP BY 1),
ids AS (SELECT group_key, regexp_replace(regexp_replace(lower(git_url), '/+$', ''), '\\.git$', '') AS n, arg_max(repo_id, ord) AS member FROM k WHERE repo_id <> '' AND git_url <> '' GROUP BY 1, 2)
"""


@query(f"""
WITH {OVERRIDDEN}
SELECT v.group_key, CASE WHEN o_repo <> '' THEN o_repo WHEN o_url LIKE '%salsa%' THEN regexp_extract(o_url, 'org/(.*)/$', 1) WHEN o_url <> '' THEN regexp_extract(o_url, 'org/(.*)\\.git$', 1) ELSE repo END AS repo,
 CASE WHEN o_repo <> '' THEN 'github' WHEN o_url LIKE '%salsa%' THEN 'gitlab' WHEN o_url <> '' THEN 'custom' ELSE platform END AS platform,
 CASE WHEN o_repo <> '' THEN CASE WHEN repo_id LIKE 'gh/%' THEN repo_id ELSE '' END WHEN o_url <> '' THEN coalesce(member, '') ELSE repo_id END AS repo_id,
 CASE WHEN o_repo <> '' THEN 'https://github.com/' || o_repo || '.git' WHEN o_url <> '' THEN o_url ELSE git_url END AS git_url, CASE WHEN o_repo <> '' AND o_url <> '' THEN o_url ELSE canonical_url END AS canonical_url, class
FROM v LEFT JOIN g USING (group_key) LEFT JOIN ids ON ids.group_key = v.group_key AND n = regexp_replace(regexp_replace(o_url, '/+$', ''), '\\.git$', '')
""")
def value_rows_overridden(spark: SparkSession, d: str) -> DataFrame:
    """Three kinds of overrides on groups: a slug, another address (the id stays only with its own upstream), a page only."""
    given = packages(spark, d)
    overrides = table(spark, d, "part").where("p_retailprice > 960").selectExpr(*_split(OVERRIDE_COLUMNS))
    out = value_rows.override_identity(value_rows.repo_rows(given), given, overrides)
    return out.select("group_key", "repo", "platform", "repo_id", "git_url", "canonical_url", "class")


@query(f"""
WITH {ROWS}, b AS (SELECT class, top_eco, packages, CASE WHEN git_url = '' THEN 'none' WHEN git_url LIKE 'https://github.com/%' THEN 'github' WHEN git_url LIKE 'https://gitlab%' THEN 'gitlab' ELSE 'other' END AS address FROM v)
SELECT grouping_id(class, top_eco, address)::BIGINT AS level, class, top_eco, address, count(*)::BIGINT AS repos, sum(packages)::BIGINT AS packages FROM b GROUP BY CUBE (class, top_eco, address)
""")
def value_marginals(spark: SparkSession, d: str) -> DataFrame:
    """Class by ecosystem by kind of address, with all totals in one pass."""
    rows = value_rows.repo_rows(packages(spark, d)).withColumn("address", value_rows.address_bucket(F.col("git_url")))
    return value_rows.marginals(rows, ["class", "top_eco", "address"], {"repos": F.count("*"), "packages": F.sum("packages")})


@query("SELECT p_brand, sum(m)::BIGINT AS downloads FROM (SELECT p_brand, p_name, max(l_quantity)::BIGINT AS m FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2) GROUP BY 1")
def alias_maxima(spark: SparkSession, d: str) -> DataFrame:
    """Parts of one name are aliases: the largest counts, then names are added up."""
    l = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_quantity").cast("long").alias("q"))
    rows = l.join(table(spark, d, "part"), "p_partkey")
    return value_rows.sum_of_alias_maxima(rows, ["p_brand"], "p_name", "q", "downloads")


VALUE = """
val AS (SELECT CASE WHEN s_nationkey < 18 THEN 'Owner' || s_nationkey || '/R' || (s_suppkey // 2) ELSE 'grp/p' || s_suppkey END AS repo, CASE WHEN s_nationkey < 18 THEN 'github' WHEN s_nationkey < 22 THEN 'gitlab' WHEN s_nationkey < 24 THEN 'custom' ELSE '' END AS platform,
  CASE WHEN s_nationkey < 5 THEN s_suppkey::VARCHAR WHEN s_nationkey BETWEEN 18 AND 20 THEN 'gl/' || s_suppkey ELSE '' END AS repo_id, CASE WHEN s_nationkey BETWEEN 18 AND 23 THEN 'https://codeberg.org/x/' || s_suppkey || '.git' ELSE '' END AS git_url,
  CASE WHEN s_acctbal > 7000 THEN 'https://up.example.org/' || s_suppkey ELSE '' END AS canonical_url, CASE WHEN s_acctbal < 0 THEN 'B' ELSE 'A' END AS class, CASE WHEN s_acctbal > 3000 THEN 'npm, pypi' WHEN s_acctbal > 0 THEN 'pypi' ELSE '' END AS ecosystems FROM supplier)
"""
HUB = """hub AS (SELECT 'owner' || s_nationkey || '/r' || (s_suppkey // 2) AS repo, CASE WHEN s_acctbal < 5000 THEN 'Owner' || s_nationkey || '/r' || (s_suppkey // 2) ELSE 'Moved/R' || (s_suppkey // 2) END AS full_name,
  CASE WHEN s_acctbal > 1000 THEN 'True' ELSE 'False' END AS valid, '2024-01-' || (10 + s_nationkey) AS fetched_at, 'gh/' || s_suppkey AS repo_id, s_acctbal > 8000 AS archived, s_nationkey AS stars FROM supplier WHERE s_nationkey < 18)"""
URLS = "urls AS (SELECT 'https://codeberg.org/x/' || s_suppkey || '.git' AS url, CASE WHEN s_acctbal > 2000 THEN 'true' ELSE 'false' END AS valid, '2024-02-01' AS checked_at FROM supplier)"
PINS = "pins AS (SELECT 'Owner' || s_nationkey || '/r' || (s_suppkey // 2) AS repo, '' AS git_url, 'True' AS valid FROM supplier WHERE s_acctbal BETWEEN 0 AND 500 UNION ALL SELECT '', 'https://codeberg.org/x/' || s_suppkey || '.git', 'False' FROM supplier WHERE s_acctbal > 9000)"
CHECKED = f"""
{VALUE}, {HUB}, {URLS}, {PINS}, raw AS (SELECT lower(repo) AS target, 'github_repo' AS type, valid = 'True' AS valid, fetched_at AS checked_at, 0 AS rank FROM hub UNION ALL SELECT lower(full_name), 'github_repo', valid = 'True', fetched_at, 0 FROM hub UNION ALL SELECT url, 'git_url', valid = 'true', checked_at, 0 FROM urls
  UNION ALL SELECT lower(repo), 'github_repo', true, 'override', 1 FROM pins WHERE repo <> '' UNION ALL SELECT git_url, 'git_url', false, 'override', 1 FROM pins WHERE repo = ''),
ver AS (SELECT target, type, arg_max(valid, (rank, checked_at, valid)) AS valid, arg_max(checked_at, (rank, checked_at, valid)) AS checked_at FROM raw GROUP BY 1, 2),
aim AS (SELECT *, CASE WHEN platform = 'github' THEN lower(repo) WHEN git_url <> '' THEN git_url END AS target, CASE WHEN platform = 'github' THEN 'github_repo' WHEN git_url <> '' THEN 'git_url' END AS type FROM val)
"""


def _table(spark: SparkSession, d: str, cte: str) -> DataFrame:
    """One of the select lists above over supplier, in Spark's words."""
    body = cte.split(" AS (", 1)[1].rsplit(")", 1)[0].replace("s_suppkey // 2", "s_suppkey div 2").replace("::VARCHAR", "").replace("THEN s_suppkey WHEN", "THEN string(s_suppkey) WHEN")
    supplier = table(spark, d, "supplier")
    out = None
    for part in body.split("UNION ALL"):
        columns, _, where = part.partition(" FROM supplier")
        df = supplier.where(where.split("WHERE", 1)[1]) if "WHERE" in where else supplier
        df = df.selectExpr(*_split(columns.strip().removeprefix("SELECT")))
        out = df if out is None else out.union(df)
    return out


@query(f"WITH {CHECKED} SELECT repo, platform, git_url, canonical_url, CASE WHEN repo_id LIKE 'gl/%' THEN true ELSE coalesce(valid, false) END AS git_valid FROM aim LEFT JOIN ver USING (target, type)")
def verdict_join(spark: SparkSession, d: str) -> DataFrame:
    """Every target has a verdict (the gate), pins win, an id of GitLab is valid by itself."""
    checked = validation.verdicts(_table(spark, d, HUB), _table(spark, d, URLS), _table(spark, d, PINS))
    return validation.validate(_table(spark, d, VALUE), checked).select("repo", "platform", "git_url", "canonical_url", "git_valid")


@query(f"""WITH {CHECKED} SELECT target, type, coalesce(string_agg(DISTINCT trim(e), ',' ORDER BY trim(e)) FILTER (WHERE e <> ''), '') AS sources, any_value(checked_at) AS checked_at, any_value(valid) AS valid
FROM (SELECT target, type, unnest(string_split(ecosystems, ',')) AS e FROM aim WHERE target IS NOT NULL) JOIN ver USING (target, type) GROUP BY 1, 2""")
def validation_targets(spark: SparkSession, d: str) -> DataFrame:
    checked = validation.verdicts(_table(spark, d, HUB), _table(spark, d, URLS), _table(spark, d, PINS))
    return validation.targets(_table(spark, d, VALUE), checked)


@query(f"""
WITH {CHECKED}, ok AS (SELECT *, CASE WHEN repo_id LIKE 'gl/%' THEN true ELSE coalesce(valid, false) END AS git_valid FROM aim LEFT JOIN ver USING (target, type)),
names AS (SELECT lower(repo) AS old, lower(full_name) AS now FROM hub UNION SELECT lower(full_name), lower(full_name) FROM hub), canon AS (SELECT old, min(now) AS now FROM names GROUP BY 1),
meta AS (SELECT lower(full_name) AS k, arg_min(struct_pack(repo_id := repo_id, archived := archived, stars := stars), (lower(repo) <> lower(full_name), repo_id, lower(repo))) AS m FROM hub GROUP BY 1),
s AS (SELECT CASE WHEN platform = 'github' THEN coalesce(now, lower(repo)) ELSE lower(repo) END AS repo, platform, class, CASE WHEN regexp_full_match(repo_id, '[0-9]+') THEN 'gh/' || repo_id ELSE repo_id END AS rid, git_url, canonical_url FROM ok LEFT JOIN canon ON platform = 'github' AND old = lower(repo) WHERE class IN ('A', 'B') AND git_valid AND platform IN ('github', 'gitlab')),
one AS (SELECT platform, min(struct_pack(class := class, repo := repo, rid := rid, git_url := git_url, canonical_url := canonical_url)) AS r FROM s GROUP BY platform, CASE WHEN platform = 'github' THEN repo WHEN rid <> '' THEN rid ELSE platform || ':' || repo END)
SELECT r.repo, platform, r.class, coalesce(m.repo_id, r.rid) AS repo_id, CASE WHEN r.git_url <> '' THEN r.git_url WHEN platform = 'github' THEN 'https://github.com/' || r.repo || '.git' ELSE '' END AS git_url, r.canonical_url, coalesce(m.archived, false) AS archived, m.stars, m IS NOT NULL AS enriched
FROM one LEFT JOIN meta ON platform = 'github' AND k = r.repo
""")
def top_repos_enriched(spark: SparkSession, d: str) -> DataFrame:
    """Valid repositories of two classes under today's names, with what their host says."""
    hub = _table(spark, d, HUB)
    checked = validation.verdicts(hub, _table(spark, d, URLS), _table(spark, d, PINS))
    none = hub.select("repo_id", "archived", "stars").limit(0)
    return validation.top_repos(validation.validate(_table(spark, d, VALUE), checked), hub, none, classes=("A", "B"))


@query("""
WITH e AS (SELECT p_partkey AS pkg, CASE WHEN p_size < 20 THEN 'GitHub' WHEN p_size < 25 THEN 'GitLab.com' ELSE '' END AS site, CASE WHEN p_size < 25 THEN 'A/' || replace(p_brand, '#', '-') ELSE '' END AS full_name, CASE WHEN p_size > 40 THEN 'https://www.github.com/A/' || replace(p_brand, '#', '-') || '/tree/main' WHEN p_size > 35 THEN 'https://git.example.org/x/' || replace(p_brand, '#', '-') || '.git' ELSE '' END AS url FROM part),
o AS (SELECT p_partkey AS pkg, CASE WHEN p_type IN ('STANDARD', 'PROMO') THEN 'a/' || replace(p_brand, '#', '-') ELSE '' END AS slug, CASE WHEN p_type = 'LARGE' THEN 'https://git.example.org/x/' || replace(p_brand, '#', '-') ELSE '' END AS git FROM part WHERE p_retailprice > 910),
x AS (SELECT e.pkg, CASE WHEN slug <> '' THEN 'github' WHEN git <> '' THEN 'git.example.org' ELSE '' END AS oh, CASE WHEN slug <> '' THEN lower(slug) WHEN git <> '' THEN 'x/' || lower(regexp_extract(git, 'x/(.*)$', 1)) ELSE '' END AS orepo,
 CASE WHEN full_name <> '' THEN CASE lower(site) WHEN 'gitlab.com' THEN 'gitlab' ELSE lower(site) END WHEN url LIKE '%github%' THEN 'github' WHEN url <> '' THEN 'git.example.org' ELSE '' END AS eh, CASE WHEN full_name <> '' THEN lower(full_name) WHEN url LIKE '%github%' THEN lower(regexp_extract(url, 'com/([^/]+/[^/]+)', 1)) WHEN url <> '' THEN lower(regexp_extract(url, 'org/(.*)\\.git', 1)) ELSE '' END AS erepo
 FROM e LEFT JOIN o USING (pkg))
SELECT pkg, CASE WHEN orepo = '' AND erepo = '' THEN 'both_empty' WHEN orepo = '' THEN 'eco_only' WHEN erepo = '' THEN 'ours_only' WHEN oh = eh AND orepo = erepo THEN 'match' WHEN eh <> 'github' THEN 'host_differs' ELSE 'mismatch' END AS verdict, oh AS our_host, orepo AS our_repo, eh AS eco_host, erepo AS eco_repo,
 oh = 'github' AND orepo IN (SELECT lower('A/' || replace(p_brand, '#', '-')) FROM part WHERE p_size = 50) AS in_scope FROM x
""")
def audit_verdicts(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    theirs = p.selectExpr("p_partkey AS pkg", "CASE WHEN p_size < 20 THEN 'GitHub' WHEN p_size < 25 THEN 'GitLab.com' ELSE '' END AS repo_host", "CASE WHEN p_size < 25 THEN concat('A/', replace(p_brand, '#', '-')) ELSE '' END AS repo_full_name",
        "CASE WHEN p_size > 40 THEN concat('https://www.github.com/A/', replace(p_brand, '#', '-'), '/tree/main') WHEN p_size > 35 THEN concat('https://git.example.org/x/', replace(p_brand, '#', '-'), '.git') ELSE '' END AS repository_url")
    ours = p.where("p_retailprice > 910").selectExpr("p_partkey AS pkg", "CASE WHEN p_type IN ('STANDARD', 'PROMO') THEN concat('a/', replace(p_brand, '#', '-')) ELSE '' END AS github_repo", "CASE WHEN p_type = 'LARGE' THEN concat('https://git.example.org/x/', replace(p_brand, '#', '-')) ELSE '' END AS git")
    scope = p.where("p_size = 50").selectExpr("concat('A/', replace(p_brand, '#', '-')) AS repo")
    return validation.audit(theirs, ours, ["pkg"], scope)


@query("""
WITH o AS (SELECT CASE WHEN s_acctbal > 5000 THEN 'gh/' || s_suppkey ELSE '' END AS rid, 'S' || s_suppkey AS slug, CASE WHEN s_acctbal > 9000 THEN 'False' WHEN s_acctbal > 4000 OR s_nationkey > 20 THEN 'True' ELSE '' END AS eol FROM supplier)
SELECT s_suppkey, coalesce(i.eol = 'True', n.eol = 'True', false) AS eol, NOT coalesce(i.eol = 'True', n.eol = 'True', false) AND NOT s_nationkey < 3 AS active
FROM supplier LEFT JOIN o i ON i.rid = 'gh/' || (s_suppkey + 1) AND i.eol <> '' LEFT JOIN o n ON n.rid = '' AND n.eol <> '' AND lower(n.slug) = 's' || s_suppkey
""")
def activity_overrides(spark: SparkSession, d: str) -> DataFrame:
    """End of life by id, by slug where an override has no id; archived is not active."""
    s = table(spark, d, "supplier")
    repos = s.selectExpr("s_suppkey", "concat('gh/', s_suppkey + 1) AS repo_id", "concat('s', s_suppkey) AS repo", "s_nationkey < 3 AS archived")
    overrides = s.selectExpr("CASE WHEN s_acctbal > 5000 THEN concat('gh/', s_suppkey) ELSE '' END AS repo_id", "concat('S', s_suppkey) AS repo", "CASE WHEN s_acctbal > 9000 THEN 'False' WHEN s_acctbal > 4000 OR s_nationkey > 20 THEN 'True' ELSE '' END AS eol")
    return validation.activity(repos, overrides).select("s_suppkey", "eol", "active")


@query("""
WITH h AS (SELECT o_custkey, year(o_orderdate) AS year, o_orderstatus AS state, max(o_orderdate) AS last_at FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY ALL),
g AS (SELECT c_custkey, y.year, s.state FROM customer, (VALUES (1995), (1996), (1997)) y(year), (VALUES ('F'), ('O')) s(state))
SELECT g.c_custkey, g.year, g.state, CASE WHEN last_at IS NULL THEN 'missing' ELSE 'stale' END AS why FROM g LEFT JOIN h ON o_custkey = c_custkey AND h.year = g.year AND h.state = g.state WHERE last_at IS NULL OR last_at < TIMESTAMP '1996-07-01'
""")
def stale_worklist(spark: SparkSession, d: str) -> DataFrame:
    """What is missing of every year and state, and what is there but old."""
    have = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("state"), "o_orderdate")
    return validation.worklist(table(spark, d, "customer"), have, ["c_custkey"], "o_orderdate", F.lit("1996-07-01").cast("timestamp_ntz"), ["F", "O"], [1995, 1996, 1997])


@query("""
WITH f AS (SELECT l_partkey AS id, l_quantity::BIGINT AS stars, l_returnflag AS flag FROM lineitem WHERE l_discount > 0.08), n AS (SELECT id, max(struct_pack(stars := stars, flag := flag)) AS r FROM f GROUP BY 1), o AS (SELECT p_partkey AS id, p_size::BIGINT AS stars, 'x' AS flag FROM part WHERE p_type <> 'PROMO')
SELECT id, r.stars, r.flag FROM n UNION ALL SELECT * FROM o WHERE id NOT IN (SELECT id FROM n)
""")
def stars_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Search results put into a table by id: of repeated finds the one with most stars."""
    old = table(spark, d, "part").where("p_type <> 'PROMO'").selectExpr("p_partkey AS id", "bigint(p_size) AS stars", "'x' AS flag")
    found = table(spark, d, "lineitem").where("l_discount > 0.08").selectExpr("l_partkey AS id", "bigint(l_quantity) AS stars", "l_returnflag AS flag")
    return validation.upsert_found(old, found, "id", "stars")[0]


@query("WITH n AS (SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_discount > 0.08), o AS (SELECT p_partkey AS id FROM part WHERE p_type <> 'PROMO') SELECT (SELECT count(*) FROM (SELECT id FROM n UNION SELECT id FROM o))::BIGINT AS total, (SELECT count(*) FROM n WHERE id NOT IN (SELECT id FROM o))::BIGINT AS added, (SELECT count(*) FROM n WHERE id IN (SELECT id FROM o))::BIGINT AS updated")
def stars_upsert_counts(spark: SparkSession, d: str) -> DataFrame:
    old = table(spark, d, "part").where("p_type <> 'PROMO'").selectExpr("p_partkey AS id", "bigint(p_size) AS stars", "'x' AS flag")
    found = table(spark, d, "lineitem").where("l_discount > 0.08").selectExpr("l_partkey AS id", "bigint(l_quantity) AS stars", "l_returnflag AS flag")
    return validation.upsert_found(old, found, "id", "stars")[1]


@query("SELECT DISTINCT lower(r) AS repo FROM (SELECT 'Org/' || p_brand AS r FROM part WHERE p_size <= 10 UNION ALL SELECT 'x/' || s_nationkey FROM supplier) WHERE r <> ''")
def slugs_of_classes(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").selectExpr("concat('Org/', p_brand) AS github_repo", "CASE WHEN p_size <= 5 THEN 'A' WHEN p_size <= 10 THEN 'B' ELSE 'C' END AS class")
    suppliers = table(spark, d, "supplier").selectExpr("concat('x/', s_nationkey) AS github_repo")
    return validation.slugs_of_classes([(parts, "class"), (suppliers, None)])
