"""Contributors: customers as identities, whose orders are their commits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.operators import people
from tidewright.queries.registry import query, table

#: Names and addresses from the balance and the segment: numbered and plain no-reply addresses, mixed case, full names, handles, bots.
IDENTITIES = """
i AS (SELECT c_custkey AS k, c_nationkey AS nation, floor(c_acctbal / 20)::BIGINT AS area,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'dev' || floor(abs(c_acctbal))::BIGINT WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN 'Renovate[bot]' ELSE ' Ann ' || upper(substr(c_mktsegment, 1, 1)) || floor(c_acctbal / 7)::BIGINT END AS name,
  CASE WHEN c_acctbal < 2000 THEN c_custkey::VARCHAR || '+Login' || floor(abs(c_acctbal))::BIGINT || '@users.noreply.github.com' WHEN c_acctbal < 4000 THEN 'login' || (floor(c_acctbal)::BIGINT - 2000) || '@Users.noreply.github.com '
       WHEN c_mktsegment = 'FURNITURE' AND c_acctbal > 9500 THEN 'actions@github.com' WHEN c_acctbal > 9000 THEN '' ELSE 'C' || floor(c_acctbal)::BIGINT || '@Example.org' END AS email FROM customer)
"""


def identities(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    bal, seg = F.col("c_acctbal"), F.col("c_mktsegment")
    whole = lambda x: F.floor(x).cast("string")
    name = F.when(seg == "BUILDING", F.concat(F.lit("dev"), whole(F.abs(bal)))).when((seg == "MACHINERY") & (bal < 0), "Renovate[bot]")
    name = name.otherwise(F.concat(F.lit(" Ann "), F.upper(F.substring(seg, 1, 1)), whole(bal / 7)))
    email = F.when(bal < 2000, F.concat(F.col("c_custkey").cast("string"), F.lit("+Login"), whole(F.abs(bal)), F.lit("@users.noreply.github.com")))
    email = email.when(bal < 4000, F.concat(F.lit("login"), (F.floor(bal) - 2000).cast("string"), F.lit("@Users.noreply.github.com ")))
    email = email.when((seg == "FURNITURE") & (bal > 9500), "actions@github.com").when(bal > 9000, "").otherwise(F.concat(F.lit("C"), whole(bal), F.lit("@Example.org")))
    return c.select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nation"), F.floor(bal / 20).alias("area"), name.alias("name"), email.alias("email"))


def _persons(repo: str) -> str:
    """CTEs t (identities with tags) and g (each with the smallest of its person)."""
    return f"""
u AS (SELECT DISTINCT {repo} AS repo, trim(name) AS name, trim(email) AS email FROM i),
t AS (SELECT *, CASE WHEN regexp_full_match(lower(email), '([0-9]+\\+)?[^@]+@users\\.noreply\\.github\\.com') THEN regexp_extract(lower(email), '^(?:[0-9]+\\+)?([^@]+)@', 1) || '@noreply' ELSE nullif(lower(email), '') END AS e, CASE WHEN name LIKE '% %' THEN lower(name) END AS f, repo || chr(1) || name || chr(1) || email AS id FROM u),
l AS (SELECT x.id AS src, y.id AS dst FROM t x JOIN t y ON x.repo = y.repo AND x.e = y.e UNION SELECT x.id, y.id FROM t x JOIN t y ON x.repo = y.repo AND x.f = y.f),
r AS (SELECT id AS node, id AS seen FROM t UNION SELECT r.node, l.dst FROM r JOIN l ON l.src = r.seen),
g AS (SELECT t.repo, t.name, t.email, t.e, min(struct_pack(name := o.name, email := o.email)) AS person FROM r JOIN t ON t.id = r.node JOIN t o ON o.id = r.seen GROUP BY ALL)
"""


BOT = """(lower(name) LIKE '%[bot]' OR lower(email) IN ('noreply@github.com', 'actions@github.com') OR coalesce(e, '') LIKE '%[bot]@noreply')"""


@query(f"WITH RECURSIVE {IDENTITIES}, {_persons('0')} SELECT name, email, person.name AS person_name, person.email AS person_email FROM g")
def identity_components(spark: SparkSession, d: str) -> DataFrame:
    """Identities that share a canonical address or a full name are one person."""
    found = people.persons(identities(spark, d).withColumn("repo", F.lit(0)))
    return found.select("name", "email", F.col("person.name").alias("person_name"), F.col("person.email").alias("person_email"))


@query(f"""
WITH RECURSIVE {IDENTITIES}, {_persons('nation')},
w AS (SELECT nation AS repo, trim(name) AS name, trim(email) AS email, count(*) AS n FROM i JOIN orders ON o_custkey = k GROUP BY ALL),
m AS (SELECT g.*, n, row_number() OVER (PARTITION BY repo, person ORDER BY n DESC, name, email) AS lead FROM g JOIN w USING (repo, name, email)),
a AS (SELECT repo, person, sum(n)::BIGINT AS commits, count(*)::BIGINT AS identities, bool_or({BOT}) AS is_bot FROM m GROUP BY ALL)
SELECT repo, name, coalesce(nullif(CASE WHEN e LIKE '%@noreply' THEN split_part(e, '@', 1) ELSE split_part(coalesce(e, ''), '@', 1) END, ''), lower(name)) AS login, commits, identities, is_bot FROM m JOIN a USING (repo, person) WHERE lead = 1
""")
def authors_of_repos(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("commits"))
    rows = identities(spark, d).join(done, "k").withColumnRenamed("nation", "repo")
    return people.authors(rows)


def _few(c: str) -> str:
    return f"""(SELECT repo, sum(CASE WHEN before < 0.5 * total THEN 1 ELSE 0 END)::BIGINT AS bf, round(sum(pow(100.0 * {c} / total, 2)))::BIGINT AS hhi, count(*)::BIGINT AS people
  FROM (SELECT repo, {c}, coalesce(sum({c}) OVER (PARTITION BY repo ORDER BY {c} DESC, person ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum({c}) OVER (PARTITION BY repo) AS total FROM p WHERE NOT bot AND {c} > 0) GROUP BY 1)"""


@query(f"""
WITH RECURSIVE {IDENTITIES}, {_persons('area')},
w AS (SELECT area AS repo, trim(name) AS name, trim(email) AS email, sum((year(o_orderdate) <= 1997)::BIGINT)::BIGINT AS f, sum((year(o_orderdate) BETWEEN 1996 AND 1996)::BIGINT)::BIGINT AS v FROM i JOIN orders ON o_custkey = k GROUP BY ALL),
p AS (SELECT repo, person, sum(f)::BIGINT AS f, sum(v)::BIGINT AS v, bool_or({BOT}) AS bot FROM g JOIN w USING (repo, name, email) GROUP BY ALL),
s AS (SELECT repo, sum(f)::BIGINT AS f, sum(v)::BIGINT AS v FROM p GROUP BY 1)
SELECT repo, s.f AS commits_full, coalesce(a.people, 0)::BIGINT AS people_full, a.bf AS bus_factor_full, a.hhi AS hhi_full, s.v AS commits_win, coalesce(b.people, 0)::BIGINT AS people_win, coalesce(b.bf, 1)::BIGINT AS bus_factor_win, coalesce(b.hhi, 10000)::BIGINT AS hhi_win,
  CASE WHEN b.repo IS NOT NULL THEN NULL WHEN s.v > 0 THEN 'no human commits in window' WHEN s.f > 0 THEN 'no commits in window' ELSE 'no commits through last complete year' END AS comment
FROM s LEFT JOIN {_few('f')} a USING (repo) LEFT JOIN {_few('v')} b USING (repo)
""")
def concentration_windows(spark: SparkSession, d: str) -> DataFrame:
    """Two windows, merged identities, bots without a share, repositories without a human filled with the worst."""
    done = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("commits"))
    rows = identities(spark, d).join(done, "k").withColumnRenamed("area", "repo")
    return people.concentration(rows, (1996, 1996), 1997)


@query("""
WITH s AS (SELECT o_custkey, count(*) FILTER (WHERE year(o_orderdate) = 1996)::BIGINT AS active, sum(o_totalprice) AS loc, nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS cves FROM orders GROUP BY 1)
SELECT c_custkey, (active = 0)::INTEGER AS dormant, round(loc / CASE WHEN active = 0 THEN 1 ELSE active END, 4) AS loc_per_active, round(cves / CASE WHEN active = 0 THEN 1 ELSE active END, 4) AS cves_per_active FROM customer LEFT JOIN s ON o_custkey = c_custkey
""")
def per_active_ratios(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.when(F.year("o_orderdate") == 1996, 1)).alias("active"), F.sum("o_totalprice").alias("loc"), F.nullif(F.count(F.when(F.col("o_orderstatus") == "F", 1)), F.lit(0)).alias("cves"))
    rows = table(spark, d, "customer").select("c_custkey").join(o, "c_custkey", "left")
    return people.workload(rows, {"loc_per_active": "loc", "cves_per_active": "cves"}, "active").select("c_custkey", "dormant", "loc_per_active", "cves_per_active")


@query("SELECT DISTINCT lower(trim(name)) AS login FROM (SELECT nation, CASE WHEN email = '' THEN '' ELSE name END AS name FROM (WITH " + IDENTITIES + " SELECT * FROM i)) WHERE nation IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) AND trim(name) <> ''")
def bus_factor_logins_in_scope(spark: SparkSession, d: str) -> DataFrame:
    members = identities(spark, d).select(F.col("nation").alias("repo_id"), F.when(F.col("email") == "", "").otherwise(F.col("name")).alias("login"))
    return people.logins_in_scope(members, table(spark, d, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("repo_id")))
