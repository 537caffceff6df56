"""The whole chain: value, risk, eligibility and the final ranking, on the driver's star schema.

A supplier stands for a repository, a part for a package, a brand for an
ecosystem and shipped quantities for downloads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions import numbers as N
from tidewright.plans import scoring
from tidewright.queries.registry import query, table

VALUE = """
m AS (SELECT l_suppkey AS repo, p_brand AS eco, sum(l_quantity) AS mass FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
c AS (SELECT repo, eco, mass, 100 - 100 * sum(mass) OVER (PARTITION BY eco ORDER BY mass DESC, repo ROWS UNBOUNDED PRECEDING) / sum(mass) OVER (PARTITION BY eco) AS pct FROM m),
n AS (SELECT repo, eco, (ln(mass) - min(ln(mass)) OVER (PARTITION BY eco)) / CASE WHEN max(ln(mass)) OVER (PARTITION BY eco) = min(ln(mass)) OVER (PARTITION BY eco) THEN 1 ELSE max(ln(mass)) OVER (PARTITION BY eco) - min(ln(mass)) OVER (PARTITION BY eco) END AS norm FROM m WHERE mass > 0),
pr AS (SELECT repo, 100 * raw / max(raw) OVER () AS pr FROM (SELECT repo, sqrt(sum(norm * norm)) AS raw FROM n GROUP BY 1)),
t AS (SELECT repo, max(pct) AS top FROM c GROUP BY 1),
v AS (SELECT s_suppkey AS repo, CASE WHEN (s_acctbal > 0)::INT + (s_suppkey % 3 = 0)::INT + (t.top IS NOT NULL)::INT + (pr IS NOT NULL)::INT >= 2 THEN (coalesce(0.6 * CASE WHEN s_acctbal > 0 THEN s_acctbal / 100 END, 0) + coalesce(0.2 * CASE WHEN s_suppkey % 3 = 0 THEN 100.0 END, 0) + coalesce(0.1 * t.top, 0) + coalesce(0.1 * pr, 0))
 / (CASE WHEN s_acctbal > 0 THEN 0.6 ELSE 0 END + CASE WHEN s_suppkey % 3 = 0 THEN 0.2 ELSE 0 END + CASE WHEN t.top IS NULL THEN 0 ELSE 0.1 END + CASE WHEN pr IS NULL THEN 0 ELSE 0.1 END) END AS value_score
 FROM supplier LEFT JOIN t ON s_suppkey = t.repo LEFT JOIN pr ON s_suppkey = pr.repo)
"""
RISK = """
oc AS (SELECT l_suppkey AS repo, o_custkey AS cust, count(*) AS commits FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity > 30 GROUP BY 1, 2),
w AS (SELECT *, coalesce(sum(commits) OVER (PARTITION BY repo ORDER BY commits DESC, cust ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(commits) OVER (PARTITION BY repo) AS total FROM oc),
b AS (SELECT repo, greatest(1, sqrt(round(sum(power(commits / total * 100, 2))) / sum((before < 0.5 * total)::INT))) AS concentration FROM w GROUP BY 1),
x AS (SELECT l_suppkey AS repo, sum(l_extendedprice) / sum(l_quantity) AS loc, count(DISTINCT CASE WHEN l_returnflag = 'R' AND l_quantity > 48 THEN l_orderkey END) AS cve, sum(l_quantity) / count(DISTINCT l_orderkey) AS load FROM lineitem GROUP BY 1),
p AS (SELECT repo, round(100 * cume_dist() OVER (ORDER BY round(loc, 6)), 2) AS complexity, round(100 * cume_dist() OVER (ORDER BY round(load, 6)), 2) AS workload, CASE WHEN cve = 0 THEN 50.0 ELSE round(50 + 50 * cume_dist() OVER (PARTITION BY cve > 0 ORDER BY cve), 2) END AS security FROM x),
r AS (SELECT repo, concentration, complexity, security, workload, power(concentration * complexity * security * workload, 0.25) AS risk_score FROM b JOIN p USING (repo))
"""
ELIGIBLE = """
e AS (SELECT s_suppkey AS repo, s_nationkey % 5 <> 0 AS oss, s_acctbal > 500 AS intent, s_nationkey <> 3 AS nonprofit, s_suppkey % 10 <> 9 AS active FROM supplier)
"""


@query(f"WITH {VALUE} SELECT repo, round(value_score, 4) AS value_score FROM v")
def value_score(spark: SparkSession, d: str) -> DataFrame:
    return scoring.value(table(spark, d, "supplier"), table(spark, d, "lineitem"), table(spark, d, "part")).select("repo", F.round("value_score", 4).alias("value_score"))


@query(f"WITH {RISK} SELECT repo, round(concentration, 4) AS concentration, complexity, security, workload, round(risk_score, 4) AS risk_score FROM r")
def risk_score(spark: SparkSession, d: str) -> DataFrame:
    r = scoring.risk(table(spark, d, "lineitem"), table(spark, d, "orders"))
    return r.select("repo", N.rounded(F.col("concentration"), 4).alias("concentration"), "complexity", "security", "workload", N.rounded(F.col("risk_score"), 4).alias("risk_score"))


@query(f"WITH {ELIGIBLE} SELECT repo, oss AND intent AND nonprofit AND active AS eligible, CASE WHEN oss AND intent AND nonprofit AND active THEN '' ELSE array_to_string(list_filter([CASE WHEN NOT oss THEN 'oss' END, CASE WHEN NOT intent THEN 'intent' END, CASE WHEN NOT nonprofit THEN 'nonprofit' END, CASE WHEN NOT active THEN 'active' END], lambda x: x IS NOT NULL), '; ') END AS reasons FROM e")
def eligibility_rollup(spark: SparkSession, d: str) -> DataFrame:
    return scoring.eligibility(table(spark, d, "supplier")).select("repo", "eligible", "reasons")


@query(f"WITH {VALUE}, {RISK}, {ELIGIBLE}, f AS (SELECT e.repo, value_score, risk_score, oss AND intent AND nonprofit AND active AS eligible, sqrt(value_score * risk_score) AS s FROM e LEFT JOIN v USING (repo) LEFT JOIN r USING (repo)) SELECT repo, round(value_score, 4) AS value_score, round(risk_score, 4) AS risk_score, eligible, round(s, 4) AS score, CASE WHEN eligible AND s IS NOT NULL THEN row_number() OVER (PARTITION BY eligible AND s IS NOT NULL ORDER BY round(s, 9) DESC, repo) END::BIGINT AS priority FROM f")
def final_score(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: every repository with its scores; eligible ones are ranked on full precision."""
    t = {n: table(spark, d, n) for n in ("supplier", "lineitem", "part", "orders")}
    v = scoring.value(t["supplier"], t["lineitem"], t["part"])
    return scoring.final(scoring.eligibility(t["supplier"]), v, scoring.risk(t["lineitem"], t["orders"]))


@query(f"WITH {ELIGIBLE} SELECT count(*)::BIGINT AS tracked, sum(oss::INT)::BIGINT AS oss, sum((oss AND intent)::INT)::BIGINT AS oss_intent, sum((oss AND intent AND nonprofit)::INT)::BIGINT AS oss_intent_nonprofit, sum((oss AND intent AND nonprofit AND active)::INT)::BIGINT AS eligible FROM e")
def funnel(spark: SparkSession, d: str) -> DataFrame:
    e = scoring.eligibility(table(spark, d, "supplier"))
    step, out = F.lit(True), [F.count("*").alias("tracked")]
    for name, alias in (("oss", "oss"), ("intent", "oss_intent"), ("nonprofit", "oss_intent_nonprofit"), ("active", "eligible")):
        step = step & F.col(name)
        out.append(F.sum(step.cast("long")).alias(alias))
    return e.agg(*out)


@query("SELECT p_brand, p_type, count(*)::BIGINT AS n, round(avg(p_retailprice), 4) AS mean FROM part GROUP BY ROLLUP (p_brand, p_type)")
def marginal_totals(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").rollup("p_brand", "p_type").agg(F.count("*").alias("n"), F.round(F.avg("p_retailprice"), 4).alias("mean"))

