"""Percentiles, shares, classes and ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions import numbers as N
from tidewright.operators import scopes as S
from tidewright.operators import windows as W
from tidewright.queries.aggregates import MASS, repo_mass
from tidewright.queries.registry import query, table

DOWNLOADS = "WITH q AS (SELECT l_partkey AS k, sum(l_quantity)::BIGINT AS v FROM lineitem GROUP BY 1), c AS (SELECT *, sum(v) OVER (ORDER BY v DESC, k ROWS UNBOUNDED PRECEDING) AS cum, sum(v) OVER () AS total FROM q)"


def downloads(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("k")).agg(F.sum("l_quantity").cast("long").alias("v"))


@query("SELECT s_suppkey, round(100 * cume_dist() OVER (ORDER BY floor(s_acctbal / 500)), 6) AS high_worse, round(100 * cume_dist() OVER (ORDER BY floor(s_acctbal / 500) DESC), 6) AS low_worse, NULL::DOUBLE AS constant FROM supplier WHERE s_acctbal > 0 UNION ALL SELECT s_suppkey, NULL, NULL, NULL FROM supplier WHERE s_acctbal <= 0")
def risk_percentile(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select("s_suppkey", F.when(F.col("s_acctbal") > 0, F.floor(F.col("s_acctbal") / 500)).alias("v"), F.lit(1).alias("one"))
    s = W.percentiles(s, {"h": ("v", "high"), "l": ("v", "low"), "constant": ("one", "high")})
    return s.select("s_suppkey", F.round("h", 6).alias("high_worse"), F.round("l", 6).alias("low_worse"), F.col("constant").cast("double").alias("constant"))


@query("""
WITH v AS (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL ELSE greatest(p_size - 25, 0) END AS cve FROM part)
SELECT p_partkey, CASE WHEN cve <= 0 THEN 50.0 WHEN cve > 0 THEN round(50 + 50 * cume_dist() OVER (PARTITION BY cve > 0 ORDER BY cve), 6) END AS risk FROM v
""")
def floor_anchored(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 5 != 0, F.greatest(F.col("p_size") - 25, F.lit(0))).alias("cve"))
    return W.floor_anchored(v, "cve", "r").select("p_partkey", F.round("r", 6).alias("risk"))


@query("""
WITH v AS (SELECT p_partkey, CASE WHEN p_size % 4 <> 0 THEN p_size END AS a, p_retailprice AS b FROM part),
p AS (SELECT p_partkey, b, a, CASE WHEN a IS NOT NULL THEN round(100 * cume_dist() OVER (PARTITION BY a IS NULL ORDER BY a), 2) END AS pa, round(100 * cume_dist() OVER (ORDER BY b), 2) AS pb FROM v)
SELECT p_partkey, coalesce(pa, CASE WHEN pb IS NOT NULL THEN 50 END)::DOUBLE AS a_p, pb AS b_p, round(greatest(1, sqrt(coalesce(pa, 50) * pb)), 2) AS score FROM p
""")
def neutral_fill(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 4 != 0, F.col("p_size")).alias("a"), F.col("p_retailprice").alias("b"))
    return S.composite_score(v, {"a": "high", "b": "high"}, "score", neutral={"a": 50.0}).select("p_partkey", "a_p", "b_p", "score")


@query(DOWNLOADS + "SELECT k, v FROM c WHERE v >= (SELECT max(v) FROM c WHERE cum >= 0.95 * total)")
def top_share_tie_inclusive(spark: SparkSession, d: str) -> DataFrame:
    return W.top_share_tied(downloads(spark, d), "v", "k", 0.95)


@query(DOWNLOADS + "SELECT k, v FROM c WHERE cum - v < 0.95 * total")
def top_share_index(spark: SparkSession, d: str) -> DataFrame:
    return W.top_share_index(downloads(spark, d), "v", "k", 0.95)


@query(DOWNLOADS + "SELECT k, round(sum(v) OVER (ORDER BY v DESC RANGE UNBOUNDED PRECEDING) / total, 8) AS share FROM c")
def cum_share_range(spark: SparkSession, d: str) -> DataFrame:
    return W.tied(W.running_total(downloads(spark, d), "v", "k"), "v").select("k", F.round(F.col("cum_tied") / F.col("total"), 8).alias("share"))


@query(DOWNLOADS + "SELECT k, round(v / total, 8) AS share, CASE WHEN cum / total <= 0.75 THEN 'A' WHEN cum / total <= 0.95 THEN 'B' ELSE 'C' END AS class FROM c")
def class_by_share(spark: SparkSession, d: str) -> DataFrame:
    rows = W.running_total(downloads(spark, d), "v", "k")
    return rows.select("k", F.round(F.col("v") / F.col("total"), 8).alias("share"), N.value_class(F.col("cum") / F.col("total")).alias("class"))


REPO_ECO = f"WITH m AS ({MASS}), c AS (SELECT repo, eco, mass, sum(mass) OVER (PARTITION BY eco ORDER BY mass DESC, repo ROWS UNBOUNDED PRECEDING) AS cum, sum(mass) OVER (PARTITION BY eco) AS total FROM m)"


@query(REPO_ECO + "SELECT repo, eco, CASE WHEN cum / total <= 0.75 THEN 'A' WHEN cum / total <= 0.95 THEN 'B' ELSE 'C' END AS class, round(100 - 100 * cum / total, 4) AS pct FROM c")
def repo_eco_class(spark: SparkSession, d: str) -> DataFrame:
    c = W.running_total(repo_mass(spark, d), "mass", "repo", ["eco"])
    return c.select("repo", "eco", N.value_class(F.col("cum") / F.col("total")).alias("class"), F.round(100 - 100 * F.col("cum") / F.col("total"), 4).alias("pct"))


@query(REPO_ECO + ", p AS (SELECT repo, eco, 100 - 100 * cum / total AS pct, CASE WHEN cum / total <= 0.75 THEN 'A' WHEN cum / total <= 0.95 THEN 'B' ELSE 'C' END AS class FROM c) SELECT repo, eco AS top_eco, round(pct, 4) AS top_pct, best AS class FROM (SELECT *, min(class) OVER (PARTITION BY repo) AS best, row_number() OVER (PARTITION BY repo ORDER BY round(pct, 9) DESC, CASE eco WHEN 'Brand#7' THEN 0 WHEN 'Brand#3' THEN 1 ELSE 2 END, eco) AS r FROM p) WHERE r = 1")
def top_eco_pct(spark: SparkSession, d: str) -> DataFrame:
    c = W.running_total(repo_mass(spark, d), "mass", "repo", ["eco"]).withColumn("pct", 100 - 100 * F.col("cum") / F.col("total")).withColumn("c", N.value_class(F.col("cum") / F.col("total")))
    best = c.groupBy("repo").agg(F.min("c").alias("class"))
    return W.first_by(c, ["repo"], F.round("pct", 9).desc(), N.place_in(F.col("eco"), ("Brand#7", "Brand#3")), F.col("eco")).join(best, "repo").select("repo", F.col("eco").alias("top_eco"), F.round("pct", 4).alias("top_pct"), "class")


@query("SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal * (1 + c_nationkey) DESC, c_custkey)::BIGINT AS priority FROM customer WHERE c_acctbal > 0")
def priority_rank(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").where("c_acctbal > 0").select("c_custkey", (F.col("c_acctbal") * (1 + F.col("c_nationkey"))).alias("v"))
    return W.running_total(c, "v", "c_custkey").select("c_custkey", F.col("place").cast("long").alias("priority"))


@query("SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey)::INT AS eco_priority FROM customer")
def eco_priority_rank(spark: SparkSession, d: str) -> DataFrame:
    rows = W.running_total(table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), "c_acctbal", "c_custkey", ["c_mktsegment"])
    return rows.select("c_custkey", "c_mktsegment", F.col("place").cast("int").alias("eco_priority"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    return W.first_by(table(spark, d, "events"), ["user_id"], F.desc("ts"), F.desc("event_id")).select("user_id", "event_id", "event_type")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 25")
def composite_sort_top(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc_nulls_last(), "o_orderkey").limit(25)


@query()
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    """A repeatable sample of 20 rows by a hash of the key and a seed; no SQL has this hash."""
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").orderBy(F.xxhash64("o_orderkey", F.lit(42)), "o_orderkey").limit(20)
