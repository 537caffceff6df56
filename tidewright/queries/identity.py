"""Which repository a package belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions import urls
from tidewright.operators import windows as W
from tidewright.queries.registry import query, table

CAND = """
cand AS (SELECT p_partkey AS pkg, 'github' AS platform, 'https://github.com/' || p_type || '/' || p_name AS url, 0 AS prio, p_size % 3 = 0 AS invalid FROM part
UNION ALL SELECT p_partkey, 'gitlab', 'https://gitlab.com/' || p_type || '/' || p_brand, 1, p_size % 2 = 0 FROM part WHERE p_partkey % 2 = 0
UNION ALL SELECT p_partkey, 'github', 'https://github.com/alt/' || p_brand, 2, false FROM part WHERE p_partkey % 5 = 0)
"""


def candidates(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    a = p.select(F.col("p_partkey").alias("pkg"), F.lit("github").alias("platform"), F.concat(F.lit("https://github.com/"), "p_type", F.lit("/"), "p_name").alias("url"), F.lit(0).alias("prio"), (F.col("p_size") % 3 == 0).alias("invalid"))
    b = p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("pkg"), F.lit("gitlab").alias("platform"), F.concat(F.lit("https://gitlab.com/"), "p_type", F.lit("/"), "p_brand").alias("url"), F.lit(1).alias("prio"), (F.col("p_size") % 2 == 0).alias("invalid"))
    c = p.where("p_partkey % 5 = 0").select(F.col("p_partkey").alias("pkg"), F.lit("github").alias("platform"), F.concat(F.lit("https://github.com/alt/"), "p_brand").alias("url"), F.lit(2).alias("prio"), F.lit(False).alias("invalid"))
    return a.unionByName(b).unionByName(c)


@query(f"WITH {CAND} SELECT pkg, platform, url, prio FROM (SELECT *, row_number() OVER (PARTITION BY pkg, platform ORDER BY invalid, prio, url) AS r FROM cand) WHERE r = 1")
def merge_urls_priority(spark: SparkSession, d: str) -> DataFrame:
    """The first valid address of each platform by source; if all are invalid, the first of all."""
    return W.first_by(candidates(spark, d), ["pkg", "platform"], F.col("invalid"), F.col("prio"), F.col("url")).select("pkg", "platform", "url", "prio")


@query(f"WITH {CAND}, m AS (SELECT *, row_number() OVER (PARTITION BY pkg, platform ORDER BY invalid, prio, url) AS r FROM cand) SELECT pkg, url AS git FROM (SELECT pkg, url, row_number() OVER (PARTITION BY pkg ORDER BY CASE platform WHEN 'github' THEN 0 ELSE 1 END) AS h FROM m WHERE r = 1) WHERE h = 1")
def host_priority_pick(spark: SparkSession, d: str) -> DataFrame:
    merged = W.first_by(candidates(spark, d), ["pkg", "platform"], F.col("invalid"), F.col("prio"), F.col("url"))
    wide = merged.groupBy("pkg").pivot("platform", list(urls.HOST_PRIORITY)).agg(F.first("url"))
    return wide.select("pkg", F.coalesce(*urls.HOST_PRIORITY).alias("git"))


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey NOT IN (1, 2) AND (s_name LIKE '%7' OR s_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_suppkey < 5))")
def rename_candidates(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    out = s.join(spark.createDataFrame([(1,), (2,)], "s_nationkey int"), "s_nationkey", "left_anti")
    by_name = out.where(F.col("s_name").endswith("7"))
    by_owner = out.join(s.where("s_suppkey < 5").select("s_nationkey"), "s_nationkey", "left_semi")
    return by_name.unionByName(by_owner).select("s_suppkey", "s_name").distinct()


@query("SELECT rid, custkey FROM (SELECT c_nationkey AS rid, c_custkey AS custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment = 'BUILDING' DESC, c_acctbal > 0 DESC, c_custkey DESC) AS r FROM customer) WHERE r = 1")
def heal_duplicates(spark: SparkSession, d: str) -> DataFrame:
    best = W.first_by(table(spark, d, "customer"), ["c_nationkey"], (F.col("c_mktsegment") == "BUILDING").desc(), (F.col("c_acctbal") > 0).desc(), F.desc("c_custkey"))
    return best.select(F.col("c_nationkey").alias("rid"), F.col("c_custkey").alias("custkey"))


@query("SELECT c_custkey, c_nationkey % 3 = 0 OR c_mktsegment = 'BUILDING' OR c_acctbal > 9000 AS intent, NOT coalesce(c_nationkey = 4, false) AND NOT coalesce(c_mktsegment = 'MACHINERY', false) AS nonprofit FROM customer")
def funding_intent(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select("c_custkey", ((F.col("c_nationkey") % 3 == 0) | (F.col("c_mktsegment") == "BUILDING") | (F.col("c_acctbal") > 9000)).alias("intent"), (~F.coalesce(F.col("c_nationkey") == 4, F.lit(False)) & ~F.coalesce(F.col("c_mktsegment") == "MACHINERY", F.lit(False))).alias("nonprofit"))
