"""Dependency graphs: parts of one order depend on the parts of its later lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.operators import graph as G
from tidewright.queries.registry import query, table

EDGES = "e AS (SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber WHERE a.l_partkey <> b.l_partkey), s AS (SELECT p_partkey AS node FROM part WHERE p_size = 11)"


def edges(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem")
    a = l.select("l_orderkey", F.col("l_partkey").alias("src"), F.col("l_linenumber").alias("n"))
    b = l.select("l_orderkey", F.col("l_partkey").alias("dst"), F.col("l_linenumber").alias("m"))
    return a.join(b, "l_orderkey").where("n < m and src <> dst").select("src", "dst").distinct()


def seeds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").where("p_size = 11").select(F.col("p_partkey").alias("node"))


@query(f"WITH RECURSIVE {EDGES}, r AS (SELECT node FROM s UNION SELECT dst FROM r JOIN e ON e.src = r.node) SELECT node FROM r")
def dep_closure(spark: SparkSession, d: str) -> DataFrame:
    return G.closure(seeds(spark, d), edges(spark, d)).select("node")


@query(f"WITH RECURSIVE {EDGES}, r AS (SELECT node FROM s UNION SELECT dst FROM r JOIN e ON e.src = r.node) SELECT src, dst FROM e WHERE src IN (SELECT node FROM r)")
def dep_tree_edges(spark: SparkSession, d: str) -> DataFrame:
    return G.dependency_tree(seeds(spark, d), edges(spark, d)).select("src", "dst")


@query("""
WITH RECURSIVE raw AS (
  SELECT l_partkey::VARCHAR AS src, CASE l_returnflag WHEN 'N' THEN (l_partkey + l_suppkey)::VARCHAR WHEN 'R' THEN '__none__' WHEN 'A' THEN l_suppkey::VARCHAR END AS dst, l_linestatus AS kind FROM lineitem WHERE l_quantity < 20
  UNION ALL SELECT p_partkey::VARCHAR, '', 'O' FROM part
), e AS (SELECT * FROM raw WHERE dst <> '' AND dst <> '__none__'
), r AS (SELECT p_partkey::VARCHAR AS node FROM part WHERE p_size = 11 UNION SELECT dst FROM r JOIN e ON e.src = r.node)
SELECT src, dst, kind FROM e WHERE src IN (SELECT node FROM r)
""")
def dep_tree_rows(spark: SparkSession, d: str) -> DataFrame:
    """Declared dependencies as they stand, repeats and all: the marker of none and blanks go, unknown targets stay."""
    l = table(spark, d, "lineitem").where("l_quantity < 20")
    dst = F.when(F.col("l_returnflag") == "N", (F.col("l_partkey") + F.col("l_suppkey")).cast("string")).when(F.col("l_returnflag") == "R", "__none__").when(F.col("l_returnflag") == "A", F.col("l_suppkey").cast("string"))
    raw = l.select(F.col("l_partkey").cast("string").alias("src"), dst.alias("dst"), F.col("l_linestatus").alias("kind"))
    raw = raw.unionByName(table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("src"), F.lit("").alias("dst"), F.lit("O").alias("kind")))
    from_parts = seeds(spark, d).select(F.col("node").cast("string").alias("node"))
    return G.dependency_tree(from_parts, raw, repeats=True)


def _pagerank_sql(rounds: int) -> str:
    sql = f"WITH {EDGES}, n0 AS (SELECT src AS node FROM e UNION SELECT dst FROM e UNION SELECT node FROM s), n AS (SELECT node, CASE WHEN node IN (SELECT node FROM s) THEN 1.0 / (SELECT count(*) FROM s) ELSE 0 END AS p, coalesce(deg, 0) AS deg FROM n0 LEFT JOIN (SELECT src, count(*) AS deg FROM e GROUP BY 1) ON src = node), r0 AS (SELECT node, p, deg, 1.0::DOUBLE / (SELECT count(*) FROM n0) AS x FROM n)"
    for i in range(rounds):
        sql += f", g{i} AS (SELECT dst AS node, sum(x / deg) AS got FROM e JOIN r{i} ON node = src GROUP BY 1), r{i + 1} AS (SELECT r.node, p, deg, 0.85 * (coalesce(got, 0) + (SELECT coalesce(sum(x), 0) FROM r{i} WHERE deg = 0) * p) + 0.15 * p AS x FROM r{i} r LEFT JOIN g{i} USING (node))"
    return sql + f" SELECT node, round(x, 6) AS rank FROM r{rounds}"


@query(_pagerank_sql(6))
def pagerank_k(spark: SparkSession, d: str) -> DataFrame:
    given = seeds(spark, d).withColumn("weight", F.lit(1.0))
    return G.pagerank(edges(spark, d), given, rounds=6).select("node", F.round("rank", 6).alias("rank"))


@query()
def pagerank_converged(spark: SparkSession, d: str) -> DataFrame:
    """Ranks at the stopping tolerance; tested against small graphs with known ranks."""
    given = seeds(spark, d).withColumn("weight", F.lit(1.0))
    return G.pagerank(edges(spark, d), given).select("node", F.round("rank", 8).alias("rank"))


@query(f"WITH {EDGES} SELECT DISTINCT coalesce(a.p_brand, src::VARCHAR) AS src, coalesce(b.p_brand, dst::VARCHAR) AS dst FROM e LEFT JOIN part a ON a.p_partkey = src AND src % 4 <> 0 LEFT JOIN part b ON b.p_partkey = dst AND dst % 4 <> 0 WHERE coalesce(a.p_brand, src::VARCHAR) <> coalesce(b.p_brand, dst::VARCHAR)")
def edge_contraction(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "part").where("p_partkey % 4 <> 0").select(F.col("p_partkey").cast("string").alias("node"), F.col("p_brand").alias("group"))
    return G.contract(edges(spark, d).select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst")), m)


@query("""
WITH RECURSIVE v AS (SELECT DISTINCT l_orderkey AS id, l_partkey * 100000 + l_suppkey AS alias FROM lineitem WHERE l_returnflag = 'R'),
l AS (SELECT x.id AS src, y.id AS dst FROM v x JOIN v y ON x.alias = y.alias), r AS (SELECT id AS node, id AS seen FROM v UNION SELECT r.node, l.dst FROM r JOIN l ON l.src = r.seen), g AS (SELECT node, min(seen) AS canonical FROM r GROUP BY 1)
SELECT canonical, count(*)::BIGINT AS ids, min(o_orderdate) AS published FROM g JOIN orders ON node = o_orderkey GROUP BY 1
""")
def vuln_alias_components(spark: SparkSession, d: str) -> DataFrame:
    """Reports that share an identifier are one, whenever they were published; those without an order connect others and are not counted."""
    v = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("node"), (F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("alias"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("node"), "o_orderdate")
    found = G.alias_components(v, "node", "alias").join(o, "node")
    return found.groupBy(F.col("label").alias("canonical")).agg(F.count("*").alias("ids"), F.min("o_orderdate").alias("published"))


@query("SELECT c_custkey, bool_or(c_acctbal > 9900) OVER (PARTITION BY c_nationkey) AS intent FROM customer")
def owner_propagation(spark: SparkSession, d: str) -> DataFrame:
    """One flag an owner, joined back: no owner's repositories meet in one task."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", (F.col("c_acctbal") > 9900).alias("own"))
    flags = c.groupBy("c_nationkey").agg(F.bool_or("own").alias("intent"))
    return c.join(flags, "c_nationkey").select("c_custkey", "intent")


@query("""
SELECT coalesce(a.k, b.k) AS project, round(1.39 * coalesce(deb, 0) + 1.0 * coalesce(brew, 0), 4) AS score, coalesce(tag, false) AS cpp
FROM (SELECT p_name AS k, max(p_retailprice) AS deb, bool_or(p_size > 45) AS tag FROM part GROUP BY 1) a
FULL JOIN (SELECT s_name AS k, max(s_acctbal) AS brew FROM supplier GROUP BY 1 UNION ALL SELECT p_name, max(p_size) FROM part GROUP BY 1 HAVING max(p_size) > 49) b ON a.k = b.k
""")
def combine_sources(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    a = p.groupBy(F.col("p_name").alias("project")).agg(F.max("p_retailprice").alias("deb"), F.bool_or(F.col("p_size") > 45).alias("tag"))
    b = p.groupBy(F.col("p_name").alias("project")).agg(F.max("p_size").cast("double").alias("brew")).where("brew > 49")
    b = b.unionByName(table(spark, d, "supplier").groupBy(F.col("s_name").alias("project")).agg(F.max("s_acctbal").alias("brew")))
    return a.join(b, "project", "full_outer").select("project", F.round(1.39 * F.coalesce("deb", F.lit(0)) + 1.0 * F.coalesce("brew", F.lit(0)), 4).alias("score"), F.coalesce("tag", F.lit(False)).alias("cpp"))
