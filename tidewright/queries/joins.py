"""Joins with fallbacks, as-of picks and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions import urls
from tidewright.operators import joins as J
from tidewright.operators import windows
from tidewright.queries.registry import query, table


@query("SELECT s_suppkey, n_name, r_name, parts FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT l_suppkey, count(DISTINCT l_partkey)::BIGINT AS parts FROM lineitem GROUP BY 1) ON s_suppkey = l_suppkey")
def left_join_dims(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("parts"))
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return s.join(parts, F.col("s_suppkey") == F.col("l_suppkey"), "left").select("s_suppkey", "n_name", "r_name", "parts")


FALLBACK = """
WITH dim AS (SELECT s_suppkey AS id, s_nationkey AS nat, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_acctbal END AS val FROM supplier WHERE s_suppkey % 3 = 0),
byid AS (SELECT id, min(val) AS v FROM dim GROUP BY 1), bynat AS (SELECT nat, min(val) AS v FROM dim GROUP BY 1)
"""


def _dim(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nat"), F.when(F.col("s_suppkey") % 4 != 0, F.col("s_acctbal")).alias("val"))


@query(FALLBACK + "SELECT s_suppkey, coalesce(a.v, b.v) AS val FROM supplier LEFT JOIN byid a ON s_suppkey = a.id LEFT JOIN bynat b ON s_nationkey = b.nat")
def two_key_fallback(spark: SparkSession, d: str) -> DataFrame:
    return J.two_key_fallback(table(spark, d, "supplier"), _dim(spark, d), ("s_suppkey", "s_nationkey"), ("id", "nat"), "val", "out").select("s_suppkey", F.col("out").alias("val"))


@query(FALLBACK + "SELECT s_suppkey, CASE WHEN a.id IS NOT NULL THEN a.v ELSE b.v END AS val FROM supplier LEFT JOIN byid a ON s_suppkey = a.id LEFT JOIN bynat b ON s_nationkey = b.nat")
def presence_aware_fallback(spark: SparkSession, d: str) -> DataFrame:
    return J.two_key_fallback(table(spark, d, "supplier"), _dim(spark, d), ("s_suppkey", "s_nationkey"), ("id", "nat"), "val", "out", stop_at_hit=True).select("s_suppkey", F.col("out").alias("val"))


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def semi_anti_gate(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    c = table(spark, d, "customer").select("c_custkey")
    return c.join(o.where("o_orderstatus = 'P'"), "c_custkey", "left_semi").join(o.where("o_orderpriority = '1-URGENT'"), "c_custkey", "left_anti")


@query("""
WITH a AS (SELECT p_partkey AS k, p_size, p_brand FROM part WHERE p_partkey % 7 <> 0), b AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_size END AS p_size, CASE WHEN p_partkey % 5 = 0 THEN 'x' ELSE p_brand END AS p_brand FROM part WHERE p_partkey % 9 <> 0)
SELECT * FROM (SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'built_only' WHEN a.k IS NULL THEN 'stored_only' WHEN a.p_size IS DISTINCT FROM b.p_size THEN 'p_size' WHEN a.p_brand IS DISTINCT FROM b.p_brand THEN 'p_brand' END AS verdict FROM a FULL JOIN b ON a.k = b.k) WHERE verdict IS NOT NULL
""")
def full_outer_diff(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    a = p.where("p_partkey % 7 <> 0").select(F.col("p_partkey").alias("k"), "p_size", "p_brand")
    b = p.where("p_partkey % 9 <> 0").select(F.col("p_partkey").alias("k"), F.when(F.col("p_partkey") % 11 != 0, F.col("p_size")).alias("p_size"), F.when(F.col("p_partkey") % 5 == 0, "x").otherwise(F.col("p_brand")).alias("p_brand"))
    return J.table_diff(a, b, "k", ["p_size", "p_brand"])


@query("""
SELECT p_partkey, coalesce(r.r_name, CASE WHEN n.n_name IS NOT NULL THEN 'debian:' || n.n_name END, 'bin:' || p_name) AS project
FROM part LEFT JOIN supplier ON p_partkey % 120 = s_suppkey LEFT JOIN nation n ON s_nationkey = n_nationkey LEFT JOIN region r ON n_regionkey = r_regionkey AND r_regionkey < 2
""")
def name_chain_default(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").join(table(spark, d, "supplier"), F.col("p_partkey") % 120 == F.col("s_suppkey"), "left")
    p = p.join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left").join(table(spark, d, "region").where("r_regionkey < 2"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return p.select("p_partkey", F.coalesce("r_name", F.concat(F.lit("debian:"), "n_name"), F.concat(F.lit("bin:"), "p_name")).alias("project"))


@query("""
SELECT alias, project FROM (SELECT alias, project, row_number() OVER (PARTITION BY alias ORDER BY prio, project) AS r FROM (
  SELECT p_name AS alias, p_partkey AS project, 0 AS prio FROM part UNION ALL SELECT p_brand, p_partkey, 1 FROM part UNION ALL SELECT p_type, p_partkey, 2 FROM part)) WHERE r = 1
""")
def alias_first_wins(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    sources = [p.select(F.col(c).alias("alias"), F.col("p_partkey").alias("project")) for c in ("p_name", "p_brand", "p_type")]
    return J.first_wins(sources, "alias")


HOST = "regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/:?#]*)', 1), '^www\\.', '')"


@query(rf"""
WITH h AS (SELECT page_id, {HOST} AS host FROM pages),
rules AS (SELECT 'example.com' AS dom, 'com' AS label, false AS exclude UNION ALL SELECT 'example.org', 'org', false UNION ALL SELECT 'example.net', 'net', false UNION ALL SELECT 'org', 'any', false
  UNION ALL SELECT DISTINCT host, 'own ' || host, false FROM h WHERE page_id < 40 UNION ALL SELECT DISTINCT regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1), NULL, true FROM h WHERE host LIKE 't%')
SELECT page_id, host, CASE WHEN NOT coalesce((SELECT bool_or(exclude) FROM rules WHERE dom <> '' AND (host = dom OR host LIKE '%.' || dom)), false)
  THEN (SELECT label FROM rules WHERE dom <> '' AND label IS NOT NULL AND (host = dom OR host LIKE '%.' || dom) ORDER BY length(dom) DESC, label LIMIT 1) END AS label FROM h
""")
def suffix_domain_match(spark: SparkSession, d: str) -> DataFrame:
    """Exclusions first, however short, then the longest domain: the rules come from the pages' own hosts."""
    pages = table(spark, d, "pages").select("page_id", urls.apex(F.col("url")).alias("host"))
    kind = "domain string, label string, exclude boolean"
    rules = spark.createDataFrame([("example.com", "com", False), ("example.org", "org", False), ("example.net", "net", False), ("org", "any", False)], kind)
    own = pages.where("page_id < 40").select(F.col("host").alias("domain"), F.concat(F.lit("own "), "host").alias("label"), F.lit(False).alias("exclude")).distinct()
    barred = pages.where(F.col("host").startswith("t")).select(F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1).alias("domain"), F.lit(None).cast("string").alias("label"), F.lit(True).alias("exclude")).distinct()
    return J.match_suffix(pages, "host", rules.unionByName(own).unionByName(barred))


@query("""
SELECT s_suppkey, coalesce(o1.v, o2.v, 'base') AS host_type FROM supplier LEFT JOIN (VALUES (3, 'foundation'), (50, 'company')) o1(k, v) ON s_suppkey = o1.k LEFT JOIN (VALUES (3, 'company'), (7, 'nonprofit')) o2(n, v) ON s_nationkey = o2.n
""")
def glob_override(spark: SparkSession, d: str) -> DataFrame:
    rules = [("3/3", "foundation"), ("3/*", "company"), ("7/*", "nonprofit"), ("*/50", "company")]
    own = spark.createDataFrame([(int(p.split("/")[1]), v) for p, v in rules if not p.endswith("*")], "k long, own string")
    wide = spark.createDataFrame([(int(p.split("/")[0]), v) for p, v in rules if p.endswith("*")], "n int, wide string")
    s = table(spark, d, "supplier").join(F.broadcast(own), F.col("s_suppkey") == F.col("k"), "left").join(F.broadcast(wide), F.col("s_nationkey") == F.col("n"), "left")
    return s.select("s_suppkey", F.coalesce("own", "wide", F.lit("base")).alias("host_type"))


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day(ts) DESC, event_id) AS r FROM events WHERE event_type <> 'error') WHERE r = 1")
def snapshot_pick_priority(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").where("event_type <> 'error'")
    return windows.first_by(e, ["user_id"], F.dayofmonth("ts").desc(), F.col("event_id")).select("user_id", "event_id", "value")


@query("SELECT user_id, event_id, loc FROM (SELECT user_id, event_id, loc, row_number() OVER (PARTITION BY user_id ORDER BY (loc > 0) DESC, ts DESC, event_id) AS r FROM (SELECT user_id, event_id, ts, CASE WHEN event_type = 'view' THEN floor(value) ELSE 0 END::BIGINT AS loc FROM events)) WHERE r = 1")
def snapshot_pick_predicate(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("loc", F.when(F.col("event_type") == "view", F.floor("value")).otherwise(0).cast("long"))
    return windows.first_by(e, ["user_id"], (F.col("loc") > 0).desc(), F.desc("ts"), F.col("event_id")).select("user_id", "event_id", "loc")


@query("""
WITH h AS (SELECT o_custkey AS cust, year(o_orderdate)::INT AS y, max(o_orderkey) AS sha FROM orders GROUP BY 1, 2), p AS (SELECT DISTINCT h.cust, t.y::INT AS y FROM h, range(1995, 2003) t(y))
SELECT p.cust, p.y, (SELECT max_by(h.sha, h.y) FROM h WHERE h.cust = p.cust AND h.y <= p.y AND p.y - h.y < 2) AS sha FROM p
""")
def asof_backward_year(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("cust"), F.year("o_orderdate").alias("yy")).agg(F.max("o_orderkey").alias("sha"))
    p = h.select("cust").distinct().select("cust", F.explode(F.sequence(F.lit(1995), F.lit(2002))).alias("y"))
    return J.asof_backward(p, h, "cust", "y", "yy", "sha", "found", reach=2).select("cust", "y", F.col("found").alias("sha"))


@query("SELECT user_id, y::INT AS d, min_by(event_id, (abs(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01' + to_days(y::INT))), event_id)) AS event_id FROM events, (VALUES (5), (15), (25)) t(y) GROUP BY 1, 2")
def nearest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", "ts", F.explode(F.array(*[F.lit(x) for x in (5, 15, 25)])).alias("d"))
    gap = F.abs(F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.timestamp_add("DAY", F.col("d"), F.lit("2024-01-01").cast("timestamp"))))
    return e.groupBy("user_id", "d").agg(F.min_by("event_id", F.struct(gap.alias("g"), "event_id")).alias("event_id"))


@query("SELECT s_suppkey, coalesce(l.q, m.q)::BIGINT AS churn, CASE WHEN l.q IS NOT NULL THEN 'local' WHEN m.q IS NOT NULL THEN 'mirror' END AS source FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS q FROM lineitem WHERE l_quantity > 49 AND l_tax > 0.07 GROUP BY 1) l ON s_suppkey = l.l_suppkey LEFT JOIN (SELECT l_suppkey, count(*) AS q FROM lineitem WHERE l_quantity < 2 GROUP BY 1) m ON s_suppkey = m.l_suppkey")
def source_fallback_label(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem")
    a = l.where("l_quantity > 49 and l_tax > 0.07").groupBy(F.col("l_suppkey").alias("ka")).agg(F.count("*").alias("a"))
    b = l.where("l_quantity < 2").groupBy(F.col("l_suppkey").alias("kb")).agg(F.count("*").alias("b"))
    s = table(spark, d, "supplier").join(a, F.col("s_suppkey") == F.col("ka"), "left").join(b, F.col("s_suppkey") == F.col("kb"), "left")
    return s.select("s_suppkey", F.coalesce("a", "b").alias("churn"), F.when(F.col("a").isNotNull(), "local").when(F.col("b").isNotNull(), "mirror").alias("source"))


@query("SELECT c_custkey, coalesce(m.new, c_nationkey)::INT AS nation FROM customer LEFT JOIN (VALUES (1, 2), (5, 6), (9, 9)) m(old, new) ON c_nationkey = m.old")
def rename_overlay(spark: SparkSession, d: str) -> DataFrame:
    m = spark.createDataFrame([(1, 2), (5, 6), (9, 9)], "old int, new int")
    return table(spark, d, "customer").join(F.broadcast(m), F.col("c_nationkey") == F.col("old"), "left").select("c_custkey", F.coalesce("new", "c_nationkey").alias("nation"))


@query("""
WITH o(k, p) AS (VALUES (1, -1), (1, -2), (4, -3)), derived AS (SELECT DISTINCT l_suppkey AS k, l_partkey AS p FROM lineitem)
SELECT k::BIGINT AS k, p::BIGINT AS p FROM derived WHERE k NOT IN (SELECT k FROM o) UNION ALL SELECT k, p FROM o
""")
def replace_join(spark: SparkSession, d: str) -> DataFrame:
    from tidewright.operators.reshape import replace_group

    derived = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_partkey").alias("p")).distinct()
    return replace_group(derived, spark.createDataFrame([(1, -1), (1, -2), (4, -3)], "k long, p long"), "k")


@query("SELECT lic, source FROM (SELECT lic, source, row_number() OVER (PARTITION BY lic ORDER BY prio) AS r FROM (SELECT DISTINCT n_name AS lic, 'osi' AS source, 0 AS prio FROM nation WHERE n_nationkey < 15 UNION ALL SELECT DISTINCT n_name, 'fsf', 1 FROM nation WHERE n_nationkey > 10 UNION ALL VALUES ('NATION_3', 'extra', 2), ('X', 'extra', 2))) WHERE r = 1")
def union_first_label(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    parts = [n.where("n_nationkey < 15").select(F.col("n_name").alias("lic"), F.lit("osi").alias("source")), n.where("n_nationkey > 10").select(F.col("n_name").alias("lic"), F.lit("fsf").alias("source")), spark.createDataFrame([("NATION_3", "extra"), ("X", "extra")], "lic string, source string")]
    return J.first_wins(parts, "lic")


@query("""
WITH a AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS k FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS k FROM lineitem WHERE l_returnflag = 'A')
SELECT 'both' AS side, s AS l_suppkey, k AS l_partkey FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'first', s, k FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'second', s, k FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
""")
def set_intersect_except(spark: SparkSession, d: str) -> DataFrame:
    """Parts that came back and that were accepted, for every supplier."""
    l = table(spark, d, "lineitem")
    return J.sets_by_key(l.where("l_returnflag = 'R'"), l.where("l_returnflag = 'A'"), ["l_suppkey", "l_partkey"])


@query("SELECT c_nationkey, len(list_filter(list_distinct(list(c_mktsegment)), lambda x: x NOT IN ('BUILDING','MACHINERY','HOUSEHOLD','FURNITURE','AUTOMOBILE'))) = 0 AS subset FROM customer GROUP BY 1")
def subset_test(spark: SparkSession, d: str) -> DataFrame:
    known = F.array(*[F.lit(x) for x in ("BUILDING", "MACHINERY", "HOUSEHOLD", "FURNITURE", "AUTOMOBILE")])
    return table(spark, d, "customer").groupBy("c_nationkey").agg((F.size(F.array_except(F.collect_set("c_mktsegment"), known)) == 0).alias("subset"))
