"""Predicates, flags and worklists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions import numbers as N
from tidewright.queries.registry import query, table


@query("SELECT c_custkey, upper(trim(c_name)) AS name_key FROM customer WHERE trim(c_name) <> ''")
def scan_project_trim(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", F.upper(F.trim("c_name")).alias("name_key")).where("name_key <> ''")


@query("""
SELECT event_id, TRY_CAST(nullif(trim(cell), '') AS DOUBLE) AS or_null, coalesce(TRY_CAST(nullif(trim(cell), '') AS DOUBLE), 0) AS or_zero
FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN ' ' WHEN 1 THEN event_type WHEN 2 THEN ' ' || event_id::VARCHAR || ' ' ELSE '0' END AS cell FROM events)
""")
def num_lenient_parse(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id") % 4
    cell = F.when(k == 0, " ").when(k == 1, F.col("event_type")).when(k == 2, F.concat(F.lit(" "), F.col("event_id").cast("string"), F.lit(" "))).otherwise("0")
    return table(spark, d, "events").select("event_id", N.num_or_null(cell).alias("or_null"), N.num_or_zero(cell).alias("or_zero"))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING','MACHINERY') AND c_acctbal > 0 AND c_name <> ''")
def scope_filter(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & (F.col("c_acctbal") > 0) & (F.col("c_name") != "")).select("c_custkey", "c_mktsegment")


@query("SELECT c_custkey, CASE WHEN c_acctbal/10000 <= 0.75 THEN 'A' WHEN c_acctbal/10000 <= 0.95 THEN 'B' ELSE 'C' END AS class FROM customer")
def class_bucket(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", N.value_class(F.col("c_acctbal") / 10000).alias("class"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending' WHEN o_totalprice < 1000 THEN 'small' ELSE 'open' END AS reason
FROM orders WHERE o_orderpriority IN ('1-URGENT','2-HIGH') AND o_orderstatus <> 'F'
""")
def flag_reason_case(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_orderstatus") != "F"))
    return o.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "pending").when(F.col("o_totalprice") < 1000, "small").otherwise("open").alias("reason"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'override' WHEN c_acctbal > 5000 THEN c_mktsegment WHEN n_regionkey < 3 THEN n_name ELSE 'noassertion' END AS license,
  CASE WHEN c_custkey % 5 = 0 THEN 'override' WHEN c_acctbal > 5000 THEN 'registry' WHEN n_regionkey < 3 THEN 'github' ELSE 'registry' END AS license_source
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def priority_coalesce(spark: SparkSession, d: str) -> DataFrame:
    from tidewright.functions.licenses import pick_license

    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    picked = pick_license([
        ("override", F.when(F.col("c_custkey") % 5 == 0, "override")),
        ("registry", F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment")).otherwise("noassertion")),
        ("github", F.when(F.col("n_regionkey") < 3, F.col("n_name")).otherwise("")),
    ])
    return rows.select("c_custkey", picked.alias("p")).select("c_custkey", F.col("p.license").alias("license"), F.col("p.source").alias("license_source"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END AS flag FROM customer")
def three_valued_flag(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey") % 3
    cell = F.when(k == 0, "True").when(k == 1, "False").otherwise("")
    return table(spark, d, "customer").select("c_custkey", N.flag(cell).alias("flag"))


@query("""
SELECT c_custkey, coalesce(c_acctbal > 0, false) AND coalesce(n_regionkey <> 2, true) AND coalesce(r_name <> 'ASIA', false) AS eligible
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey <> 7 LEFT JOIN region ON n_regionkey = r_regionkey
""")
def and_with_defaults(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").where("n_nationkey <> 7")
    rows = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    flags = F.coalesce(F.col("c_acctbal") > 0, F.lit(False)) & F.coalesce(F.col("n_regionkey") != 2, F.lit(True)) & F.coalesce(F.col("r_name") != "ASIA", F.lit(False))
    return rows.select("c_custkey", flags.alias("eligible"))


@query("""
SELECT p_partkey, (CASE WHEN p_size % 4 <> 0 THEN 1 ELSE 0 END + CASE WHEN p_retailprice > 950 THEN 1 ELSE 0 END + 1)::INT AS present,
  (CASE WHEN p_size % 4 <> 0 THEN 1 ELSE 0 END + CASE WHEN p_retailprice > 950 THEN 1 ELSE 0 END + 1) >= 2 AS complete FROM part
""")
def count_nonzero_complete(spark: SparkSession, d: str) -> DataFrame:
    n = N.count_nonzero(F.col("p_size") % 4, F.when(F.col("p_retailprice") > 950, F.col("p_retailprice")), F.lit(1))
    return table(spark, d, "part").select("p_partkey", n.cast("int").alias("present"), (n >= 2).alias("complete"))


@query("""
SELECT event_id, event_type <> 'error' AND ts >= CASE WHEN event_type = 'signup' THEN TIMESTAMP '2024-01-25' ELSE TIMESTAMP '2024-01-10' END AS fresh FROM events
""")
def freshness_dual_ttl(spark: SparkSession, d: str) -> DataFrame:
    at = F.lit("2024-01-30").cast("timestamp")
    days = F.when(F.col("event_type") == "signup", 5).otherwise(20)
    fresh = (F.col("event_type") != "error") & (F.col("ts") >= F.timestamp_add("DAY", -days, at))
    return table(spark, d, "events").select("event_id", fresh.alias("fresh"))


@query("""
SELECT k.o_custkey AS custkey, s.state AS state, y.year::INT AS year
FROM (SELECT DISTINCT o_custkey FROM orders) k, (VALUES ('O'), ('F')) s(state), range(1996, 2001) y(year)
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = k.o_custkey AND o.o_orderstatus = s.state AND year(o.o_orderdate) = y.year)
""")
def gap_worklist(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("state"), F.year("o_orderdate").alias("year"))
    grid = o.select("custkey").distinct().select("custkey", F.explode(F.array(F.lit("O"), F.lit("F"))).alias("state")).select("custkey", "state", F.explode(F.sequence(F.lit(1996), F.lit(2000))).alias("year"))
    return grid.join(o, ["custkey", "state", "year"], "left_anti")


@query("SELECT o_custkey, count(*)::BIGINT AS orders FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 2000 GROUP BY 1 HAVING count(DISTINCT year(o_orderdate)) = 5")
def all_years_division(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").where(F.year("o_orderdate").between(1996, 2000))
    return o.groupBy("o_custkey").agg(F.count("*").alias("orders"), F.count_distinct(F.year("o_orderdate")).alias("y")).where("y = 5").drop("y")


@query("""
SELECT s_suppkey, (s_acctbal > 0 AND s_nationkey <> 3) AS active, (CASE WHEN s_nationkey % 3 = 0 THEN 0.0 WHEN s_acctbal > 5000 THEN 0.5 ELSE 1.0 END)::DOUBLE AS backing FROM supplier
""")
def active_and_backing(spark: SparkSession, d: str) -> DataFrame:
    owner = F.when(F.col("s_nationkey") % 3 == 0, "company").otherwise("none")
    host = F.when(F.col("s_acctbal") > 5000, "nonprofit").otherwise("none")
    eol, archived = F.col("s_acctbal") <= 0, F.col("s_nationkey") == 3
    return table(spark, d, "supplier").select("s_suppkey", (~eol & ~archived).alias("active"), F.least(N.backing_score(owner), N.backing_score(host)).alias("backing"))


@query("SELECT user_id, max(ts) >= TIMESTAMP '2024-01-29' AS fresh FROM events GROUP BY 1")
def newest_row_fresh(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("user_id").agg((F.max("ts") >= F.lit("2024-01-29").cast("timestamp")).alias("fresh"))


@query("SELECT p_partkey, p_size % 10 = 0 AND p_retailprice >= 5 AND p_brand NOT LIKE 'Brand#2%' AS false_zero, CASE WHEN p_size % 10 = 0 AND p_brand NOT LIKE 'Brand#2%' THEN NULL ELSE p_size END AS measured FROM part")
def false_zero_guard(spark: SparkSession, d: str) -> DataFrame:
    odd = (F.col("p_size") % 10 == 0) & (F.col("p_retailprice") >= 5) & ~F.col("p_brand").startswith("Brand#2")
    return table(spark, d, "part").select("p_partkey", odd.alias("false_zero"), F.when(~odd, F.col("p_size")).alias("measured"))


@query("SELECT c_custkey, len(list_filter(['github','gitlab',lower(c_mktsegment)], lambda x: x NOT IN ('github','gitlab','building'))) > 0 AS unmeasured FROM customer")
def unmeasured_channels(spark: SparkSession, d: str) -> DataFrame:
    declared = F.array(F.lit("github"), F.lit("gitlab"), F.lower("c_mktsegment"))
    known = F.array(F.lit("github"), F.lit("gitlab"), F.lit("building"))
    return table(spark, d, "customer").select("c_custkey", (F.size(F.array_except(declared, known)) > 0).alias("unmeasured"))
