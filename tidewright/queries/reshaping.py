"""Long and wide tables, upserts, quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.operators import quality as Q
from tidewright.operators import reshape as R
from tidewright.queries.registry import query, table

LONG = "l AS (SELECT user_id AS repo, event_type AS metric, max(value) AS value FROM events GROUP BY 1, 2)"


def long_metrics(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.col("user_id").alias("repo"), F.col("event_type").alias("metric")).agg(F.max("value").alias("value"))


@query(f"WITH {LONG}, n AS (SELECT repo, metric, CASE WHEN repo % 5 = 0 THEN NULL ELSE value + 1 END AS value FROM l WHERE repo % 2 = 0) SELECT l.repo, l.metric, coalesce(n.value, l.value) AS value FROM l LEFT JOIN n ON l.repo = n.repo AND l.metric = n.metric")
def long_upsert(spark: SparkSession, d: str) -> DataFrame:
    old = long_metrics(spark, d)
    new = old.where("repo % 2 = 0").withColumn("value", F.when(F.col("repo") % 5 != 0, F.col("value") + 1))
    return R.upsert(old, new, ["repo", "metric"], "value")


@query(f"WITH {LONG} SELECT repo, max(CASE WHEN metric = 'view' THEN value END) AS \"view\", max(CASE WHEN metric = 'click' THEN value END) AS click, max(CASE WHEN metric = 'error' THEN value END) AS error FROM l GROUP BY 1")
def long_to_wide(spark: SparkSession, d: str) -> DataFrame:
    return R.long_to_wide(long_metrics(spark, d), ["repo"], "metric", "value", ["view", "click", "error"])


@query("SELECT p_partkey, 'size' AS metric, p_size::DOUBLE AS value FROM part WHERE p_size % 4 <> 0 UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part")
def wide_to_long(spark: SparkSession, d: str) -> DataFrame:
    wide = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 4 != 0, F.col("p_size").cast("double")).alias("size"), F.col("p_retailprice").alias("price"))
    return R.wide_to_long(wide, ["p_partkey"], ["size", "price"], "metric", "value")


@query("SELECT p_partkey, p_name, CASE WHEN p_type <> 'PROMO' THEN p_brand END AS note FROM part")
def preserve_columns(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return R.preserve_columns(p.select("p_partkey", "p_name"), p.where("p_type <> 'PROMO'").select("p_partkey", F.col("p_brand").alias("note")), "p_partkey")


@query("SELECT user_id, event_id, aliases FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY (event_type <> 'error') DESC, ts DESC, event_type) AS r FROM events) JOIN (SELECT user_id AS u, array_to_string(list_sort(list_distinct(list(event_type))), '|') AS aliases FROM events GROUP BY 1) ON u = user_id WHERE r = 1")
def dedupe_freshest(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("ok", F.col("event_type") != "error")
    return R.freshest(e, "user_id", "ok", "ts", "event_type").select("user_id", "event_id", F.array_join("aliases", "|").alias("aliases"))


@query("SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN '' WHEN p_size % 2 = 0 THEN (p_size // 2)::VARCHAR ELSE (p_size / 2)::VARCHAR END AS cell FROM part")
def format_cells(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").withColumn("v", F.when(F.col("p_size") % 4 == 0, F.lit("NaN").cast("double")).otherwise(F.col("p_size") / 2))
    return p.select("p_partkey", R.format_cell("v").alias("cell"))


@query("""
SELECT 'acctbal_range' AS rule, c_custkey::BIGINT AS key FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'segment_domain', c_custkey FROM customer WHERE c_mktsegment NOT IN ('BUILDING','MACHINERY','HOUSEHOLD')
UNION ALL SELECT 'score_without_input', c_custkey FROM customer WHERE c_acctbal > 9990 AND c_nationkey > 20
""")
def quality_rules(spark: SparkSession, d: str) -> DataFrame:
    rules = {
        "acctbal_range": F.col("c_acctbal") >= 0,
        "segment_domain": F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD"),
        "score_without_input": ~((F.col("c_acctbal") > 9990) & (F.col("c_nationkey") > 20)),
    }
    return Q.violations(table(spark, d, "customer"), F.col("c_custkey").cast("long"), rules)


@query("""
WITH r AS (SELECT sum((l_discount NOT BETWEEN 0 AND 0.05)::INT)::BIGINT AS a, sum((l_tax < 0)::INT)::BIGINT AS b, sum((l_quantity = 0)::INT)::BIGINT AS c, sum((l_tax = 0)::INT)::BIGINT AS z, count(*) AS n FROM lineitem)
SELECT 'discount_range' AS rule, a AS n, CASE WHEN a = 0 THEN 'ok' WHEN a > 0.1 * (SELECT n FROM r) THEN 'error' ELSE 'warning' END AS severity FROM r UNION ALL SELECT 'negative_tax', b, CASE WHEN b = 0 THEN 'ok' WHEN b > 0.1 * (SELECT n FROM r) THEN 'error' ELSE 'warning' END FROM r
UNION ALL SELECT 'many_zeros', z, CASE WHEN z = 0 THEN 'ok' WHEN z > 0.1 * (SELECT n FROM r) THEN 'error' ELSE 'warning' END FROM r
""")
def anomaly_rules(spark: SparkSession, d: str) -> DataFrame:
    rules = {"discount_range": F.col("l_discount").between(0, 0.05), "negative_tax": F.col("l_tax") >= 0, "many_zeros": F.col("l_tax") != 0}
    return Q.rule_counts(table(spark, d, "lineitem"), rules, error_share=0.1)


@query("SELECT p_type, count(*)::BIGINT AS rows, round(avg((TRY_CAST(CASE WHEN p_partkey % 4 = 0 THEN p_name ELSE p_size::VARCHAR END AS DOUBLE) IS NOT NULL)::INT), 6) AS numeric_share FROM part GROUP BY 1")
def numeric_inference(spark: SparkSession, d: str) -> DataFrame:
    cell = F.when(F.col("p_partkey") % 4 == 0, F.col("p_name")).otherwise(F.col("p_size").cast("string"))
    return table(spark, d, "part").groupBy("p_type").agg(F.count("*").alias("rows"), F.round(F.avg(cell.try_cast("double").isNotNull().cast("int")), 6).alias("numeric_share"))


@query("SELECT p_brand, sum((p_type = 'ECONOMY')::INT)::BIGINT AS economy, CASE WHEN sum((p_type = 'SMALL')::INT) > 0 THEN sum((p_type = 'SMALL')::INT) END::BIGINT AS small FROM part GROUP BY 1")
def stats_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Counts by brand and type; a combination that does not occur is blank in one column and 0 where it was measured."""
    wide = table(spark, d, "part").groupBy("p_brand").pivot("p_type", ["ECONOMY", "SMALL"]).count()
    return wide.select("p_brand", F.coalesce("ECONOMY", F.lit(0)).cast("long").alias("economy"), F.col("SMALL").alias("small"))


@query("""
SELECT cust, y::INT AS year, coalesce(opened, 0)::BIGINT AS opened, coalesce(closed, 0)::BIGINT AS closed FROM (SELECT DISTINCT o_custkey AS cust FROM orders) k CROSS JOIN range(1996, 2001) t(y)
LEFT JOIN (SELECT o_custkey AS c1, year(o_orderdate) AS y1, count(*) AS opened FROM orders GROUP BY 1, 2) a ON a.c1 = cust AND a.y1 = y LEFT JOIN (SELECT o_custkey AS c2, year(o_orderdate) AS y2, count(*) AS closed FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2) b ON b.c2 = cust AND b.y2 = y
""")
def issue_year_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Opened and closed a year; every year of the window is there, measured as 0 if nothing happened."""
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("cust"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("opened"), F.sum((F.col("o_orderstatus") == "F").cast("long")).alias("closed"))
    grid = o.select("cust").distinct().select("cust", F.explode(F.sequence(F.lit(1996), F.lit(2000))).alias("year"))
    return grid.join(o, ["cust", "year"], "left").select("cust", "year", F.coalesce("opened", F.lit(0)).alias("opened"), F.coalesce("closed", F.lit(0)).alias("closed"))
