"""Nested payloads, partitioned files, signals and profiles over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.lineage import shared_folder
from tidewright.operators import eligibility as E
from tidewright.operators import graph as G
from tidewright.operators import reshape
from tidewright.queries.graphs import _pagerank_sql, edges, seeds
from tidewright.queries.registry import query, table
from tidewright.sources import payloads as P


@query("SELECT o_orderkey, year(o_orderdate)::INT AS year, o_totalprice FROM orders WHERE year(o_orderdate) IN (1996, 1997)")
def year_glob_scan(spark: SparkSession, d: str) -> DataFrame:
    """A dump of one file a month, of which the files of two years and of one without data are wanted."""
    where = f"{shared_folder(spark)}/dump-{uuid.uuid4().hex}"
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"), F.date_format("o_orderdate", "MM").alias("m"))
    schema = rows.drop("y", "m").schema
    for y in (1995, 1996, 1997):
        rows.where(F.col("y") == y).select("o_orderkey", "o_totalprice").write.option("header", "true").csv(f"{where}/{y}-all")
    return P.read_years(spark, where, [1996, 1997, 1890], schema).select("o_orderkey", "year", "o_totalprice")


@query("""
SELECT o_custkey AS repo, 'opened' AS metric, count(*)::BIGINT AS value, NULL::VARCHAR AS note FROM orders GROUP BY 1 UNION ALL SELECT c_custkey, 'segment', c_nationkey::BIGINT, c_mktsegment FROM customer
""")
def union_metrics(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("repo")).agg(F.count("*").alias("value")).withColumn("metric", F.lit("opened"))
    b = table(spark, d, "customer").select(F.col("c_custkey").alias("repo"), F.explode(F.array(F.lit("segment"), F.lit("other"))).alias("metric"), F.col("c_nationkey").cast("long").alias("value"), F.col("c_mktsegment").alias("note"))
    return P.union_metrics([a, b], ("opened", "segment"))


@query("SELECT DISTINCT l_orderkey AS package, 's' || l_suppkey AS login, CASE WHEN s_acctbal > 0 THEN s_nationkey END AS id FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_suppkey % 10 <> 0")
def maintainer_rows(spark: SparkSession, d: str) -> DataFrame:
    login = F.when(F.col("l_suppkey") % 10 == 0, " ").otherwise(F.concat(F.lit(" s"), F.col("l_suppkey").cast("string")))
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("package")).agg(F.collect_list(F.struct(login.alias("login"))).alias("maintainers"))
    ids = table(spark, d, "supplier").where("s_acctbal > 0").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("login"), F.col("s_nationkey").alias("id"))
    return P.maintainers(rows, "package", ids)


@query("SELECT event_id, props->>'$.k' AS k, NULL::VARCHAR AS missing, event_type AS kind FROM events")
def flatten_payload(spark: SparkSession, d: str) -> DataFrame:
    json = F.concat(F.lit('{"owner": {"kind": ["'), "event_type", F.lit('"]}, "props": '), "props", F.lit("}"))
    return P.flatten(table(spark, d, "events").select("event_id", json.alias("json")), {"k": "props.k", "missing": "owner.login", "kind": "owner.kind[0]"}, "event_id")


@query("SELECT s_name AS name, CASE WHEN s_nationkey % 3 = 0 THEN 'ok' ELSE 'not_found' END AS status FROM supplier WHERE s_nationkey % 3 < 2")
def alias_batch(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select(F.concat(F.lit("r"), F.col("s_suppkey").cast("string")).alias("alias"), F.col("s_name").alias("name"), "s_nationkey")
    third = F.col("s_nationkey") % 3
    response = F.when(third == 0, F.concat(F.lit('{"'), "alias", F.lit('": {"id": 1}}'))).when(third == 1, F.concat(F.lit('{"'), "alias", F.lit('": null}'))).otherwise('{"other": {"id": 2}}')
    return P.alias_statuses(s, response).select("name", "status")


@query("""
SELECT s_suppkey, s_name AS commit, 'score' AS metric, s_acctbal AS value FROM supplier WHERE s_nationkey > 3 UNION ALL
SELECT s_suppkey, s_name, 'binary_artifacts', -1 FROM supplier WHERE s_nationkey > 3 UNION ALL SELECT s_suppkey, s_name, 'code_review', s_nationkey FROM supplier WHERE s_nationkey > 3 AND s_suppkey % 2 = 0
""")
def scorecard_long(spark: SparkSession, d: str) -> DataFrame:
    review = F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey").cast("string")).otherwise("null")
    commit = F.when(F.col("s_nationkey") > 3, F.col("s_name")).otherwise(" ")
    json = F.concat(F.lit('{"commit": "'), commit, F.lit('", "overallScore": '), F.col("s_acctbal").cast("string"), F.lit(', "checks": [{"name": "Binary-Artifacts", "score": -1}, {"name": "Code-Review", "score": '), review, F.lit('}, {"score": 3}]}'))
    return P.scorecard_long(table(spark, d, "supplier").select("s_suppkey", json.alias("json")), "s_suppkey")


@query("""
WITH y AS (SELECT o_custkey AS package, year(o_orderdate)::INT AS year, CASE WHEN min(o_totalprice) > 5000 THEN count(*) END AS n FROM orders GROUP BY 1, 2), g AS (SELECT package, max(year) AS gap FROM y WHERE n IS NULL GROUP BY 1)
SELECT package, year, CASE WHEN year <= gap THEN 0 ELSE n END::BIGINT AS n FROM y LEFT JOIN g USING (package)
""")
def zero_before_gap(spark: SparkSession, d: str) -> DataFrame:
    y = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("package"), F.year("o_orderdate").alias("year")).agg(F.when(F.min("o_totalprice") > 5000, F.count("*")).alias("n"))
    return P.zero_before_gap(y, "package", "year", "n")


@query("SELECT DISTINCT lower(x) AS slug FROM (SELECT c_custkey AS k, c_mktsegment AS x FROM customer UNION ALL SELECT o_custkey, o_orderpriority FROM orders) WHERE k IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def slugs_in_scope(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    a = c.select(F.col("c_custkey").alias("k"), F.concat(F.lit(" "), "c_mktsegment").alias("slug"))
    b = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("slug"))
    return P.union_in_scope(c.where("c_acctbal > 5000").select(F.col("c_custkey").alias("k")), "k", [a, b, a.withColumn("slug", F.lit(" "))], "slug")


@query("SELECT 'balance' AS part, count(*)::BIGINT AS n FROM customer WHERE c_acctbal > 0 UNION ALL SELECT 'place', count(*) FROM customer")
def wide_split(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("acctbal"), "c_nationkey", "c_mktsegment")
    balance, place = P.split_columns(c, "c_custkey", [["acctbal"], ["c_nationkey", "c_mktsegment"]])
    return balance.agg(F.lit("balance").alias("part"), F.count("*").alias("n")).unionByName(place.agg(F.lit("place").alias("part"), F.count("*").alias("n")))


@query(f"SELECT node, rank FROM ({_pagerank_sql(6)}) WHERE node % 2 = 0")
def transit_dropped(spark: SparkSession, d: str) -> DataFrame:
    """Nodes without a row of their own pass rank on but are not shown."""
    e = edges(spark, d)
    known = e.select(F.col("src").alias("node")).union(e.select("dst")).union(seeds(spark, d).select("node")).where("node % 2 = 0")
    ranks = G.pagerank(e, seeds(spark, d).withColumn("weight", F.lit(1.0)), rounds=6)
    return G.of_known(ranks, known).select("node", F.round("rank", 6).alias("rank"))


@query("""
WITH r AS (SELECT c_custkey, c_nationkey AS owner, c_mktsegment = 'BUILDING' AND c_acctbal > 9900 AS links, c_acctbal < -990 AS yml, CASE WHEN c_acctbal BETWEEN 0 AND 20 THEN 'pp' ELSE '' END AS paypal, CASE WHEN c_name LIKE '%77' THEN 'oc' ELSE ' ' END AS oc FROM customer),
o AS (SELECT DISTINCT owner FROM r WHERE links OR yml OR trim(oc) <> '')
SELECT c_custkey, links OR yml OR paypal <> '' OR trim(oc) <> '' AS intent, links OR yml OR paypal <> '' OR trim(oc) <> '' OR owner IN (SELECT owner FROM o) AS owner_intent FROM r
""")
def intent_signals(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    flags = {"has_funding_links": (F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 9900), "has_funding_yml": F.col("c_acctbal") < -990}
    rows = c.select("c_custkey", F.col("c_nationkey").alias("owner_key"), *(F.lit(None).cast("boolean").alias(f) for f in E.SIGNAL_FLAGS if f not in flags), *(v.alias(k) for k, v in flags.items()), F.when(F.col("c_acctbal").between(0, 20), "pp").otherwise("").alias("paypal"), F.when(F.col("c_name").endswith("77"), "oc").otherwise(" ").alias("oc_slug"), F.lit("").alias("host"), F.lit(None).cast("string").alias("owner"))
    return E.owner_intent(rows, "owner_key").select("c_custkey", "intent", "owner_intent")


@query("""
WITH v AS (SELECT 'acctbal' AS name, c_acctbal AS x FROM customer UNION ALL SELECT 'nation', c_nationkey FROM customer)
SELECT name, count(*)::BIGINT AS n, sum((x < 0)::INT)::BIGINT AS negative, array_to_string(list_transform(list_sort(list(x))[1:5], lambda x: round(x, 2)), ',') AS smallest, array_to_string(list_transform(list_reverse_sort(list(x))[1:5], lambda x: round(x, 2)), ',') AS largest FROM v GROUP BY 1
""")
def numeric_profile(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_acctbal").cast("string").alias("acctbal"), F.col("c_nationkey").cast("string").alias("nation"), F.col("c_mktsegment").alias("segment"))
    found = reshape.numeric_profile(c)
    shown = {k: F.array_join(F.transform(k, lambda x: F.round(x, 2).cast("string")), ",") for k in ("smallest", "largest")}
    return found.select("name", "n", "negative", *(v.alias(k) for k, v in shown.items()))
