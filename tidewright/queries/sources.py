"""Parsers of semi-structured input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.queries.registry import query, table
from tidewright.sources import readers, sinks


@query("SELECT event_id, user_id FROM events")
def missing_source_empty(spark: SparkSession, d: str) -> DataFrame:
    """A dump of several years of which one is missing: its rows are none, not an error."""
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType())])
    there, missing = (readers.read_or_empty(spark, f"{d}/{name}.parquet", schema, "parquet") for name in ("events", "no-such-table"))
    return missing.unionByName(there.select("event_id", "user_id"))


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def json_props_explode(spark: SparkSession, d: str) -> DataFrame:
    m = F.from_json("props", "map<string,string>")
    return table(spark, d, "events").select("event_id", F.explode(m).alias("name", "v")).where("name = 'k'").select("event_id", F.col("v").cast("long").alias("k"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE k END AS project FROM events, LATERAL (SELECT unnest(CASE WHEN event_id % 3 = 0 THEN [0] WHEN event_id % 3 = 1 THEN [1] ELSE [1, 2] END)::BIGINT AS k)")
def json_flatten_outer(spark: SparkSession, d: str) -> DataFrame:
    """One row a project; a manifest without projects keeps one row."""
    k = F.col("event_id") % 3
    manifest = F.when(k == 0, '{"projects": []}').when(k == 1, '{"projects": [{"id": 1}]}').otherwise('{"projects": [{"id": 1}, {"id": 2}]}')
    parsed = F.from_json(manifest, "projects array<struct<id: long>>")
    return table(spark, d, "events").select("event_id", F.explode_outer(parsed["projects"]).alias("p")).select("event_id", F.col("p.id").alias("project"))


@query("SELECT p_partkey, p_name AS package, 'libc6 (>= 2), ' || p_type AS depends FROM part")
def stanza_parse(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("Package: "), "p_name", F.lit("\nDepends: libc6 (>= 2),\n "), "p_type", F.lit("\nId: "), "p_partkey")
    fields = readers.stanzas(table(spark, d, "part").select(text.alias("value")))
    return fields.select(F.col("fields")["Id"].cast("long").alias("p_partkey"), F.col("fields")["Package"].alias("package"), F.col("fields")["Depends"].alias("depends"))


@query("SELECT p_partkey AS rank, p_brand AS name, p_size::BIGINT AS installs FROM part WHERE p_partkey % 7 <> 0")
def whitespace_table(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.when(F.col("p_partkey") % 7 == 0, "#").otherwise(""), "p_partkey", F.lit("   "), "p_brand", F.lit("\t"), "p_size")
    return readers.popularity(table(spark, d, "part").select(line.alias("value")))


@query("SELECT p_brand || '.c' AS path, sum(p_size)::BIGINT AS added, sum(p_partkey % 9)::BIGINT AS deleted FROM part WHERE p_partkey % 4 <> 0 AND p_partkey % 5 <> 0 GROUP BY 1")
def numstat_churn(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    line = F.concat(F.when(k % 4 == 0, "-").otherwise(F.col("p_size").cast("string")), F.lit("\t"), k % 9, F.lit("\t"), "p_brand", F.when(k % 5 == 0, ".png").otherwise(".c"))
    return readers.numstat(table(spark, d, "part").select(line.alias("value")), (".c", ".h"))


@query("SELECT floor(epoch(ts))::BIGINT AS at, 'u' || user_id AS name, 'u' || user_id || '@x' AS email FROM events WHERE event_type <> 'error'")
def commit_log_parse(spark: SparkSession, d: str) -> DataFrame:
    at = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("string")
    line = F.concat(F.when(F.col("event_type") == "error", "?").otherwise(at), F.lit("\x1fu"), "user_id", F.lit("\x1f u"), "user_id", F.lit("@x"))
    return readers.commit_log(table(spark, d, "events").select(line.alias("value")))


@query("SELECT p_partkey, p_name AS name FROM part UNION ALL SELECT p_partkey, p_brand FROM part WHERE p_partkey % 2 = 0")
def truncated_json_rescue(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit('[{"name": "'), "p_name", F.lit('", "x": 1}, {"name" : "'), "p_brand", F.when(F.col("p_partkey") % 2 == 0, '", "x').otherwise(""))
    return table(spark, d, "part").select("p_partkey", F.explode(readers.rescue_objects(text)).alias("name"))


@query("SELECT key, max_by(v, n)::BIGINT AS v FROM (SELECT lower(trim(c_mktsegment)) AS key, c_custkey AS v, c_custkey AS n FROM customer) GROUP BY 1")
def keyed_last_wins(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select(F.concat(F.lit(" "), F.col("c_mktsegment")).alias("key"), F.col("c_custkey").alias("v"))
    return readers.last_by_key(rows, "key", F.col("v"), lower=True)


@query("SELECT s_suppkey, '{\"s_name\":\"' || s_name || '\",\"s_nationkey\":' || s_nationkey || '}' AS json FROM supplier")
def rows_as_json(spark: SparkSession, d: str) -> DataFrame:
    return sinks.as_json(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), "s_suppkey")


@query("SELECT user_id, event_id, k FROM (SELECT user_id, event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events) WHERE k > 50")
def nested_flatten(spark: SparkSession, d: str) -> DataFrame:
    parsed = table(spark, d, "events").select("user_id", "event_id", F.from_json("props", "k long").alias("p"))
    return parsed.select("user_id", "event_id", "p.k").where("k > 50")


@query("SELECT o_custkey AS cust, year(o_orderdate)::INT AS year, min_by(o_orderkey, (o_orderdate, o_orderkey)) AS first_sha, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS last_sha, count(*)::BIGINT AS commits FROM orders GROUP BY 1, 2")
def commits_per_year(spark: SparkSession, d: str) -> DataFrame:
    at = F.struct("o_orderdate", "o_orderkey")
    return table(spark, d, "orders").groupBy(F.col("o_custkey").alias("cust"), F.year("o_orderdate").alias("year")).agg(F.min_by("o_orderkey", at).alias("first_sha"), F.max_by("o_orderkey", at).alias("last_sha"), F.count("*").alias("commits"))
