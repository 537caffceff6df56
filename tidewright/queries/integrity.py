"""Whole tables kept right: keyed commits, damaged dumps, drifted ids, differences, rules."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewright.lineage import shared_folder
from tidewright.operators import compare, healing, rules
from tidewright.queries.registry import query, table
from tidewright.sources import damaged, keyed


def _fetch(spark: SparkSession, d: str, condition: str, add: int) -> DataFrame:
    """Contributors of suppliers: line items by part; suppliers without money fail, those of one nation find nothing."""
    l = table(spark, d, "lineitem").where(condition).groupBy(F.col("l_suppkey").alias("repo"), F.col("l_partkey").alias("login")).agg((F.count("*") + add).alias("commits"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("repo"), (F.col("s_acctbal") < 0).alias("failed"), F.col("s_nationkey").alias("nation"))
    rows = s.join(l, "repo", "left")
    nothing = (F.col("nation") == 7) | F.col("failed")
    return rows.select("repo", "failed", F.when(~nothing, F.col("login")).alias("login"), F.when(~nothing, F.col("commits")).alias("commits"), "nation").distinct()


def _sql_rows(condition: str, add: int, scope: str) -> str:
    return f"""SELECT DISTINCT s_suppkey AS repo, s_acctbal < 0 AS failed, CASE WHEN s_nationkey <> 7 AND s_acctbal >= 0 THEN login END AS login, CASE WHEN s_nationkey <> 7 AND s_acctbal >= 0 THEN commits END AS commits
  FROM supplier LEFT JOIN (SELECT l_suppkey, l_partkey AS login, count(*) + {add} AS commits FROM lineitem WHERE {condition} GROUP BY 1, 2) ON l_suppkey = s_suppkey WHERE {scope}"""


@query(f"""
WITH a AS ({_sql_rows('l_quantity < 30', 0, 'true')}), b AS ({_sql_rows('l_quantity >= 40', 100, 's_nationkey < 5')}),
f AS (SELECT *, 1 AS batch FROM a WHERE repo NOT IN (SELECT repo FROM b) UNION ALL SELECT *, 2 FROM b),
s AS (SELECT repo, batch, bool_or(failed) AS failed, count(login) AS n FROM f GROUP BY 1, 2)
SELECT s.repo, CASE WHEN s.failed THEN 'error' WHEN s.n > 0 THEN 'ok' ELSE 'empty' END AS status, CASE WHEN s.failed THEN 0 ELSE s.n END AS n, s.batch::VARCHAR AS fetched_at, f.login, f.commits
FROM s LEFT JOIN f ON f.repo = s.repo AND f.login IS NOT NULL
""")
def keyed_commit(spark: SparkSession, d: str) -> DataFrame:
    """Two fetches put into a table and its states; the second replaces its suppliers, and is tried twice."""
    kinds = {"rows": StructType().add("repo", "long").add("login", "long").add("commits", "long"), "status": StructType().add("repo", "long").add("status", "string").add("n", "long").add("fetched_at", "string")}
    tables = keyed.KeyedTables(spark, f"{shared_folder(spark)}/fetches-{uuid.uuid4().hex}", "repo", kinds, buckets=8)
    first, second = _fetch(spark, d, "l_quantity < 30", 0), _fetch(spark, d, "l_quantity >= 40", 100).where("nation < 5")
    keyed.commit_fetch(tables, first.drop("nation"), "failed", F.lit("1"), stream="fetch", number=0)
    for _ in range(2):
        keyed.commit_fetch(tables, second.drop("nation"), "failed", F.lit("2"), stream="fetch", number=1)
    return tables.read("status").join(tables.read("rows"), "repo", "left")


LINES = """
lines AS (SELECT CASE l_linestatus || l_returnflag
  WHEN 'OA' THEN l_orderkey || ',' || l_linenumber WHEN 'FA' THEN ',' || l_linenumber || ',' || l_quantity || ',n' WHEN 'OR' THEN l_orderkey || ',' || l_linenumber || ',many,n'
  WHEN 'FR' THEN l_orderkey || ',' || l_linenumber || ',,"a, b",c' ELSE l_orderkey || ',' || l_linenumber || ', ' || l_quantity || ' ,"x, ' || l_partkey || '"' END AS line, * FROM lineitem WHERE l_quantity < 5)
"""


def damaged_lines(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").where("l_quantity < 5")
    line = """CASE concat(l_linestatus, l_returnflag) WHEN 'OA' THEN concat(l_orderkey, ',', l_linenumber) WHEN 'FA' THEN concat(',', l_linenumber, ',', l_quantity, ',n') WHEN 'OR' THEN concat(l_orderkey, ',', l_linenumber, ',many,n')
      WHEN 'FR' THEN concat(l_orderkey, ',', l_linenumber, ',,"a, b",c') ELSE concat(l_orderkey, ',', l_linenumber, ', ', l_quantity, ' ,"x, ', l_partkey, '"') END"""
    return l.select(F.expr(line).alias("value"))


def _split(spark: SparkSession, d: str) -> damaged.Split:
    """The lines, written as text and read back."""
    path = f"{shared_folder(spark)}/damaged-{uuid.uuid4().hex}"
    damaged_lines(spark, d).write.text(path)
    schema = StructType().add("order", "long").add("line", "integer").add("quantity", "double").add("note", "string")
    return damaged.read_damaged(spark, path, schema, ["order", "line"])


@query(f"""WITH {LINES} SELECT l_orderkey::BIGINT AS "order", l_linenumber::INTEGER AS line, l_quantity::DOUBLE AS quantity, 'x, ' || l_partkey AS note FROM lines WHERE l_linestatus || l_returnflag NOT IN ('OA', 'FA', 'OR', 'FR')""")
def damaged_good_rows(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d).good


@query(f"WITH {LINES} SELECT line, CASE l_linestatus || l_returnflag WHEN 'FA' THEN 'bad key' WHEN 'OR' THEN 'bad number' ELSE 'ragged' END AS reason FROM lines WHERE l_linestatus || l_returnflag IN ('OA', 'FA', 'OR', 'FR')")
def damaged_rejected_lines(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d).rejected


DRIFT = """
cur AS (SELECT 's' || c_custkey AS slug, CASE WHEN c_mktsegment = 'BUILDING' THEN 'gl/salsa-' ELSE 'gh/' END || c_custkey AS repo_id FROM customer WHERE c_acctbal < 8000),
ren AS (SELECT 'old' || c_custkey AS old, 'mid' || c_custkey AS new FROM customer WHERE c_acctbal < 1000 UNION ALL SELECT 'mid' || c_custkey, 'S' || c_custkey FROM customer WHERE c_acctbal < 1000 UNION ALL SELECT 'ring' || (c_nationkey % 3), 'ring' || ((c_nationkey + 1) % 3) FROM customer),
raw AS (SELECT o_orderkey, c_custkey, CASE WHEN c_acctbal < 0 THEN 'Old' || c_custkey WHEN c_acctbal < 1000 THEN 'mid' || c_custkey WHEN c_acctbal BETWEEN 4000 AND 4500 THEN 'lost' || c_custkey ELSE 's' || c_custkey END AS slug,
  CASE WHEN o_orderpriority = '1-URGENT' THEN c_custkey::VARCHAR WHEN o_orderpriority = '2-HIGH' THEN 'gh/9' || c_custkey WHEN o_orderpriority = '3-MEDIUM' AND c_acctbal > 3000 THEN '' ELSE 'gh/' || (c_custkey + CASE WHEN c_nationkey < 8 THEN 50000000 ELSE 0 END) END AS repo_id FROM orders JOIN customer ON c_custkey = o_custkey)
"""


def _drift(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    c = table(spark, d, "customer")
    text = lambda p, x: F.concat(F.lit(p), F.col(x).cast("string"))
    current = c.where("c_acctbal < 8000").select(text("s", "c_custkey").alias("slug"), F.concat(F.when(F.col("c_mktsegment") == "BUILDING", "gl/salsa-").otherwise("gh/"), F.col("c_custkey").cast("string")).alias("repo_id"))
    few = c.where("c_acctbal < 1000")
    renames = few.select(text("old", "c_custkey").alias("old"), text("mid", "c_custkey").alias("new")).unionByName(few.select(text("mid", "c_custkey").alias("old"), text("S", "c_custkey").alias("new")))
    renames = renames.unionByName(c.select(F.expr("concat('ring', c_nationkey % 3)").alias("old"), F.expr("concat('ring', (c_nationkey + 1) % 3)").alias("new")))
    rows = table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.expr("CASE WHEN c_acctbal < 0 THEN concat('Old', c_custkey) WHEN c_acctbal < 1000 THEN concat('mid', c_custkey) WHEN c_acctbal BETWEEN 4000 AND 4500 THEN concat('lost', c_custkey) ELSE concat('s', c_custkey) END").alias("slug"),
        F.expr("CASE WHEN o_orderpriority = '1-URGENT' THEN string(c_custkey) WHEN o_orderpriority = '2-HIGH' THEN concat('gh/9', c_custkey) WHEN o_orderpriority = '3-MEDIUM' AND c_acctbal > 3000 THEN '' ELSE concat('gh/', c_custkey + if(c_nationkey < 8, 50000000, 0)) END").alias("repo_id"),
    )
    return rows, current, renames


#: One pass of healing: names by rename, then by the id's owner; ids prefixed; all rows of a name without its current id stamped.
HEALED = """
a AS (SELECT o_orderkey, lower(slug) AS was, CASE WHEN lower(slug) LIKE 'old%' OR lower(slug) LIKE 'mid%' THEN 's' || c_custkey ELSE lower(slug) END AS slug, repo_id AS had, CASE WHEN regexp_full_match(repo_id, '[0-9]+') THEN 'gh/' || repo_id ELSE repo_id END AS repo_id FROM raw),
b AS (SELECT o_orderkey, was, coalesce(cur.slug, o.slug, a.slug) AS slug, had, a.repo_id, coalesce(cur.repo_id, CASE WHEN o.slug IS NOT NULL THEN a.repo_id END) AS id, cur.slug IS NULL AND o.slug IS NULL AS lost
  FROM a LEFT JOIN cur ON cur.slug = a.slug LEFT JOIN cur o ON o.repo_id = a.repo_id AND cur.slug IS NULL),
c AS (SELECT *, id IS NOT NULL AND repo_id <> id AND NOT coalesce(bool_or(repo_id = id) FILTER (WHERE repo_id <> '' AND id IS NOT NULL) OVER (PARTITION BY slug), true) AS stamp FROM b),
h AS (SELECT o_orderkey, slug, CASE WHEN stamp THEN id ELSE repo_id END AS repo_id, CASE WHEN stamp THEN 'restamped' WHEN had <> repo_id THEN 'prefixed' WHEN was <> slug THEN 'renamed' WHEN lost AND repo_id <> '' THEN 'vanished' END AS action FROM c)
"""


@query(f"WITH {DRIFT}, {HEALED} SELECT o_orderkey, slug, repo_id FROM h")
def heal_drifted_ids(spark: SparkSession, d: str) -> DataFrame:
    """Renamed, drifted, bare and vanished ids of one table; the report is the next query."""
    rows, current, renames = _drift(spark, d)
    return healing.heal_ids({"orders": rows}, current, renames)[0]["orders"].select("o_orderkey", "slug", "repo_id")


@query(f"WITH {DRIFT}, {HEALED} SELECT action, count(*)::BIGINT AS rows FROM h WHERE action <> 'vanished' GROUP BY 1 UNION ALL SELECT 'vanished', count(*) FROM c WHERE lost AND repo_id <> ''")
def heal_report(spark: SparkSession, d: str) -> DataFrame:
    rows, current, renames = _drift(spark, d)
    report = healing.heal_ids({"orders": rows}, current, renames)[1]
    return report.where("round = 1 or action = 'vanished'").groupBy("action").agg(F.sum("rows").alias("rows"))


@query(f"WITH {DRIFT}, x AS (SELECT DISTINCT lower(slug) AS slug, repo_id AS had FROM raw WHERE repo_id <> '') SELECT slug, string_agg(had, ',' ORDER BY had) AS ids FROM x JOIN cur USING (slug) GROUP BY slug HAVING NOT bool_or(had = repo_id)")
def drift_detection(spark: SparkSession, d: str) -> DataFrame:
    """Names of which no row has the current id."""
    rows, current, _ = _drift(spark, d)
    return healing.drifted_names(rows, current).select("slug", F.array_join("ids", ",").alias("ids"))


CHANGED = """
old AS (SELECT l_orderkey, l_linenumber, l_quantity, l_tax, l_shipdate::DATE AS day FROM lineitem),
new AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey = 77 THEN NULL ELSE l_quantity END AS l_quantity, CASE WHEN l_extendedprice < 1000 THEN l_discount ELSE l_tax END AS l_tax, l_shipdate::DATE AS day FROM lineitem WHERE l_orderkey <> 99 UNION ALL SELECT -1, 1, 5, 0, NULL)
"""


@query(f"""
WITH {CHANGED}, n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity NULLS FIRST, l_tax, day) AS r FROM new), o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity NULLS FIRST, l_tax, day) AS r FROM old),
j AS (SELECT coalesce(n.l_orderkey, o.l_orderkey)::VARCHAR AS l_orderkey, coalesce(n.l_linenumber, o.l_linenumber)::VARCHAR AS l_linenumber, n.r AS nr, o.r AS o_r, n.l_quantity AS q1, o.l_quantity AS q2, n.l_tax AS t1, o.l_tax AS t2, n.day AS d1, o.day AS d2 FROM n FULL JOIN o ON n.l_orderkey = o.l_orderkey AND n.l_linenumber = o.l_linenumber AND n.r = o.r)
SELECT l_orderkey, l_linenumber, 'built_only' AS "column" FROM j WHERE o_r IS NULL UNION ALL SELECT l_orderkey, l_linenumber, 'stored_only' FROM j WHERE nr IS NULL
UNION ALL SELECT l_orderkey, l_linenumber, 'l_quantity' FROM j WHERE nr IS NOT NULL AND o_r IS NOT NULL AND q1 IS DISTINCT FROM q2 UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax' FROM j WHERE nr IS NOT NULL AND o_r IS NOT NULL AND t1 IS DISTINCT FROM t2
UNION ALL SELECT l_orderkey, l_linenumber, 'day' FROM j WHERE nr IS NOT NULL AND o_r IS NOT NULL AND d1 IS DISTINCT FROM d2
""")
def table_cell_differences(spark: SparkSession, d: str) -> DataFrame:
    """A few changed cells of lineitem: digests first, then only the buckets that differ."""
    l = table(spark, d, "lineitem")
    old = l.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", F.col("l_shipdate").cast("date").alias("day"))
    new = l.where("l_orderkey <> 99").select("l_orderkey", "l_linenumber", F.expr("if(l_orderkey = 77, NULL, l_quantity)").alias("l_quantity"), F.expr("if(l_extendedprice < 1000, l_discount, l_tax)").alias("l_tax"), F.col("l_shipdate").cast("date").alias("day"))
    new = new.unionByName(spark.createDataFrame([(-1, 1, 5.0, 0.0, None)], new.schema))
    return compare.cell_differences(new, old, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_tax", "day"]).select("l_orderkey", "l_linenumber", "column")


MEASURES = """
m AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN round(o_totalprice, 2)::VARCHAR WHEN 'O' THEN (round(o_totalprice, 2) - 30000)::VARCHAR ELSE 'unknown' END AS price,
  CASE WHEN o_custkey < 100 THEN '' ELSE (o_custkey / 10)::VARCHAR END AS a_p, (o_custkey - 20)::VARCHAR AS b_p, CASE WHEN o_orderpriority = '5-LOW' THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS fetched_at FROM orders)
"""


def measures(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey", F.expr("CASE o_orderstatus WHEN 'F' THEN string(round(o_totalprice, 2)) WHEN 'O' THEN string(round(o_totalprice, 2) - 30000) ELSE 'unknown' END").alias("price"),
        F.expr("if(o_custkey < 100, '', string(o_custkey / 10))").alias("a_p"), F.expr("string(o_custkey - 20)").alias("b_p"), F.expr("if(o_orderpriority = '5-LOW', 'soon', date_format(o_orderdate, 'yyyy-MM-dd'))").alias("fetched_at"),
    )


@query(f"""
WITH {MEASURES}, f AS (
SELECT CASE WHEN try_cast(price AS DOUBLE) IS NULL THEN 'type' WHEN price::DOUBLE < 0 THEN 'negative' WHEN price::DOUBLE > 100000 THEN 'outlier' END AS category, CASE WHEN try_cast(price AS DOUBLE) IS NULL OR price::DOUBLE < 0 THEN 'err' ELSE 'warn' END AS severity, o_orderkey, 'price' AS metric FROM m
UNION ALL SELECT CASE WHEN a_p <> '' AND (a_p::DOUBLE < 0 OR a_p::DOUBLE > 100) THEN 'pct-range' END, 'err', o_orderkey, 'a_p' FROM m UNION ALL SELECT CASE WHEN b_p::DOUBLE < 0 OR b_p::DOUBLE > 100 THEN 'pct-range' END, 'err', o_orderkey, 'b_p' FROM m
UNION ALL SELECT CASE WHEN try_cast(fetched_at AS DATE) IS NULL THEN 'type' WHEN fetched_at::DATE::TIMESTAMP < TIMESTAMP '1998-01-01' - INTERVAL 90 DAY THEN 'staleness' END, CASE WHEN try_cast(fetched_at AS DATE) IS NULL THEN 'err' ELSE 'info' END, o_orderkey, 'fetched_at' FROM m)
SELECT category, severity, o_orderkey::VARCHAR AS key, metric FROM f WHERE category IS NOT NULL
""")
def rule_findings(spark: SparkSession, d: str) -> DataFrame:
    """Ranges, percentiles by the end of their names, and staleness from one table of rules."""
    table_of = rules.rules_table(spark, [("price", 0.0, 100000.0, None, "outlier", "warn"), ("*_p", 0.0, 100.0, None, "pct-range", "err"), ("fetched_at", None, None, 90, "staleness", "info")])
    return rules.anomalies(measures(spark, d), "o_orderkey", table_of, F.lit("1998-01-01").cast("timestamp")).select("category", "severity", "key", "metric")


@query("""
WITH i AS (SELECT lower(c_name) AS slug, CASE WHEN c_acctbal < 0 THEN '' WHEN c_acctbal < 1000 THEN c_custkey::VARCHAR WHEN c_acctbal < 2000 THEN 'gl/salsa-' || c_custkey WHEN c_acctbal < 3000 THEN 'gl/nowhere-' || c_custkey WHEN c_acctbal < 4000 THEN 'gl/' || c_custkey WHEN c_acctbal < 5000 THEN 'hub/' || c_custkey ELSE 'gh/' || c_custkey END AS repo_id, c_nationkey FROM customer)
SELECT * FROM (SELECT CASE WHEN repo_id = '' THEN CASE WHEN c_nationkey < 12 THEN 'blank' END WHEN regexp_full_match(repo_id, '[0-9]+') THEN 'bare number' WHEN repo_id LIKE 'hub/%' THEN 'shape' WHEN repo_id LIKE 'gl/nowhere%' THEN 'unknown instance' END AS problem, slug, repo_id FROM i) WHERE problem IS NOT NULL
""")
def id_problems(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    rid = F.expr("CASE WHEN c_acctbal < 0 THEN '' WHEN c_acctbal < 1000 THEN string(c_custkey) WHEN c_acctbal < 2000 THEN concat('gl/salsa-', c_custkey) WHEN c_acctbal < 3000 THEN concat('gl/nowhere-', c_custkey) WHEN c_acctbal < 4000 THEN concat('gl/', c_custkey) WHEN c_acctbal < 5000 THEN concat('hub/', c_custkey) ELSE concat('gh/', c_custkey) END")
    return rules.id_findings(c.select("c_name", rid.alias("repo_id")), "c_name", "repo_id", c.where("c_nationkey < 12").select(F.col("c_name").alias("slug")))
