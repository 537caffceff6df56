"""Grouped measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewright.functions import numbers as N
from tidewright.operators import stats, windows
from tidewright.queries.registry import query, table

PER_CUSTOMER = "SELECT c_nationkey AS nation, o_custkey AS cust, count(*) AS commits FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"
BUS = f"""
WITH c AS ({PER_CUSTOMER}),
w AS (SELECT *, coalesce(sum(commits) OVER (PARTITION BY nation ORDER BY commits DESC, cust ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(commits) OVER (PARTITION BY nation) AS total FROM c),
b AS (SELECT nation, sum(CASE WHEN before < 0.5 * total THEN 1 ELSE 0 END)::BIGINT AS bus_factor, round(sum(power(commits / total * 100, 2)))::BIGINT AS hhi, count(*)::BIGINT AS members FROM w GROUP BY 1)
"""


def contributors(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("cust"))
    per = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("cust")).agg(F.count("*").alias("commits"))
    return per.join(c, "cust")


@query("SELECT p_brand AS crate, sum(q)::DOUBLE AS downloads, count(*)::BIGINT AS versions FROM (SELECT l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1) JOIN part ON l_partkey = p_partkey GROUP BY 1")
def two_level_sum(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    return per.join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_brand").alias("crate")).agg(F.sum("q").alias("downloads"), F.count("*").alias("versions"))


@query("SELECT p_name AS source, year, max(q)::DOUBLE AS downloads FROM (SELECT l_partkey, year(l_shipdate)::INT AS year, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2) JOIN part ON l_partkey = p_partkey GROUP BY 1, 2")
def max_not_sum(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "lineitem").groupBy("l_partkey", F.year("l_shipdate").alias("year")).agg(F.sum("l_quantity").alias("q"))
    return per.join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_name").alias("source"), "year").agg(F.max("q").alias("downloads"))


@query("""
SELECT l_partkey, coalesce(floor(avg(CASE WHEN q > 0 THEN q END)), 0)::BIGINT AS populated, floor(sum(q) / 5)::BIGINT AS over_all
FROM (SELECT l_partkey, y, sum(CASE WHEN year(l_shipdate) = y THEN l_quantity ELSE 0 END) AS q FROM lineitem, range(1996, 2001) t(y) GROUP BY 1, 2) GROUP BY 1
""")
def avg_populated_years(spark: SparkSession, d: str) -> DataFrame:
    years = [F.sum(F.when(F.year("l_shipdate") == y, F.col("l_quantity")).otherwise(0)).alias(str(y)) for y in range(1996, 2001)]
    wide = table(spark, d, "lineitem").groupBy("l_partkey").agg(*years)
    long = wide.unpivot(["l_partkey"], [str(y) for y in range(1996, 2001)], "year", "q")
    return long.groupBy("l_partkey").agg(stats.mean_populated("q").alias("populated"), F.floor(F.sum("q") / 5).cast("long").alias("over_all"))


@query("SELECT l_suppkey, count(DISTINCT l_orderkey)::BIGINT AS cves FROM lineitem WHERE l_returnflag = 'R' AND year(l_shipdate) BETWEEN 1996 AND 2000 GROUP BY 1")
def count_distinct_window(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").where((F.col("l_returnflag") == "R") & F.year("l_shipdate").between(1996, 2000))
    return l.groupBy("l_suppkey").agg(F.count_distinct("l_orderkey").alias("cves"))


@query("""
SELECT s_suppkey, CASE WHEN n IS NOT NULL THEN n WHEN s_suppkey % 3 <> 0 THEN 0 END::BIGINT AS cves
FROM supplier LEFT JOIN (SELECT l_suppkey, count(DISTINCT l_orderkey) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 49 AND l_suppkey % 2 = 0 GROUP BY 1) ON s_suppkey = l_suppkey
""")
def confirmed_zero(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "lineitem").where("l_returnflag = 'R' and l_quantity > 49 and l_suppkey % 2 = 0").groupBy("l_suppkey").agg(F.count_distinct("l_orderkey").alias("n"))
    asked = F.col("s_suppkey") % 3 != 0
    return table(spark, d, "supplier").join(found, F.col("s_suppkey") == F.col("l_suppkey"), "left").select("s_suppkey", F.when(F.col("n").isNotNull(), F.col("n")).when(asked, 0).cast("long").alias("cves"))


@query("SELECT p_brand, p_type AS top_type FROM (SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS r FROM part GROUP BY 1, 2) WHERE r = 1")
def mode_tiebreak(spark: SparkSession, d: str) -> DataFrame:
    return stats.mode_of(table(spark, d, "part"), ["p_brand"], "p_type", "top_type")


@query("SELECT p_brand, p_partkey AS top_part FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS r FROM part) WHERE r = 1")
def argmax_tiebreak(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy("p_brand").agg(F.max_by("p_partkey", F.struct("p_size", -F.col("p_partkey"))).alias("top_part"))


@query("""
SELECT l_suppkey AS repo, count(DISTINCT p_brand)::BIGINT AS ecosystems, count(DISTINCT l_partkey)::BIGINT AS packages,
  round(sum(CASE WHEN p_brand = 'Brand#1' THEN l_quantity ELSE 0 END), 2) AS mass_1, round(sum(CASE WHEN p_brand = 'Brand#2' THEN l_quantity ELSE 0 END), 2) AS mass_2, min(p_partkey) AS first_package
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
""")
def group_collapse_multi(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    mass = [F.round(F.sum(F.when(F.col("p_brand") == f"Brand#{i}", F.col("l_quantity")).otherwise(0)), 2).alias(f"mass_{i}") for i in (1, 2)]
    return rows.groupBy(F.col("l_suppkey").alias("repo")).agg(F.count_distinct("p_brand").alias("ecosystems"), F.count_distinct("l_partkey").alias("packages"), *mass, F.min("p_partkey").alias("first_package"))


@query(BUS + "SELECT * FROM b")
def bus_factor_hhi(spark: SparkSession, d: str) -> DataFrame:
    return stats.bus_factor_hhi(contributors(spark, d), "nation", "cust", "commits")


@query(BUS + "SELECT nation, string_agg(cust::VARCHAR, ',' ORDER BY commits DESC, cust) AS logins FROM w WHERE before < 0.5 * total AND cust % 11 <> 0 GROUP BY 1")
def bus_factor_members(spark: SparkSession, d: str) -> DataFrame:
    """Members without a login count for the bus factor and are left out of the list."""
    rows = windows.bus_factor_rows(contributors(spark, d), "nation", "cust", "commits").where("before < 0.5 * total")
    rows = rows.withColumn("login", F.when(F.col("cust") % 11 != 0, F.col("cust").cast("string")).otherwise(" ")).where("trim(login) <> ''")
    names = F.array_sort(F.collect_list(F.struct((-F.col("commits")).alias("k"), "cust")))
    return rows.groupBy("nation").agg(F.array_join(F.transform(names, lambda r: r["cust"].cast("string")), ",").alias("logins"))


@query(BUS + "SELECT nation, round(greatest(1, sqrt(hhi / bus_factor)), 4) AS concentration FROM b")
def concentration_score(spark: SparkSession, d: str) -> DataFrame:
    b = stats.bus_factor_hhi(contributors(spark, d), "nation", "cust", "commits")
    return b.select("nation", F.round(N.concentration_score(F.col("hhi"), F.col("bus_factor")), 4).alias("concentration"))


@query("""
SELECT n_nationkey, CASE WHEN k IS NULL THEN 1 ELSE k END::BIGINT AS active_5y, CASE WHEN k IS NULL THEN 10000 END::BIGINT AS hhi, CASE WHEN k IS NULL THEN 'dormant' ELSE '' END AS comment
FROM nation LEFT JOIN (SELECT c_nationkey, count(DISTINCT o_custkey) AS k FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P' AND o_totalprice > 490000 AND c_name NOT LIKE '%7' GROUP BY 1) ON n_nationkey = c_nationkey
""")
def dormant_imputation(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").where("o_orderstatus = 'P' and o_totalprice > 490000").join(table(spark, d, "customer").where(~F.col("c_name").endswith("7")), F.col("o_custkey") == F.col("c_custkey"))
    k = o.groupBy("c_nationkey").agg(F.count_distinct("o_custkey").alias("k"))
    rows = table(spark, d, "nation").join(k, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    dormant = F.col("k").isNull()
    return rows.select("n_nationkey", F.when(dormant, 1).otherwise(F.col("k")).cast("long").alias("active_5y"), F.when(dormant, 10000).cast("long").alias("hhi"), F.when(dormant, "dormant").otherwise("").alias("comment"))


ISSUES = """
WITH y AS (SELECT o_custkey AS cust, year(o_orderdate) AS year, sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS opened, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS closed FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 2000 GROUP BY 1, 2)
"""


def issue_years(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").where(F.year("o_orderdate").between(1996, 2000))
    return o.groupBy(F.col("o_custkey").alias("cust"), F.year("o_orderdate").alias("year")).agg(F.sum((F.col("o_orderstatus") == "O").cast("long")).alias("opened"), F.sum((F.col("o_orderstatus") == "F").cast("long")).alias("closed"))


@query(ISSUES + "SELECT cust, CASE WHEN count(*) < 2 THEN 0 ELSE round(regr_slope(opened::DOUBLE, year::DOUBLE), 6) + 0 END AS slope_opened FROM y GROUP BY 1")
def ols_slope(spark: SparkSession, d: str) -> DataFrame:
    return issue_years(spark, d).groupBy("cust").agg((F.round(stats.slope("opened", "year"), 6) + 0.0).alias("slope_opened"))


@query(ISSUES + """
SELECT cust, CASE WHEN sum(opened) > 0 THEN round(sum(closed) / sum(opened), 3) END AS close_ratio, (sum(opened) - sum(closed))::BIGINT AS net_new,
  CASE WHEN sum(opened) / 5 >= 1 THEN round((coalesce(regr_slope(closed::DOUBLE, year::DOUBLE), 0) - coalesce(regr_slope(opened::DOUBLE, year::DOUBLE), 0)) / (sum(opened) / 5), 4) + 0 END AS trend
FROM y GROUP BY 1 HAVING count(*) = 5
""")
def ratio_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Issue measures of those with all five years; the others have none at all."""
    opened, closed = F.sum("opened"), F.sum("closed")
    g = issue_years(spark, d).groupBy("cust").agg(
        F.count("*").alias("n"), F.when(opened > 0, F.round(closed / opened, 3)).alias("close_ratio"), (opened - closed).alias("net_new"),
        F.when(opened / 5 >= 1, F.round((stats.slope("closed", "year") - stats.slope("opened", "year")) / (opened / 5), 4) + 0.0).alias("trend"),
    )
    return g.where("n = 5").drop("n")


@query(ISSUES + "SELECT c_custkey, CASE WHEN n = 5 THEN opened END::BIGINT AS opened_5y FROM customer LEFT JOIN (SELECT cust, count(*) AS n, sum(opened) AS opened FROM y GROUP BY 1) ON c_custkey = cust")
def all_or_nothing_years(spark: SparkSession, d: str) -> DataFrame:
    g = issue_years(spark, d).groupBy("cust").agg(F.count("*").alias("n"), F.sum("opened").alias("opened"))
    return table(spark, d, "customer").join(g, F.col("c_custkey") == F.col("cust"), "left").select("c_custkey", F.when(F.col("n") == 5, F.col("opened")).alias("opened_5y"))


@query("SELECT p_partkey, round(power(greatest(1, p_size) * greatest(1, p_retailprice / 100) * 3.0, 1 / 3.0), 6) AS geom FROM part")
def geom_mean_composite(spark: SparkSession, d: str) -> DataFrame:
    g = N.geometric_mean(F.greatest(F.lit(1), F.col("p_size")), F.greatest(F.lit(1.0), F.col("p_retailprice") / 100), F.lit(3.0))
    return table(spark, d, "part").select("p_partkey", F.round(g, 6).alias("geom"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 3 <> 0 AND p_size % 2 <> 0 THEN greatest(p_size, 20) END AS strict_worst,
  greatest(CASE WHEN p_size % 3 <> 0 THEN p_size END, CASE WHEN p_size % 2 <> 0 THEN 20 END) AS any_worst FROM part
""")
def worst_of_any(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.when(F.col("p_size") % 3 != 0, F.col("p_size")), F.when(F.col("p_size") % 2 != 0, F.lit(20))
    return table(spark, d, "part").select("p_partkey", N.worst_of(a, b).alias("strict_worst"), N.worst_present(a, b).alias("any_worst"))


@query("""
WITH v AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_size * 2.0 END AS a, CASE WHEN p_size % 2 = 0 THEN 100.0 END AS b, p_retailprice / 20 AS c FROM part)
SELECT p_partkey, CASE WHEN (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + 1 >= 2 THEN round((coalesce(0.6 * a, 0) + coalesce(0.2 * b, 0) + 0.1 * c) / (CASE WHEN a IS NULL THEN 0 ELSE 0.6 END + CASE WHEN b IS NULL THEN 0 ELSE 0.2 END + 0.1), 6) END AS score FROM v
""")
def prorata_blend(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.when(F.col("p_size") % 3 == 0, F.col("p_size") * 2.0), F.when(F.col("p_size") % 2 == 0, 100.0)
    return table(spark, d, "part").select("p_partkey", F.round(N.pro_rata([(0.6, a), (0.2, b), (0.1, F.col("p_retailprice") / 20)], 2), 6).alias("score"))


MASS = "SELECT l_suppkey AS repo, p_brand AS eco, sum(l_quantity) AS mass FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"


def repo_mass(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("q"))
    return per.join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_suppkey").alias("repo"), F.col("p_brand").alias("eco")).agg(F.sum("q").alias("mass"))


@query(f"WITH m AS ({MASS}), l AS (SELECT *, ln(mass) AS v FROM m WHERE mass > 0), s AS (SELECT *, max(v) OVER (PARTITION BY eco) - min(v) OVER (PARTITION BY eco) AS span, min(v) OVER (PARTITION BY eco) AS lo FROM l) SELECT repo, eco, round((v - lo) / CASE WHEN span = 0 THEN 1 ELSE span END, 6) AS norm FROM s")
def ln_minmax(spark: SparkSession, d: str) -> DataFrame:
    return stats.ln_minmax(repo_mass(spark, d), ["eco"], "mass", "n").select("repo", "eco", F.round("n", 6).alias("norm"))


@query(f"WITH m AS ({MASS}), l AS (SELECT *, ln(mass) AS v FROM m WHERE mass > 0), s AS (SELECT *, max(v) OVER (PARTITION BY eco) - min(v) OVER (PARTITION BY eco) AS span, min(v) OVER (PARTITION BY eco) AS lo FROM l), r AS (SELECT repo, sqrt(sum(power((v - lo) / CASE WHEN span = 0 THEN 1 ELSE span END, 2))) AS raw FROM s GROUP BY 1) SELECT repo, round(100 * raw / max(raw) OVER (), 4) AS pr_score FROM r")
def pnorm_mass(spark: SparkSession, d: str) -> DataFrame:
    return stats.pnorm_score(stats.ln_minmax(repo_mass(spark, d), ["eco"], "mass", "n"), "repo", "n", "s").select("repo", F.round("s", 4).alias("pr_score"))


@query("SELECT c_custkey, round(c_acctbal / count(*) OVER (PARTITION BY c_nationkey), 4) AS budget_share FROM customer")
def org_budget_split(spark: SparkSession, d: str) -> DataFrame:
    n = F.count("*").over(Window.partitionBy("c_nationkey"))
    return table(spark, d, "customer").select("c_custkey", F.round(F.col("c_acctbal") / n, 4).alias("budget_share"))


@query("SELECT c_nationkey, array_to_string(list_sort(list_distinct(list(c_mktsegment))), ',') AS segments FROM customer GROUP BY 1")
def set_union_per_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ",").alias("segments"))


@query("SELECT c_mktsegment, round(quantile_cont(c_acctbal, 0), 4) AS q0, round(quantile_cont(c_acctbal, 0.25), 4) AS q25, round(quantile_cont(c_acctbal, 0.5), 4) AS q50, round(quantile_cont(c_acctbal, 0.75), 4) AS q75, round(quantile_cont(c_acctbal, 1), 4) AS q100 FROM customer GROUP BY 1")
def quantiles5(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "customer").groupBy("c_mktsegment").agg(F.percentile("c_acctbal", F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)])).alias("q"))
    return q.select("c_mktsegment", *[F.round(F.col("q")[i], 4).alias(f"q{n}") for i, n in enumerate((0, 25, 50, 75, 100))])


@query("SELECT o_orderpriority, sum((o_orderstatus = 'F')::INT)::BIGINT AS F, sum((o_orderstatus = 'O')::INT)::BIGINT AS O, sum((o_orderstatus = 'P')::INT)::BIGINT AS P FROM orders GROUP BY 1")
def contingency_pivot(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count()


@query("""
SELECT sum((NOT a AND b AND c)::INT)::BIGINT AS only_a, sum((a AND NOT b AND c)::INT)::BIGINT AS only_b, sum((a AND b AND NOT c)::INT)::BIGINT AS only_c
FROM (SELECT c_acctbal > 2000 AS a, c_nationkey < 18 AS b, c_mktsegment <> 'BUILDING' AS c FROM customer)
""")
def sole_blocker(spark: SparkSession, d: str) -> DataFrame:
    flags = table(spark, d, "customer").select((F.col("c_acctbal") > 2000).alias("a"), (F.col("c_nationkey") < 18).alias("b"), (F.col("c_mktsegment") != "BUILDING").alias("c"))
    names = ["a", "b", "c"]
    only = []
    for n in names:
        cond = ~F.col(n)
        for o in names:
            cond = cond & F.col(o) if o != n else cond
        only.append(F.sum(cond.cast("long")).alias(f"only_{n}"))
    return flags.agg(*only)


@query("SELECT p_brand, count(*)::BIGINT AS total, sum((p_size > 10)::INT)::BIGINT AS measured, round(100.0 * sum((p_size > 10)::INT) / count(*), 4) AS pct FROM part GROUP BY 1")
def coverage(spark: SparkSession, d: str) -> DataFrame:
    n = F.count(F.when(F.col("p_size") > 10, 1))
    return table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("total"), n.alias("measured"), F.round(100.0 * n / F.count("*"), 4).alias("pct"))


@query("SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dup_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query("""
SELECT l_partkey, bool_and(l_returnflag <> 'N') AS every_disabled, bool_or(l_linestatus = 'O') AS any_open,
  coalesce(NOT bool_or(l_linestatus = 'O') AND max(l_shipdate) < TIMESTAMP '2001-06-01', false) AS is_eol FROM lineitem GROUP BY 1
""")
def eol_verdict(spark: SparkSession, d: str) -> DataFrame:
    open_ = F.bool_or(F.col("l_linestatus") == "O")
    gone = ~open_ & (F.max("l_shipdate") < F.lit("2001-06-01").cast("timestamp"))
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(F.every(F.col("l_returnflag") != "N").alias("every_disabled"), open_.alias("any_open"), F.coalesce(gone, F.lit(False)).alias("is_eol"))


@query("SELECT c_nationkey, bool_or(CASE WHEN c_custkey % 7 = 0 THEN true WHEN c_custkey % 3 = 0 THEN false END) AS critical FROM customer GROUP BY 1")
def any_true_wins(spark: SparkSession, d: str) -> DataFrame:
    flag = F.when(F.col("c_custkey") % 7 == 0, True).when(F.col("c_custkey") % 3 == 0, False)
    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.bool_or(flag).alias("critical"))


@query("SELECT l_suppkey AS repo, count(*)::BIGINT AS functions, sum(l_quantity)::DOUBLE AS total, round(avg(l_quantity), 6) AS mean, max(l_quantity) AS worst, round(100 * sum(l_discount) / sum(l_quantity), 6) AS density FROM lineitem GROUP BY 1")
def tree_metrics(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("l_quantity")
    return table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("repo")).agg(F.count("*").alias("functions"), F.sum(q).alias("total"), F.round(F.avg(q), 6).alias("mean"), F.max(q).alias("worst"), F.round(100 * F.sum("l_discount") / F.sum(q), 6).alias("density"))


@query("SELECT user_id, year(ts)::INT AS year, event_type, count(*)::BIGINT AS commits FROM events GROUP BY 1, 2, 3")
def year_buckets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("user_id", F.year("ts").alias("year"), "event_type").agg(F.count("*").alias("commits"))


@query("SELECT user_id, sum((ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-27')::INT)::BIGINT AS recent, count(*)::BIGINT AS total FROM events GROUP BY 1")
def window_counts(spark: SparkSession, d: str) -> DataFrame:
    inside = (F.col("ts") >= F.lit("2024-01-20").cast("timestamp")) & (F.col("ts") < F.lit("2024-01-27").cast("timestamp"))
    return table(spark, d, "events").groupBy("user_id").agg(F.sum(inside.cast("long")).alias("recent"), F.count("*").alias("total"))
