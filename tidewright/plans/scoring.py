"""Composed plans: value, risk, eligibility and the final ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.config import PARAMS, Params
from tidewright.functions import numbers as N
from tidewright.lineage import cut
from tidewright.operators import stats
from tidewright.operators import windows as W


def value(repos: DataFrame, shipped: DataFrame, packages: DataFrame, p: Params = PARAMS) -> DataFrame:
    """(repo, value_score): pro-rata blend of criticality, ecosystem flag, best position and dependency mass."""
    per = shipped.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("q"))  # below the join: far fewer rows meet
    mass = per.join(packages, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_suppkey").alias("repo"), F.col("p_brand").alias("eco")).agg(F.sum("q").alias("mass"))
    mass = cut(mass)
    placed = W.running_total(mass, "mass", "repo", ["eco"])
    top = placed.groupBy("repo").agg(F.max(100 - 100 * F.col("cum") / F.col("total")).alias("top"))
    score = stats.pnorm_score(stats.ln_minmax(mass, ["eco"], "mass", "n"), "repo", "n", "pr")
    rows = repos.select(F.col("s_suppkey").alias("repo"), "s_acctbal").join(top, "repo", "left").join(score, "repo", "left")
    criticality, flag = F.when(F.col("s_acctbal") > 0, F.col("s_acctbal") / 100), F.when(F.col("repo") % 3 == 0, 100.0)
    parts = [(p.w_criticality, criticality), (p.w_ecosystem, flag), (p.w_centrality, F.col("top")), (p.w_mass, F.col("pr"))]
    return rows.select("repo", N.pro_rata(parts, p.min_components).alias("value_score"))


def risk(shipped: DataFrame, orders: DataFrame, p: Params = PARAMS) -> DataFrame:
    """(repo, four dimensions, risk_score): geometric mean; a missing dimension leaves no score."""
    big = shipped.where("l_quantity > 30").groupBy(F.col("l_suppkey").alias("repo"), "l_orderkey").agg(F.count("*").alias("k"))
    commits = big.join(orders.select("o_orderkey", F.col("o_custkey").alias("cust")), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("repo", "cust").agg(F.sum("k").alias("commits"))
    b = stats.bus_factor_hhi(commits, "repo", "cust", "commits", p.bus_factor_share).select("repo", N.concentration_score(F.col("hhi"), F.col("bus_factor")).alias("concentration"))
    cve = F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 48), F.col("l_orderkey"))
    x = shipped.groupBy(F.col("l_suppkey").alias("repo")).agg(
        N.rounded(F.sum("l_extendedprice") / F.sum("l_quantity"), 6).alias("loc"), F.count_distinct(cve).alias("cve"), N.rounded(F.sum("l_quantity") / F.count_distinct("l_orderkey"), 6).alias("load")
    )
    x = W.percentiles(x, {"s": ("cve", "floor"), "c": ("loc", "high"), "w": ("load", "high")})
    x = x.select("repo", *[N.rounded(F.col(c), 2).alias(out) for c, out in (("c", "complexity"), ("s", "security"), ("w", "workload"))])
    rows = b.join(x, "repo")
    return rows.withColumn("risk_score", N.geometric_mean(*map(F.col, ("concentration", "complexity", "security", "workload"))))


def eligibility(repos: DataFrame) -> DataFrame:
    """(repo, four flags, eligible, reasons); an unknown flag counts against, but for nonprofit."""
    flags = {"oss": F.col("s_nationkey") % 5 != 0, "intent": F.col("s_acctbal") > 500, "nonprofit": F.col("s_nationkey") != 3, "active": F.col("s_suppkey") % 10 != 9}
    rows = repos.select(F.col("s_suppkey").alias("repo"), *[F.coalesce(c, F.lit(n == "nonprofit")).alias(n) for n, c in flags.items()])
    all_of = F.lit(True)
    for n in flags:
        all_of = all_of & F.col(n)
    reasons = F.array_join(F.array_compact(F.array(*[F.when(~F.col(n), n) for n in flags])), "; ")
    return rows.withColumns({"eligible": all_of, "reasons": reasons})


def final(eligible: DataFrame, value_: DataFrame, risk_: DataFrame) -> DataFrame:
    """Every repository; score = sqrt(value x risk); priority 1..n over eligible rows with a score, ties by repo."""
    rows = cut(eligible.join(value_, "repo", "left").join(risk_, "repo", "left").withColumn("s", F.sqrt(F.col("value_score") * F.col("risk_score"))))
    ranked = rows.where("eligible and s is not null").select("repo", N.rounded(F.col("s"), 9).alias("v"))
    ranked = W.running_total(ranked, "v", "repo").select("repo", F.col("place").cast("long").alias("priority"))
    out = rows.join(ranked, "repo", "left")
    value_score, risk_score, score = (N.rounded(F.col(c), 4) for c in ("value_score", "risk_score", "s"))
    return out.select("repo", value_score.alias("value_score"), risk_score.alias("risk_score"), "eligible", score.alias("score"), "priority")
