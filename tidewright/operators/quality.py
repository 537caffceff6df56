"""Data-quality rules: one pass over a table for any number of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, key: Column, rules: dict[str, Column]) -> DataFrame:
    """(rule, key) of every row that breaks a rule; a rule that is unknown for a row counts as kept."""
    broken = F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()])
    return df.select(F.explode(F.array_compact(broken)).alias("rule"), key.alias("key"))


def rule_counts(df: DataFrame, rules: dict[str, Column], error_share: float) -> DataFrame:
    """(rule, n, severity): ok, warning, or error beyond a share of the rows."""
    total = df.agg(F.count("*").alias("_total"), *[F.sum(F.coalesce(~r, F.lit(False)).cast("long")).alias(n) for n, r in rules.items()])
    long = total.unpivot(["_total"], list(rules), "rule", "n")
    return long.select("rule", "n", F.when(F.col("n") == 0, "ok").when(F.col("n") > error_share * F.col("_total"), "error").otherwise("warning").alias("severity"))


def gate(df: DataFrame, rules: dict[str, Column], what: str) -> DataFrame:
    """df, if no row breaks a rule; otherwise a ValueError with the counts."""
    bad = {r["rule"]: r["n"] for r in rule_counts(df, rules, 1.0).where("n > 0").collect()}
    if bad:
        raise ValueError(f"{what}: {bad}")
    return df
