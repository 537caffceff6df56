"""Joins with a rule for what happens when a key is missing, repeated or blank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.urls import domain_suffixes
from tidewright.operators.windows import first_by


def two_key_fallback(df: DataFrame, dim: DataFrame, keys: tuple[str, str], dim_keys: tuple[str, str], value: str, out: str, stop_at_hit: bool = False) -> DataFrame:
    """Adds `out`: dim's value by the first key, else by the second. Two equi-joins, never an OR.

    stop_at_hit: a row found by the first key settles it even with a NULL value.
    """
    parts = []
    for i, dim_key in enumerate(dim_keys):
        one = dim.where(F.col(dim_key).isNotNull()).groupBy(F.col(dim_key).alias(f"_k{i}")).agg(F.min(value).alias(f"_v{i}"))
        parts.append(one.withColumn(f"_h{i}", F.lit(True)))
    joined = df.join(parts[0], F.col(keys[0]) == F.col("_k0"), "left").join(parts[1], F.col(keys[1]) == F.col("_k1"), "left")
    second = F.when(F.col("_h0"), F.col("_v0")).otherwise(F.col("_v1")) if stop_at_hit else F.coalesce("_v0", "_v1")
    return joined.withColumn(out, second).drop("_k0", "_v0", "_h0", "_k1", "_v1", "_h1")


def first_wins(sources: list[DataFrame], key: str) -> DataFrame:
    """Union of tables with the same columns; of a repeated key, the row of the earliest table."""
    from functools import reduce

    marked = [s.withColumn("_p", F.lit(i)) for i, s in enumerate(sources)]
    rest = [F.col(c) for c in sources[0].columns if c != key]
    return first_by(reduce(DataFrame.unionByName, marked), [key], F.col("_p"), *rest).drop("_p")


def asof_backward(df: DataFrame, history: DataFrame, key: str, at: str, when: str, value: str, out: str, reach: int = 30) -> DataFrame:
    """Adds `out`: history's last value at or before `at`, no more than `reach` back. One union and one window; no range join."""
    points = df.select(key, F.col(at).alias("_t"), F.lit(None).cast(history.schema[value].dataType).alias("_v"), F.lit(1).alias("_is")).distinct()
    known = history.where(F.col(value).isNotNull()).select(key, F.col(when).alias("_t"), F.col(value).alias("_v"), F.lit(0).alias("_is"))
    w = Window.partitionBy(key).orderBy("_t", "_is").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("_is") == 0, F.struct("_t", "_v")), ignorenulls=True).over(w)
    found = points.unionByName(known).withColumn("_l", last).where("_is = 1").select(key, F.col("_t").alias(at), F.when(F.col("_t") - F.col("_l._t") < reach, F.col("_l._v")).alias(out))
    return df.join(found, [key, at], "left")


def anti_or_raise(df: DataFrame, dim: DataFrame, key: str, what: str) -> DataFrame:
    """df, if all its keys are in dim; otherwise a ValueError that names a few."""
    missing = [r[0] for r in df.join(dim, key, "left_anti").select(key).distinct().orderBy(key).limit(5).collect()]
    if missing:
        raise ValueError(f"{what}: no row for {missing}")
    return df


def table_diff(built: DataFrame, stored: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, verdict): built_only, stored_only, or the first column that differs."""
    a = built.select(F.col(key).alias("_a"), *[F.col(c).alias(f"_a_{c}") for c in columns], F.lit(True).alias("_in_a"))
    b = stored.select(F.col(key).alias("_b"), *[F.col(c).alias(f"_b_{c}") for c in columns], F.lit(True).alias("_in_b"))
    verdict: Column = F.lit(None)
    for c in reversed(columns):
        verdict = F.when(~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")), c).otherwise(verdict)
    verdict = F.when(F.col("_in_b").isNull(), "built_only").when(F.col("_in_a").isNull(), "stored_only").otherwise(verdict)
    rows = a.join(b, F.col("_a") == F.col("_b"), "full_outer").select(F.coalesce("_a", "_b").alias(key), verdict.alias("verdict"))
    return rows.where("verdict is not null")


def match_suffix(rows: DataFrame, host: str, rules: DataFrame, out: str = "label") -> DataFrame:
    """Adds `out`: the label of the longest rule (domain, label, exclude) that a host is or ends with at a dot.

    A rule that excludes, however short, comes before all others: such a host has
    no label. Hosts are matched once each, by equality of their domains, so that
    no row is compared with every rule; of equal domains the smallest label counts.
    """
    domain = F.lower(F.trim("domain"))
    known = rules.select(domain.alias("_d"), "label", F.coalesce("exclude", F.lit(False)).alias("_x")).where("_d <> ''").groupBy("_d").agg(F.min("label").alias("_l"), F.bool_or("_x").alias("_x"))
    hosts = rows.select(F.lower(F.trim(F.col(host))).alias("_h")).where("_h <> ''").distinct()
    hit = hosts.select("_h", F.explode(domain_suffixes(F.col("_h"))).alias("_d")).join(known, "_d")
    best = hit.groupBy("_h").agg(F.bool_or("_x").alias("_x"), F.max_by("_l", F.when(F.col("_l").isNotNull(), F.struct(F.length("_d").alias("n"), "_d"))).alias("_l"))
    best = best.select("_h", F.when(~F.col("_x"), F.col("_l")).alias(out))
    return rows.join(best, F.lower(F.trim(F.col(host))) == F.col("_h"), "left").drop("_h")


def sets_by_key(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """(columns, side) of the distinct rows of two tables: `both`, `first` or `second`; intersection and both differences of all keys in one shuffle. NULLs are equal."""
    marked = a.select(*columns, F.lit(1).alias("_m")).unionByName(b.select(*columns, F.lit(2).alias("_m")))
    sides = marked.groupBy(*columns).agg(F.bit_or("_m").alias("_m"))
    return sides.select(*columns, F.when(F.col("_m") == 3, "both").when(F.col("_m") == 1, "first").otherwise("second").alias("side"))
