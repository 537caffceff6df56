"""Grouped measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators.windows import bus_factor_rows, first_by


def bus_factor_hhi(df: DataFrame, group: str, member: str, commits: str, share: float = 0.5) -> DataFrame:
    """group, bus_factor (fewest members that hold the share), hhi (0 to 10000, rounded), members. Members without commits don't count."""
    rows = bus_factor_rows(df.where(F.col(commits) > 0), group, member, commits)
    return rows.groupBy(group).agg(
        F.sum((F.col("before") < share * F.col("total")).cast("long")).alias("bus_factor"),
        F.round(F.sum(F.pow(F.col("share") * 100, 2))).cast("long").alias("hhi"),
        F.count("*").alias("members"),
    )


def mode_of(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """The most frequent value of each key; the smallest among equals."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return first_by(counts, keys, F.desc("_n"), F.col(value)).select(*keys, F.col(value).alias(out))


def slope(value: str, x: str) -> Column:
    """Least-squares slope; 0 for fewer than two points or no spread."""
    return F.coalesce(F.regr_slope(F.col(value).cast("double"), F.col(x).cast("double")), F.lit(0.0))


def mean_populated(value: str) -> Column:
    """Mean over values above 0, cut to an integer; 0 if there are none."""
    return F.coalesce(F.floor(F.avg(F.when(F.col(value) > 0, F.col(value)))), F.lit(0)).cast("long")


def ln_minmax(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """ln(value) scaled to 0..1 within keys, over values above 0; a single level scales to 0."""
    rows = df.where(F.col(value) > 0).withColumn("_l", F.ln(value))
    limits = rows.groupBy(*(F.col(k).alias(f"_key_{k}") for k in keys)).agg(F.min("_l").alias("_lo"), F.max("_l").alias("_hi"))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    span = F.col("_hi") - F.col("_lo")
    scaled = rows.join(limits, same).withColumn(out, (F.col("_l") - F.col("_lo")) / F.when(span == 0, 1.0).otherwise(span))
    return scaled.drop("_l", "_lo", "_hi", *(f"_key_{k}" for k in keys))


def pnorm_score(df: DataFrame, key: str, normal: str, out: str, p: float = 2.0) -> DataFrame:
    """p-norm of a key's normals, scaled so that the greatest is 100."""
    raw = df.groupBy(key).agg(F.pow(F.sum(F.pow(normal, F.lit(p))), F.lit(1 / p)).alias("_raw"))
    top = raw.agg(F.max("_raw").alias("_top"))
    return raw.crossJoin(F.broadcast(top)).select(key, F.when(F.col("_top") > 0, 100.0 * F.col("_raw") / F.col("_top")).alias(out))
