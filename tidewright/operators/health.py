"""Checks over whole tables; each gives (check, ok, detail) rows, so that any number can be put together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _result(df: DataFrame, check: str, bad: Column, detail: str) -> DataFrame:
    return df.select(F.lit(check).alias("check"), (bad == 0).alias("ok"), F.concat(bad.cast("string"), F.lit(f" {detail}")).alias("detail"))


def all_of(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def dates_sane(df: DataFrame, column: str, now: Column) -> DataFrame:
    """Every non-blank cell is an ISO time and not over a day ahead of now."""
    text = F.trim(F.col(column).cast("string"))
    at = F.try_to_timestamp(text)
    bad = F.coalesce(text != "", F.lit(False)) & (at.isNull() | (at > now + F.expr("INTERVAL 1 DAY")))
    return _result(df.agg(F.coalesce(F.sum(bad.cast("long")), F.lit(0)).alias("n")), f"dates: {column}", F.col("n"), "malformed or future dates")


def has_columns(df: DataFrame, columns: dict[str, str], name: str) -> DataFrame:
    """The schema has these columns of these types (simple names); only the schema is looked at."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    wrong = sorted(c for c, kind in columns.items() if have.get(c) != kind)
    return df.sparkSession.range(1).select(F.lit(f"schema: {name}").alias("check"), F.lit(not wrong).alias("ok"), F.lit(f"{len(wrong)} columns missing or of another type").alias("detail"))


def covered(parent: DataFrame, child: DataFrame, key: str, name: str) -> DataFrame:
    """Every key of parent is in child: the gate of full coverage, and of scores that need their inputs."""
    missing = parent.select(key).where(F.col(key).isNotNull()).distinct().join(child.select(key), key, "left_anti")
    return _result(missing.agg(F.count("*").alias("n")), f"coverage: {name}", F.col("n"), "keys missing")


def overrides_used(overrides: DataFrame, rows: DataFrame, key: str, dormant: Column) -> DataFrame:
    """(key, state) of overrides: `used`, `dormant` where the condition over the override says so, else `orphan`."""
    seen = rows.select(F.col(key).alias("_k")).distinct()
    joined = overrides.join(seen, F.col(key) == F.col("_k"), "left")
    return joined.select(key, F.when(F.col("_k").isNotNull(), "used").when(F.coalesce(dormant, F.lit(False)), "dormant").otherwise("orphan").alias("state"))


def sidecar_agrees(data: DataFrame, status: DataFrame, key: str, ok: str) -> DataFrame:
    """Keys with data and those whose status says ok are the same."""
    left = data.select(F.col(key).alias("_k")).where("_k IS NOT NULL").distinct()
    right = status.where(F.col(ok)).select(F.col(key).alias("_o")).where("_o IS NOT NULL").distinct()
    return _result(left.join(right, F.col("_k") == F.col("_o"), "full").where("_k IS NULL OR _o IS NULL").agg(F.count("*").alias("n")), "sidecar", F.col("n"), "keys differ")


def one_id_each(df: DataFrame, name: str, number: str) -> DataFrame:
    """Rows of one name agree on their id: (name, ids) of those that do not."""
    return df.where(F.col(number).isNotNull()).groupBy(name).agg(F.array_sort(F.collect_set(number)).alias("ids")).where(F.size("ids") > 1)


def filled(df: DataFrame, scope: Column, column: str, name: str) -> DataFrame:
    """Every row in scope has a value in the column; the detail names how many lack it, and the scope's size."""
    blank = F.coalesce(F.trim(F.col(column).cast("string")), F.lit("")) == ""
    sums = df.where(F.coalesce(scope, F.lit(False))).agg(F.count("*").alias("n"), F.coalesce(F.sum(blank.cast("long")), F.lit(0)).alias("bad"))
    return sums.select(F.lit(f"filled: {name}").alias("check"), (F.col("bad") == 0).alias("ok"), F.concat(F.col("bad").cast("string"), F.lit(" of "), F.col("n").cast("string"), F.lit(" rows blank")).alias("detail"))
