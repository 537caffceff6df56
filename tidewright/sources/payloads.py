"""Nested service payloads and partitioned dumps to flat rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.numbers import snake_case
from tidewright.sources.readers import read_or_empty

#: The parts of a scorecard that are read.
SCORECARD = "commit string, date string, overallScore double, checks array<struct<name:string,score:double>>"


def read_years(spark: SparkSession, folder: str, years: list[int], schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Files `{year}-*` of a folder with a year column; only the files of these years are listed and read, and none is an empty table."""
    parts = [read_or_empty(spark, f"{folder}/{year}-*", schema, fmt).withColumn("year", F.lit(year)) for year in years]
    return reduce(DataFrame.unionByName, parts)


def union_metrics(frames: list[DataFrame], metrics: tuple[str, ...]) -> DataFrame:
    """Rows of several long tables (metric and more; columns that one lacks are NULL) for the metrics wanted."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.where(F.col("metric").isin(*metrics))


def maintainers(payloads: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """(key, login, id) of payloads (key, maintainers: array of struct with login): blank logins go, ids (login, id) are attached where known."""
    rows = payloads.select(key, F.explode("maintainers").alias("m")).select(key, F.trim("m.login").alias("login")).where("login <> ''").distinct()
    return rows.join(ids.select("login", "id"), "login", "left").select(key, "login", "id")


def flatten(payloads: DataFrame, paths: dict[str, str], key: str) -> DataFrame:
    """One column for each path (new name to a dotted path, or one with [n]); what a payload lacks is NULL."""
    return payloads.select(key, *(F.get_json_object("json", "$." + path).alias(name) for name, path in paths.items()))


def alias_statuses(batch: DataFrame, response: Column) -> DataFrame:
    """(name, status, value) of a batch (alias, name) against its response (JSON: alias to object or null).

    An object is `ok`, a null is `not_found`; an alias the response lacks was a passing error and gives no row.
    """
    found = F.from_json(response, "map<string,string>")
    rows = batch.withColumn("_r", found).where(F.array_contains(F.map_keys("_r"), F.col("alias"))).withColumn("value", F.try_element_at("_r", "alias"))
    return rows.select("name", F.when(F.col("value").isNull(), "not_found").otherwise("ok").alias("status"), "value")


def scorecard_long(payloads: DataFrame, key: str) -> DataFrame:
    """(key, commit, metric, value) of payloads (key, json): the overall score and each check under its snake_case name.

    A check of -1 stays, one without name or score goes, as does a payload without a commit.
    """
    s = F.from_json("json", SCORECARD)
    checks = F.transform(F.coalesce("s.checks", F.array().cast("array<struct<name:string,score:double>>")), lambda c: F.struct(snake_case(c["name"]).alias("metric"), c["score"].alias("value"), c["name"].alias("raw")))
    overall = F.array(F.struct(F.lit("score").alias("metric"), F.col("s.overallScore").alias("value"), F.lit("score").alias("raw")))
    rows = payloads.select(key, s.alias("s")).where(F.trim("s.commit") != "").select(key, F.trim("s.commit").alias("commit"), F.explode(F.concat(overall, checks)).alias("m"))
    return rows.where("m.value IS NOT NULL AND m.raw <> ''").select(key, "commit", "m.metric", "m.value")


def zero_before_gap(df: DataFrame, key: str, year: str, count: str) -> DataFrame:
    """A missing year and all before it count 0: years are fetched backwards and the first gap ends the series."""
    gap = df.where(F.col(count).isNull()).groupBy(F.col(key).alias("_k")).agg(F.max(year).alias("_gap"))
    rows = df.join(gap, F.col(key) == F.col("_k"), "left")
    return rows.withColumn(count, F.when(F.col(year) <= F.col("_gap"), F.lit(0)).otherwise(F.col(count))).drop("_k", "_gap")


def union_in_scope(scope: DataFrame, key: str, sources: list[DataFrame], name: str) -> DataFrame:
    """Distinct lower-case names of sources (key, name) whose key is in scope; blank names go."""
    rows = reduce(DataFrame.unionByName, [s.select(F.lower(F.col(key).cast("string")).alias("_k"), F.lower(F.trim(name)).alias(name)) for s in sources])
    wanted = scope.select(F.lower(F.col(key).cast("string")).alias("_k")).distinct()
    return rows.where(f"{name} <> ''").join(wanted, "_k", "left_semi").select(name).distinct()


def split_columns(df: DataFrame, key: str, groups: list[list[str]]) -> list[DataFrame]:
    """One narrow table for each group of columns, without rows that have none of them."""
    return [df.select(key, *g).where(F.coalesce(*(F.col(c).cast("string") for c in g)).isNotNull()) for g in groups]
