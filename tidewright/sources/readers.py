"""Readers of the engine's table formats; a missing file is an empty table, a pointer file is an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

POINTER = "version https://git-lfs.github.com/spec/"


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", **options) -> DataFrame:
    """The table at path with the given schema; no rows if nothing is there."""
    defaults = {"header": "true", "mode": "PERMISSIVE"} if fmt == "csv" else {}
    try:
        return spark.read.format(fmt).options(**defaults | options).schema(schema).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def reject_pointers(spark: SparkSession, path: str) -> None:
    """Raise ValueError if a file holds a large-file pointer and not its data. Pointers are small: contents of larger files are not read."""
    small = spark.read.format("binaryFile").load(path).where(F.col("length") < 1024)
    found = small.where(F.col("content").cast("string").startswith(POINTER)).select("path").limit(3).collect()
    if found:
        raise ValueError(f"pointers instead of data: {[r['path'] for r in found]}")


def last_by_key(df: DataFrame, key: str, order: Column, lower: bool = False) -> DataFrame:
    """One row a trimmed key, the last by order; rows with a blank key are dropped."""
    k = F.nullif(F.trim(F.col(key)), F.lit(""))
    rest = [c for c in df.columns if c != key]
    rows = df.select((F.lower(k) if lower else k).alias("_key"), F.struct(*rest).alias("_row"), order.alias("_at")).where(F.col("_key").isNotNull())
    return rows.groupBy("_key").agg(F.max_by("_row", "_at").alias("_row")).select(F.col("_key").alias(key), *[F.col(f"_row.{c}") for c in rest])


def stanzas(lines: DataFrame) -> DataFrame:
    """Rows of `value` (one stanza each) to a map of its fields; folded lines are joined."""
    joined = F.regexp_replace("value", r"\n[ \t]+", " ")
    pairs = F.filter(F.split(joined, "\n"), lambda l: l.contains(":"))
    return lines.select(F.map_from_entries(F.transform(pairs, lambda l: F.struct(F.trim(F.substring_index(l, ":", 1)), F.trim(F.regexp_replace(l, "^[^:]*:", ""))))).alias("fields"))


def read_stanzas(spark: SparkSession, path: str) -> DataFrame:
    return stanzas(spark.read.option("lineSep", "\n\n").text(path).where(F.trim("value") != ""))


def popularity(lines: DataFrame) -> DataFrame:
    """(rank, name, installs) of a white-space table; comments, rules and totals are left out."""
    parts = F.split(F.trim("value"), r"\s+")
    rows = lines.where(~F.col("value").rlike(r"^\s*(#|-|$)")).select(parts[0].try_cast("long").alias("rank"), parts[1].alias("name"), parts[2].try_cast("long").alias("installs"))
    return rows.where("rank is not null and name <> 'Total'")


def numstat(lines: DataFrame, suffixes: tuple[str, ...]) -> DataFrame:
    """(path, added, deleted) summed over `added<TAB>deleted<TAB>path` lines of source files; binaries have no numbers."""
    parts = F.split("value", "\t")
    rows = lines.select(parts[0].try_cast("long").alias("a"), parts[1].try_cast("long").alias("d"), parts[2].alias("path")).where("a is not null and d is not null")
    wanted = F.lit(False)
    for s in suffixes:
        wanted = wanted | F.col("path").endswith(s)
    return rows.where(wanted).groupBy("path").agg(F.sum("a").alias("added"), F.sum("d").alias("deleted"))


def commit_log(lines: DataFrame) -> DataFrame:
    """(at, name, email) of lines whose fields are separated by the unit separator; broken lines are skipped."""
    parts = F.split("value", "\x1f")
    rows = lines.select(parts[0].try_cast("long").alias("at"), F.trim(parts[1]).alias("name"), F.trim(parts[2]).alias("email"), F.size(parts).alias("n"))
    return rows.where("n = 3 and at is not null").drop("n")


def rescue_objects(text: Column) -> Column:
    """All whole `"name": "..."` values of a JSON text that was cut off."""
    return F.regexp_extract_all(text, F.lit(r'"name"\s*:\s*"([^"]*)"'), F.lit(1))


def year_dimension(df: DataFrame, key: str, first: int, last: int) -> DataFrame:
    return df.select(key).distinct().select(key, F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year"))


def row_numbers(df: DataFrame, key: str, *order: Column) -> DataFrame:
    return df.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
