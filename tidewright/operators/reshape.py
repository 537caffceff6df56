"""Long and wide tables, upserts and overlays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators.windows import first_by


def long_to_wide(df: DataFrame, keys: list[str], name: str, value: str, names: list) -> DataFrame:
    """One column a name; the names are given, so that no extra pass is needed to find them."""
    return df.groupBy(*keys).pivot(name, names).agg(F.max(value))


def wide_to_long(df: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """One row a column that is not NULL."""
    return df.unpivot(keys, columns, name, value).where(F.col(value).isNotNull())


def upsert(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """New rows replace old ones of the same key; new rows without a value are refused."""
    fresh = new.where(F.col(value).isNotNull())
    return old.join(fresh, keys, "left_anti").unionByName(fresh)


def replace_group(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All of a key's rows are replaced when the new table has the key."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def preserve_columns(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """New rows with the columns that only the old table has."""
    extra = [c for c in old.columns if c not in new.columns]
    return new.join(first_by(old.select(key, *extra), [key], *[F.col(c) for c in extra]), key, "left") if extra else new


def freshest(df: DataFrame, key: str, valid: str, at: str, alias: str) -> DataFrame:
    """One row a key, valid and recent first, with all aliases of the key."""
    names = df.groupBy(key).agg(F.array_sort(F.collect_set(alias)).alias("aliases"))
    return first_by(df, [key], F.desc(valid), F.desc(at), F.col(alias)).join(names, key)


def format_cell(value: str):
    """Numbers as text: whole numbers without a fraction, NaN and infinities blank."""
    c = F.col(value).cast("double")
    odd = F.isnan(c) | c.isin(float("inf"), float("-inf"))
    return F.when(c.isNull() | odd, "").when(c == F.floor(c), c.cast("long").cast("string")).otherwise(c.cast("string"))


def numeric_profile(df: DataFrame, share: float = 0.8, ends: int = 5) -> DataFrame:
    """(name, n, negative, smallest, largest) of the columns of which at least that share of the non-blank cells are numbers.

    smallest and largest hold `ends` values each; every task keeps only its own few before they are put together.
    """
    cells = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.trim(F.col(c).cast("string")).alias("cell")) for c in df.columns))).alias("e")).select("e.*").where("cell <> ''")
    x = cells.withColumn("x", F.col("cell").try_cast("double"))
    sums = x.groupBy("name").agg(F.count("*").alias("cells"), F.count("x").alias("n"), F.sum((F.col("x") < 0).cast("long")).alias("negative")).where(F.col("n") >= share * F.col("cells"))
    part = F.spark_partition_id().alias("part")
    out = sums
    for name, order in (("smallest", F.asc("x")), ("largest", F.desc("x"))):
        own = x.where("x IS NOT NULL").select("name", "x", part).withColumn("r", F.row_number().over(Window.partitionBy("name", "part").orderBy(order))).where(F.col("r") <= ends)
        few = own.withColumn("r", F.row_number().over(Window.partitionBy("name").orderBy(order))).where(F.col("r") <= ends)
        ranked = few.groupBy("name").agg(F.sort_array(F.collect_list("x"), asc=name == "smallest").alias(name))
        out = out.join(ranked, "name")
    return out.select("name", "n", "negative", "smallest", "largest")
