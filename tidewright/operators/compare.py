"""What differs between two versions of a table, without joining what is equal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bucket(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def digest(df: DataFrame, key: list[str], columns: list[str], buckets: int = 4096) -> DataFrame:
    """(bucket, rows, sum, mix): for each bucket of the key's hash two sums of row hashes, whatever the order of rows.

    NULL, blank and the column's place count: a value that moves to another
    column changes the hash.
    """
    cells = [F.coalesce(F.concat(F.lit(f"{i}="), F.col(c).cast("string")), F.lit(f"{i}~")) for i, c in enumerate([*key, *columns])]
    big = "decimal(38,0)"
    rows = df.select(_bucket(key, buckets).alias("bucket"), F.xxhash64(*cells).alias("a"), F.xxhash64(F.lit(1), *cells).alias("b"))
    return rows.groupBy("bucket").agg(F.count("*").alias("rows"), F.sum(F.col("a").cast(big)).alias("sum"), F.sum(F.col("b").cast(big)).alias("mix"))


def unequal_buckets(a: DataFrame, b: DataFrame, key: list[str], columns: list[str], buckets: int = 4096) -> DataFrame:
    """(bucket) of the buckets whose digests differ: one scan of each side, and nothing of it is shuffled but digests."""
    x, y = (digest(df, key, columns, buckets).select(F.col("bucket").alias(f"{n}_b"), F.struct("rows", "sum", "mix").alias(n)) for n, df in (("x", a), ("y", b)))
    return x.join(y, F.col("x_b") == F.col("y_b"), "full_outer").where(~F.col("x").eqNullSafe(F.col("y"))).select(F.coalesce("x_b", "y_b").alias("bucket"))


def cell_differences(built: DataFrame, stored: DataFrame, key: list[str], columns: list[str], buckets: int = 4096) -> DataFrame:
    """(key..., column, built, stored) of every cell that differs; a row that only one side has is one entry, `built_only` or `stored_only`.

    Keys compare as text. Only buckets whose digests differ are joined: where a few cells
    have changed, a second scan reads and shuffles a few rows. Of rows that
    repeat a key, the n-th (by all columns) of one side meets the n-th of the other.
    """
    from pyspark.sql import Window

    bad = unequal_buckets(built, stored, key, columns, buckets)
    order = Window.partitionBy(*key).orderBy(*columns) if columns else Window.partitionBy(*key).orderBy(*key)

    def side(df: DataFrame, name: str) -> DataFrame:
        rows = df.select(*key, *columns).withColumn("_bucket", _bucket(key, buckets)).join(F.broadcast(bad.withColumnRenamed("bucket", "_bucket")), "_bucket", "left_semi")  # `buckets` rows at most
        rows = rows.withColumn("_nth", F.row_number().over(order))
        cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns)) if columns else F.array().cast("array<struct<column:string,value:string>>")
        return rows.select(*(F.col(k).cast("string").alias(f"{name}_{k}") for k in key), F.col("_nth").alias(f"{name}_nth"), cells.alias(name))

    a, b = side(built, "a"), side(stored, "b")
    same = F.col("a_nth") == F.col("b_nth")
    for k in key:
        same &= F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}"))
    joined = a.join(b, same, "full_outer")
    one = lambda name: F.array(F.struct(F.lit(name).alias("column"), F.lit(None).cast("string").alias("built"), F.lit(None).cast("string").alias("stored")))
    pairs = F.filter(F.zip_with("a", "b", lambda x, y: F.struct(x["column"].alias("column"), x["value"].alias("built"), y["value"].alias("stored"))), lambda c: ~c["built"].eqNullSafe(c["stored"]))
    found = F.when(F.col("b_nth").isNull(), one("built_only")).when(F.col("a_nth").isNull(), one("stored_only")).otherwise(pairs)
    return joined.select(*(F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in key), F.explode(found).alias("_c")).select(*key, "_c.*")
