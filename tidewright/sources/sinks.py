"""Writers: whole-table CSV with fixed columns, keyed JSON, sorted output."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, columns: list[str], *order: Column, quote_all: bool = True) -> None:
    """Replace the table at path as a whole: it is written beside it and takes its place by renaming.

    A failed write leaves the old table; between the two renames a reader finds none, never half of one.
    """
    spark = df.sparkSession
    fresh, old = (f"{path.rstrip('/')}.{kind}-{uuid.uuid4().hex}" for kind in ("new", "old"))
    df.select(*columns).orderBy(*order).write.option("quoteAll", str(quote_all).lower()).csv(fresh, header=True)
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(at(path)) and not files.rename(at(path), at(old)):
        raise OSError(f"cannot move {path}")
    if not files.rename(at(fresh), at(path)):
        files.rename(at(old), at(path))
        raise OSError(f"cannot put {fresh} in place")
    files.delete(at(old), True)


def as_json(df: DataFrame, key: str) -> DataFrame:
    """(key, json): each row's other columns as one JSON object."""
    return df.select(key, F.to_json(F.struct(*[c for c in df.columns if c != key])).alias("json"))
