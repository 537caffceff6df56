"""Dumps with damaged lines: what can be read, and what was rejected and why."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt"


@dataclass(frozen=True)
class Split:
    """good: typed rows; rejected: (line, reason) of the others."""

    good: DataFrame
    rejected: DataFrame


def _marked(lines: DataFrame, schema: StructType, keys: list[str], separator: str) -> DataFrame:
    """(line, row of text cells, reason): ragged, bad key, bad number, in this order; NULL where nothing is wrong.

    `ragged` is a line with fewer or more fields than the schema or a quote that
    never ends; `bad key` a blank key; `bad number` a cell that is not blank and not
    of its column's type.
    """
    header = separator.join(schema.names)
    text = StructType([*(StructField(n, StringType()) for n in schema.names), StructField(CORRUPT, StringType())])
    real = lines.where((F.trim("value") != "") & (F.col("value") != header) & (F.col("value") != F.lit('"' + f'"{separator}"'.join(schema.names) + '"')))
    parsed = real.select(F.col("value").alias("line"), F.from_csv("value", _ddl(text), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "sep": separator, "escape": '"'}).alias("row"))
    cell = lambda n: F.trim(F.col("row").getField(n))
    blank_key = _any([F.coalesce(cell(k), F.lit("")) == "" for k in keys])
    wrong = _any([(F.coalesce(cell(f.name), F.lit("")) != "") & cell(f.name).try_cast(f.dataType).isNull() for f in schema if not isinstance(f.dataType, StringType)])
    open_quote = (F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))) % 2 == 1
    return parsed.withColumn("reason", F.when(open_quote | F.col("row").isNull() | F.col("row").getField(CORRUPT).isNotNull(), "ragged").when(blank_key, "bad key").when(wrong, "bad number"))


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out |= c
    return out


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def split_lines(lines: DataFrame, schema: StructType, keys: list[str], separator: str = ",") -> Split:
    """lines (value) of a delimited dump as typed rows and rejected lines. Blank lines and repeated headers are neither; blank cells are NULL."""
    marked = _marked(lines, schema, keys, separator)
    cells = [F.nullif(F.trim(F.col("row").getField(f.name)), F.lit("")).try_cast(f.dataType).alias(f.name) for f in schema]
    return Split(marked.where("reason is null").select(*cells), marked.where("reason is not null").select("line", "reason"))


def read_damaged(spark, path: str, schema: StructType, keys: list[str], separator: str = ",") -> Split:
    """split_lines() of the text files at path."""
    return split_lines(spark.read.text(path), schema, keys, separator)


def rejected_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reason").agg(F.count("*").alias("n"))
