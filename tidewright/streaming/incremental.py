"""The same transformations over streams: windowed counts and keyed upserts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.lineage import shared_folder
from tidewright.sources.keyed import KeyedTables


def drain(stream: DataFrame, mode: str = "append", name: str = "stream", key: str | None = None) -> DataFrame:
    """Run a stream over what is there now and return its rows from a table in the shared folder.

    In update mode a batch holds the rows of the keys (`key`) that changed, which replace the earlier ones: only
    their buckets are written. In complete mode every batch is a whole result and replaces the one before: the last
    one's rows are returned, none if there was no batch. A batch that is tried again changes nothing twice.
    """
    spark = stream.sparkSession
    out = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if mode == "append":
        stream.writeStream.format("parquet").option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start(out).awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)
    if mode == "update":
        if key is None:
            raise ValueError("update mode needs the key by which batches are merged")
        tables = KeyedTables(spark, out, key, {name: stream.schema})
        merge_stream(stream, tables, name, f"{out}-state")
        return tables.read(name)
    if mode != "complete":
        raise ValueError(f"no such mode: {mode}")
    done: list[int] = []

    def keep(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{n}")
        done.append(n)

    stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/{max(done)}") if done else spark.createDataFrame([], stream.schema)


def merge_stream(stream: DataFrame, tables: KeyedTables, name: str, state: str) -> None:
    """Run a stream in update mode over what is there now; each batch replaces its keys' rows in the table, once."""

    def merge(batch: DataFrame, n: int) -> None:
        tables.commit({name: batch}, stream=name, batch=n)

    stream.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def bucket_counts(events: DataFrame, at: str, key: str, every: str, late: str) -> DataFrame:
    """Counts by key in tumbling windows; rows later than `late` are not waited for."""
    rows = events.withWatermark(at, late).groupBy(F.window(at, every), key).agg(F.count("*").alias("n"))
    return rows.select(F.col("window.start").alias("start"), key, "n")


def upsert_latest(events: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """The newest value of each key, kept as state."""
    return events.groupBy(key).agg(F.max_by(value, at).alias(value))
