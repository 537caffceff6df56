"""Streams over the events table, run until what is there has been read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.queries.registry import query, table
from tidewright.streaming import incremental


def event_stream(spark: SparkSession, d: str) -> DataFrame:
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT year(ts)::INT AS year, event_type, count(*)::BIGINT AS n FROM events GROUP BY 1, 2")
def stream_year_counts(spark: SparkSession, d: str) -> DataFrame:
    counts = event_stream(spark, d).groupBy(F.year("ts").alias("year"), "event_type").agg(F.count("*").alias("n"))
    return incremental.drain(counts, "complete", "years")


@query("SELECT user_id, max_by(value, (ts, event_id)) AS value FROM events GROUP BY 1")
def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    rows = event_stream(spark, d).withColumn("at", F.struct("ts", "event_id"))
    return incremental.drain(incremental.upsert_latest(rows, "user_id", "at", "value"), "update", "latest", "user_id")


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*)::BIGINT AS n FROM events GROUP BY 1, 2")
def stream_day_windows(spark: SparkSession, d: str) -> DataFrame:
    counts = incremental.bucket_counts(event_stream(spark, d), "ts", "event_type", "1 day", "1 hour")
    return incremental.drain(counts, "complete", "days").withColumn("start", F.col("start").cast("timestamp_ntz"))
