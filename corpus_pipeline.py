"""Cleaning pipeline over `documents`: reject toxic texts, keep one of each near-duplicate group,
cut repeated passages, drop benchmark leaks, and encode what is left.

Each stage takes all that its predecessor kept. All but the last return the
columns of `documents`; texts are never sampled or cut to a prefix. A stage sets
the session's batches for Python to a few MB (`small_batches`): executors live
through all stages, and their heaps have grown to the limit after the first two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import decontaminate, near_dedup, repeat_removal, subword, toxicity
from tidewright.llm.common import materialize, small_batches


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.learn(docs, labels))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8: the smallest doc_id of each group stays."""
    small_batches(spark)
    return near_dedup.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 50-byte strings that a smaller doc_id has are cut out; n_chars follows the text."""
    small_batches(spark)
    return repeat_removal.remove_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a ten-word window of a benchmark item go."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Subword ids with seeded merge dropout, and the check that they decode to the text."""
    small_batches(spark)
    return subword.encode_texts(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", keep_one_of_each_group),
    ("repeat_removal", cut_repeated_passages),
    ("decontamination", drop_benchmark_leaks),
    ("subword", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
