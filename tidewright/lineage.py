"""Cutting lineage in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a local session (tests) may do without and uses this machine's temporary folder."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors see")
    return where or f"file://{os.path.join(tempfile.gettempdir(), 'tidewright-shared')}"


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and read from a checkpoint from now on."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
