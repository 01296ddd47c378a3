"""Durable intermediate results in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Only a local session without that setting gets a folder of its own: on a
    cluster a machine-local folder would be lost with its executor."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    current = context.getCheckpointDir()
    if named is None and current is not None:
        return current
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="cohortline-")
    if current is None:
        context.setCheckpointDir(named)
    return named


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Materialise the rows reliably and cut their lineage, so that a lost
    executor re-reads them instead of re-computing values that could differ."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
