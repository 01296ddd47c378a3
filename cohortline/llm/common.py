"""What several operators share: staged tables, reading of the input tables, byte and span helpers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.sources.shared import new_path

#: The white space of the contracts, for regular expressions of Java and of Python.
SPACE = r"[\x20\x09-\x0D]"
#: Spark deletes the shuffle files of an action when it ends. Otherwise they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data, through Spark's reader, so that any file system will do."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside go with their action; the session's own setting holds again afterwards."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back; their shuffle files are deleted.

    This cuts the lineage: a lost executor re-reads the rows, and values that hang
    on the order of rows (row numbers, blocks) are the same for all who read them."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with brief_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # known: no job looks for it in the files


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_text(col: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the input doesn't use."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices of the ranges [start, start + length), one range after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)
