"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins against a table with one hot key rely on the adaptive skew join: it splits
# the hot partition of the fact side and repeats the small matching part, also
# where the split costs an extra shuffle. Aggregations need no such help, as they
# reduce each task's rows before the shuffle.
# Rows of feature tables shrink tenfold in a shuffle, so merged partitions end at
# 16 MB of shuffled bytes: a task sorts some hundred MB, however large the tables are.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
