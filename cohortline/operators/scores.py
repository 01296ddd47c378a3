"""Standardised test scores with their code names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Test codes and their names.
ACT_CODES = {
    "ACEN": "English",
    "ACMA": "Mathematics",
    "ACRD": "Reading",
    "ACSC": "Science",
    "ACCO": "Composite",
    "ACWR": "Writing",
}


def act_lookup(spark: SparkSession) -> DataFrame:
    """The code names as a table."""
    return spark.createDataFrame(list(ACT_CODES.items()), "code string, name string")


def act_scores(test: DataFrame, prefix: str = "AC") -> DataFrame:
    """Scores whose code starts with the prefix, with the code's name if known.

    The lookup has a fixed handful of rows, which bounds its broadcast."""
    lookup = F.broadcast(act_lookup(test.sparkSession))
    return test.where(F.col("test_id").startswith(prefix)).join(
        lookup, F.col("test_id") == F.col("code"), "left"
    )


def act_composite(test: DataFrame, name: str = "Composite") -> DataFrame:
    """Only the composite scores."""
    return act_scores(test).where(F.col("name") == name)
