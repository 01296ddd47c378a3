"""Ordered running totals and ranks that do not need one task per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.functions.hashing import digest
from cohortline.sources.shared import durable


def running_totals(df: DataFrame, by: Sequence[str], order: Sequence[Column], sums: Mapping[str, Column],
                   totals: Mapping[str, str] | None = None) -> DataFrame:
    """Add inclusive running sums in the given order within each `by` group, and for `totals` (new name: name of a
    sum) the sum over the whole group.

    The order must be total within a group. Rows are range-partitioned by group and order, so a hot group spreads
    over many tasks: each task sums its own range and adds the totals of the ranges before it. The placement is made
    durable first, because both passes must see the same ranges. Group totals come from the range totals, so
    no join gathers a group by its key alone."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = durable(
        df.withColumns({f"_{n}": c for n, c in sums.items()})
        .repartitionByRange(ranges, *[F.col(b) for b in by], *order)
        .withColumn("_range", F.spark_partition_id())
    )
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    totals = totals or {}
    before = (
        placed.groupBy(*by, "_range")
        .agg(*[F.sum(f"_{n}").alias(f"_t_{n}") for n in sums])
        .select(
            *by, "_range", *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_b_{n}") for n in sums],
            *[F.sum(f"_t_{n}").over(whole).alias(name) for name, n in totals.items()])
    )
    within = (
        Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.join(before, [*by, "_range"])
        .withColumns({n: F.sum(f"_{n}").over(within) + F.col(f"_b_{n}") for n in sums})
        .select(*df.columns, *sums, *totals)
    )


def hash_bucket(keys: Sequence[str], seed: int) -> Column:
    """16-bit prefix of the hash order of the keys."""
    return F.substring(digest(*keys, seed=seed), 1, 4)


def hash_bucket_counts(df: DataFrame, by: Sequence[str], keys: Sequence[str], seed: int) -> DataFrame:
    """Rows per (group, 16-bit hash prefix) and the rows of the group in lower prefixes.

    At most 65,536 rows per group, whatever the size of the data."""
    counts = df.groupBy(*by, hash_bucket(keys, seed).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    lower = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_n").over(lower), F.lit(0)))


def hash_rank(df: DataFrame, by: Sequence[str], keys: Sequence[str], seed: int = 0, name: str = "rank") -> DataFrame:
    """Rank of each row in the hash order of its keys within its group.

    Hash order is uniform, so fixed hash prefixes split any group evenly; the
    sort inside a prefix covers 1/65,536 of it."""
    buckets = hash_bucket_counts(df, by, keys, seed)
    w = Window.partitionBy(*by, "_bucket").orderBy(digest(*keys, seed=seed), *keys)
    return (
        df.withColumn("_bucket", hash_bucket(keys, seed))
        .join(buckets, [*by, "_bucket"])
        .withColumn(name, F.row_number().over(w) + F.col("_before"))
        .drop("_bucket", "_n", "_before")
    )
