"""Filling missing values from fitted statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.functions.columns import quoted

Fill = dict[str, float | str]


def as_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles (booleans as 0/1)."""
    wanted = set(columns)
    types = dict(df.dtypes)
    return df.select(*[
        (F.col(f"`{c}`").cast("int") if types[c] == "boolean" else F.col(f"`{c}`")).cast("double").alias(c)
        if c in wanted else F.col(f"`{c}`")
        for c in df.columns
    ])


def fit_means(df: DataFrame, columns: Sequence[str]) -> Fill:
    """Mean of every column in one aggregation; 0 for a column without values."""
    row = df.agg(*[F.avg(F.col(f"`{c}`")).alias(c) for c in columns]).first()
    return {c: 0.0 if row[c] is None else row[c] for c in columns}


def feature_array(columns: Sequence[str], types: dict[str, str]) -> Column:
    """The columns as one array of doubles (booleans as 0/1), nulls kept."""
    values = [f"cast({quoted(c)} as int)" if types[c] == "boolean" else quoted(c) for c in columns]
    return F.expr("cast(array(" + ", ".join(f"cast({v} as double)" for v in values) + ") as array<double>)")


def array_means(df: DataFrame, size: int, features: str = "features") -> list[float]:
    """Mean of every array position; 0 for a position without values.

    A task adds up its rows into one vector of sums and one of counts. These partial states are merged by about the square root
    of so many tasks, and the driver adds up what those have: a bounded number of vectors, however many rows there are. Sums are
    extended numbers, kept as two doubles, so that the order of rows and tasks doesn't move the means."""
    schema = "sums array<double>, rests array<double>, counts array<double>"

    def state_of(sums: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        main = sums.astype(float)
        return pa.RecordBatch.from_pydict({"sums": [main], "rests": [(sums - main).astype(float)], "counts": [counts.astype(float)]})

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(size, np.longdouble), np.zeros(size, np.int64)
        for b in batches:
            values, lengths = pc.list_flatten(b["x"]), pc.fill_null(pc.list_value_length(b["x"]), 0).to_numpy(zero_copy_only=False)
            if not np.isin(lengths, (0, size)).all():
                raise ValueError(f"every array needs {size} values")
            known = pc.is_valid(values).to_numpy(zero_copy_only=False).reshape(-1, size)
            numbers = pc.fill_null(values, 0.0).to_numpy(zero_copy_only=False).reshape(-1, size)
            sums += numbers.sum(axis=0, dtype=np.longdouble)
            counts += known.sum(axis=0)
        yield state_of(sums, counts)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(size, np.longdouble), np.zeros(size)
        for b in batches:
            main, rest, n = (b[c].flatten().to_numpy().reshape(-1, size) for c in ("sums", "rests", "counts"))
            sums += main.sum(axis=0, dtype=np.longdouble) + rest.sum(axis=0, dtype=np.longdouble)
            counts += n.sum(axis=0)
        yield state_of(sums, counts)

    if not size:
        return []
    mergers = max(1, math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    rows = df.select(F.col(features).cast("array<double>").alias("x"))
    states = rows.mapInArrow(partial, schema).repartition(mergers).mapInArrow(merge, schema).collect()
    sums, rests, counts = (np.sum([r[c] for r in states], axis=0, dtype=np.longdouble) for c in ("sums", "rests", "counts"))
    return np.where(counts > 0, (sums + rests) / np.maximum(counts, 1), 0.0).astype(float).tolist()


def fill_array(df: DataFrame, means: Sequence[float], features: str = "features") -> DataFrame:
    """Replace nulls of the array by the mean of their position."""
    if not means:
        return df
    return df.withColumn(
        features, F.zip_with(features, F.lit(list(means)), lambda x, m: F.coalesce(x, m))
    )


def fit_modes(df: DataFrame, columns: Sequence[str]) -> Fill:
    """Most frequent value of every column, the smallest among equals.

    Values are counted as (column, value) groups, so a column with many values
    is spread over the cluster rather than held in one aggregation buffer."""
    if not columns:
        return {}
    pair = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns]))
    counts = (
        df.select(pair.alias("p")).select("p.c", "p.v").where("v is not null")
        .groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    )
    top = Window.partitionBy("c").orderBy(F.desc("n"), F.asc("v"))
    rows = counts.withColumn("rn", F.row_number().over(top)).where("rn = 1").collect()
    return {r["c"]: r["v"] for r in rows}


def fit_fill(df: DataFrame, columns: Sequence[str]) -> Fill:
    """Most frequent value for text columns, mean for the others."""
    types = {f.name: f.dataType for f in df.schema.fields}
    text = [c for c in columns if isinstance(types[c], T.StringType)]
    return {**fit_modes(df, text), **fit_means(df, [c for c in columns if c not in text])}


def fill(df: DataFrame, values: Fill) -> DataFrame:
    """Replace nulls by the fitted values."""
    return df.select(*[
        F.coalesce(F.col(f"`{c}`"), F.lit(values[c])).alias(c) if c in values else F.col(f"`{c}`") for c in df.columns
    ])


def impute(train: DataFrame, test: DataFrame, columns: Sequence[str], strategy: str = "mean",
           per_fold: bool = False) -> tuple[DataFrame, DataFrame]:
    """Impute both folds with the statistics of the training fold.

    `per_fold=True` fits the test fold on itself instead, which lets test data
    shape its own features."""
    if strategy not in ("mean", "most_frequent"):
        raise ValueError(f"unknown imputation strategy {strategy!r}")
    fit = fit_fill if strategy == "most_frequent" else fit_means
    if strategy == "mean":
        train, test = as_numbers(train, columns), as_numbers(test, columns)
    values = fit(train, columns)
    return fill(train, values), fill(test, fit(test, columns) if per_fold else values)
