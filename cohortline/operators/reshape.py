"""From long unit-by-time tables to one row per unit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.functions.columns import quoted, text_literal
from cohortline.operators.ranking import running_totals
from cohortline.roles import DEFAULT, Roles
from cohortline.sources.shared import durable

Vocabulary = dict[str, list[str]]
#: Column of the encoded categories in a sparse dataset.
CATEGORIES = "categories"


def dedup_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """Keep the row with the largest `order` per key; ties go to the smallest `ties`.

    Filtering row_number = 1 lets Spark keep one row per key and task before the
    shuffle, so repeated keys never gather in one task."""
    w = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in order], *[F.col(c).asc_nulls_last() for c in ties]
    )
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def pivot_by_time(df: DataFrame, times: Sequence[int], values: Sequence[str] | None = None,
                  roles: Roles = DEFAULT) -> DataFrame:
    """One row per unit with a column `<time>_<step>_<feature>` for every step and feature.

    Steps are given, so the schema is known before any data is read. Input rows
    must be unique per (unit, step)."""
    skip = {roles.unit, roles.time}
    values = [c for c in df.columns if c not in skip] if values is None else list(values)
    # A unit's records as one map: collected without sorting, and at most one record a step.
    entry = F.struct(F.col(roles.time).alias("step"), F.struct(*values).alias("record"))
    steps = df.groupBy(roles.unit).agg(
        F.map_from_entries(F.collect_list(F.when(F.col(roles.time).isin(list(times)), entry))).alias("_steps")
    ).select(roles.unit, *[F.col("_steps")[t].alias(f"_{t}") for t in times])
    return steps.selectExpr(
        quoted(roles.unit),
        *[f"`_{t}`.{quoted(v)} as {quoted(f'{roles.time}_{t}_{v}')}" for v in values for t in times],
    )


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def category_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(c, v): the distinct values of each column, without nulls."""
    pair = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]))
    return df.select(pair.alias("p")).select("p.c", "p.v").where("v is not null").distinct()


def sparse_vocabulary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(c, v, index): a number from 0 for each value of each column, in the order of column and value.

    The vocabulary is a table of any size; its numbers are running counts over ranges of it."""
    values = category_values(df, string_columns(df) if columns is None else list(columns)).withColumn("_all", F.lit(0))
    return running_totals(values, ["_all"], [F.asc("c"), F.asc("v")], {"n": F.lit(1)}).select(
        "c", "v", (F.col("n") - 1).alias("index"))


def one_hot_sparse(df: DataFrame, columns: Sequence[str] | None = None, vocabulary: DataFrame | None = None,
                   roles: Roles = DEFAULT) -> DataFrame:
    """unit, indices: the positions of the ones of a unit's encoded categories, ascending. Units must be unique; a unit
    without any value has no position, and values outside the vocabulary are left out. No number of values is too large: a row holds at most one position a column.

    A value that most units share is one small row of the vocabulary, and the units' side of its join can be split."""
    columns = string_columns(df.drop(roles.unit)) if columns is None else list(columns)
    vocabulary = sparse_vocabulary(df, columns) if vocabulary is None else vocabulary
    pairs = F.explode_outer(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]))
    long = df.select(roles.unit, pairs.alias("p")).select(roles.unit, "p.c", "p.v")
    return long.join(vocabulary, ["c", "v"], "left").groupBy(roles.unit).agg(F.sort_array(F.collect_list("index")).alias("indices"))


def blocks_of(df: DataFrame) -> dict[str, tuple[int, int]]:
    """First number and end of each encoded column's block; empty for a dense table."""
    if CATEGORIES not in df.columns:
        return {}
    return {c: (lo, hi) for c, (lo, hi) in df.schema[CATEGORIES].metadata["blocks"].items()}


def with_categories(df: DataFrame, columns: Sequence[str] | None = None, vocabulary: DataFrame | None = None,
                    roles: Roles = DEFAULT) -> DataFrame:
    """The text columns replaced by one column CATEGORIES, the positions of a unit's ones; zeros are not stored. Units must be unique,
    rows without a unit are left out.

    The values of a column have consecutive numbers. Where each block starts and ends is kept in the column's metadata, which goes
    to Parquet and back; the values themselves stay in tables."""
    columns = string_columns(df.drop(roles.unit)) if columns is None else list(columns)
    if not columns:
        none = F.array().cast("array<bigint>")
        return df.withColumn(CATEGORIES, none.alias(CATEGORIES, metadata={"blocks": {}}))
    df = durable(df)
    vocabulary = durable(sparse_vocabulary(df, columns) if vocabulary is None else vocabulary)
    found = vocabulary.groupBy("c").agg(F.min("index").alias("lo"), (F.max("index") + 1).alias("hi")).collect()  # one row a column
    blocks = {c: [0, 0] for c in columns} | {r["c"]: [r["lo"], r["hi"]] for r in found}
    ones = one_hot_sparse(df.select(roles.unit, *columns), columns, vocabulary, roles)
    return df.drop(*columns).join(ones, roles.unit).withColumn(
        CATEGORIES, F.col("indices").alias(CATEGORIES, metadata={"blocks": blocks})).drop("indices")


def block_positions(blocks: Mapping[str, tuple[int, int]], columns: Sequence[str]) -> tuple[Column, int]:
    """The positions in CATEGORIES that belong to `columns`, numbered from 0 without gaps, and how many numbers there are."""
    ranges: list[list[int]] = []
    for lo, hi in sorted(blocks[c] for c in columns):
        if ranges and ranges[-1][1] == lo:
            ranges[-1][1] = hi
        elif hi > lo:
            ranges.append([lo, hi])
    def renumbered(lo: int, hi: int, first: int) -> Column:
        return F.transform(F.filter(CATEGORIES, lambda i: (i >= lo) & (i < hi)), lambda i: i + F.lit(first - lo))

    parts, size = [], 0
    for lo, hi in ranges:
        parts.append(renumbered(lo, hi, size))
        size += hi - lo
    return (F.concat(*parts) if parts else F.array().cast("array<bigint>")), size


def fit_vocabulary(df: DataFrame, columns: Sequence[str] | None = None) -> Vocabulary:
    """Distinct values of each column, all columns in one pass.

    The values become column names, so they reach the driver. Columns with very many
    values belong in `one_hot_sparse`, which keeps them in tables."""
    columns = string_columns(df) if columns is None else list(columns)
    if not columns:
        return {}
    rows = category_values(df, columns).collect()
    vocabulary: Vocabulary = {c: [] for c in columns}
    for r in sorted((r["c"], r["v"]) for r in rows):
        vocabulary[r[0]].append(r[1])
    return vocabulary


def one_hot(df: DataFrame, vocabulary: Mapping[str, Sequence[str]] | None = None,
            columns: Sequence[str] | None = None) -> DataFrame:
    """Replace each column by 0/1 columns `<column>_<value>`; null gives all zeros."""
    vocabulary = fit_vocabulary(df, columns) if vocabulary is None else vocabulary
    kept = [quoted(c) for c in df.columns if c not in vocabulary]
    dummies = [
        f"cast({quoted(c)} <=> {text_literal(v)} as int) as {quoted(f'{c}_{v}')}" for c, vs in vocabulary.items() for v in vs
    ]
    return df.selectExpr(*kept, *dummies)


def extract_features(static: DataFrame, yearly: DataFrame, times: Sequence[int], roles: Roles = DEFAULT,
                     ties: Sequence[str] = (), columns_to_dummy: Sequence[str] | None = None,
                     vocabulary: Mapping[str, Sequence[str]] | None = None, unique: bool = False,
                     sparse: bool = False) -> DataFrame:
    """Static features merged with the pivoted yearly features, categories encoded (`sparse`: by `with_categories`).

    The latest record of a repeated step is used (`unique`: there is none, so nothing is sorted); units missing on either side
    stay, with nulls. Date columns are no categories and pass unchanged."""
    latest = yearly if unique else dedup_last(yearly, [roles.unit, roles.time], [roles.year], ties)
    wide = pivot_by_time(latest.drop(roles.cohort, roles.year), times, roles=roles)
    merged = static.join(wide, roles.unit, "full")
    return with_categories(merged, columns_to_dummy, roles=roles) if sparse else one_hot(merged, vocabulary, columns_to_dummy)


def labelled(labels: DataFrame, roles: Roles = DEFAULT, outcome: str = "outcome_label") -> DataFrame:
    """Known outcomes per unit, under the label name."""
    return labels.select(roles.unit, F.col(outcome).alias(roles.label)).dropna()


def extract_instances(features: DataFrame, labels: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Features of the units with a known outcome; the last label column is the label."""
    last = labels.columns[-1]
    return features.join(labels.withColumnRenamed(last, roles.label), roles.unit)


def feature_columns(df: DataFrame, roles: Roles = DEFAULT, dropped: Sequence[str] = (),
                    keep_cohort: bool = False) -> list[str]:
    """All columns but the identifying roles and the dropped ones; encoded columns by their own names."""
    out = {roles.unit, roles.time, roles.label, *dropped} | (set() if keep_cohort else {roles.cohort})
    names = [c for c in df.columns if c != CATEGORIES or CATEGORIES in out]
    return [c for c in [*names, *blocks_of(df)] if c not in out]
