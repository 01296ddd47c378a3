"""One row per unit for modelling, from feature tables or from raw tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.operators import yearly as Y
from cohortline.operators.reshape import (
    dedup_last,
    extract_features,
    extract_instances,
    fit_vocabulary,
    labelled,
    string_columns,
)
from cohortline.plans.session import apply_settings
from cohortline.roles import DEFAULT, Roles
from cohortline.sources.tables import cached, load_district


def latest_yearly_features(cby: DataFrame, attendance: DataFrame, incidents: DataFrame, taken: DataFrame,
                           catalog: DataFrame, enrollment: DataFrame, schools: DataFrame, roles: Roles = DEFAULT,
                           school_col: str = "current_school_id", **options) -> DataFrame:
    """Yearly features of the latest record per (unit, step) only.

    The same rows as building all yearly features and then keeping the last per
    step (ties: smallest absences, then smallest school), but every input is made
    unique before it is joined, so repeated records never multiply."""
    latest = dedup_last(cby, [roles.unit, roles.time], [roles.year])
    absent = dedup_last(attendance, [roles.unit, roles.year], [], list(Y.ABSENCES))
    attended = enrollment.groupBy(roles.unit, roles.year).agg(F.min(school_col).alias(school_col))
    return Y.yearly_features(latest, absent, incidents, taken, catalog, attended, schools, roles, unique=True, **options)


def build_dataset(static: DataFrame, yearly: DataFrame, labels: DataFrame, times: Sequence[int],
                  roles: Roles = DEFAULT, dropped: Sequence[str] = (), ties: Sequence[str] = (),
                  columns_to_dummy: Sequence[str] | None = None,
                  vocabulary: Mapping[str, Sequence[str]] | None = None, unique: bool = False,
                  sparse: bool = False) -> DataFrame:
    """Features and label of every unit with a known outcome.

    `dropped` names static columns (dates, ages) that are no features. `sparse` keeps the categories as positions of ones, so that
    no category value becomes a column or reaches the driver."""
    features = extract_features(
        static.drop(*dropped), yearly, times, roles, ties, columns_to_dummy, vocabulary, unique, sparse
    )
    return extract_instances(features, labelled(labels, roles), roles)


def dataset_vocabulary(static: DataFrame, yearly: DataFrame, times: Sequence[int], roles: Roles = DEFAULT,
                       dropped: Sequence[str] = (), ties: Sequence[str] = (), unique: bool = False) -> dict[str, list[str]]:
    """Category values of the merged features, found on the long tables: the values
    of a yearly column at a step are the categories of that step's column."""
    latest = yearly if unique else dedup_last(yearly, [roles.unit, roles.time], [roles.year], ties)
    text = string_columns(yearly.drop(roles.unit, roles.time))
    found: dict[str, list[str]] = {f"{roles.time}_{t}_{c}": [] for c in text for t in times}
    if text:
        pair = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in text]))
        values = latest.where(F.col(roles.time).isin(list(times))).select(F.col(roles.time).alias("t"), pair.alias("p"))
        rows = values.select("t", "p.c", "p.v").where("v is not null").distinct().collect()  # they become column names
        for t, c, v in sorted(map(tuple, rows)):
            found[f"{roles.time}_{t}_{c}"].append(v)
    return {**fit_vocabulary(static.drop(roles.unit, *dropped)), **found}


def observed_steps(yearly: DataFrame, roles: Roles = DEFAULT) -> list[int]:
    """Distinct steps of the yearly table; they become column names."""
    return sorted(r[0] for r in yearly.select(roles.time).where(F.col(roles.time).isNotNull()).distinct().collect())


def fetch_data(spark: SparkSession, district: str, root: str | None = None, jdbc: Mapping[str, str] | None = None,
               cache: str | None = None, times: Sequence[int] | None = None, roles: Roles = DEFAULT,
               dropped: Sequence[str] = (), ties: Sequence[str] = (),
               sparse: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """(dataset, feature catalog) of a district's materialised feature tables.

    With `cache` the dataset is written there on the first call and read
    afterwards. Steps not given are those the yearly table shows."""
    tables = load_district(apply_settings(spark), district, root, jdbc)

    def build() -> DataFrame:
        steps = observed_steps(tables.yearly, roles) if times is None else times
        vocabulary = None if sparse else dataset_vocabulary(tables.static, tables.yearly, steps, roles, dropped, ties)
        return build_dataset(
            tables.static, tables.yearly, tables.label, steps, roles, dropped, ties, vocabulary=vocabulary, sparse=sparse)

    return (build() if cache is None else cached(spark, cache, build)), tables.catalog
