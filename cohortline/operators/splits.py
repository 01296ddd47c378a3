"""Temporal splits, feature selection and sweep grids."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.roles import DEFAULT, Roles

LAST_GRADE = 12
# Categories that never form a feature set of their own.
SKIPPED_CATEGORIES = ("id", "attendance", "coursework", "demographic", "school")


def _years(values: Iterable[int] | None, cohorts: Column) -> Column:
    return cohorts if values is None else F.array(*[F.lit(v) for v in values])


def temporal_splits(data: DataFrame, grades: Sequence[int] = tuple(range(6, 12)), roles: Roles = DEFAULT,
                    train_cohorts: Sequence[int] | None = None, test_cohorts: Sequence[int] | None = None,
                    knowledge_date: bool = True, last_grade: int = LAST_GRADE, train_only_latest: bool = False,
                    test_only_latest: bool = False) -> DataFrame:
    """Pairs (grade, train, test) of cohort years with train before test.

    With `knowledge_date`, outcomes of the train cohort must be known when the
    test cohort is in the given grade. The pairs unfold from one row that holds
    the distinct cohort years."""
    years = data.agg(F.sort_array(F.collect_set(roles.cohort)).alias("years"))
    unfolded = (
        years.select("years", F.explode(_years(train_cohorts, F.col("years"))).alias("train"))
        .select("years", "train", F.explode(_years(test_cohorts, F.col("years"))).alias("test"))
        .select("years", "train", "test", F.explode(F.array(*[F.lit(g) for g in grades])).alias("grade"))
    )
    bound = F.col("test") - (F.lit(last_grade) - F.col("grade"))
    keep = F.col("train") < F.col("test")
    if knowledge_date:
        keep = keep & (F.col("train") <= bound)
    if train_only_latest:
        keep = keep & (F.col("train") == bound)
    if test_only_latest:
        keep = keep & (F.col("test") == F.element_at("years", -1))
    return unfolded.where(keep).select("grade", "train", "test")


def fold_of(cohort: Column | str, train: Column | int, test: Column | int) -> Column:
    """'train' up to the train cohort, 'test' from the test cohort on, null between."""
    c = F.col(cohort) if isinstance(cohort, str) else cohort
    return F.when(c >= test, "test").when(c <= train, "train")


def one_row(**frames: DataFrame) -> DataFrame:
    """Single-row frames with one column each, side by side in a single row.

    A union and an aggregation, so no join is needed."""
    types = {n: df.schema[n].dataType for n, df in frames.items()}
    parts = [
        df.select(*[F.col(m) if m == n else F.lit(None).cast(t).alias(m) for m, t in types.items()])
        for n, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts).agg(*[F.first(n, ignorenulls=True).alias(n) for n in types])


def cohort_folds(data: DataFrame, splits: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """(cohort, grade, train, test, fold): what each cohort year is in each split.

    Both inputs are calendar-sized, so the table is too; data rows then meet
    their splits through an equality join on the cohort year."""
    packed = splits.agg(F.collect_list(F.struct("grade", "train", "test")).alias("all"))
    years = data.agg(F.collect_set(roles.cohort).alias("years"))
    return (
        one_row(years=years, all=packed)
        .select(F.explode("years").alias(roles.cohort), "all")
        .select(roles.cohort, F.explode("all").alias("s"))
        .select(roles.cohort, "s.grade", "s.train", "s.test",
                fold_of(roles.cohort, F.col("s.train"), F.col("s.test")).alias("fold"))
        .where("fold is not null")
    )


def split_membership(data: DataFrame, splits: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Fold of every unit in every split; units between the folds are left out."""
    return data.select(roles.unit, roles.cohort).join(cohort_folds(data, splits, roles), roles.cohort)


def split_class_counts(data: DataFrame, splits: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Rows per split, fold and label, counted per cohort before the splits are joined."""
    counts = data.groupBy(roles.cohort, roles.label).agg(F.count(F.lit(1)).alias("rows"))
    return (
        counts.join(cohort_folds(data, splits, roles), roles.cohort)
        .groupBy("grade", "train", "test", "fold", roles.label)
        .agg(F.sum("rows").alias("n"))
    )


def usable_splits(data: DataFrame, splits: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Splits with both folds non-empty and two classes to learn from."""
    return (
        split_class_counts(data, splits, roles)
        .groupBy("grade", "train", "test")
        .agg(F.countDistinct(F.when(F.col("fold") == "train", F.col(roles.label))).alias("classes"),
             F.count_if(F.col("fold") == "test").alias("tested"))
        .where("classes >= 2 and tested > 0")
        .select("grade", "train", "test")
    )


# -- features known at a grade, and feature sets ------------------------------

def features_asof(columns: Sequence[str], grade: int, roles: Roles = DEFAULT, last_grade: int = LAST_GRADE) -> list[str]:
    """Columns that do not describe a step after `grade`."""
    later = re.compile(rf"{re.escape(roles.time)}_({'|'.join(str(g) for g in range(grade + 1, last_grade + 1))})_")
    return list(columns) if grade >= last_grade else [c for c in columns if not later.match(c)]


def belongs_to(column: str, feature: str, roles: Roles = DEFAULT) -> bool:
    """The column is the feature itself, its value at a step, or one of its category columns."""
    base = re.sub(rf"^{re.escape(roles.time)}_\d+_", "", column)
    return base == feature or base.startswith(f"{feature}_")


def feature_sets(catalog: DataFrame, skipped: Sequence[str] = SKIPPED_CATEGORIES) -> DataFrame:
    """(feature_set, category) rows: every category alone, all but one, and all.

    The set name lists its categories; 'all' stands for every feature and has no
    category rows. Unfolds from one row that holds the distinct categories."""
    kept = catalog.where(~F.col("feature_category_primary").isin(list(skipped)))
    names = kept.agg(F.sort_array(F.collect_set("feature_category_primary")).alias("names"))
    members = F.array_union(
        F.array_union(
            F.transform("names", lambda x: F.array(x)),
            F.transform("names", lambda x: F.array_remove("names", x)),
        ),
        F.array(F.col("names")),
    )
    return (
        names.select(F.explode(members).alias("set"))
        .where(F.size("set") > 0)
        .select(F.concat_ws(", ", "set").alias("feature_set"), F.explode("set").alias("category"))
        .distinct()
    )


def feature_set_columns(catalog_rows: Sequence, columns: Sequence[str], categories: Sequence[str],
                        roles: Roles = DEFAULT) -> list[str]:
    """Columns of the features in the categories, excluded features left out.

    'all' takes every column that does not belong to an excluded feature.
    A column belongs to the longest feature name that matches it."""
    def owner(column: str):
        hits = [r for r in catalog_rows if belongs_to(column, r["feature_name"], roles)]
        return max(hits, key=lambda r: len(r["feature_name"]), default=None)

    out = []
    for c in columns:
        r = owner(c)
        if r is None:
            if list(categories) == ["all"]:
                out.append(c)
        elif r["exclude_when_modeling"] == 0 and (
            list(categories) == ["all"] or r["feature_category_primary"] in categories
        ):
            out.append(c)
    return out
