"""Crosstab reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions import columns as C
from cohortline.operators.cohort import HIGH_SCHOOL, LAST_GRADE
from cohortline.roles import DEFAULT, Roles


def cohort_sizes(cohorts: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Members per cohort."""
    return cohorts.groupBy(roles.cohort).agg(F.count(F.lit(1)).alias("n"))


def newest_first(report: DataFrame, *keys: str) -> DataFrame:
    """A finished report by falling keys, unknown keys first. Reports are small;
    sorting is the last step and only for reading."""
    return report.orderBy(*[F.desc_nulls_first(k) for k in keys])


def continued_enrollment(cby: DataFrame, labels: DataFrame, roles: Roles = DEFAULT,
                         grades: Sequence[int] = tuple(HIGH_SCHOOL)) -> DataFrame:
    """Per cohort: label rows with an outcome, and how many belong to units seen in
    each grade and through each run of consecutive grades. Empty cells are null.

    Instead of one join per cell, units carry one flag per grade and all cells
    come from a single conditional aggregation."""
    seen = cby.where(F.col(roles.time).isin(list(grades))).groupBy(roles.unit).agg(
        *[F.max(C.flag(F.col(roles.time) == g)).alias(f"g{g}") for g in grades]
    )
    outcomes = (
        labels.where(F.col("outcome_label").isNotNull())
        .groupBy(roles.unit, roles.cohort)
        .agg(F.count(F.lit(1)).alias("rows"))
    )

    def cell(run: Sequence[int]) -> Column:
        through = F.lit(True)
        for g in run:
            through = through & (F.col(f"g{g}") == 1)
        return F.sum(F.when(through, F.col("rows")))

    cells = [cell([g]).alias(f"enrol_{g}") for g in grades]
    cells += [cell(grades[i:j + 1]).alias(f"enrol_{grades[i]}thru{grades[j]}")
              for i in range(2) for j in range(i + 1, len(grades))]
    return (
        outcomes.join(seen, roles.unit, "left")
        .groupBy(F.col(roles.cohort).alias("cohort_yr"))
        .agg(F.sum("rows").alias("total_outcome"), *cells)
    )


def only_grade(cby: DataFrame, labels: DataFrame, grade: int, later: range, count_as: str,
               roles: Roles = DEFAULT) -> DataFrame:
    """Per cohort: units seen in `grade` but in none of the `later` grades, and
    what is known about their outcome. A unit without a label row counts as not observed."""
    g = F.col(roles.time)
    stopped = (
        cby.groupBy(roles.unit, roles.cohort)
        .agg(F.max(C.flag(g == grade)).alias("here"), F.max(C.flag(g.between(later[0], later[-1]))).alias("beyond"))
        .where("here = 1 and beyond = 0")
        .select(roles.unit, F.col(roles.cohort).alias("inferred_cohort"))
    )
    outcome = labels.select(
        roles.unit, (F.col("grad_early") + F.col("grad_on_time")).alias("on_time"),
        F.col("grad_not_on_time").alias("late"), "dropout_ever", "outcome_label",
    )
    rows = stopped.join(outcome, roles.unit, "left").select(
        roles.unit, "inferred_cohort", "on_time", "late", "dropout_ever",
        C.flag(F.col("outcome_label").isNull()).alias("unseen"),
    ).distinct()
    return rows.groupBy("inferred_cohort").agg(
        F.count(F.lit(1)).alias(count_as),
        F.sum("on_time").alias("which_grad_on_time"),
        F.sum("late").alias("which_grad_not_on_time"),
        F.sum("dropout_ever").alias("which_dropout_ever"),
        F.sum("unseen").alias("outcome_not_observed"),
    )


def only_grade9(cby: DataFrame, labels: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    return only_grade(cby, labels, 9, range(10, 13), "students_with_only_grade_9_records", roles)


def only_grade10(cby: DataFrame, labels: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    return only_grade(cby, labels, 10, range(11, 13), "students_in_grade_10_but_not_11to12", roles)


def outcome_by_cohort(labels: DataFrame, cohorts: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Outcome flags summed per cohort beside the cohort size."""
    sums = {
        "grad_early": "grad_early",
        "grad_on_time": "grad_on_time",
        "grad_late_1yr": "grad_late_1year",
        "grad_late_2plyrs": "grad_late_2plusyears",
        "dropout_hs": "dropout_hs",
        "dropout_late": "dropout_late",
        "no_record": "no_record_found",
    }
    sizes = cohort_sizes(cohorts.where(F.col(roles.cohort).isNotNull()), roles).withColumnRenamed("n", "total_students")
    return labels.groupBy(roles.cohort).agg(*[F.sum(c).alias(n) for n, c in sums.items()]).join(
        sizes, roles.cohort, "left"
    )


def outcome_12regular(labels: DataFrame, cohorts: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Five-flag outcomes per cohort, shown under and sized by the preceding cohort year."""
    sums = {
        "grad_on_time": "on_time_grad",
        "grad_late_1yr": "late_grad_1year",
        "grad_late_2ormoreyrs": "late_grad_2ormoreyears",
        "ever_dropout": "ever_dropout",
        "no_record": "no_record_found",
    }
    sizes = cohort_sizes(cohorts, roles).withColumnRenamed("n", "total_students")
    return labels.groupBy((F.col(roles.cohort) - 1).alias(roles.cohort)).agg(
        *[F.sum(c).alias(n) for n, c in sums.items()]
    ).join(sizes, roles.cohort, "left")


def actual_vs_inferred(enrollment: DataFrame, cohorts: DataFrame, roles: Roles = DEFAULT,
                       grade: int = LAST_GRADE) -> DataFrame:
    """Active last-grade units per year against the size of the cohort graduating that year."""
    seniors = (
        enrollment.where(
            ((F.col("current_grade_level") == str(grade)) | (F.col(roles.time) == grade)) & C.is_true("active_status")
        )
        .groupBy(roles.year)
        .agg(F.countDistinct(roles.unit).alias(f"active_grade_{grade}_students"))
    )
    sizes = cohort_sizes(cohorts, roles).select(
        (F.col(roles.cohort) - 1).alias(roles.year), F.col("n").alias("inferred_cohort_size")
    )
    return seniors.join(sizes, roles.year, "left")


def school_by_year(enrollment: DataFrame, schools: DataFrame, roles: Roles = DEFAULT, name_part: str = "HS",
                   grades: range = HIGH_SCHOOL) -> DataFrame:
    """Data-quality counts of high-school enrollment per school name and year.

    Enrollment is counted per (school id, year) before it meets the school table:
    a school with a large share of all records is reduced map-side, and the join
    sees one row per school and year."""
    high = C.grade_codes(grades)
    previous = [f"{g:02d}" for g in (grades[0] - 1, *grades)]
    last, nxt, current = F.col("last_grade_level"), F.col("next_grade"), C.grade_value(roles.time)
    kept = enrollment.where(
        (last.isin(previous) | last.isNull())
        & C.in_grades(grades, roles.time)
        & (nxt.isin(high) | nxt.isNull())
    ).select(
        F.col("current_school_id").alias("sid"), roles.year, "active_status",
        last.try_cast("int").alias("last"), current.alias("cur"), nxt.try_cast("int").alias("nxt"),
        "current_year_round_track",
    )
    tests = {
        "num_active": C.is_true("active_status"),
        "last_grade_missing": F.col("last").isNull(),
        "next_grade_missing": F.col("nxt").isNull(),
        "currentgrade_sameas_lastgrade": F.col("cur") == F.col("last"),
        "currentgrade_diff_from_lastgrade": F.col("cur") != F.col("last"),
        "currentgrade_sameas_nextgrade": F.col("cur") == F.col("nxt"),
        "round_track_flag": F.col("current_year_round_track").isNotNull(),
    }
    per_id = kept.groupBy("sid", roles.year).agg(
        F.count(F.lit(1)).alias("num_total"), *[F.count_if(t).alias(n) for n, t in tests.items()]
    )
    names = schools.where(F.col("name").contains(name_part)).select("id", F.col("name").alias("school_name"))
    return (
        per_id.join(names, F.col("sid") == F.col("id"))
        .groupBy("school_name", roles.year)
        .agg(*[F.sum(n).alias(n) for n in ("num_total", *tests)])
    )
