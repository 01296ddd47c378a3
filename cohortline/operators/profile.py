"""Data-profile queries over the raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions import columns as C
from cohortline.operators.cohort import HIGH_SCHOOL
from cohortline.roles import DEFAULT, Roles


def value_counts(df: DataFrame, *keys: str, counted: str | None = None) -> DataFrame:
    """Rows per key; with `counted`, rows in which that column is not null."""
    return df.groupBy(*keys).agg(F.count(F.col(counted) if counted else F.lit(1)).alias("n"))


def distinct_values(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct key combinations."""
    return df.select(*keys).distinct()


def distinct_sketches(df: DataFrame, counted: str, *keys: str, precision: int = 14) -> DataFrame:
    """A HyperLogLog sketch of the values of a column per key (null keys are a key). Sketches are of a bounded size, whatever the number of
    values, and merge: kept per finest key, they give the distinct counts of any coarser one without the data."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(counted), precision).alias("sketch"))


def merged_distinct(sketches: DataFrame, *keys: str) -> DataFrame:
    """Estimated distinct values per coarser key, from sketches; the standard error is about 1.04 / 2 ** (precision / 2) and less."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def status_totals(enrollment: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Records and units by what their status text contains, and how many distinct
    withdrawal codes occur. One pass per unit, no distinct expansion for the units."""
    s = F.col("current_status")
    per_unit = enrollment.groupBy(roles.unit).agg(
        F.count_if(s.contains("W")).alias("w"),
        F.count_if(s.contains("0") & s.contains("2")).alias("both"),
        F.max(C.flag(s.contains("2"))).alias("two"),
        F.max(C.flag(s.contains("0"))).alias("zero"),
    )
    unit_known = F.col(roles.unit).isNotNull()
    return per_unit.agg(
        F.coalesce(F.sum("w"), F.lit(0)).alias("records_with_w"),
        F.coalesce(F.sum(F.when(unit_known, F.col("both"))), F.lit(0)).alias("records_with_0_and_2"),
        F.count_if(unit_known & (F.col("two") == 1)).alias("units_with_2"),
        F.count_if(unit_known & (F.col("zero") == 1)).alias("units_with_0"),
    )


def null_cohorts(cohorts: DataFrame, unit: str = "id", roles: Roles = DEFAULT) -> DataFrame:
    """Units without a cohort."""
    return cohorts.where(F.col(roles.cohort).isNull()).select(unit).distinct()


def school_records(enrollment: DataFrame, school_ids: Sequence[int], roles: Roles = DEFAULT) -> DataFrame:
    """Active records at the given (placeholder) schools."""
    return enrollment.where(F.col("current_school_id").isin(list(school_ids)) & C.is_true("active_status")).select(
        "current_school_id", "current_grade_level", "active_status", roles.year, "withdraw_code"
    )


def years_in_high_school(enrollment: DataFrame, cohorts: DataFrame, roles: Roles = DEFAULT,
                         excluded_schools: Sequence[int] = (997, 998), grades: range = range(9, 14),
                         with_years: bool = True) -> DataFrame:
    """Active high-school records by cohort, year, grade and years spent in high school.

    Records are counted per unit, year and grade before the cohort is joined."""
    keys = [roles.unit, roles.year, roles.time, "current_grade_level"]
    counts = (
        enrollment.where(
            ~F.col("current_school_id").isin(list(excluded_schools))
            & C.is_true("active_status")
            & F.col(roles.time).between(grades[0], grades[-1])
        )
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    joined = counts.join(cohorts.select(roles.unit, roles.cohort), roles.unit, "left")
    out = [roles.cohort, *keys[1:]]
    if with_years:
        joined = joined.withColumn("years_spent_inhs", F.col(roles.year) - F.col(roles.cohort) + 5)
        out.append("years_spent_inhs")
    known = F.when(F.col(roles.cohort).isNotNull(), F.col("rows")).otherwise(0)
    return joined.groupBy(*out).agg(F.sum(known).alias("n"))


def grade_repeats(enrollment: DataFrame, roles: Roles = DEFAULT, current: str = "current_grade_level") -> DataFrame:
    """Records whose next grade equals the current one, as recorded."""
    return enrollment.where(F.col(current) == F.col("next_grade")).groupBy(
        roles.year, F.col(current).alias("current_grade"), "next_grade"
    ).agg(F.count(F.lit(1)).alias("n"))


def promotions(enrollment: DataFrame, roles: Roles = DEFAULT, current: str = "current_grade_level") -> DataFrame:
    """Records per year whose next grade sorts after the current one, as recorded text."""
    return enrollment.where(F.col(current) < F.col("next_grade")).groupBy(roles.year).agg(
        F.count(F.lit(1)).alias("n")
    )


def grade_moves(enrollment: DataFrame, schools: DataFrame, roles: Roles = DEFAULT, name_part: str = "HS") -> DataFrame:
    """Per high school and year: units, and non-null counts of grade comparisons.

    `count` of a comparison counts the rows in which it is known, true or false;
    the `_true` columns beside it count the rows in which it holds. Schools
    without any record keep a row with an unknown year."""
    cur, last, nxt = F.col("current_grade_level"), F.col("last_grade_level"), F.col("next_grade")
    tests = {
        "currentgrade_sameas_lastgrade": cur == last,
        "currentgrade_diff_from_lastgrade": cur != last,
        "currentgrade_sameas_nextgrade": cur == nxt,
    }
    counters = {
        "active_status": F.count("active_status"),
        **{n: F.count(t) for n, t in tests.items()},
        **{f"{n}_true": F.count_if(t) for n, t in tests.items()},
        "round_track_flag": F.count("current_year_round_track"),
    }
    high = schools.where(F.col("name").contains(name_part)).select("id", "name")
    per_unit = enrollment.groupBy(F.col("current_school_id").alias("sid"), roles.year, roles.unit).agg(
        *[c.alias(n) for n, c in counters.items()]
    )
    found = (
        per_unit.join(high, F.col("sid") == F.col("id"))
        .groupBy("name", roles.year)
        .agg(F.countDistinct(roles.unit).alias("number_of_enrollments"), *[F.sum(n).alias(n) for n in counters])
    )
    used = per_unit.select("sid").distinct()
    empty = high.join(used, F.col("id") == F.col("sid"), "left_anti").select("name").distinct().select(
        "name", F.lit(None).cast(found.schema[roles.year].dataType).alias(roles.year),
        *[F.lit(0).cast("bigint").alias(n) for n in ("number_of_enrollments", *counters)],
    )
    return found.unionByName(empty)


def schools_by_year(enrollment: DataFrame, schools: DataFrame, roles: Roles = DEFAULT, name_part: str = "HS") -> DataFrame:
    """High schools with the years in which they have records."""
    active = enrollment.select(F.col("current_school_id").alias("sid"), roles.year).distinct()
    return schools.where(F.col("name").contains(name_part)).join(
        active, F.col("id") == F.col("sid"), "left"
    ).select("id", "name", roles.year).distinct()


def enrollment_schools(enrollment: DataFrame, schools: DataFrame, roles: Roles = DEFAULT,
                       units: Sequence[int] | None = None) -> DataFrame:
    """Enrollment records with school name and normalised grades, for all or some units."""
    rows = enrollment if units is None else enrollment.where(F.col(roles.unit).isin(list(units)))
    return rows.join(schools.select("id", F.col("name").alias("school_name")),
                     F.col("current_school_id") == F.col("id"), "left").select(
        roles.unit, "school_name", roles.year, "active_status",
        F.col("last_grade_level").try_cast("int").alias("last_grade"),
        C.grade_value(roles.time).alias("current_grade"),
        F.col("next_grade").try_cast("int").alias("next_grade"),
    )


def unit_enrollment(enrollment: DataFrame, roles: Roles = DEFAULT, grades: range = HIGH_SCHOOL) -> DataFrame:
    """Per unit: years in high school, schools attended and records there."""
    seen = enrollment.where(C.in_grades(grades, roles.time)).groupBy(
        roles.unit, roles.year, "current_school_id"
    ).agg(F.count(F.lit(1)).alias("rows"))
    return seen.groupBy(roles.unit).agg(
        F.countDistinct(roles.year).alias("hs_years_in_district"),
        F.countDistinct("current_school_id").alias("number_of_schools"),
        F.sum("rows").alias("number_of_enrollments"),
    )


SUMMARY = ("hs_years_in_district", "number_of_schools", "number_of_enrollments")


def enrollment_summary(enrollment: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Units per combination of years, schools and records."""
    return unit_enrollment(enrollment, roles).groupBy(*SUMMARY).agg(F.count(roles.unit).alias("n_units"))


def enrollment_summary_by_year(enrollment: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Units per year and combination of years, schools and records."""
    years = enrollment.select(roles.unit, roles.year).distinct()
    return years.join(unit_enrollment(enrollment, roles), roles.unit, "left").groupBy(roles.year, *SUMMARY).agg(
        F.count(roles.unit).alias("n_units")
    )
