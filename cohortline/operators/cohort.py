"""Cohort assignment and the unit-by-year table.

Per-unit choices are aggregations rather than windows wherever possible: the
partial aggregate leaves one row per unit and task, so a unit that owns a large
share of all records is already reduced before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.functions import columns as C
from cohortline.roles import DEFAULT, Roles

HIGH_SCHOOL = range(9, 13)
ALL_GRADES = range(1, 13)
TRANSFER_OUT = "2"
LAST_GRADE = 12


def grade_normalised(enrollment: DataFrame, roles: Roles = DEFAULT, grades: range = HIGH_SCHOOL,
                     code: str = "current_grade_level") -> DataFrame:
    """Enrollment records of the given grades with one numeric `grade`.

    A record passes when its text code OR its numeric level is in range, so a
    level outside the range can survive through its code."""
    return enrollment.where(C.in_grades(grades, roles.time, code)).select(
        roles.unit,
        roles.year,
        C.grade_value(roles.time, code).alias("grade"),
        "active_status",
        "current_status",
    )


#: Stands for an unknown year: after all others, which lie within 2**29 of zero. A year that doesn't fit overflows, which is an error.
NO_YEAR = 2**29
#: Grades are 32-bit numbers; their offset makes room for unknown ones below all others.
GRADE_OFFSET, GRADE_SPAN = 2**31 + 1, 2**33


def _packed(year: Column, grade: Column) -> Column:
    """Year and grade (32-bit numbers) as one number that sorts by year (unknown last), then grade (unknown first). A number keeps the
    minimum per unit in hash aggregation, where a struct would sort all records; 33 bits hold any grade."""
    return F.coalesce(year.cast("bigint"), F.lit(NO_YEAR)) * F.lit(GRADE_SPAN) + F.coalesce(
        grade.cast("int").cast("bigint") + F.lit(GRADE_OFFSET), F.lit(0))


def _unpacked(name: str, year_type: T.DataType) -> tuple[Column, Column]:
    grade = F.pmod(F.col(name), F.lit(GRADE_SPAN))
    year = F.expr(f"({name} - pmod({name}, {GRADE_SPAN}L)) div {GRADE_SPAN}L")
    return F.nullif(year, F.lit(NO_YEAR)).cast(year_type), (F.nullif(grade, F.lit(0)) - F.lit(GRADE_OFFSET)).cast("int")


def first_enrollment(enrollment: DataFrame, roles: Roles = DEFAULT, grades: range = HIGH_SCHOOL) -> DataFrame:
    """Earliest active record per unit: year ascending (nulls last), then grade."""
    records = grade_normalised(enrollment, roles, grades).where(C.is_true("active_status"))
    first = _packed(F.col(roles.year), F.col("grade"))
    year, grade = _unpacked("first", records.schema[roles.year].dataType)
    return (
        records.where(F.col(roles.unit).isNotNull())
        .groupBy(roles.unit)
        .agg(F.min(first).alias("first"))
        .select(roles.unit, year.alias("first_academic_year"), grade.alias("first_grade"))
    )


def _later_transfer(first: DataFrame, transfers: DataFrame, unit: str):
    return (
        (first[unit] == transfers["t_unit"])
        & (transfers["yr"] >= first["first_academic_year"])
        & (transfers["gr"] >= first["first_grade"])
    )


def transfer_out(enrollment: DataFrame, roles: Roles = DEFAULT, grades: range = HIGH_SCHOOL,
                 status: str = TRANSFER_OUT) -> DataFrame:
    """Each unit's first record joined with its transfer-out records in the same
    or a later year and grade. One unit row meets that unit's records: the join
    has a single hash key and the range conditions as residual."""
    first = first_enrollment(enrollment, roles, grades)
    transfers = (
        grade_normalised(enrollment, roles, grades)
        .where(F.col("current_status") == status)
        .select(F.col(roles.unit).alias("t_unit"), F.col(roles.year).alias("yr"), F.col("grade").alias("gr"),
                F.col("current_status").alias("st"))
    )
    return first.join(transfers, _later_transfer(first, transfers, roles.unit)).drop("t_unit")


def cohort(enrollment: DataFrame, roles: Roles = DEFAULT, grades: range = HIGH_SCHOOL,
           status: str = TRANSFER_OUT, last_grade: int = LAST_GRADE) -> DataFrame:
    """Expected graduation year per unit, units that later transferred out removed.

    Only the latest transfer year per (unit, grade) can decide the anti join, so
    the transfer side is aggregated to that before it is shuffled."""
    first = first_enrollment(enrollment, roles, grades)
    transfers = (
        grade_normalised(enrollment, roles, grades)
        .where(F.col("current_status") == status)
        .groupBy(F.col(roles.unit).alias("t_unit"), F.col("grade").alias("gr"))
        .agg(F.max(roles.year).alias("yr"))
    )
    return first.join(transfers, _later_transfer(first, transfers, roles.unit), "left_anti").select(
        roles.unit,
        (F.col("first_academic_year") - F.col("first_grade") + last_grade + 1).alias(roles.cohort),
    )


def enrollment_rn_ct(enrollment: DataFrame, roles: Roles = DEFAULT, grades: range = HIGH_SCHOOL,
                     code: str = "current_grade_level") -> DataFrame:
    """First active record by grade code per unit with the unit's record count."""
    records = enrollment.where(F.col(code).isin(C.grade_codes(grades)) & C.is_true("active_status"))
    grade = F.col(code).try_cast("int")
    year, first_grade = _unpacked("first", enrollment.schema[roles.year].dataType)
    return (
        records.groupBy(roles.unit)
        .agg(F.min(_packed(F.col(roles.year), grade)).alias("first"), F.count(F.lit(1)).alias("ct"))
        .select(roles.unit, year.alias(roles.year), first_grade.alias("current_grade"), "ct")
    )


def cohort_all_units(person: DataFrame, enrollment: DataFrame, roles: Roles = DEFAULT, person_id: str = "id",
                     grades: range = HIGH_SCHOOL, last_grade: int = LAST_GRADE) -> DataFrame:
    """Earlier cohort rule: every person, null cohort without a matching record,
    transfers kept."""
    first = enrollment_rn_ct(enrollment, roles, grades)
    return person.select(F.col(person_id).alias("p_id")).join(
        first, F.col("p_id") == F.col(roles.unit), "left"
    ).select(
        F.col("p_id").alias("id"),
        (F.col(roles.year) + last_grade + 1 - F.col("current_grade")).alias(roles.cohort),
    )


def cohort_by_year(enrollment: DataFrame, cohorts: DataFrame, roles: Roles = DEFAULT,
                   grades: range = ALL_GRADES, code: str = "current_grade_level", unique: bool = False,
                   distinct: bool = False) -> DataFrame:
    """Active enrollment records of units that have a cohort.

    Several records in one year all stay by default, as the yearly tables fan out
    with them. `distinct=True` keeps equal rows once and `unique=True` one row
    per (unit, year), with the highest grade; both reduce the records before the
    join, so a unit with very many records joins with a few."""
    records = enrollment.where(C.in_grades(grades, roles.time, code) & C.is_true("active_status")).select(
        roles.unit, roles.year, C.grade_value(roles.time, code).alias(roles.time)
    )
    if unique:
        records = records.groupBy(roles.unit, roles.year).agg(F.max(roles.time).alias(roles.time))
    elif distinct:
        records = records.distinct()
    members = cohorts.where(F.col(roles.cohort).isNotNull()).select(roles.unit, roles.cohort)
    return records.join(members, roles.unit).select(roles.unit, roles.cohort, roles.year, roles.time)


def cohort_by_year_v0(enrollment: DataFrame, cohorts: DataFrame, roles: Roles = DEFAULT,
                      cohort_id: str = "id") -> DataFrame:
    """Earlier unit-by-year rule: any numeric grade, active records only."""
    records = enrollment.where(F.col(roles.time).isNotNull() & C.is_true("active_status")).select(
        roles.unit, roles.year, roles.time
    )
    members = cohorts.where(F.col(roles.cohort).isNotNull()).select(
        F.col(cohort_id).alias(roles.unit), roles.cohort
    )
    return records.join(members, roles.unit).select(roles.unit, roles.cohort, roles.year, roles.time)


def first_grade9(enrollment: DataFrame, roles: Roles = DEFAULT, grade: int = 9) -> DataFrame:
    """First year in which a unit is recorded in the given grade."""
    return (
        enrollment.where(F.col(roles.time) == grade)
        .groupBy(roles.unit)
        .agg(F.min(roles.year).alias(f"first_enroll_grade_{grade}"))
    )


def _latest_nulls_first(column: str):
    """Last value in an order where a missing value counts as the latest."""
    return F.when(F.count_if(F.col(column).isNull()) > 0, F.lit(None)).otherwise(F.max(column))


def last_enrollment(enrollment: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Latest active year per unit (a missing year counts as latest) and record count."""
    return (
        enrollment.where(C.is_true("active_status"))
        .groupBy(roles.unit)
        .agg(_latest_nulls_first(roles.year).alias(roles.year), F.count(F.lit(1)).alias("ct"))
    )


def last_withdrawal(outcome: DataFrame, roles: Roles = DEFAULT, date: str = "withdraw_date") -> DataFrame:
    """Latest withdrawal date per unit (a missing date counts as latest) and record count."""
    return outcome.groupBy(roles.unit).agg(_latest_nulls_first(date).alias(date), F.count(F.lit(1)).alias("ct"))


def enrollment_jumps(yearly: DataFrame, roles: Roles = DEFAULT, grades: range = HIGH_SCHOOL) -> DataFrame:
    """Number of units whose grade rose by more than the years passed between two
    consecutive records.

    Repeated (unit, year, grade) rows cannot create a jump, so they are removed
    first; the window then holds at most years x grades rows per unit."""
    steps = (
        yearly.where(F.col(roles.time).between(grades[0], grades[-1]))
        .select(roles.unit, roles.year, roles.time)
        .distinct()
    )
    w = Window.partitionBy(roles.unit).orderBy(F.col(roles.year).asc_nulls_last(), F.col(roles.time).asc_nulls_last())
    jump = (F.col(roles.time) - F.lag(roles.time).over(w)) - (F.col(roles.year) - F.lag(roles.year).over(w))
    return (
        steps.select(roles.unit, jump.alias("jump"))
        .where(F.col("jump") > 0)
        .agg(F.countDistinct(roles.unit).alias("units_with_jump"))
    )
