"""Time-invariant features and the earlier flat model table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions import columns as C
from cohortline.roles import DEFAULT, Roles

# Output prefix -> date column whose age at that date is reported.
ENTRY_DATES = {
    "age_first_entered_district": "date_first_entered_district",
    "age_entered_into_us": "date_entered_into_us",
}


def race_flags(race: Column | str = "race", ethnicity: Column | str = "race_ethnicity") -> dict[str, Column]:
    """More than one race ever reported; 'H' among the codes of either column."""
    return {
        "race_2more": C.has_text(race, "_"),
        "race_is_hispanic": C.has_text(race, "H"),
        "race_ethnicity_is_hispanic": C.has_text(ethnicity, "H"),
    }


def static_features(cohorts: DataFrame, fixed: DataFrame, person: DataFrame, roles: Roles = DEFAULT,
                    person_id: str = "id", entry_dates: Mapping[str, str] = ENTRY_DATES) -> DataFrame:
    """One row per cohort member: demographics, ages, language and race features.

    The three tables join on the unit alone, so one hash partitioning of each
    serves both joins."""
    profile = fixed.select(
        F.col(person_id).alias(roles.unit), "gender", F.col("race_original").alias("race"), "race_ethnicity",
        "home_language_code", "special_ed_ever",
    )
    dates = person.select(F.col(person_id).alias(roles.unit), "date_of_birth", *entry_dates.values())
    members = cohorts.where(F.col(roles.cohort).isNotNull())
    joined = members.join(profile, roles.unit, "left").join(dates, roles.unit, "left")
    ages = []
    for name, column in entry_dates.items():
        months, days = C.age_parts(column, "date_of_birth")
        ages += [months.alias(f"{name}_months"), days.alias(f"{name}_days")]
    older = C.relative_age(roles.cohort, "date_of_birth")
    derived = {
        "rel_age_to_cohort": older,
        "rel_age_to_cohort_1to3_years_older": C.flag(older.between(1, 3)),
        **C.language_columns("home_language_code"),
        **race_flags(),
    }
    return joined.select(
        roles.unit, roles.cohort, "date_of_birth", "gender", "race", "race_ethnicity", "home_language_code",
        "special_ed_ever", *ages, *[c.alias(n) for n, c in derived.items()],
    )


def relative_age_to_grade9(first_grade: DataFrame, person: DataFrame, roles: Roles = DEFAULT,
                           person_id: str = "id", first_col: str = "first_enroll_grade_9") -> DataFrame:
    """Relative age measured from the first grade-9 year with a nominal age of 16 years."""
    births = person.select(F.col(person_id).alias(roles.unit), "date_of_birth")
    return first_grade.join(births, roles.unit, "left").select(
        roles.unit, first_col, C.relative_age(first_col, "date_of_birth", expected=192).alias("rel_age_to_cohort")
    )


def first_model_table(first_grade: DataFrame, composite: DataFrame, person: DataFrame, outcome: DataFrame,
                      roles: Roles = DEFAULT, person_id: str = "id",
                      entry_dates: Mapping[str, str] = ENTRY_DATES) -> DataFrame:
    """Earlier flat model table: first grade-9 year, composite test score,
    demographics, ages in days, withdrawal code. Repeated records fan out."""
    scores = composite.select(
        F.col(roles.unit).alias("act_id"), F.col(roles.year).alias("act_year"), F.col("name").alias("act_subject"),
        F.col("score").alias("act_score"),
    )
    codes = outcome.select(F.col(roles.unit).alias("o_id"), "withdraw_code")
    people = person.join(codes, F.col("o_id") == F.col(person_id), "left").select(
        F.col(person_id), "gender", "race", "home_language_code", "date_of_birth",
        *[F.datediff(F.col(c), F.col("date_of_birth")).alias(n.replace("age_", "age_in_days_", 1))
          for n, c in entry_dates.items()],
        "withdraw_code",
    )
    return first_grade.join(scores, F.col(roles.unit) == F.col("act_id"), "left").join(
        people, F.col(roles.unit) == F.col(person_id), "left"
    )


def absence_by_offset(first_grade: DataFrame, attendance: DataFrame, roles: Roles = DEFAULT,
                      first_col: str = "first_enroll_grade_9", column: str = "unexcused_absence",
                      first: int = 9, offsets: range = range(2)) -> DataFrame:
    """Absences of a unit's first grade-9 year and the years after it, one column each.

    One join and one aggregation for all offsets."""
    per_year = attendance.groupBy(roles.unit, roles.year).agg(F.max(column).alias("days"))
    offset = F.col(roles.year) - F.col(first_col)
    near = per_year.join(first_grade, roles.unit).where(offset.between(offsets[0], offsets[-1]))
    wide = near.groupBy(roles.unit).agg(
        *[F.max(F.when(offset == k, F.col("days"))).alias(f"{column}_grade_{first + k}") for k in offsets]
    )
    return first_grade.join(wide, roles.unit, "left")
