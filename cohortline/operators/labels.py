"""Graduation records and outcome labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions import columns as C
from cohortline.operators.cohort import last_enrollment, last_withdrawal
from cohortline.roles import DEFAULT, Roles

# The spellings of a regular grade-12 graduation.
REGULAR_GRADUATION = ("12 Grade Regular Program Graduate", "12th Grade Regular Program", "1")


def grad_label(cohorts: DataFrame, graduates: DataFrame, roles: Roles = DEFAULT,
               classes: Sequence[str] = REGULAR_GRADUATION) -> DataFrame:
    """Distinct regular graduations per cohort member; null year without one."""
    regular = (
        graduates.where(F.col("classification").isin(list(classes)))
        .select(roles.unit, roles.year, "classification")
        .distinct()
    )
    members = cohorts.where(F.col(roles.cohort).isNotNull()).select(roles.unit, roles.cohort).distinct()
    return members.join(regular, roles.unit, "left").select(roles.unit, roles.cohort, roles.year, "classification")


def _with_outcome(graduation: DataFrame, outcome: DataFrame, roles: Roles, date: str) -> DataFrame:
    left = F.col("withdrawn_id").isNotNull()
    withdrawn = outcome.select(F.col(roles.unit).alias("withdrawn_id"), F.col(date).alias("withdraw_date"))
    return graduation.join(withdrawn, F.col(roles.unit) == F.col("withdrawn_id"), "left").select(
        "*", (F.col(roles.year) + 1 - F.col(roles.cohort)).alias("delay"), left.alias("left_early")
    )


def label(graduation: DataFrame, outcome: DataFrame, roles: Roles = DEFAULT, date: str = "withdraw_date",
          year_shift_days: int = 184) -> DataFrame:
    """Outcome flags per graduation and withdrawal record.

    `outcome_label` is 1 for any withdrawal, 0 for an early or on-time
    graduation, else null."""
    delay, left_early = F.col("delay"), F.col("left_early")
    ended = C.outcome_year("withdraw_date", year_shift_days)
    cohort_year = F.col(roles.cohort)
    return _with_outcome(graduation, outcome, roles, date).select(
        roles.unit,
        roles.cohort,
        C.flag(delay < 0).alias("grad_early"),
        C.flag(delay == 0).alias("grad_on_time"),
        C.flag(delay == 1).alias("grad_late_1year"),
        C.flag(delay > 1).alias("grad_late_2plusyears"),
        C.flag(delay >= 1).alias("grad_not_on_time"),
        C.flag(left_early & (ended <= cohort_year)).alias("dropout_hs"),
        C.flag(left_early & (ended > cohort_year)).alias("dropout_late"),
        C.flag(left_early).alias("dropout_ever"),
        C.flag(F.col(roles.year).isNull() & F.col("withdraw_date").isNull()).alias("no_record_found"),
        F.when(left_early, F.lit(1)).when(delay <= 0, F.lit(0)).alias("outcome_label"),
    )


def label_12regular(graduation: DataFrame, outcome: DataFrame, roles: Roles = DEFAULT,
                    date: str = "withdraw_date") -> DataFrame:
    """Five-flag variant: on time (or early), late by one or more years, dropout, no record."""
    delay = F.col("delay")
    return _with_outcome(graduation, outcome, roles, date).select(
        roles.unit,
        roles.cohort,
        C.flag(delay <= 0).alias("on_time_grad"),
        C.flag(delay == 1).alias("late_grad_1year"),
        C.flag(delay > 1).alias("late_grad_2ormoreyears"),
        C.flag(F.col("left_early")).alias("ever_dropout"),
        C.flag(F.col(roles.year).isNull() & F.col("withdraw_date").isNull()).alias("no_record_found"),
    )


def labels2(cohorts: DataFrame, enrollment: DataFrame, outcome: DataFrame, roles: Roles = DEFAULT,
            date: str = "withdraw_date") -> DataFrame:
    """Earlier labels from the last active year, the last withdrawal year and the cohort."""
    seen = last_enrollment(enrollment, roles).select(roles.unit, F.col(roles.year).alias("y"))
    gone = last_withdrawal(outcome, roles, date).select(
        roles.unit, F.year(date).alias("w"), F.lit(True).alias("withdrew")
    )
    y, w, c = F.col("y"), F.col("w"), F.col(roles.cohort)
    return cohorts.join(seen, roles.unit, "left").join(gone, roles.unit, "left").select(
        roles.unit,
        C.flag(y > c).alias("s_spring_enrollment"),
        C.flag(y >= c).alias("late_enrollment"),
        C.flag((y >= c) & (w >= y)).alias("late_dropout"),
        C.flag((y <= w) & (w <= c)).alias("hs_dropout"),
        C.flag(C.is_true("withdrew")).alias("ever_dropout"),
        C.flag((w < y) & (y < c)).alias("grad_and_dropout"),
        C.flag((w < y) | (y > c)).alias("not_grad_ontime"),
    )
