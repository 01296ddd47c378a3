"""Column roles shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    """Names of the columns that identify a row.

    unit    the instance (one person)
    year    the calendar period of a record
    time    the time step features are pivoted by
    cohort  the group used for temporal train/test splits
    label   the outcome column of the assembled dataset
    """

    unit: str = "student_id"
    year: str = "academic_year"
    time: str = "grade_level"
    cohort: str = "cohort"
    label: str = "label"


DEFAULT = Roles()
