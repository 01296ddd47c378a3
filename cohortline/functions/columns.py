"""Scalar expressions. All are built-in Column expressions, so they stay inside
whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> str:
    """A column name as SQL text. Selects of hundreds of columns are written as SQL
    text, which the driver builds far faster than as many Column objects."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    """A string as SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def flag(cond: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def is_true(c: ColumnLike) -> Column:
    """Null-safe truth test: null counts as not true."""
    return _c(c).eqNullSafe(F.lit(True))


def any_true(names: Iterable[str]) -> Column:
    """True when at least one of the boolean columns is true."""
    return reduce(lambda a, b: a | b, (F.coalesce(F.col(f"`{n}`"), F.lit(False)) for n in names))


# -- grades -----------------------------------------------------------------

def grade_value(level: ColumnLike = "grade_level", code: ColumnLike = "current_grade_level") -> Column:
    """Numeric grade: the numeric level, else the text code read as a number.

    Codes such as 'KI' give null rather than an ANSI cast error."""
    return F.coalesce(_c(level), _c(code).try_cast("int"))


def grade_codes(grades: Iterable[int]) -> list[str]:
    """Text spellings of a run of grades, plain and zero-padded."""
    return sorted({s for g in grades for s in (str(g), f"{g:02d}")})


def in_grades(grades: range, level: ColumnLike = "grade_level", code: ColumnLike = "current_grade_level") -> Column:
    """The text code names one of the grades OR the numeric level lies in the run."""
    return _c(code).isin(grade_codes(grades)) | _c(level).between(grades[0], grades[-1])


# -- dates ------------------------------------------------------------------

def school_year(date: ColumnLike, shift_days: int = 184) -> Column:
    """School year of a date with a July boundary: 30 June belongs to the year before."""
    return F.year(F.date_add(_c(date), shift_days)) - 1


def outcome_year(date: ColumnLike, shift_days: int = 184) -> Column:
    """Graduation-year scale of a date: the year in which its school year ends."""
    return F.year(F.date_add(_c(date), shift_days))


def october_year(date: ColumnLike, months: int = 9) -> Column:
    """School year of a date with an October boundary."""
    return F.year(F.add_months(_c(date), -months))


def age_parts(later: ColumnLike, earlier: ColumnLike) -> tuple[Column, Column]:
    """Symbolic age as (whole months, remaining days).

    A missing day count is borrowed from the month of the earlier date, and
    swapping the arguments only flips the sign."""
    a, b = _c(later), _c(earlier)
    hi, lo = F.greatest(a, b), F.least(a, b)
    both = a.isNotNull() & b.isNotNull()
    sign = F.when(a < b, F.lit(-1)).otherwise(F.lit(1))
    calendar = (F.year(hi) - F.year(lo)) * 12 + F.month(hi) - F.month(lo)
    borrow = F.dayofmonth(hi) < F.dayofmonth(lo)
    months = F.when(borrow, calendar - 1).otherwise(calendar)
    gap = F.dayofmonth(hi) - F.dayofmonth(lo)
    days = F.when(borrow, gap + F.dayofmonth(F.last_day(lo))).otherwise(gap)
    return F.when(both, sign * months), F.when(both, sign * days)


def relative_age(cohort: ColumnLike, birth: ColumnLike, after_new_year: int = 14, expected: int = 240) -> Column:
    """Years (of 365 days) by which a person is older than the cohort's nominal age.

    The reference point is `after_new_year` months past 1 January of the cohort
    year; the nominal age is `expected` months."""
    anchor = F.add_months(F.make_date(_c(cohort), F.lit(1), F.lit(1)), after_new_year)
    return F.datediff(anchor, F.add_months(_c(birth), expected)) / F.lit(365.0)


# -- strings ----------------------------------------------------------------

def separators(c: ColumnLike, sep: str = "_") -> Column:
    """Number of separators in a joined code list; null counts as none."""
    return F.coalesce(F.length(_c(c)) - F.length(F.replace(_c(c), F.lit(sep), F.lit(""))), F.lit(0))


def has_text(c: ColumnLike, *parts: str) -> Column:
    """1 when the text contains every part."""
    return flag(reduce(lambda a, b: a & b, (_c(c).contains(p) for p in parts)))


def language_columns(c: ColumnLike, prefix: str = "home_language", most: int = 6) -> dict[str, Column]:
    """`<prefix>_<n>more` flags for n = 2..most and the capped `<prefix>_count`."""
    n = separators(c)
    out = {f"{prefix}_{k}more": flag(n >= k - 1) for k in range(2, most + 1)}
    out[f"{prefix}_count"] = F.least(n, F.lit(most - 1)) + 1
    return out


# Numeric bands of the letter marks (None = no upper bound). F has
# no numeric band; a low number counts as no mark at all.
MARK_BANDS: dict[str, tuple[int, int | None] | None] = {
    "a": (90, None),
    "b": (80, 89),
    "c": (70, 79),
    "d": (60, 69),
    "f": None,
}
MARK_POINTS = {"a": 4, "b": 3, "c": 2, "d": 1, "f": 0}


def mark_flags(mark: ColumnLike) -> dict[str, Column]:
    """`mark_is_<letter>` flags from a letter (with optional sign) or a whole number."""
    m = _c(mark)
    number = F.when(m.rlike(r"^[0-9]+\z"), m.try_cast("int"))
    out = {}
    for letter, band in MARK_BANDS.items():
        name = letter.upper()
        if band is None:
            hit = m == name
        else:
            low, high = band
            within = (number >= low) if high is None else number.between(low, high)
            hit = m.isin([name + s for s in ("-", "", "+")]) | F.coalesce(within, F.lit(False))
        out[f"mark_is_{letter}"] = flag(hit)
    return out


def grade_points(counts: Mapping[str, ColumnLike]) -> Column:
    """Grade-point average from mark counts per letter; null without any mark."""
    total = reduce(lambda a, b: a + b, (_c(counts[x]) for x in MARK_POINTS))
    points = reduce(lambda a, b: a + b, (_c(counts[x]) * p for x, p in MARK_POINTS.items() if p))
    return F.when(total > 0, points.cast("double") / total)


def course_flags(name: ColumnLike) -> dict[str, Column]:
    """Honors, English-honors, mathematics and advanced-science flags of a course title."""
    t = F.upper(_c(name))
    return {
        "course_honors": has_text(t, "HONOR"),
        "course_eng_honors": has_text(t, "ENGL", "HONOR"),
        "course_math": flag(t.rlike("(MATH|ALGEBRA|GEOMETRY)")),
        "course_adv_sci": flag(t.contains("ADV") & t.rlike("(SCIENCE|PHYSIC|CHEM|BIO)")),
    }


# -- coverage ---------------------------------------------------------------

def covered(year: ColumnLike, value: ColumnLike, first: int, last: int | None = None, fill: object = 0) -> Column:
    """`value` with nulls filled inside the years a source covers; null outside them."""
    y = _c(year)
    inside = (y >= first) if last is None else y.between(first, last)
    return F.when(inside, F.coalesce(_c(value), F.lit(fill)))
