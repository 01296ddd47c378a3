"""Per-year features.

Every source is reduced to one row per (unit, year) before it meets the yearly
table, so the joins share one partitioning and a hot unit costs one row per
year and task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions import columns as C
from cohortline.roles import DEFAULT, Roles

ABSENCES = ("days_absent", "excused_absence", "unexcused_absence")
ATTENDANCE_FROM = 2004
INCIDENTS_BETWEEN = (2007, 2013)

# Incident columns of each category. Categories may overlap.
INCIDENT_CATEGORIES: dict[str, list[str]] = {
    "terror": [
        "Acts of Terror",
        "Bomb Threat",
        "Bomb Threat: Aiding/Abetting",
        "Fire Setting/Incendiary Material",
        "Threat/False Threat",
    ],
    "assault": [
        "Assault Involving Weapon/Dangerous Instrument/Substances",
        "Assault Involving a Weapon(Grade 6-12)",
        "Assault Involving a Weapon/Dangerous Instrument/Substances",
        "Assault on Employee/Adult(13 or Older)-Serious Injury",
        "Assault on Employee/Adult(Grade 6-12)-First Violation",
        "Assault on School Personnel or Other Adult",
        "Assault on Student",
        "Assault on Student(13 or Older)-Witnessed by School Official",
        "Assault on Student(Grade 6-12)-First Violation",
        "Assault on Student(Grade K-5)-First Violation",
        "Assault on Student: Actual Serious Injury",
        "Fighting/Assault-Multiple on One (Grade 6-12)",
        "Fighting/Physical Aggression",
        "Instigation of Fight/Physical Aggression",
        "Physical Aggression/Fighting",
    ],
    "academic": [
        "Cheating",
        "Class/Activity Disturbance",
        "School / Class Attendance",
        "School Disturbance",
    ],
    "gang": [
        "Gang and Gang Related Activity",
        "Gang/Gang Related Activity",
    ],
    "weapon": [
        "Assault Involving Weapon/Dangerous Instrument/Substances",
        "Assault Involving a Weapon(Grade 6-12)",
        "Assault Involving a Weapon/Dangerous Instrument/Substances",
        "Bomb Threat",
        "Bomb Threat: Aiding/Abetting",
        "Firearm(14 or older) Possess or Handle on School Property",
        "Firearm/Destructive Device K-12",
        "Firearm/Explosive Device(K-12) on School Property",
    ],
    "drug": [
        "Narcotics/Alcohol/Controlled Substances/Chemicals/Drug Parapher",
        "Possess/Distribute/Use of Alcohol/Drug/Paraphernalia",
        "Possession/Use Drugs/Alcohol or Paraphernalia-ACE",
        "Possession/Use Drugs/Alcohol or Paraphernalia-Alternative Offer",
        "Possession/Use Drugs/Alcohol or Paraphernalia-Repeat Violation",
        "Sale/Distribution of Drugs/Alcohol",
        "Sale/Distribution of NCCSA Schedule I/II Drugs(14 or older)",
    ],
}

# School columns that only say whether a programme exists.
PROGRAMMES = ("pbis", "stem", "global", "ib", "cis", "success_maker", "academy_of_reading", "academy_of_math")
GRADE_SPANS = {"elementary": "E", "middle": "M", "high": "H"}
MAGNETS = {"ib": "IB", "gifted": "GT"}


def yearly_base(cby: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Unit-by-year rows with the years left until the cohort's graduation."""
    return cby.select(
        roles.unit, roles.cohort, roles.year, roles.time,
        (F.col(roles.cohort) - F.col(roles.year)).alias("countdown"),
    )


def absences(yearly: DataFrame, attendance: DataFrame, roles: Roles = DEFAULT, since: int = ATTENDANCE_FROM,
             columns: Sequence[str] = ABSENCES) -> DataFrame:
    """Add absence counts. The zero fill belongs to the attendance record: a
    unit-year without a record stays null."""
    source = attendance.select(
        roles.unit, roles.year, *[C.covered(roles.year, F.col(c), since).alias(c) for c in columns]
    )
    return yearly.join(source, [roles.unit, roles.year], "left")


def incident_categories(incidents: DataFrame, roles: Roles = DEFAULT, date: str = "incident_date",
                        categories: Mapping[str, Sequence[str]] = INCIDENT_CATEGORIES) -> DataFrame:
    """Incidents with their school year and one 0/1 column per category."""
    flags = {name: C.flag(C.any_true(cols)) for name, cols in categories.items()}
    return incidents.select(
        roles.unit, C.school_year(date).alias(roles.year), "suspension_length",
        *[c.alias(n) for n, c in flags.items()],
    )


def discipline_by_year(incidents: DataFrame, roles: Roles = DEFAULT, date: str = "incident_date",
                       categories: Mapping[str, Sequence[str]] = INCIDENT_CATEGORIES) -> DataFrame:
    """Suspension counts, days and category totals per (unit, school year)."""
    names = list(categories)
    none = F.lit(True)
    for n in names:
        none = none & (F.col(n) == 0)
    return (
        incident_categories(incidents, roles, date, categories)
        .groupBy(roles.unit, roles.year)
        .agg(
            F.count(F.lit(1)).alias("susp_count"),
            F.sum("suspension_length").alias("total_susp_days"),
            F.min("suspension_length").alias("min_susp_days"),
            F.max("suspension_length").alias("max_susp_days"),
            *[F.sum(n).alias(n) for n in names],
            F.sum(C.flag(none)).alias("other"),
        )
    )


def discipline(yearly: DataFrame, incidents: DataFrame, roles: Roles = DEFAULT, date: str = "incident_date",
               categories: Mapping[str, Sequence[str]] = INCIDENT_CATEGORIES,
               between: tuple[int, int] = INCIDENTS_BETWEEN) -> DataFrame:
    """Add raw and windowed discipline columns. The zero fill belongs to the
    yearly row: in covered years no incident means 0."""
    first, last = between
    joined = yearly.join(discipline_by_year(incidents, roles, date, categories), [roles.unit, roles.year], "left")
    windowed = {
        "suspension_count": "susp_count",
        "suspension_days": "total_susp_days",
        "min_suspension_days": "min_susp_days",
        "max_suspension_days": "max_susp_days",
    }
    inside = F.col(roles.year).between(first, last)
    return joined.select(
        "*",
        *[C.covered(roles.year, F.col(c), first, last).alias(n) for n, c in windowed.items()],
        *[F.when(inside, C.flag(F.col(c) > 0)).alias(f"disc_{c}") for c in [*categories, "other"]],
    )


def discipline_oct_year(incidents: DataFrame, roles: Roles = DEFAULT, date: str = "incident_date") -> DataFrame:
    """Earlier discipline summary with an October year boundary."""
    return incidents.groupBy(roles.unit, C.october_year(date).alias(roles.year)).agg(
        F.count(F.lit(1)).alias("suspension_count"),
        F.sum("suspension_length").alias("total_suspension_days"),
        F.min("suspension_length").alias("min_suspension_days"),
        F.max("suspension_length").alias("max_suspension_days"),
    )


def course_marks(taken: DataFrame, catalog: DataFrame, roles: Roles = DEFAULT,
                 excluded_grades: Sequence[str] = ("PK", "KI")) -> DataFrame:
    """Courses taken with mark flags and, where the catalog knows the course,
    title flags. Title flags of unknown courses are null, not 0.

    Joined on (course, school): a popular course spreads over its schools, and
    the adaptive skew join splits what is left. The mark goes through the join as
    it is, and its flags, which are wider, are made behind it."""
    flags = C.course_flags("name")
    titles = catalog.select(
        F.col("code").alias("course_code"), "school_id", *[c.alias(n) for n, c in flags.items()]
    )
    marks = C.mark_flags("mark")
    rows = taken.where(~F.col("grade_level").isin(list(excluded_grades))).select(
        roles.unit, roles.year, "course_code", "school_id", F.col("grade_level").try_cast("int").alias("grade"), "mark",
    )
    return rows.join(titles, ["course_code", "school_id"], "left").select(
        "course_code", "school_id", roles.unit, roles.year, "grade", *[c.alias(n) for n, c in marks.items()], *flags,
    )


def courses_by_year(taken: DataFrame, catalog: DataFrame, roles: Roles = DEFAULT,
                    excluded_grades: Sequence[str] = ("PK", "KI")) -> DataFrame:
    """Course and mark totals per (unit, year)."""
    totals = [*C.course_flags("name"), *C.mark_flags("mark")]
    return (
        course_marks(taken, catalog, roles, excluded_grades)
        .groupBy(roles.unit, roles.year)
        .agg(F.count(F.lit(1)).alias("courses_taken"), *[F.sum(n).alias(n) for n in totals])
    )


def courses(yearly: DataFrame, taken: DataFrame, catalog: DataFrame, roles: Roles = DEFAULT,
            excluded_grades: Sequence[str] = ("PK", "KI")) -> DataFrame:
    """Add course totals, mark totals and the grade-point average."""
    gpa = C.grade_points({letter: f"mark_is_{letter}" for letter in C.MARK_POINTS})
    return yearly.join(
        courses_by_year(taken, catalog, roles, excluded_grades), [roles.unit, roles.year], "left"
    ).select("*", gpa.alias("avg_gpa"))


def school_flags(school: DataFrame, id_col: str = "id", dropped: Sequence[str] = ("name",)) -> DataFrame:
    """School attributes prefixed `school_`, with grade-span and magnet flags and
    programme columns turned into booleans."""
    programmes = [c for c in PROGRAMMES if c in school.columns]
    plain = [c for c in school.columns if c not in {id_col, *programmes, *dropped}]
    out = [F.col(id_col).alias("school_id"), *[F.col(c).alias(f"school_{c}") for c in plain]]
    if "grade_span" in plain:
        out += [C.has_text("grade_span", code).alias(f"school_is_{n}") for n, code in GRADE_SPANS.items()]
    if "magnet" in plain:
        out.append(F.col("magnet").isNotNull().alias("school_is_magnet"))
        out += [F.coalesce(F.col("magnet").contains(code), F.lit(False)).alias(f"school_magnet_is_{n}")
                for n, code in MAGNETS.items()]
    out += [F.col(c).isNotNull().alias(f"school_{c}") for c in programmes]
    return school.select(*out)


#: How many equal rows a weighted row stands for.
WEIGHT = "_times"


def weighted(df: DataFrame) -> DataFrame:
    """Each different row once, and how often it occurs."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(WEIGHT))


def expanded(df: DataFrame) -> DataFrame:
    """The rows as often as their weight says."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(WEIGHT)))).drop("_copy", WEIGHT)


def _attended(yearly: DataFrame, enrollment: DataFrame, schools: DataFrame, roles: Roles, school_col: str,
              unique: bool = False) -> DataFrame:
    """Weighted rows with every different school of the unit-year. Repeated records multiply weights instead of rows; those that are `unique`
    need no counting."""
    keys = [roles.unit, roles.year, school_col]
    one = F.lit(1).cast("bigint").alias("_seen")
    times = enrollment.select(*keys, one) if unique else enrollment.groupBy(*keys).agg(F.count(F.lit(1)).alias("_seen"))
    flags = school_flags(schools)
    return (
        yearly.join(times, [roles.unit, roles.year], "left")
        .withColumn(WEIGHT, F.col(WEIGHT) * F.coalesce("_seen", F.lit(1))).drop("_seen")
        .join(flags, F.col(school_col) == flags["school_id"], "left")
        .drop(flags["school_id"])
    )


def school(yearly: DataFrame, enrollment: DataFrame, schools: DataFrame, roles: Roles = DEFAULT,
           school_col: str = "current_school_id") -> DataFrame:
    """Add the school of every enrollment record of the unit-year and its attributes. Rows are multiplied at the end only."""
    return expanded(_attended(weighted(yearly), enrollment, schools, roles, school_col))


def yearly_features(cby: DataFrame, attendance: DataFrame, incidents: DataFrame, taken: DataFrame,
                    catalog: DataFrame, enrollment: DataFrame, schools: DataFrame, roles: Roles = DEFAULT,
                    attendance_from: int = ATTENDANCE_FROM,
                    incidents_between: tuple[int, int] = INCIDENTS_BETWEEN,
                    categories: Mapping[str, Sequence[str]] = INCIDENT_CATEGORIES, repeated: bool = True,
                    unique: bool = False) -> DataFrame:
    """The whole yearly feature table, repeated unit-years kept.

    Repeated rows of the unit-by-year table and of the enrollment records go through all joins once, with a weight; a unit-year
    of m records never makes m x m rows before the result. `repeated=False` leaves each different row once; `unique=True` says that
    neither table repeats a row, so that nothing is weighed."""
    base = yearly_base(cby, roles)
    out = base.withColumn(WEIGHT, F.lit(1).cast("bigint")) if unique else weighted(base)
    out = absences(out, attendance, roles, attendance_from)
    out = discipline(out, incidents, roles, categories=categories, between=incidents_between)
    out = courses(out, taken, catalog, roles)
    out = _attended(out, enrollment, schools, roles, "current_school_id", unique)
    return expanded(out) if repeated and not unique else out.drop(WEIGHT)


def yearly_features_v0(cby: DataFrame, attendance: DataFrame, incidents: DataFrame, enrollment: DataFrame,
                       schools: DataFrame, roles: Roles = DEFAULT, attendance_from: int = ATTENDANCE_FROM,
                       incidents_between: tuple[int, int] = INCIDENTS_BETWEEN) -> DataFrame:
    """Earlier yearly table: October years, and zero fill on the yearly row for
    absences as well as suspensions."""
    first, last = incidents_between
    incident_years = discipline_oct_year(incidents, roles)
    joined = weighted(cby).join(
        attendance.select(roles.unit, roles.year, *ABSENCES), [roles.unit, roles.year], "left"
    ).join(incident_years, [roles.unit, roles.year], "left")
    suspended = [c for c in incident_years.columns if c not in (roles.unit, roles.year)]
    filled = joined.select(
        roles.unit, roles.cohort, roles.year, roles.time, WEIGHT,
        *[C.covered(roles.year, F.col(c), attendance_from).alias(c) for c in ABSENCES],
        *[C.covered(roles.year, F.col(c), first, last).alias(c) for c in suspended],
    )
    return expanded(_attended(filled, enrollment, schools, roles, "current_school_id"))
