import datetime as dt
from functools import reduce

from pyspark.sql import functions as F

from cohortline.operators import reports as X
from cohortline.operators import static as S
from cohortline.operators import yearly as Y
from cohortline.plans import dataset as D
from cohortline.operators import reshape as R

YEARLY = "student_id bigint, cohort int, academic_year int, grade_level int"


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_absence_and_suspension_fill_differ(spark):
    base = spark.createDataFrame([(1, 2012, 2008, 9), (2, 2012, 2008, 9), (3, 2012, 2003, 4)], YEARLY)
    attendance = spark.createDataFrame(
        [(1, 2008, None, 2.0, None), (3, 2003, 5.0, 1.0, 1.0)],
        "student_id bigint, academic_year int, days_absent double, excused_absence double, unexcused_absence double")
    got = {r[0]: tuple(r)[4:] for r in Y.absences(base, attendance).select(*base.columns, *Y.ABSENCES).collect()}
    assert got == {1: (0.0, 2.0, 0.0), 2: (None, None, None), 3: (None, None, None)}
    incidents = spark.createDataFrame(
        [(1, dt.date(2008, 9, 1), 3, True, None), (1, dt.date(2009, 6, 30), 5, None, None)],
        "student_id bigint, incident_date date, suspension_length int, a boolean, b boolean")
    out = Y.discipline(base, incidents, categories={"x": ["a"], "y": ["a", "b"]})
    got = {r["student_id"]: r for r in out.collect()}
    assert (got[1]["susp_count"], got[1]["suspension_days"], got[1]["max_suspension_days"]) == (2, 8, 5)
    assert (got[1]["x"], got[1]["y"], got[1]["other"]) == (1, 1, 1)
    assert (got[1]["disc_x"], got[1]["disc_other"]) == (1, 1)
    assert got[2]["susp_count"] is None and got[2]["suspension_count"] == 0 and got[2]["disc_x"] == 0
    assert got[3]["suspension_count"] is None and got[3]["disc_x"] is None


def test_unknown_courses_leave_null_flags(spark):
    base = spark.createDataFrame([(1, 2012, 2008, 9), (2, 2012, 2008, 9)], YEARLY)
    taken = spark.createDataFrame(
        [(1, 2008, "A", 1, "9", "95"), (1, 2008, "A", 2, "9", "F"), (2, 2008, "Z", 1, "9", "P"), (2, 2008, "A", 1, None, "A"),
         (2, 2008, "A", 1, "KI", "A")],
        "student_id bigint, academic_year int, course_code string, school_id int, grade_level string, mark string")
    catalog = spark.createDataFrame([("A", 1, "Algebra honors")], "code string, school_id int, name string")
    got = {r["student_id"]: r for r in Y.courses(base, taken, catalog).collect()}
    assert (got[1]["courses_taken"], got[1]["course_math"], got[1]["mark_is_a"], got[1]["mark_is_f"]) == (2, 1, 1, 1)
    assert got[1]["avg_gpa"] == 2.0
    assert got[2]["courses_taken"] == 1 and got[2]["course_math"] is None and got[2]["avg_gpa"] is None


def test_incident_categories_name_36_columns():
    names = {c for cols in Y.INCIDENT_CATEGORIES.values() for c in cols}
    assert len(names) == 36
    assert [len(v) for v in Y.INCIDENT_CATEGORIES.values()] == [5, 15, 4, 2, 8, 7]


def test_static_nulls(spark):
    cohorts = spark.createDataFrame([(1, 2014), (2, None)], "student_id bigint, cohort int")
    fixed = spark.createDataFrame([(1, "F", None, None, None, None)],
                                  "id bigint, gender string, race_original string, race_ethnicity string, home_language_code string, special_ed_ever boolean")
    person = spark.createDataFrame([(1, None, None, None)],
                                   "id bigint, date_of_birth date, date_first_entered_district date, date_entered_into_us date")
    (row,) = S.static_features(cohorts, fixed, person).collect()
    assert row["rel_age_to_cohort"] is None and row["rel_age_to_cohort_1to3_years_older"] == 0
    assert row["home_language_count"] == 1 and row["race_2more"] == 0


def test_continued_enrollment_equals_one_join_per_cell(district):
    cby, label = district.cby, district.label.where("outcome_label is not null")
    at = {g: cby.where(F.col("grade_level") == g).select("student_id").distinct() for g in range(9, 13)}

    def cell(run):
        joined = reduce(lambda a, g: a.join(at[g], "student_id"), run, label)
        return dict(joined.groupBy("cohort").count().collect())

    fused = {r["cohort_yr"]: r for r in X.continued_enrollment(cby, district.label).collect()}
    for name, run in {"enrol_9": [9], "enrol_9thru11": [9, 10, 11], "enrol_10thru12": [10, 11, 12]}.items():
        want = cell(run)
        assert {c: r[name] for c, r in fused.items()} == {c: want.get(c) for c in fused}
    for r in fused.values():
        cells = [r["enrol_9thru12"] or 0, r["enrol_9thru11"] or 0, r["enrol_9thru10"] or 0, r["enrol_9"] or 0, r["total_outcome"]]
        assert cells == sorted(cells)


def test_only_grade_counts_units_without_a_label_row(spark):
    cby = spark.createDataFrame([(1, 2009, 2005, 9), (2, 2009, 2005, 9), (2, 2009, 2006, 10), (3, 2009, 2005, 9)], YEARLY)
    labels = spark.createDataFrame([(3, 1, 0, 0, 0, 0), (3, 0, 1, 0, 0, 0)],
                                   "student_id bigint, grad_early int, grad_on_time int, grad_not_on_time int, dropout_ever int, outcome_label int")
    (row,) = X.only_grade9(cby, labels).collect()
    assert tuple(row) == (2009, 2, 1, 0, 0, 1)


def test_school_report_invariants(district):
    for r in X.school_by_year(district.enrollment, district["school"]).collect():
        assert r["num_active"] <= r["num_total"]
        assert r["currentgrade_sameas_lastgrade"] + r["currentgrade_diff_from_lastgrade"] + r["last_grade_missing"] == r["num_total"]


def test_latest_features_equal_dedup_after_fan_out(district):
    late = R.dedup_last(district.yearly, ["student_id", "grade_level"], ["academic_year"], ["current_school_id"])
    early = district.latest.select(*late.columns)
    assert early.exceptAll(late).count() == 0 and late.exceptAll(early).count() == 0


def test_reports_can_be_read_newest_first(spark):
    df = spark.createDataFrame([(2001,), (None,), (2003,)], "cohort_yr int")
    assert [r[0] for r in X.newest_first(df, "cohort_yr").collect()] == [None, 2003, 2001]


def test_repeated_records_go_through_joins_once(spark):
    """A unit-year of 300 records gives 300 x 300 rows, but no join sees more than its different rows."""
    yearly = spark.createDataFrame([(1, 2000, 5)] * 300 + [(2, 2001, 6), (2, 2001, 6), (3, 1999, None)], "student_id bigint, academic_year int, v int")
    attended = spark.createDataFrame([(1, 2000, 7)] * 200 + [(1, 2000, 8)] * 99 + [(1, 2000, None), (2, 2001, 7)],
                                     "student_id bigint, academic_year int, current_school_id int")
    schools = spark.createDataFrame([(7, "a", "E"), (8, "b", None)], "id int, name string, grade_span string")
    got = Y.school(yearly, attended, schools).groupBy("student_id", "v", "current_school_id", "school_is_elementary").count().collect()
    assert {(*tuple(r)[:3], bool(r[3]), r[4]) for r in got} == {
        (1, 5, 7, True, 60000), (1, 5, 8, False, 29700), (1, 5, None, False, 300), (2, 6, 7, True, 2), (3, None, None, False, 1)}
    assert Y.weighted(yearly).count() == 3 and Y.expanded(Y.weighted(yearly)).count() == 303


def test_marks_become_flags_behind_the_join(spark):
    """The rows that the join moves and sorts carry the mark itself, not its flags."""
    taken = spark.createDataFrame([(1, 2000, "C1", 3, "9", "A-")], "student_id bigint, academic_year int, course_code string, school_id int, grade_level string, mark string")
    catalog = spark.createDataFrame([("C1", 3, "Algebra I")], "code string, school_id int, name string")
    marks = Y.course_marks(taken, catalog)
    assert marks.columns[:5] == ["course_code", "school_id", "student_id", "academic_year", "grade"]
    assert marks.select("mark_is_a", "course_math").first() == (1, 1)
    plan = marks._jdf.queryExecution().optimizedPlan().toString()
    assert "mark_is_a" in plan and "mark_is_a" not in plan[plan.index("Join"):]


def test_merged_partitions_are_bounded(district):
    """A task of the registered queries reads about 16 MB of shuffled rows, however large the tables are."""
    assert district.spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
