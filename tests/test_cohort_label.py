import datetime as dt

from pyspark.sql import functions as F

from cohortline.operators import cohort as K
from cohortline.operators import labels as L

ENROLLMENT = ("student_id bigint, academic_year int, grade_level int, current_grade_level string, "
              "active_status boolean, current_status string")


def enrollment(spark, *rows):
    return spark.createDataFrame(list(rows), ENROLLMENT)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_first_enrollment_order_and_ties(spark):
    e = enrollment(
        spark,
        (1, 2005, 11, "11", True, "0"), (1, 2005, 10, "10", True, "0"), (1, 2004, 9, "9", False, "0"),
        (2, None, 9, "9", True, "0"), (2, 2007, 10, "10", True, "0"),
        (3, None, 12, "12", True, "0"),
        (4, 2001, 9, "9", None, "0"),
        (None, 2001, 9, "9", True, "0"),
    )
    assert as_set(K.first_enrollment(e)) == {(1, 2005, 10), (2, 2007, 10), (3, None, 12)}


def test_cohort_drops_units_that_transfer_out_later(spark):
    e = enrollment(
        spark,
        (1, 2005, 9, "9", True, "0"), (1, 2006, 10, "10", True, "2"),
        (2, 2005, 10, "10", True, "0"), (2, 2004, 10, "10", False, "2"), (2, 2006, 9, "9", False, "2"),
        (3, 2005, 9, "9", True, "2"),
        (4, None, 9, "9", True, "2"),
    )
    # 2: one transfer is earlier, the other in a lower grade; 4: an unknown year never compares
    assert as_set(K.cohort(e)) == {(2, 2008), (4, None)}
    assert {r["student_id"] for r in K.transfer_out(e).collect()} == {1, 3}


def test_cohort_by_year_keeps_repeats_unless_unique(spark):
    e = enrollment(
        spark, (1, 2005, 9, "9", True, "0"), (1, 2005, None, "10", True, "0"), (1, 2005, 9, "9", True, "0"),
        (1, 2006, None, "KI", True, "0"), (1, 2007, 11, "11", None, "0"),
    )
    cohorts = spark.createDataFrame([(1, 2009), (2, None)], "student_id bigint, cohort int")
    assert K.cohort_by_year(e, cohorts).count() == 3
    assert as_set(K.cohort_by_year(e, cohorts, unique=True)) == {(1, 2009, 2005, 10)}


def test_last_records_treat_a_missing_date_as_latest(spark):
    e = enrollment(spark, (1, 2005, 9, "9", True, "0"), (1, None, 9, "9", True, "0"), (2, 2004, 9, "9", True, "0"),
                   (2, 2009, 9, "9", False, "0"))
    assert as_set(K.last_enrollment(e)) == {(1, None, 2), (2, 2004, 1)}
    o = spark.createDataFrame([(1, dt.date(2001, 1, 1)), (1, dt.date(2002, 1, 1))], "student_id bigint, withdraw_date date")
    assert as_set(K.last_withdrawal(o)) == {(1, dt.date(2002, 1, 1), 2)}


def test_jumps_ignore_repeated_records(spark):
    y = spark.createDataFrame(
        [(1, 2005, 9), (1, 2005, 9), (1, 2006, 11), (2, 2005, 9), (2, 2006, 10), (3, 2005, 12), (3, 2009, 9)],
        "student_id bigint, academic_year int, grade_level int")
    assert K.enrollment_jumps(y).first()[0] == 1


def test_label_rules(spark):
    cohorts = spark.createDataFrame([(i, 2005) for i in range(1, 7)] + [(9, None)], "student_id bigint, cohort int")
    regular = "12th Grade Regular Program"
    graduates = spark.createDataFrame(
        [(1, 2004, regular), (1, 2004, regular), (2, 2005, regular), (3, 2004, regular), (4, 2004, "Certificate"), (6, 2002, "1")],
        "student_id bigint, academic_year int, classification string")
    outcome = spark.createDataFrame(
        [(3, dt.date(2005, 6, 30)), (4, dt.date(2005, 7, 1)), (5, None)], "student_id bigint, withdraw_date date")
    rows = {r["student_id"]: r for r in L.label(L.grad_label(cohorts, graduates), outcome).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6]
    assert rows[1]["grad_on_time"] == 1 and rows[1]["outcome_label"] == 0
    assert rows[2]["grad_late_1year"] == 1 and rows[2]["grad_not_on_time"] == 1 and rows[2]["outcome_label"] is None
    assert rows[3]["grad_on_time"] == 1 and rows[3]["dropout_hs"] == 1 and rows[3]["outcome_label"] == 1
    assert rows[4]["dropout_late"] == 1 and rows[4]["no_record_found"] == 0
    assert rows[5]["dropout_ever"] == 1 and rows[5]["dropout_hs"] == 0 and rows[5]["no_record_found"] == 1
    assert rows[6]["grad_early"] == 1 and rows[6]["outcome_label"] == 0


def test_label_fans_out_with_repeated_outcomes(spark):
    grad = spark.createDataFrame([(1, 2005, 2004, "1")], "student_id bigint, cohort int, academic_year int, classification string")
    outcome = spark.createDataFrame([(1, dt.date(2005, 1, 1)), (1, dt.date(2006, 1, 1))], "student_id bigint, withdraw_date date")
    assert L.label(grad, outcome).count() == 2


def test_labels2(spark):
    cohorts = spark.createDataFrame([(1, 2005), (2, 2005)], "student_id bigint, cohort int")
    e = enrollment(spark, (1, 2005, 12, "12", True, "0"))
    o = spark.createDataFrame([(1, dt.date(2006, 1, 1))], "student_id bigint, withdraw_date date")
    got = {r[0]: tuple(r)[1:] for r in L.labels2(cohorts, e, o).collect()}
    assert got == {1: (0, 1, 1, 0, 1, 0, 0), 2: (0, 0, 0, 0, 0, 0, 0)}


def test_one_unit_with_a_third_of_all_records(spark):
    """The per-unit choices give the same rows when one unit is hot."""
    hot = spark.range(30000).select(
        F.lit(7).cast("bigint").alias("student_id"), (F.col("id") % 5 + 2001).cast("int").alias("academic_year"),
        (F.col("id") % 4 + 9).cast("int").alias("grade_level"), F.lit("9").alias("current_grade_level"),
        F.lit(True).alias("active_status"), F.lit("0").alias("current_status"))
    rest = spark.range(60000).select(
        (F.col("id") + 100).alias("student_id"), F.lit(2003).alias("academic_year"), F.lit(10).alias("grade_level"),
        F.lit("10").alias("current_grade_level"), F.lit(True).alias("active_status"),
        F.when(F.col("id") % 3 == 0, "2").otherwise("0").alias("current_status"))
    c = K.cohort(hot.unionByName(rest))
    assert c.where("student_id = 7").first()["cohort"] == 2001 - 9 + 13
    assert c.count() == 1 + 40000


def test_first_enrollment_keeps_odd_grades(spark):
    """A record passes by its code alone, so that its numeric grade can be anything."""
    rows = [(1, 2000, -1, "9"), (1, 2001, 9, "9"), (2, 2000, 9999, "10"), (2, 2000, 99999, "10"), (3, None, 9, "9"), (3, 2005, -300, "9"),
            (4, 2000, 2**31 - 1, "9"), (5, 2000, -(2**31), "9"), (6, None, 11, "11"), (7, -5, 9, "9"), (7, 3, 9, "9")]
    df = spark.createDataFrame([(*r, True, "1") for r in rows], "student_id bigint, academic_year int, grade_level int, "
                               "current_grade_level string, active_status boolean, current_status string")
    got = {r[0]: tuple(r)[1:] for r in K.first_enrollment(df).collect()}
    assert got == {1: (2000, -1), 2: (2000, 9999), 3: (2005, -300), 4: (2000, 2**31 - 1), 5: (2000, -(2**31)), 6: (None, 11), 7: (-5, 9)}
