import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from cohortline.functions import columns as C
from cohortline.functions import hashing as H


def one(spark, schema, row, *cols):
    return tuple(spark.createDataFrame([row], schema).select(*cols).first())


def test_school_year_turns_in_july(spark):
    rows = spark.createDataFrame([(dt.date(2010, 6, 30),), (dt.date(2010, 7, 1),)], "d date")
    got = [tuple(r) for r in rows.select(C.school_year("d"), C.outcome_year("d")).collect()]
    assert got == [(2009, 2010), (2010, 2011)]
    october = spark.createDataFrame([(dt.date(2010, 9, 30),), (dt.date(2010, 10, 1),)], "d date")
    assert [r[0] for r in october.select(C.october_year("d")).collect()] == [2009, 2010]


def test_relative_age(spark):
    (years,) = one(spark, "c int, d date", (2014, dt.date(1996, 3, 15)), C.relative_age("c", "d"))
    assert years == pytest.approx(-1.0410958904)


@pytest.mark.parametrize("later, earlier, months, days", [
    (dt.date(2001, 4, 10), dt.date(1957, 6, 13), 43 * 12 + 9, 27),
    (dt.date(1957, 6, 13), dt.date(2001, 4, 10), -(43 * 12 + 9), -27),
    (dt.date(2000, 3, 31), dt.date(2000, 2, 29), 1, 2),
    (dt.date(2000, 1, 1), dt.date(2000, 1, 1), 0, 0),
    (None, dt.date(2000, 1, 1), None, None),
])
def test_age_parts(spark, later, earlier, months, days):
    assert one(spark, "a date, b date", (later, earlier), *C.age_parts("a", "b")) == (months, days)


@pytest.mark.parametrize("mark, letter", [
    ("A-", "a"), ("100", "a"), ("105", "a"), ("90", "a"), ("89", "b"), ("B+", "b"), ("70", "c"), ("60", "d"), ("45", None),
    ("F", "f"), ("F-", None), ("P", None), ("99999999999", None), (None, None),
])
def test_marks(spark, mark, letter):
    flags = C.mark_flags("m")
    got = one(spark, "m string", (mark,), *flags.values())
    assert got == tuple(int(n == f"mark_is_{letter}") for n in flags)


@pytest.mark.parametrize("codes, n", [(None, 1), ("en", 1), ("en_es", 2), ("a_b_c_d_e_f", 6), ("a_b_c_d_e_f_g", 6)])
def test_language_count(spark, codes, n):
    got = one(spark, "h string", (codes,), *C.language_columns("h").values())
    assert got == (*[int(n >= k) for k in range(2, 7)], n)


def test_grade_filter_is_an_or_and_codes_never_fail(spark):
    rows = spark.createDataFrame([(8, "9"), (None, "KI"), (9, "KI"), (None, "09")],
                                 "grade_level int, current_grade_level string")
    got = rows.where(C.in_grades(range(9, 13))).select(C.grade_value()).collect()
    assert sorted(r[0] for r in got) == [8, 9, 9]


def test_coverage_window(spark):
    rows = spark.createDataFrame([(2003, None), (2004, None), (2005, 3)], "y int, v int")
    assert [r[0] for r in rows.select(C.covered("y", "v", 2004)).collect()] == [None, 0, 3]
    assert [r[0] for r in rows.select(C.covered("y", F.col("v"), 2003, 2004)).collect()] == [0, 0, None]


def test_grade_points(spark):
    schema = ", ".join(f"{x} int" for x in "abcdf")
    gpa = C.grade_points({x: x for x in "abcdf"})
    assert one(spark, schema, (1, 1, 0, 0, 2), gpa) == (7 / 4,)
    assert one(spark, schema, (0, 0, 0, 0, 0), gpa) == (None,)


def test_course_flags(spark):
    names = ["Honors English II", "ADV Chemistry", "Geometry Honors", None]
    rows = spark.createDataFrame([(n,) for n in names], "t string").select(*C.course_flags("t").values())
    assert [tuple(r) for r in rows.collect()] == [(1, 1, 0, 0), (0, 0, 0, 1), (1, 0, 1, 0), (0, 0, 0, 0)]


def test_json_hash_is_the_hash_of_a_json_list(spark):
    fields = ["9", '{"a": "b\\c"}', ""]
    (got,) = one(spark, "a string, b string, c string", tuple(fields), H.json_list_hash(F.col("a"), F.col("b"), F.col("c")))
    assert got == hashlib.sha1(json.dumps(fields).encode()).hexdigest()


def test_uniform_is_stable_and_even(spark):
    u = spark.range(20000).select(H.uniform("id", seed=3).alias("u"))
    low, high, mean = u.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low and high < 1 and abs(mean - 0.5) < 0.01
    assert u.agg(F.sum("u")).first() == spark.range(20000).repartition(7).select(H.uniform("id", seed=3).alias("u")).agg(F.sum("u")).first()
