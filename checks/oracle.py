"""Expected results as DuckDB SQL over the generated tables.

Written with plain windows, DISTINCT and correlated sub-queries so that they do
not share the shape of the Spark operators they check."""

from __future__ import annotations

import json
import re

from checks.standin import STANDIN

HS = "('9', '09', '10', '11', '12')"
LOW = ", ".join(f"'{s}'" for g in range(1, 13) for s in sorted({str(g), f"{g:02d}"}))
GRADE = "coalesce(grade_level, try_cast(current_grade_level as int))"
CATEGORIES = {
    "terror": ["f_threat"],
    "assault": ["f_fight", "f_assault_weapon"],
    "academic": ["f_cheating"],
    "gang": ["f_gang"],
    "weapon": ["f_assault_weapon", "f_firearm", "f_threat"],
    "drug": ["f_drug"],
}
ATTENDANCE_FROM = 1996
INCIDENTS_BETWEEN = (1996, 1999)

T: dict[str, str] = dict(STANDIN)
Q: dict[str, str] = {}


def with_tables(query: str) -> str:
    """The query behind the definitions of every table it uses, directly or not."""
    names = list(T)
    needed: set[str] = set()

    def visit(text: str, below: int) -> None:
        for n in names[:below]:
            if n not in needed and re.search(rf"\b{n}\b", text):
                needed.add(n)
                visit(T[n], names.index(n))

    visit(query, len(names))
    ctes = ",\n".join(f"{n} as ({T[n].strip()})" for n in names if n in needed)
    return f"with {ctes}\n{query.strip()}" if ctes else query


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(text) for name, text in Q.items()}


def ints(*names: str) -> str:
    return ", ".join(f"cast(sum({n}) as bigint) as {n}" for n in names)


# -- cohorts -----------------------------------------------------------------

T["t_high"] = f"""
select student_id, academic_year, {GRADE} as grade, active_status, current_status
from school_enrollment where current_grade_level in {HS} or grade_level between 9 and 12"""
T["t_first"] = """
select student_id, academic_year as first_academic_year, grade as first_grade
from (select *, row_number() over (partition by student_id order by academic_year asc nulls last, grade asc) as rn
      from t_high where active_status) where rn = 1"""
T["t_cohort"] = """
select student_id, first_academic_year - first_grade + 13 as cohort
from t_first f
where not exists (select 1 from t_high h where h.student_id = f.student_id and h.current_status = '2'
                  and h.academic_year >= f.first_academic_year and h.grade >= f.first_grade)"""
T["t_code_first"] = f"""
select student_id, academic_year, g as current_grade, ct
from (select student_id, academic_year, try_cast(current_grade_level as int) as g,
             row_number() over (partition by student_id order by academic_year asc nulls last, try_cast(current_grade_level as int)) as rn,
             count(*) over (partition by student_id) as ct
      from school_enrollment where active_status and current_grade_level in {HS}) where rn = 1"""
T["t_cohort_all"] = """
select s.id, f.academic_year + 13 - f.current_grade as cohort
from student s left join t_code_first f on f.student_id = s.id"""
T["t_cby"] = f"""
select e.student_id, c.cohort, e.academic_year, {GRADE} as grade_level
from school_enrollment e join t_cohort c on c.student_id = e.student_id and c.cohort is not null
where e.active_status and (e.current_grade_level in ({LOW}) or e.grade_level between 1 and 12)"""
T["t_cby_v0"] = """
select e.student_id, c.cohort, e.academic_year, e.grade_level
from school_enrollment e join t_cohort_all c on c.id = e.student_id
where c.cohort is not null and e.active_status and e.grade_level is not null"""
T["t_first9"] = """
select student_id, min(academic_year) as first_enroll_grade_9
from school_enrollment where grade_level = 9 group by student_id"""
T["t_last_enr"] = """
select student_id, academic_year, ct from (
  select student_id, academic_year, row_number() over (partition by student_id order by academic_year desc nulls first) as rn,
         count(*) over (partition by student_id) as ct from school_enrollment where active_status) where rn = 1"""
T["t_last_out"] = """
select student_id, withdraw_date, ct from (
  select student_id, withdraw_date, row_number() over (partition by student_id order by withdraw_date desc nulls first) as rn,
         count(*) over (partition by student_id) as ct from outcome) where rn = 1"""

Q["grade_normalised"] = "select * from t_high"
Q["first_enrollment"] = "select * from t_first"
Q["transfer_out"] = """
select f.*, h.academic_year as yr, h.grade as gr, h.current_status as st
from t_first f join t_high h on h.student_id = f.student_id and h.current_status = '2'
 and h.academic_year >= f.first_academic_year and h.grade >= f.first_grade"""
Q["cohort"] = "select * from t_cohort"
Q["cohort_sizes"] = "select cohort, count(*) as n from t_cohort group by cohort"
Q["enrollment_rn_ct"] = "select * from t_code_first"
Q["cohort_all_students"] = "select * from t_cohort_all"
Q["cohort_by_year"] = "select * from t_cby"
Q["cohort_by_year_v0"] = "select * from t_cby_v0"
Q["first_grade9"] = "select * from t_first9"
Q["distinct_sketched"] = """
select academic_year, count(distinct student_id) as units, true as close from school_enrollment group by academic_year"""
Q["last_enrollment"] = "select * from t_last_enr"
Q["last_withdrawal"] = "select student_id, cast(withdraw_date as varchar) as withdraw_date, ct from t_last_out"
Q["enrollment_jumps"] = """
select count(distinct student_id) as units_with_jump from (
  select student_id,
         grade_level - lag(grade_level) over w - (academic_year - lag(academic_year) over w) as jump
  from t_cby where grade_level between 9 and 12
  window w as (partition by student_id order by academic_year asc nulls last, grade_level asc nulls last))
where jump > 0"""

# -- labels ------------------------------------------------------------------

T["t_grad"] = """
select distinct c.student_id, c.cohort, g.academic_year, g.classification
from t_cohort c left join graduates g on g.student_id = c.student_id
 and g.classification in ('12 Grade Regular Program Graduate', '12th Grade Regular Program', '1')
where c.cohort is not null"""
T["t_label_rows"] = """
select g.student_id, g.cohort, g.academic_year, g.academic_year + 1 - g.cohort as delay,
       o.student_id is not null as gone, o.withdraw_date, year(o.withdraw_date + interval 184 day) as gone_year
from t_grad g left join outcome o on o.student_id = g.student_id"""


def bit(cond: str, name: str) -> str:
    return f"cast(coalesce({cond}, false) as int) as {name}"


T["t_label"] = f"""
select student_id, cohort, {bit('delay < 0', 'grad_early')}, {bit('delay = 0', 'grad_on_time')},
       {bit('delay = 1', 'grad_late_1year')}, {bit('delay > 1', 'grad_late_2plusyears')},
       {bit('delay >= 1', 'grad_not_on_time')}, {bit('gone and gone_year <= cohort', 'dropout_hs')},
       {bit('gone and gone_year > cohort', 'dropout_late')}, {bit('gone', 'dropout_ever')},
       {bit('academic_year is null and withdraw_date is null', 'no_record_found')},
       cast(case when gone then 1 when delay <= 0 then 0 end as int) as outcome_label
from t_label_rows"""
T["t_label12"] = f"""
select student_id, cohort, {bit('delay <= 0', 'on_time_grad')}, {bit('delay = 1', 'late_grad_1year')},
       {bit('delay > 1', 'late_grad_2ormoreyears')}, {bit('gone', 'ever_dropout')},
       {bit('academic_year is null and withdraw_date is null', 'no_record_found')}
from t_label_rows"""

Q["grad_label"] = "select * from t_grad"
Q["label"] = "select * from t_label"
Q["label_12regular"] = "select * from t_label12"
Q["labels2"] = f"""
select student_id, {bit('y > cohort', 's_spring_enrollment')}, {bit('y >= cohort', 'late_enrollment')},
       {bit('y >= cohort and w >= y', 'late_dropout')}, {bit('y <= w and w <= cohort', 'hs_dropout')},
       {bit('gone', 'ever_dropout')}, {bit('w < y and y < cohort', 'grad_and_dropout')},
       {bit('w < y or y > cohort', 'not_grad_ontime')}
from (select c.student_id, c.cohort, e.academic_year as y, year(o.withdraw_date) as w, o.student_id is not null as gone
      from t_cohort c left join t_last_enr e on e.student_id = c.student_id
      left join t_last_out o on o.student_id = c.student_id)"""

# -- static features ---------------------------------------------------------

AGES = {"age_first_entered_district": "date_first_entered_district", "age_entered_into_us": "date_entered_into_us"}
AGE_COLUMNS = ", ".join(
    f"cast(datepart('year', age({c}, date_of_birth)) * 12 + datepart('month', age({c}, date_of_birth)) as int) as {n}_months, "
    f"cast(datepart('day', age({c}, date_of_birth)) as int) as {n}_days"
    for n, c in AGES.items()
)


def rel_age(cohort: str, years: int) -> str:
    return (f"(date_diff('day', cast(date_of_birth + interval {years} year as date), "
            f"cast(make_date(cast({cohort} as bigint), 1, 1) + interval 14 month as date)) / 365.0)")


PARTS = "coalesce(len(string_split({0}home_language_code, '_')), 1)"


def langs(t: str = "") -> str:
    parts = PARTS.format(t)
    return ", ".join(bit(f"{parts} >= {k}", f"home_language_{k}more") for k in range(2, 7)) + (
        f", cast(least({parts}, 6) as int) as home_language_count")


def races(t: str = "") -> str:
    return ", ".join([
        bit(f"contains({t}race_original, '_')", "race_2more"), bit(f"contains({t}race_original, 'H')", "race_is_hispanic"),
        bit(f"contains({t}race_ethnicity, 'H')", "race_ethnicity_is_hispanic"),
    ])


T["t_static"] = f"""
select c.student_id, c.cohort, cast(s.date_of_birth as varchar) as date_of_birth, f.gender, f.race_original as race,
       f.race_ethnicity, f.home_language_code, f.special_ed_ever, {AGE_COLUMNS},
       round({rel_age('c.cohort', 20)}, 6) as rel_age_to_cohort,
       {bit(rel_age('c.cohort', 20) + ' between 1 and 3', 'rel_age_to_cohort_1to3_years_older')}, {langs('f.')}, {races('f.')}
from t_cohort c left join student_fixed f on f.id = c.student_id left join student s on s.id = c.student_id
where c.cohort is not null"""

Q["cohort_feature"] = "select * from t_static"
Q["age_parts"] = f"select id, {AGE_COLUMNS} from student"
Q["language_counts"] = f"select id, {langs()} from student_fixed"
Q["race_flags"] = f"select id, {races()} from student_fixed"
Q["relative_age"] = f"""
select t.student_id, first_enroll_grade_9, round({rel_age('first_enroll_grade_9', 16)}, 6) as rel_age_to_cohort
from t_first9 t left join student s on s.id = t.student_id"""

T["t_act"] = """
select t.*, l.code, l.name from test t
left join (values ('ACEN', 'English'), ('ACMA', 'Mathematics'), ('ACRD', 'Reading'), ('ACSC', 'Science'),
                  ('ACCO', 'Composite'), ('ACWR', 'Writing')) l(code, name) on l.code = t.test_id
where t.test_id like 'AC%'"""
Q["act_lookup"] = "select * from t_act"
Q["act_composite"] = "select * from t_act where name = 'Composite'"
Q["first_model_table"] = """
select f.student_id, f.first_enroll_grade_9, a.student_id as act_id, a.academic_year as act_year, a.name as act_subject,
       a.score as act_score, s.id, s.gender, s.race, s.home_language_code, cast(s.date_of_birth as varchar) as date_of_birth,
       cast(date_diff('day', date_of_birth, date_first_entered_district) as int) as age_in_days_first_entered_district,
       cast(date_diff('day', date_of_birth, date_entered_into_us) as int) as age_in_days_entered_into_us, o.withdraw_code
from t_first9 f left join (select * from t_act where name = 'Composite') a on a.student_id = f.student_id
left join student s on s.id = f.student_id left join outcome o on o.student_id = s.id"""
Q["absence_by_offset"] = """
select f.*, a.unexcused_absence as unexcused_absence_grade_9, b.unexcused_absence as unexcused_absence_grade_10
from t_first9 f
left join school_attendance a on a.student_id = f.student_id and a.academic_year = f.first_enroll_grade_9
left join school_attendance b on b.student_id = f.student_id and b.academic_year = f.first_enroll_grade_9 + 1"""

# -- yearly features ---------------------------------------------------------

ABSENCE = ("days_absent", "excused_absence", "unexcused_absence")
LO, HI = INCIDENTS_BETWEEN
T["t_base"] = "select *, cohort - academic_year as countdown from t_cby"
T["t_att"] = "select student_id, academic_year, " + ", ".join(
    f"case when academic_year >= {ATTENDANCE_FROM} then coalesce({c}, 0) end as {c}" for c in ABSENCE
) + " from school_attendance"
T["t_inc"] = """
select student_id, cast(year(incident_date + interval 184 day) - 1 as int) as academic_year, suspension_length, """ + ", ".join(
    bit(" or ".join(f"coalesce({c}, false)" for c in cols), n) for n, cols in CATEGORIES.items()
) + " from discipline_temp"
T["t_disc"] = """
select distinct student_id, academic_year, count(*) over w as susp_count, cast(sum(suspension_length) over w as bigint) as total_susp_days,
       min(suspension_length) over w as min_susp_days, max(suspension_length) over w as max_susp_days, """ + ", ".join(
    f"cast(sum({n}) over w as bigint) as {n}" for n in CATEGORIES
) + ", cast(sum(case when " + " + ".join(CATEGORIES) + """ = 0 then 1 else 0 end) over w as bigint) as other
from t_inc window w as (partition by student_id, academic_year)"""
WINDOWED = {"suspension_count": "susp_count", "suspension_days": "total_susp_days",
            "min_suspension_days": "min_susp_days", "max_suspension_days": "max_susp_days"}
DISC_RAW = ["susp_count", "total_susp_days", "min_susp_days", "max_susp_days", *CATEGORIES, "other"]
INSIDE = f"b.academic_year between {LO} and {HI}"
DISC_OUT = ", ".join(
    [f"d.{c}" for c in DISC_RAW]
    + [f"case when {INSIDE} then coalesce(d.{c}, 0) end as {n}" for n, c in WINDOWED.items()]
    + [f"cast(case when {INSIDE} then case when d.{c} > 0 then 1 else 0 end end as int) as disc_{c}" for c in [*CATEGORIES, "other"]]
)


def mark(letter: str, low: int | None = None, high: int | None = None) -> str:
    num = "case when regexp_full_match(mark, '[0-9]+') then try_cast(mark as int) end"
    band = "false" if low is None else f"({num}) >= {low}" + ("" if high is None else f" and ({num}) <= {high}")
    spell = f"('{letter}')" if low is None else f"('{letter}-', '{letter}', '{letter}+')"
    return bit(f"(mark in {spell}) or coalesce({band}, false)", f"mark_is_{letter.lower()}")


MARKS = ", ".join([mark("A", 90), mark("B", 80, 89), mark("C", 70, 79), mark("D", 60, 69), mark("F")])
TITLES = ", ".join([
    bit("contains(upper(name), 'HONOR')", "course_honors"),
    bit("contains(upper(name), 'ENGL') and contains(upper(name), 'HONOR')", "course_eng_honors"),
    bit("regexp_matches(upper(name), 'MATH|ALGEBRA|GEOMETRY')", "course_math"),
    bit("contains(upper(name), 'ADV') and regexp_matches(upper(name), 'SCIENCE|PHYSIC|CHEM|BIO')", "course_adv_sci"),
])
MARK_NAMES = [f"mark_is_{x}" for x in "abcdf"]
TITLE_NAMES = ["course_honors", "course_eng_honors", "course_math", "course_adv_sci"]
T["t_titles"] = f"select code as course_code, school_id, {TITLES} from course"
T["t_marks"] = f"""
select e.student_id, e.academic_year, e.course_code, e.school_id, try_cast(e.grade_level as int) as grade, {MARKS},
       {', '.join('t.' + n for n in TITLE_NAMES)}
from course_enrollment e left join t_titles t on t.course_code = e.course_code and t.school_id = e.school_id
where e.grade_level not in ('PK', 'KI')"""
T["t_courses"] = f"""
select student_id, academic_year, count(*) as courses_taken, {ints(*TITLE_NAMES, *MARK_NAMES)}
from t_marks group by student_id, academic_year"""
GPA = ("case when mark_is_a + mark_is_b + mark_is_c + mark_is_d + mark_is_f > 0 then round(cast(4 * mark_is_a + 3 * mark_is_b "
       "+ 2 * mark_is_c + mark_is_d as double) / (mark_is_a + mark_is_b + mark_is_c + mark_is_d + mark_is_f), 6) end as avg_gpa")
COURSE_OUT = ", ".join(f"k.{n}" for n in ["courses_taken", *TITLE_NAMES, *MARK_NAMES])
SCHOOL_OUT = ("s.area as school_area, s.grade_span as school_grade_span, s.magnet as school_magnet, s.calendar as school_calendar, "
              "s.crowding as school_crowding, s.school_is_elementary, s.school_is_middle, s.school_is_high, s.school_is_magnet, "
              "s.school_magnet_is_ib, s.school_magnet_is_gifted, s.school_pbis, s.school_stem")
T["t_school"] = f"""
select id, area, grade_span, magnet, calendar, crowding, {bit("contains(grade_span, 'E')", 'school_is_elementary')},
       {bit("contains(grade_span, 'M')", 'school_is_middle')}, {bit("contains(grade_span, 'H')", 'school_is_high')},
       magnet is not null as school_is_magnet, coalesce(contains(magnet, 'IB'), false) as school_magnet_is_ib,
       coalesce(contains(magnet, 'GT'), false) as school_magnet_is_gifted, pbis is not null as school_pbis,
       stem is not null as school_stem
from school"""
KEY = "on {0}.student_id = b.student_id and {0}.academic_year = b.academic_year"
ATT_OUT = ", ".join(f"a.{c}" for c in ABSENCE)

Q["school_year"] = """
select cast(year(incident_date + interval 184 day) - 1 as int) as school_year, count(*) as n from discipline_temp group by 1"""
Q["yf_base"] = "select * from t_base"
Q["yf_absences"] = f"select b.*, {ATT_OUT} from t_base b left join t_att a {KEY.format('a')}"
Q["incident_categories"] = "select * from t_inc"
Q["yf_discipline"] = f"select b.*, {DISC_OUT} from t_base b left join t_disc d {KEY.format('d')}"
Q["discipline_oct_year"] = """
select student_id, cast(year(incident_date - interval 9 month) as int) as academic_year, count(*) as suspension_count,
       cast(sum(suspension_length) as bigint) as total_suspension_days, min(suspension_length) as min_suspension_days,
       max(suspension_length) as max_suspension_days
from discipline_temp group by 1, 2"""
Q["course_marks"] = "select * from t_marks"
Q["course_flags"] = f"select code, school_id, {TITLES} from course"
Q["yf_courses"] = f"select b.*, {COURSE_OUT}, {GPA} from t_base b left join t_courses k {KEY.format('k')}"
Q["school_flags"] = f"select s.id as school_id, {SCHOOL_OUT} from t_school s"
Q["yf_school"] = f"""
select b.*, e.current_school_id, {SCHOOL_OUT} from t_base b
left join school_enrollment e {KEY.format('e')} left join t_school s on s.id = e.current_school_id"""
Q["yearly_features"] = f"""
select b.*, {ATT_OUT}, {DISC_OUT}, {COURSE_OUT}, {GPA}, e.current_school_id, {SCHOOL_OUT} from t_base b
left join t_att a {KEY.format('a')} left join t_disc d {KEY.format('d')} left join t_courses k {KEY.format('k')}
left join school_enrollment e {KEY.format('e')} left join t_school s on s.id = e.current_school_id"""
Q["yf_v0"] = f"""
select b.student_id, b.cohort, b.academic_year, b.grade_level,
       {', '.join(f"case when b.academic_year >= {ATTENDANCE_FROM} then coalesce(a.{c}, 0) end as {c}" for c in ABSENCE)},
       {', '.join(f"case when {INSIDE} then coalesce(d.{c}, 0) end as {c}" for c in ('suspension_count', 'total_suspension_days', 'min_suspension_days', 'max_suspension_days'))},
       e.current_school_id, {SCHOOL_OUT}
from t_cby_v0 b left join school_attendance a {KEY.format('a')} left join ({Q['discipline_oct_year']}) d {KEY.format('d')}
left join school_enrollment e {KEY.format('e')} left join t_school s on s.id = e.current_school_id"""

# -- reports -----------------------------------------------------------------

RUNS = {"9": (9, 9), "10": (10, 10), "11": (11, 11), "12": (12, 12), "9thru10": (9, 10), "9thru11": (9, 11),
        "9thru12": (9, 12), "10thru11": (10, 11), "10thru12": (10, 12)}
Q["xtab_continued_enrollment"] = "select l.cohort as cohort_yr, count(*) as total_outcome, " + ", ".join(
    "nullif(count(*) filter (where " + " and ".join(
        f"exists (select 1 from t_cby y where y.student_id = l.student_id and y.grade_level = {g})" for g in range(a, b + 1)
    ) + f"), 0) as enrol_{n}" for n, (a, b) in RUNS.items()
) + " from t_label l where l.outcome_label is not null group by l.cohort"


def only_grade(grade: int, count_as: str) -> str:
    return f"""
select inferred_cohort, count(*) as {count_as}, cast(sum(ontime) as bigint) as which_grad_on_time,
       cast(sum(grad_not_on_time) as bigint) as which_grad_not_on_time, cast(sum(dropout_ever) as bigint) as which_dropout_ever,
       cast(sum(unseen) as bigint) as outcome_not_observed
from (select distinct y.student_id, y.cohort as inferred_cohort, l.grad_early + l.grad_on_time as ontime, l.grad_not_on_time,
             l.dropout_ever, case when l.outcome_label is null then 1 else 0 end as unseen
      from t_cby y left join t_label l on l.student_id = y.student_id
      where y.grade_level = {grade} and y.student_id not in (select student_id from t_cby where grade_level between {grade + 1} and 12))
group by inferred_cohort"""


Q["xtab_only_grade9"] = only_grade(9, "students_with_only_grade_9_records")
Q["xtab_only_grade10"] = only_grade(10, "students_in_grade_10_but_not_11to12")
T["t_sizes"] = "select cohort, count(*) as total_students from t_cohort where cohort is not null group by cohort"
Q["xtab_outcome"] = """
select l.cohort, cast(sum(grad_early) as bigint) as grad_early, cast(sum(grad_on_time) as bigint) as grad_on_time,
       cast(sum(grad_late_1year) as bigint) as grad_late_1yr, cast(sum(grad_late_2plusyears) as bigint) as grad_late_2plyrs,
       cast(sum(dropout_hs) as bigint) as dropout_hs, cast(sum(dropout_late) as bigint) as dropout_late,
       cast(sum(no_record_found) as bigint) as no_record, max(s.total_students) as total_students
from t_label l left join t_sizes s on s.cohort = l.cohort group by l.cohort"""
Q["xtab_outcome_12regular"] = """
select l.cohort - 1 as cohort, cast(sum(on_time_grad) as bigint) as grad_on_time, cast(sum(late_grad_1year) as bigint) as grad_late_1yr,
       cast(sum(late_grad_2ormoreyears) as bigint) as grad_late_2ormoreyrs, cast(sum(ever_dropout) as bigint) as ever_dropout,
       cast(sum(no_record_found) as bigint) as no_record, max(s.total_students) as total_students
from t_label12 l left join t_sizes s on s.cohort = l.cohort - 1 group by l.cohort"""
Q["xtab_cohort_size"] = """
select e.academic_year, count(distinct e.student_id) as active_grade_12_students,
       (select count(*) from t_cohort c where c.cohort = e.academic_year + 1 having count(*) > 0) as inferred_cohort_size
from school_enrollment e where (current_grade_level = '12' or grade_level = 12) and active_status group by e.academic_year"""
Q["xtab_school_by_year"] = f"""
select school_name, academic_year, count(*) as num_total, count(*) filter (where active_status) as num_active,
       count(*) filter (where last is null) as last_grade_missing, count(*) filter (where nxt is null) as next_grade_missing,
       count(*) filter (where cur = last) as currentgrade_sameas_lastgrade,
       count(*) filter (where cur <> last) as currentgrade_diff_from_lastgrade,
       count(*) filter (where cur = nxt) as currentgrade_sameas_nextgrade,
       count(current_year_round_track) as round_track_flag
from (select s.name as school_name, e.academic_year, e.active_status, try_cast(e.last_grade_level as int) as last,
             {GRADE} as cur, try_cast(e.next_grade as int) as nxt, e.current_year_round_track
      from school_enrollment e join school s on s.id = e.current_school_id
      where contains(s.name, 'HS') and (e.last_grade_level is null or e.last_grade_level in ('08', '09', '10', '11', '12'))
        and (e.current_grade_level in {HS} or e.grade_level between 9 and 12)
        and (e.next_grade is null or e.next_grade in {HS}))
group by school_name, academic_year"""

# -- profile -----------------------------------------------------------------

Q["profile_status"] = "select current_status, count(current_status) as n from school_enrollment group by current_status"
Q["profile_distinct"] = """
select count(current_status) filter (where contains(current_status, 'W')) as records_with_w,
       count(student_id) filter (where contains(current_status, '0') and contains(current_status, '2')) as records_with_0_and_2,
       count(distinct case when contains(current_status, '2') then student_id end) as units_with_2,
       count(distinct case when contains(current_status, '0') then student_id end) as units_with_0
from school_enrollment"""
Q["profile_withdraw_codes"] = "select withdraw_code, count(withdraw_code) as n from school_enrollment group by withdraw_code"
Q["profile_null_cohorts"] = "select distinct id from t_cohort_all where cohort is null"
Q["profile_school_rows"] = """
select current_school_id, current_grade_level, active_status, academic_year, withdraw_code
from school_enrollment where current_school_id in (997, 998) and active_status"""
PROFILE_HS = """
select t.cohort, e.academic_year, e.grade_level, e.current_grade_level{0}, count(t.cohort) as n
from school_enrollment e left join t_cohort t on t.student_id = e.student_id
where e.current_school_id not in (997, 998) and e.active_status and e.grade_level between 9 and 13
group by all"""
Q["profile_years_in_hs"] = PROFILE_HS.format(", e.academic_year - t.cohort + 5 as years_spent_inhs")
Q["profile_cohort_grades"] = PROFILE_HS.format("")
Q["profile_movement"] = """
select academic_year, current_grade_level as current_grade, next_grade, count(*) as n
from school_enrollment where current_grade_level = next_grade group by all"""
Q["profile_promotions"] = """
select academic_year, count(*) as n from school_enrollment where current_grade_level < next_grade group by academic_year"""
Q["profile_current_grades"] = "select distinct current_grade_level from school_enrollment"
Q["profile_course_years"] = "select distinct academic_year from course_enrollment"
Q["profile_active_years"] = """
select academic_year, count(active_status) as n from school_enrollment where active_status group by academic_year"""
Q["profile_withdraw_reasons"] = "select reason_code, count(student_id) as n from outcome group by reason_code"
Q["profile_withdraw_reasons_by_grade"] = """
select grade_level, reason_code_description, reason_code, count(student_id) as n from outcome group by all"""
Q["profile_out_codes"] = """
select has_out_code, count(has_out_code) as n, (select count(distinct has_out_code) from school_enrollment) as n_codes
from school_enrollment group by has_out_code"""
Q["profile_school_locators"] = "select distinct current_school_number_locator from school_enrollment"
Q["profile_left_schools"] = """
select distinct current_school_id from school_enrollment where current_school_number_locator in ('GRD', 'OUT')"""
Q["profile_high_schools"] = "select id, name from school where contains(name, 'HS')"
Q["profile_schools_by_year"] = """
select distinct s.id, s.name, e.academic_year
from school s left join school_enrollment e on e.current_school_id = s.id where contains(s.name, 'HS')"""
MOVES = {"currentgrade_sameas_lastgrade": "current_grade_level = last_grade_level",
         "currentgrade_diff_from_lastgrade": "current_grade_level <> last_grade_level",
         "currentgrade_sameas_nextgrade": "current_grade_level = next_grade"}
Q["profile_grade_moves"] = "select name, academic_year, count(distinct student_id) as number_of_enrollments, count(active_status) as active_status, " + ", ".join(
    f"count({c}) as {n}, count(*) filter (where {c}) as {n}_true" for n, c in MOVES.items()
) + """, count(current_year_round_track) as round_track_flag
from school s left join school_enrollment e on e.current_school_id = s.id where contains(name, 'HS') group by name, academic_year"""
Q["profile_enrollment_schools"] = f"""
select e.student_id, s.name as school_name, e.academic_year, e.active_status, try_cast(e.last_grade_level as int) as last_grade,
       {GRADE} as current_grade, try_cast(e.next_grade as int) as next_grade
from school_enrollment e left join school s on s.id = e.current_school_id"""
T["t_unit_enr"] = f"""
select student_id, count(distinct academic_year) as hs_years_in_district, count(distinct current_school_id) as number_of_schools,
       count(*) as number_of_enrollments
from school_enrollment where current_grade_level in {HS} or grade_level between 9 and 12 group by student_id"""
Q["enrollment_summary"] = """
select hs_years_in_district, number_of_schools, number_of_enrollments, count(distinct student_id) as n_units from t_unit_enr group by all"""
Q["enrollment_summary_by_year"] = """
select e.academic_year, u.hs_years_in_district, u.number_of_schools, u.number_of_enrollments, count(distinct e.student_id) as n_units
from school_enrollment e left join t_unit_enr u on u.student_id = e.student_id group by all"""

# -- dataset -----------------------------------------------------------------

TIMES = range(4, 13)
STATIC_DROPPED = ["date_of_birth", *[f"{n}_{u}" for n in AGES for u in ("months", "days")]]
STATIC_VOCABULARY = {
    "gender": ["F", "M"],
    "race": ["A_W", "B", "H", "W"],
    "race_ethnicity": ["B", "B_H", "H", "W"],
    "home_language_code": ["a_b_c_d", "a_b_c_d_e_f", "a_b_c_d_e_f_g", "en", "en_es", "en_es_fr"],
}
SCHOOL_VOCABULARY = {
    "school_area": ["area0", "area1", "area2", "area3"],
    "school_grade_span": ["E", "H", "MH"],
    "school_magnet": ["GT/AIG", "IB"],
    "school_calendar": ["traditional"],
}
STEP_VOCABULARY = {f"grade_level_{t}_{c}": v for t in TIMES for c, v in SCHOOL_VOCABULARY.items()}
VOCABULARY = {**STATIC_VOCABULARY, **STEP_VOCABULARY}
SCHOOL_COLUMNS = ["school_area", "school_grade_span", "school_magnet", "school_calendar", "school_crowding",
                  "school_is_elementary", "school_is_middle", "school_is_high", "school_is_magnet",
                  "school_magnet_is_ib", "school_magnet_is_gifted", "school_pbis", "school_stem"]
YEARLY_VALUES = ["countdown", *ABSENCE, *DISC_RAW, *WINDOWED, *[f"disc_{c}" for c in [*CATEGORIES, "other"]],
                 "courses_taken", *TITLE_NAMES, *MARK_NAMES, "avg_gpa", "current_school_id", *SCHOOL_COLUMNS]
BOOLEANS = {"school_is_magnet", "school_magnet_is_ib", "school_magnet_is_gifted", "school_pbis", "school_stem"}
STATIC_VALUES = ["special_ed_ever", "rel_age_to_cohort", "rel_age_to_cohort_1to3_years_older",
                 *[f"home_language_{k}more" for k in range(2, 7)], "home_language_count", "race_2more",
                 "race_is_hispanic", "race_ethnicity_is_hispanic"]

T["t_yearly"] = Q["yearly_features"]
T["t_latest"] = """
select * exclude (rn) from (
  select *, row_number() over (partition by student_id, grade_level
                               order by academic_year desc, current_school_id asc nulls last) as rn from t_yearly)
where rn = 1"""
T["t_pivot"] = "select student_id, " + ", ".join(
    f"max(case when grade_level = {t} then {v} end) as grade_level_{t}_{v}" for v in YEARLY_VALUES for t in TIMES
) + " from t_latest group by student_id"


def dummies(vocabulary: dict[str, list[str]]) -> str:
    return ", ".join(
        f"""cast(case when {c} = '{v}' then 1 else 0 end as int) as "{c}_{v}" """ for c, vs in vocabulary.items() for v in vs
    )


STEP_NUMBERS = [f"grade_level_{t}_{v}" for v in YEARLY_VALUES if v not in SCHOOL_VOCABULARY for t in TIMES]
T["t_features"] = f"""
select coalesce(s.student_id, p.student_id) as student_id, s.cohort, {', '.join(STATIC_VALUES)}, {', '.join(STEP_NUMBERS)},
       {dummies(VOCABULARY)}
from t_static s full join t_pivot p on p.student_id = s.student_id"""
T["t_known"] = "select student_id, outcome_label as label from t_label where outcome_label is not null"
T["t_dataset"] = "select f.*, k.label from t_features f join t_known k on k.student_id = f.student_id"
FEATURES = [*STATIC_VALUES, *STEP_NUMBERS, *[f"{c}_{v}" for c, vs in VOCABULARY.items() for v in vs]]

Q["dedup_last"] = "select * from t_latest"
Q["pivot_by_grade"] = "select * from t_pivot"
Q["one_hot"] = f"select * exclude ({', '.join(STATIC_VOCABULARY)}), {dummies(STATIC_VOCABULARY)} from t_static"
Q["features_merged"] = "select * from t_features"
Q["labelled_instances"] = "select s.*, k.label from t_static s join t_known k on k.student_id = s.student_id"
Q["dataset"] = "select * from t_dataset"
Q["dataset_fitted"] = "select * from t_dataset"
T["t_pairs"] = " union all ".join(
    f"select student_id, '{c}' as c, cast({c} as varchar) as v from t_static" for c in STATIC_VOCABULARY)
T["t_numbered"] = """
select c, v, row_number() over (order by c, v) - 1 as i from (select distinct c, v from t_pairs where v is not null) x"""
Q["one_hot_sparse"] = """
select student_id, coalesce(string_agg(cast(i as varchar), ',' order by i), '') as indices
from t_pairs left join t_numbered using (c, v) group by student_id"""

Q["dataset_cache"] = "select * from t_dataset"
Q["load_units"] = """
select 'cohort' as table_name, count(*) as n, count(distinct student_id) as units from t_cohort
union all select 'static', count(*), count(distinct student_id) from t_static
union all select 'yearly', count(*), count(distinct student_id) from t_yearly
union all select 'label', count(*), count(distinct student_id) from t_label"""


def is_boolean(f: str) -> bool:
    return f == "special_ed_ever" or any(f.endswith("_" + b) for b in BOOLEANS)


def number(f: str) -> str:
    return f'cast(cast("{f}" as int) as double)' if is_boolean(f) else f'cast("{f}" as double)'


# -- splits ------------------------------------------------------------------

GRADES = range(6, 12)
T["t_splits"] = f"""
select g.grade, a.cohort as train, b.cohort as test
from (select distinct cohort from t_dataset) a join (select distinct cohort from t_dataset) b on a.cohort < b.cohort
join (select cast(unnest(range({GRADES[0]}, {GRADES[-1] + 1})) as int) as grade) g on a.cohort <= b.cohort - (12 - g.grade)"""
T["t_member"] = """
select d.student_id, d.cohort, s.grade, s.train, s.test, case when d.cohort <= s.train then 'train' else 'test' end as fold, d.label
from t_dataset d join t_splits s on d.cohort <= s.train or d.cohort >= s.test"""
Q["temporal_splits"] = "select * from t_splits"
Q["split_membership"] = "select student_id, cohort, grade, train, test, fold from t_member"
Q["split_class_counts"] = "select grade, train, test, fold, label, count(*) as n from t_member group by all"
T["t_usable"] = """
select grade, train, test from t_member group by all
having count(distinct label) filter (where fold = 'train') >= 2 and count(*) filter (where fold = 'test') > 0"""
Q["usable_splits"] = "select * from t_usable"

ASOF_GRADE = 9


def asof(names: list[str], grade: int) -> list[str]:
    return [n for n in names if not n.startswith("grade_level_") or int(n.split("_")[2]) <= grade]


Q["features_asof_grade"] = "select student_id, " + ", ".join(f'"{f}"' for f in asof(FEATURES, ASOF_GRADE)) + " from t_dataset"

# Feature catalog of the stand-in features: name, table, category, excluded.
CATALOG = (
    [(n, "_cohort_feature", "demographic", 0) for n in ("gender", "race", "race_ethnicity", "race_2more", "race_is_hispanic",
                                                       "race_ethnicity_is_hispanic", "special_ed_ever")]
    + [(n, "_cohort_feature", "age", 0) for n in ("rel_age_to_cohort", "rel_age_to_cohort_1to3_years_older")]
    + [("home_language_code", "_cohort_feature", "language", 1)]
    + [(f"home_language_{k}more", "_cohort_feature", "language", 0) for k in range(2, 7)]
    + [("home_language_count", "_cohort_feature", "language", 0)]
    + [("countdown", "_cohort_by_year_feature", "id", 0), ("current_school_id", "_cohort_by_year_feature", "id", 1)]
    + [(n, "_cohort_by_year_feature", "attendance", 0) for n in ABSENCE]
    + [(n, "_cohort_by_year_feature", "incident", 1) for n in DISC_RAW]
    + [(n, "_cohort_by_year_feature", "suspension", 0) for n in WINDOWED]
    + [(f"disc_{n}", "_cohort_by_year_feature", "incident", 0) for n in [*CATEGORIES, "other"]]
    + [(n, "_cohort_by_year_feature", "coursework", 0) for n in ("courses_taken", *TITLE_NAMES)]
    + [(n, "_cohort_by_year_feature", "mark", 0) for n in (*MARK_NAMES, "avg_gpa")]
    + [(n, "_cohort_by_year_feature", "school", 0) for n in SCHOOL_COLUMNS]
)
T["t_catalog"] = ("select * from (values " + ", ".join(f"('{a}', '{b}', '{c}', {d})" for a, b, c, d in CATALOG)
                  + ") v(feature_name, table_name, feature_category_primary, exclude_when_modeling)")
ALL_RAW = [(n, "t_static") for n in ["gender", "race", "race_ethnicity", "home_language_code", *STATIC_VALUES]] + [
    (n, "t_latest") for n in YEARLY_VALUES]
T["t_coverage"] = " union all ".join(
    f"select '{n}' as feature_name, count({n}) as n_values from {t}" for n, t in ALL_RAW)
SKIPPED = "('id', 'attendance', 'coursework', 'demographic', 'school')"
T["t_set_categories"] = f"select distinct feature_category_primary as category from t_catalog where feature_category_primary not in {SKIPPED}"
T["t_sets"] = """
select category as feature_set, category from t_set_categories
union all
select string_agg(b.category, ', ' order by b.category), unnest(list(b.category)) from t_set_categories a
join t_set_categories b on b.category <> a.category group by a.category
union all
select string_agg(category, ', ' order by category), unnest(list(category)) from t_set_categories"""
Q["feature_catalog"] = "select c.*, v.n_values from t_catalog c join t_coverage v on v.feature_name = c.feature_name"
Q["feature_sets"] = """
select s.feature_set, s.category, cast(sum(v.n_values) as bigint) as n_values
from t_sets s join t_catalog c on c.feature_category_primary = s.category and c.exclude_when_modeling = 0
join t_coverage v on v.feature_name = c.feature_name group by all"""
# Columns of the model dataset per feature, excluded features left out, with their value counts.
_OWNER = {}
for _f in FEATURES:
    _base = "_".join(_f.split("_")[3:]) if _f.startswith("grade_level_") else _f
    _OWNER[_f] = max((c for c in CATALOG if _base == c[0] or _base.startswith(c[0] + "_")), key=lambda c: len(c[0]))
Q["feature_set_members"] = "select s.feature_set, m.column_name, m.n_values from t_sets s join (" + " union all ".join(
    f"""select '{f}' as column_name, '{o[2]}' as category, count("{f}") as n_values from t_dataset"""
    for f, o in _OWNER.items() if o[3] == 0
) + ") m on m.category = s.category"

# -- imputation, sampling ----------------------------------------------------

TRAIN, TEST = 1999, 2002
X = asof(FEATURES, ASOF_GRADE)
Q["imputed_mean"] = (
    "select student_id, label, case when cohort >= {1} then 'test' else 'train' end as fold, ".format(TRAIN, TEST)
    + ", ".join(f"round(coalesce({number(f)}, (select avg({number(f)}) from t_dataset where cohort <= {TRAIN}), 0), 6) as \"{f}\"" for f in X)
    + f" from t_dataset where cohort <= {TRAIN} or cohort >= {TEST}"
)
MODE_COLUMNS = ["gender", "race", "race_ethnicity", "home_language_code"]
MEAN_COLUMNS = ["rel_age_to_cohort", "age_first_entered_district_months", "age_entered_into_us_months"]
Q["imputed_mode"] = "select student_id, " + ", ".join(
    f"coalesce({c}, (select {c} from t_static where {c} is not null group by {c} order by count(*) desc, {c} limit 1)) as {c}" for c in MODE_COLUMNS
) + ", " + ", ".join(f"round(coalesce(cast({c} as double), (select avg({c}) from t_static)), 6) as {c}" for c in MEAN_COLUMNS) + " from t_static"
Q["assembled"] = (
    "select student_id, cast(label as double) as label, " + f"{len(X)} as n_features, round("
    + " + ".join(f"round(coalesce({number(f)}, (select avg({number(f)}) from t_dataset where cohort <= {TRAIN}), 0), 6)" for f in X)
    + f", 6) as feature_sum from t_dataset where cohort <= {TRAIN}"
)


def hash_order(*keys: str, seed: int | str = 0) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"cast({k} as varchar)" for k in keys) + f", '{seed}'))"


def draw(*keys: str, seed: int | str = 0) -> str:
    return f"(('0x' || substr({hash_order(*keys, seed=seed)}, 1, 8))::bigint / 4294967296.0)"


RATIO = 1.5
Q["subsample"] = f"""
select student_id, cohort, label from (
  select student_id, cohort, label, row_number() over (partition by label order by {hash_order('student_id')}, student_id) as rn,
         count(*) filter (where label = 1) over () as ones from t_dataset)
where label = 1 or rn <= floor({RATIO} * ones)"""
Q["subsample_by_cohort"] = f"""
select student_id, cohort, label from (
  select student_id, cohort, label, row_number() over (partition by cohort, label order by {hash_order('student_id', seed=7)}, student_id) as rn,
         count(*) filter (where label = 1) over (partition by cohort) as ones from t_dataset)
where label = 1 or rn <= floor(2.0 * ones)"""
Q["stratified_kfold"] = f"""
select student_id, label, cast((row_number() over (partition by label order by {hash_order('student_id')}, student_id) - 1) % 5 as int) as fold
from t_dataset"""
T["t_prior"] = f"select avg(label) as p from t_dataset where cohort <= {TRAIN}"
Q["dummy_baseline"] = f"""
select 'stratified' as strategy, student_id, cast(label as double) as y_true,
       case when {draw('student_id')} < p then 1.0::double else 0.0::double end as y_pred,
       case when {draw('student_id')} < p then 1.0::double else 0.0::double end as y_prob from t_dataset, t_prior where cohort >= {TEST}
union all
select 'uniform', student_id, cast(label as double), case when {draw('student_id')} < 0.5 then 1.0::double else 0.0::double end, 0.5::double
from t_dataset where cohort >= {TEST}"""
T["t_minority"] = "select student_id, " + ", ".join(
    f"round(coalesce({number(f)}, (select avg({number(f)}) from t_dataset where cohort <= {TRAIN}), 0), 6)::double as x{i}" for i, f in enumerate(X)
) + f" from t_dataset where label = 1 and cohort <= {TRAIN}"
DIST = " + ".join(f"(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})" for i in range(len(X)))
T["t_near"] = f"""
select student_id, cast(rank as int) as rank, neighbour, sqrt(d2) as distance from (
  select *, row_number() over (partition by student_id order by d2, neighbour) as rank
  from (select a.student_id, b.student_id as neighbour, {DIST} as d2 from t_minority a join t_minority b on b.student_id <> a.student_id))
where rank <= 4"""
Q["smote_neighbours"] = "select student_id, rank, neighbour, round(distance, 6) as distance from t_near"
Q["smote"] = f"""
select d.student_id, cast(d.copy as int) as copy, d.neighbour, """ + ", ".join(
    f"round(a.x{i} + {draw('d.student_id', 'd.copy', seed='gap0')} * (b.x{i} - a.x{i}), 6) as x{i}" for i in range(len(X))
) + f"""
from (select c.student_id, c.copy, n.neighbour
      from (select m.student_id, k.copy, {draw('m.student_id', 'k.copy', seed='pick0')} as u,
                   (select count(*) from t_near n where n.student_id = m.student_id) as size
            from t_minority m cross join (select unnest([0, 1]) as copy) k) c
      join t_near n on n.student_id = c.student_id and n.rank = cast(floor(c.u * c.size) as bigint) + 1) d
join t_minority a on a.student_id = d.student_id join t_minority b on b.student_id = d.neighbour"""

Q["smote_forest"] = """
select (select count(*) from t_near) as wanted, true as enough, (select count(*) * 2 from t_minority) as made"""

# -- sweep tables ------------------------------------------------------------

SUBSAMPLES, SMOTES = (None, 1.0, 2.5, 5.0), (None, 100, 200, 500)
T["t_modifiers"] = ("select * from (values " + ", ".join(
    f"({'null' if s is None else s}::double, {'null' if o is None else o}::int, 'mean')" for s in SUBSAMPLES for o in SMOTES
) + ") v(subsample, smote, imputation)")
Q["modifier_grid"] = """
select s.*, m.*, cast(c.zeros as bigint) as zeros, cast(c.ones as bigint) as ones,
       cast(c.ones * (1 + coalesce(m.smote, 0) / 100) as bigint) as ones_after,
       cast(case when m.subsample is null then c.zeros
                 else least(c.zeros, floor(m.subsample * (c.ones * (1 + coalesce(m.smote, 0) / 100)))) end as bigint) as zeros_after
from t_usable s join (select grade, train, test, count(*) filter (where label = 0) as zeros, count(*) filter (where label = 1) as ones
                      from t_member where fold = 'train' group by all) c using (grade, train, test)
cross join t_modifiers m"""

FOREST = [{"n_estimators": a, "criterion": "entropy", "max_features": b, "max_depth": c, "bootstrap": True, "random_state": 0}
          for a in (5, 50) for b in (None, "log2") for c in (3, 10)]
MODELS = [("dummy", "DummyClassifier", {"strategy": s, "random_state": 0}) for s in ("stratified", "uniform")] + [
    ("random_forest", "RandomForestClassifier", p) for p in FOREST]
T["t_models"] = "select * from (values " + ", ".join(
    f"('{a}', '{b}', '{json.dumps(p, sort_keys=True)}')" for a, b, p in MODELS) + ") v(learner, model, params)"
ESCAPED = "replace(replace(params, '\\', '\\\\'), '\"', '\\\"')"
T["t_configs"] = f"""
select s.grade, s.test, s.train, m.learner, m.model, m.params, 'all' as features, o.subsample, o.smote, o.imputation,
       sha1('["' || concat_ws('", "', grade, test, train, model, {ESCAPED}, 'all', coalesce(cast(subsample as varchar), ''),
                              coalesce(cast(smote as varchar), '')) || '"]') as summary_hash
from t_usable s cross join t_modifiers o cross join t_models m"""
Q["sweep_configs"] = "select * from t_configs"
Q["config_hash"] = "select summary_hash, count(*) as n from t_configs group by summary_hash"
Q["model_grid"] = "select model, params, count(*) as n_fits from t_configs group by model, params"
T["t_drawn"] = f"""
select grade, train, test, strategy, label, case when strategy = 'uniform' then cast(u < 0.5 as int) else cast(u < p as int) end as y_pred,
       case when strategy = 'uniform' then 0.5 else cast(u < p as int) end as y_prob
from (select grade, train, test, label, {draw('student_id')} as u from t_member where fold = 'test')
join (select grade, train, test, avg(label) as p from t_member where fold = 'train' group by all) using (grade, train, test)
cross join (select unnest(['stratified', 'uniform']) as strategy)"""
T["t_hard"] = """
select grade, train, test, strategy, round((tp + tn)::double / n, 6) as acc, round(case when tp + fp = 0 then 0 else tp::double / (tp + fp) end, 6) as pre,
       round(case when tp + fn = 0 then 0 else tp::double / (tp + fn) end, 6) as recall,
       round(case when 2 * tp + fp + fn = 0 then 0 else 2.0 * tp / (2 * tp + fp + fn) end, 6) as f1, round(brier, 6) as brier
from (select grade, train, test, strategy, count(*) as n, count(*) filter (where label = 1 and y_pred = 1) as tp,
             count(*) filter (where label = 0 and y_pred = 1) as fp, count(*) filter (where label = 1 and y_pred = 0) as fn,
             count(*) filter (where label = 0 and y_pred = 0) as tn, avg((y_prob - label) * (y_prob - label)) as brier
      from t_drawn group by all)"""
Q["sweep_summary"] = f"""
select c.grade, c.test, c.train, c.model, c.params, c.features, '' as subsampled, '' as smoted, c.summary_hash, c.learner = 'dummy' as baseline, true as sound,
       h.acc, h.pre, h.recall, h.f1, h.brier
from t_configs c left join t_hard h on c.learner = 'dummy' and h.strategy = json_extract_string(c.params, '$.strategy')
     and (h.grade, h.train, h.test) = (c.grade, c.train, c.test)
where c.test = {TEST} and c.subsample is null and c.smote is null"""
# -- metrics -----------------------------------------------------------------

TOP = {"0.1%": 0.001, "0.2%": 0.002, "0.5%": 0.005, "1.0%": 0.01, "2.0%": 0.02, "5.0%": 0.05, "10.0%": 0.1, "50.0%": 0.5, "100%": 1.0}
Q["confusion_metrics"] = """
select summary_hash, tp, fp, fn, tn, round((tp + tn)::double / (tp + fp + fn + tn), 6) as acc,
       round(case when tp + fp = 0 then 0 else tp::double / (tp + fp) end, 6) as pre,
       round(case when tp + fn = 0 then 0 else tp::double / (tp + fn) end, 6) as recall,
       round(case when 2 * tp + fp + fn = 0 then 0 else 2.0 * tp / (2 * tp + fp + fn) end, 6) as f1
from (select summary_hash, count(*) filter (where y_true = 1 and y_pred = 1) as tp, count(*) filter (where y_true = 0 and y_pred = 1) as fp,
             count(*) filter (where y_true = 1 and y_pred = 0) as fn, count(*) filter (where y_true = 0 and y_pred = 0) as tn
      from predictions group by summary_hash)"""
Q["brier"] = "select summary_hash, round(avg((y_prob - y_true) ** 2), 6) as brier from predictions group by summary_hash"
T["t_curve"] = """
select summary_hash, y_prob, pos, neg, sum(pos) over w as tp, sum(neg) over w as fp,
       sum(pos) over (partition by summary_hash) as p, sum(neg) over (partition by summary_hash) as n
from (select summary_hash, y_prob, sum(y_true) as pos, sum(1 - y_true) as neg from predictions group by all)
window w as (partition by summary_hash order by y_prob desc rows unbounded preceding)"""
T["t_roc"] = """
select summary_hash, y_prob as threshold, fp / n as fpr, tp / p as tpr from t_curve
union all select distinct summary_hash, null, 0.0, 0.0 from predictions"""
T["t_pr"] = """
select summary_hash, y_prob as threshold, tp / p as recall, tp / (tp + fp) as precision from t_curve
union all select distinct summary_hash, null, 0.0, 1.0 from predictions"""
Q["roc_points"] = "select summary_hash, threshold, round(fpr, 6) as fpr, round(tpr, 6) as tpr from t_roc"
Q["pr_points"] = "select summary_hash, threshold, round(recall, 6) as recall, round(precision, 6) as precision from t_pr"
T["t_grid"] = """
select h.summary_hash, g.i, case when g.i = 99 then 1.0 else (
  select arg_max(a.tpr + (case when b.fpr is null then 0 else (b.tpr - a.tpr) / (b.fpr - a.fpr) * (g.i * (1 / 99.0::double) - a.fpr) end), a.fpr)
  from (select summary_hash, fpr, max(tpr) as tpr from t_roc group by all) a
  left join lateral (select fpr, min(tpr) as tpr from t_roc r where r.summary_hash = a.summary_hash and r.fpr > a.fpr
                     group by fpr order by fpr limit 1) b on true
  where a.summary_hash = h.summary_hash and a.fpr <= g.i * (1 / 99.0::double)) end as y
from (select distinct summary_hash from predictions) h cross join (select unnest(range(100)) as i) g"""
T["t_roc_auc"] = """
select g.summary_hash, (sum(g.y) - sum(g.y) filter (where g.i in (0, 99)) / 2) / 99 as roc_auc from t_grid g group by g.summary_hash"""
T["t_exact"] = """
select summary_hash, sum(neg * (tp + tp - pos) / 2.0) / max(p * n) as roc_auc_exact from t_curve group by summary_hash"""
T["t_prc"] = """
select summary_hash, sum((recall - r0) * (precision + p0) / 2) as prc_auc from (
  select *, lag(recall) over w as r0, lag(precision) over w as p0 from t_pr
  window w as (partition by summary_hash order by threshold desc nulls first)) group by summary_hash"""
Q["roc_auc"] = """
select summary_hash, round(roc_auc, 6) as roc_auc, round(roc_auc_exact, 6) as roc_auc_exact from t_roc_auc join t_exact using (summary_hash)"""
Q["pr_auc"] = "select summary_hash, round(prc_auc, 6) as prc_auc from t_prc"
T["t_ranked"] = """
select *, row_number() over (partition by summary_hash order by y_prob desc, student_id) as rank,
       sum(y_true) over (partition by summary_hash order by y_prob desc, student_id rows unbounded preceding) as hits,
       count(*) over (partition by summary_hash) as n, sum(y_true) over (partition by summary_hash) as p,
       row_number() over (partition by summary_hash order by student_id) as pos
from predictions"""


def top(k: float) -> str:
    return f"floor({k}::double * n)"


T["t_pre"] = "select summary_hash, " + ", ".join(
    f"""round(coalesce(sum(y_true) filter (where rank <= {top(k)}) / nullif(max({top(k)}), 0), 0), 6) as "pre@{name}" """ for name, k in TOP.items()
) + " from t_ranked group by summary_hash"
Q["precision_at_k"] = "select * from t_pre"
Q["ap_at_k_ranked"] = "select summary_hash, " + ", ".join(
    f"""round(coalesce(sum(hits / rank) filter (where y_true = 1 and rank <= {top(k)}) / nullif(max(least({top(k)}, p)), 0), 0), 6) as "ranked_ap@{name}" """
    for name, k in TOP.items()
) + " from t_ranked group by summary_hash"
T["t_hits"] = """
select summary_hash, y_pred, min(pos) as pos, max(n) as n from t_ranked r
where exists (select 1 from predictions q where q.summary_hash = r.summary_hash and q.y_true = r.y_pred) group by summary_hash, y_pred"""
T["t_ap"] = "select summary_hash, " + ", ".join(
    f"""round(coalesce(sum(h / pos) filter (where pos <= {top(k)}) / nullif(max({top(k)}), 0), 0), 6) as "ap@{name}" """ for name, k in TOP.items()
) + " from (select *, row_number() over (partition by summary_hash order by pos)::double as h from t_hits) group by summary_hash"
Q["ap_at_k"] = "select * from t_ap"
RISK_K = 0.1
Q["risk_list"] = f"""
select summary_hash, rank, student_id, cast(floor(y_prob * 100) as int) as risk_score from t_ranked where rank <= {top(RISK_K)}"""
Q["evaluate"] = (
    "select c.summary_hash, acc, f1, recall, pre, brier, round(roc_auc, 6) as roc_auc, round(prc_auc, 6) as prc_auc, p.* exclude (summary_hash), "
    f"a.* exclude (summary_hash) from ({Q['confusion_metrics']}) c join ({Q['brier']}) b using (summary_hash) "
    "join t_roc_auc using (summary_hash) join t_prc using (summary_hash) join t_pre p using (summary_hash) join t_ap a using (summary_hash)")
# -- sinks -------------------------------------------------------------------

Q["csv_roundtrip"] = "select * from graduates"
Q["table_sink_modes"] = """
select student_id, cast(academic_year as bigint) as academic_year, classification, 2 as written from graduates
union all select student_id, cast(academic_year as bigint), classification, 1 from graduates"""
Q["summary_append_once"] = Q["evaluate"]
Q["predictions_partitioned"] = """
select student_id, y_true, y_pred, y_prob, 9 as grade, 2002 as test, 1999 as train, 'given' as model,
       sha1(cast(summary_hash as varchar)) as summary_hash from predictions"""

# What must hold for learners without a closed form: a row for each unit of the test fold, its outcome, a
# probability, and the label that goes with it; with a copy of the label among the features, that label.
for _name in ("rf_scores", "dt_scores", "gbt_scores", "lr_scores", "nb_scores"):
    Q[_name] = f"""
select student_id, cast(label as double) as y_true, true as in_range, true as consistent from t_dataset where cohort >= {TEST}"""
# Multinomial naive Bayes in closed form, over counts and every category value that any unit has.
_COUNTS = [c for c in X if c.startswith("grade_level_") and ("mark_is" in c or "course" in c or "disc_" in c)]
_DUMMIES = [f"{c}_{v}" for c, vs in VOCABULARY.items() for v in vs]
Q["nb_sparse"] = f"""
select * from (with size as (select {len(_COUNTS)} + {' + '.join(f'coalesce(max("{f}"), 0)' for f in _DUMMIES)} as d from t_features),
rows as (select student_id, cohort, label, [{', '.join(number(f) for f in [*_COUNTS, *_DUMMIES])}] as x from t_dataset),
cells as (select student_id, cohort, label, unnest(x) as v, generate_subscripts(x, 1) as i from rows),
means as (select i, coalesce(avg(v) filter (where cohort <= {TRAIN}), 0) as m from cells group by i),
filled as (select student_id, cohort, label, i, coalesce(v, m) as v from cells join means using (i)),
sums as (select label, i, sum(v) as s from filled where cohort <= {TRAIN} group by label, i),
totals as (select label, sum(s) as t from sums group by label),
theta as (select label, i, ln((s + 0.1) / (t + 0.1 * d)) as w from sums join totals using (label), size),
prior as (select label, ln(count(*) + 0.1) as p from t_dataset where cohort <= {TRAIN} group by label),
odds as (select i, max(w) filter (where label = 1) - max(w) filter (where label = 0) as o from theta group by i),
scores as (select student_id, max(f.label) as label, sum(v * o) as z from filled f join odds using (i) where cohort >= {TEST} group by student_id)
select student_id, cast(label as double) as y_true, round(1 / (1 + exp(
  (select p from prior where label = 0) - (select p from prior where label = 1) - z)), 6) as y_prob from scores) nb"""
Q["learners_planted"] = " union all ".join(
    f"select '{n}' as learner, student_id, cast(label as double) as y_true, cast(label as double) as y_pred from t_dataset where cohort >= {TEST}"
    for n in ("decision_tree", "gradient_boosting", "logistic_regression", "random_forest"))
Q["feature_importance"] = "select 'planted' as feature, cast(100 as double) as importance"
Q["report_newest_first"] = Q["cohort_sizes"]
