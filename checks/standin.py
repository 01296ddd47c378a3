"""Raw district tables derived from the generated test tables.

One SQL text per table, valid in Spark SQL and in DuckDB: customers stand for
students, orders for enrollment records, line items for courses, incidents and
attendance, parts for courses, suppliers for schools, labels for a scored test set."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("customer", "supplier", "part", "orders", "lineitem", "labels")

STANDIN: dict[str, str] = {}

STANDIN["school_enrollment"] = """
with b as (select o_custkey as student_id, o_orderkey as k, o_orderstatus as st,
                  cast(year(cast(o_orderdate as date) + interval 184 day) - 1 as int) as ay
           from orders),
g as (select *, cast(6 + student_id % 4 + (ay - 1995) - (case when k % 17 = 0 then 1 else 0 end) as int) as g from b)
select student_id, ay as academic_year,
       case when k % 5 = 0 then null else g end as grade_level,
       case when g < 10 and k % 2 = 0 then concat('0', cast(g as string)) else cast(g as string) end as current_grade_level,
       case when k % 7 = 0 then null when g <= 10 then concat('0', cast(g - 1 as string)) else cast(g - 1 as string) end as last_grade_level,
       case when k % 9 = 0 then null when k % 10 = 1 then cast(g as string) else cast(g + 1 as string) end as next_grade,
       st <> 'P' as active_status,
       case when k % 97 = 0 then '2' when k % 31 = 0 then 'W' else '0' end as current_status,
       case when k % 53 = 0 then 997 else cast(k % 10 as int) end as current_school_id,
       case when k % 3 = 0 then 'T1' end as current_year_round_track,
       case when k % 97 = 0 then 'W2' end as withdraw_code,
       case when k % 97 = 0 then true when k % 4 <> 0 then false end as has_out_code,
       case when k % 53 = 0 then 'GRD' when k % 59 = 0 then 'OUT' else concat('L', cast(k % 10 as string)) end as current_school_number_locator
from g
"""

STANDIN["student"] = """
select c_custkey as id,
       case when c_custkey % 50 = 0 then null else cast(date '1985-09-01' - cast(365 * (c_custkey % 4) as int) - cast(c_custkey % 900 as int) as date) end as date_of_birth,
       case when c_custkey % 11 = 0 then null else cast(date '1990-01-15' + cast(c_custkey % 3000 as int) as date) end as date_first_entered_district,
       case when c_custkey % 6 = 0 then cast(date '1988-03-31' + cast(c_custkey % 2500 as int) as date) end as date_entered_into_us,
       case when c_custkey % 2 = 0 then 'F' else 'M' end as gender, c_mktsegment as race,
       case when c_custkey % 3 = 0 then 'en_es' else 'en' end as home_language_code
from customer
"""

STANDIN["student_fixed"] = """
select c_custkey as id, case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
       case c_custkey % 5 when 0 then 'B' when 1 then 'W' when 2 then 'H' when 3 then 'A_W' else null end as race_original,
       case c_custkey % 4 when 0 then 'H' when 1 then 'W' when 2 then 'B_H' else 'B' end as race_ethnicity,
       case c_custkey % 7 when 0 then 'en' when 1 then 'en_es' when 2 then 'en_es_fr' when 3 then 'a_b_c_d' when 4 then 'a_b_c_d_e_f' when 5 then 'a_b_c_d_e_f_g' else null end as home_language_code,
       c_custkey % 10 = 0 as special_ed_ever
from customer
"""

STANDIN["school_attendance"] = """
select o_custkey as student_id, cast(year(cast(o_orderdate as date) + interval 184 day) - 1 as int) as academic_year,
       sum(case when l_returnflag = 'R' then l_quantity end) as days_absent,
       sum(case when l_returnflag = 'A' then l_quantity end) as excused_absence,
       sum(case when l_returnflag = 'N' then l_quantity end) as unexcused_absence
from orders join lineitem on l_orderkey = o_orderkey
group by o_custkey, cast(year(cast(o_orderdate as date) + interval 184 day) - 1 as int)
"""

STANDIN["discipline_temp"] = """
select o_custkey as student_id, cast(l_shipdate as date) as incident_date, greatest(cast(l_quantity - 40 as int), 0) as suspension_length,
       case when l_partkey % 29 = 0 then null else l_partkey % 13 = 0 end as f_threat,
       l_partkey % 3 = 0 as f_fight, l_partkey % 7 = 0 as f_assault_weapon, l_partkey % 5 = 0 as f_cheating,
       l_partkey % 17 = 0 as f_gang, l_partkey % 19 = 0 as f_firearm, case when l_partkey % 23 = 0 then true end as f_drug
from orders join lineitem on l_orderkey = o_orderkey where l_returnflag = 'R'
"""

STANDIN["course_enrollment"] = """
select o_custkey as student_id, cast(year(cast(o_orderdate as date) + interval 184 day) - 1 as int) as academic_year,
       concat('C', cast(l_partkey as string)) as course_code,
       cast((l_partkey + (case when l_linenumber = 1 then 1 else 0 end)) % 10 as int) as school_id,
       case when l_linenumber = 7 then 'KI' when l_suppkey % 20 = 0 then null else cast(9 + l_linenumber % 4 as string) end as grade_level,
       case when l_linenumber % 3 = 0 then case cast(l_quantity as int) % 6 when 0 then 'A+' when 1 then 'B' when 2 then 'C-' when 3 then 'D' when 4 then 'F' else null end
            else cast(cast(l_quantity as int) + 52 as string) end as mark
from orders join lineitem on l_orderkey = o_orderkey
"""

STANDIN["course"] = """
select concat('C', cast(p_partkey as string)) as code, cast(p_partkey % 10 as int) as school_id,
       case p_partkey % 8 when 0 then 'Algebra I' when 1 then 'Honors English II' when 2 then 'Geometry Honors' when 3 then 'ADV Chemistry' when 4 then 'Biology'
            when 5 then null else p_name end as name
from part
"""

STANDIN["school"] = """
select cast(s_suppkey as int) as id, concat(s_name, case when s_suppkey % 3 = 0 then ' MS' else ' HS' end) as name,
       concat('area', cast(s_nationkey % 4 as string)) as area,
       case s_suppkey % 4 when 0 then 'H' when 1 then 'MH' when 2 then 'E' else null end as grade_span,
       case s_suppkey % 5 when 0 then 'IB' when 1 then 'GT/AIG' else null end as magnet, 'traditional' as calendar,
       case when s_suppkey % 2 = 0 then 'x' end as pbis, case when s_suppkey % 3 = 0 then 'x' end as stem, s_acctbal as crowding
from supplier
"""

STANDIN["graduates"] = """
select c_custkey as student_id,
       cast(2001 - c_custkey % 4 + (case c_custkey % 7 when 0 then 1 when 1 then 2 when 2 then -1 else 0 end) as int) as academic_year,
       case c_custkey % 6 when 0 then '12 Grade Regular Program Graduate' when 1 then '12th Grade Regular Program' when 2 then 'Certificate' else '1' end as classification
from customer
"""

STANDIN["outcome"] = """
select c_custkey as student_id,
       case when c_custkey % 40 = 3 then null else cast(date '1999-10-01' + cast(c_custkey % 1200 as int) as date) end as withdraw_date,
       case when c_custkey % 16 = 3 then 'W1' else 'W2' end as withdraw_code, cast(c_custkey % 4 as string) as reason_code,
       cast(9 + c_custkey % 5 as int) as grade_level, concat('reason ', cast(c_custkey % 4 as string)) as reason_code_description
from customer where c_acctbal < 375
"""

STANDIN["test"] = """
select c_custkey as student_id, 2000 as academic_year,
       case c_custkey % 4 when 0 then 'ACCO' when 1 then 'ACMA' when 2 then 'SAT1' else 'ACRD' end as test_id,
       cast(10 + c_custkey % 26 as double) as score
from customer
"""

STANDIN["predictions"] = """
select m as summary_hash, doc_id as student_id, y_true, p / 100.0 as y_prob,
       case when p >= 50 then cast(1 as double) else cast(0 as double) end as y_pred
from (select 1 as m, doc_id, cast(quality as double) as y_true, cast((doc_id * 32) % 101 as double) as p from labels
      union all
      select 2 as m, doc_id, cast(quality as double) as y_true, cast((doc_id * 33) % 101 as double) as p from labels) s
"""


class Tables:
    """The raw district tables over one test-data directory, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.built:
            text = STANDIN[name]
            for base in BASE_TABLES:
                if re.search(rf"\b{base}\b", text):
                    self.spark.read.parquet(f"{self.sf_dir}/{base}.parquet").createOrReplaceTempView(base)
            self.built[name] = self.spark.sql(text)
        return self.built[name]
