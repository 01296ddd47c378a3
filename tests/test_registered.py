"""Registered queries against their SQL on the smallest test data."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import duck_rows, spark_rows
from conftest import SF

CHECKED = """
cohort label labels2 cohort_feature yf_absences yf_discipline yf_courses xtab_continued_enrollment xtab_school_by_year
profile_grade_moves split_class_counts subsample smote sweep_configs evaluate
first_enrollment cohort_by_year grad_label yf_school yearly_features dedup_last pivot_by_grade dataset dataset_fitted one_hot one_hot_sparse
imputed_mean imputed_mode smote_neighbours load_units rf_scores nb_scores learners_planted feature_importance roc_points ap_at_k risk_list
predictions_partitioned profile_out_codes profile_school_locators profile_withdraw_reasons_by_grade report_newest_first
""".split()


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, name):
    assert spark_rows(queries()[name](spark, SF)) == duck_rows(SF, oracle_sql()[name])


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
