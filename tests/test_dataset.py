import pytest
from pyspark.sql import functions as F

from cohortline.operators import impute as I
from cohortline.operators import reshape as R
from cohortline.operators import sampling as G
from cohortline.operators import splits as V
from cohortline.operators.ranking import hash_rank, running_totals


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_dedup_keeps_the_latest_record(spark):
    df = spark.createDataFrame([(1, 9, 2005, "b"), (1, 9, 2006, "z"), (1, 9, 2006, "a"), (1, 10, None, "q")], "u int, g int, y int, v string")
    assert as_set(R.dedup_last(df, ["u", "g"], ["y"], ["v"])) == {(1, 9, 2006, "a"), (1, 10, None, "q")}


def test_pivot_and_back(spark):
    df = spark.createDataFrame([(1, 9, 1.0, "x"), (1, 10, None, "y"), (2, 10, 3.0, None)], "student_id bigint, grade_level int, v double, s string")
    wide = R.pivot_by_time(df, [9, 10])
    assert wide.columns == ["student_id", "grade_level_9_v", "grade_level_10_v", "grade_level_9_s", "grade_level_10_s"]
    assert as_set(wide) == {(1, 1.0, None, "x", "y"), (2, None, 3.0, None, None)}


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, c string")
    out = R.one_hot(df)
    assert out.columns == ["k", "c_a", "c_b"]
    assert as_set(out) == {(1, 1, 0), (2, 0, 1), (3, 0, 0)}


def test_one_hot_sparse(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, None, None)], "student_id int, c string, d string")
    assert {tuple(r) for r in R.sparse_vocabulary(df, ["c", "d"]).collect()} == {("c", "a", 0), ("c", "b", 1), ("d", "x", 2)}
    assert {(r[0], tuple(r[1])) for r in R.one_hot_sparse(df, ["c", "d"]).collect()} == {(1, (0, 2)), (2, (1,)), (3, ())}


def test_wide_plans_do_not_sort_records(spark, district):
    from cohortline.operators import cohort as K

    for df in (K.first_enrollment(district.enrollment), K.enrollment_rn_ct(district.enrollment)):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_merge_keeps_units_of_either_side(spark):
    static = spark.createDataFrame([(1, 2009, "F"), (2, 2009, "M")], "student_id bigint, cohort int, gender string")
    yearly = spark.createDataFrame([(2, 2009, 2005, 9, 5), (3, 2009, 2005, 9, 6)],
                                   "student_id bigint, cohort int, academic_year int, grade_level int, v int")
    out = R.extract_features(static, yearly, [9])
    assert as_set(out) == {(1, 2009, None, 1, 0), (2, 2009, 5, 0, 1), (3, None, 6, 0, 0)}


def test_instances_need_a_label(spark):
    features = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "student_id bigint, v int")
    labels = spark.createDataFrame([(1, 1), (2, None)], "student_id bigint, outcome_label int")
    assert as_set(R.extract_instances(features, R.labelled(labels))) == {(1, 5, 1)}


def test_mean_and_mode_imputation(spark):
    df = spark.createDataFrame([(1.0, None, "b"), (3.0, None, "a"), (None, None, None)], "x double, y double, s string")
    train, test = I.impute(df, df.where("x is null"), ["x", "y"])
    assert as_set(train.select("x", "y")) == {(1.0, 0.0), (3.0, 0.0), (2.0, 0.0)} and test.first()["x"] == 2.0
    assert I.fit_fill(df, ["x", "s"]) == {"x": 2.0, "s": "a"}
    own = I.impute(df, df.where("x = 1 or x is null"), ["x"], per_fold=True)[1]
    assert {r["x"] for r in own.collect()} == {1.0}
    with pytest.raises(ValueError):
        I.impute(df, df, ["x"], "regression")


def test_array_imputation_equals_column_imputation(spark):
    df = spark.createDataFrame([(1.0, None, True), (3.0, None, None), (None, None, False)], "x double, y double, b boolean")
    arrays = df.select(I.feature_array(["x", "y", "b"], dict(df.dtypes)).alias("features"))
    means = I.array_means(arrays, 3)
    assert means == [2.0, 0.0, 0.5]
    assert {tuple(r[0]) for r in I.fill_array(arrays, means).collect()} == {(1.0, 0.0, 1.0), (3.0, 0.0, 0.5), (2.0, 0.0, 0.0)}


@pytest.fixture(scope="module")
def instances(spark):
    return spark.createDataFrame([(i, 2000 + i % 4, int(i % 3 == 0)) for i in range(60)], "student_id bigint, cohort int, label int")


def test_splits(spark, instances):
    pairs = as_set(V.temporal_splits(instances))
    want = {(g, a, b) for g in range(6, 12) for a in range(2000, 2004) for b in range(2000, 2004) if a < b and a <= b - (12 - g)}
    assert pairs == want
    assert as_set(V.temporal_splits(instances, test_only_latest=True)) == {p for p in want if p[2] == 2003}
    assert as_set(V.temporal_splits(instances, train_only_latest=True)) == {p for p in want if p[1] == p[2] - (12 - p[0])}
    assert as_set(V.temporal_splits(instances, test_cohorts=[2005], knowledge_date=False, grades=[9])) == {(9, a, 2005) for a in range(2000, 2004)}


def test_every_unit_is_in_at_most_one_fold(instances):
    splits = V.temporal_splits(instances)
    m = V.split_membership(instances, splits)
    assert m.groupBy("student_id", "grade", "train", "test").count().where("count > 1").count() == 0
    for r in m.collect():
        assert r["cohort"] <= r["train"] if r["fold"] == "train" else r["cohort"] >= r["test"]
    counts = V.split_class_counts(instances, splits)
    assert counts.agg(F.sum("n")).first()[0] == m.count()


def test_splits_with_one_class_are_not_usable(spark):
    one = spark.createDataFrame([(1, 2000, 0), (2, 2001, 1), (3, 2004, 1)], "student_id bigint, cohort int, label int")
    assert as_set(V.usable_splits(one, V.temporal_splits(one, grades=[11]))) == {(11, 2001, 2004)}


def test_features_known_at_a_grade():
    cols = ["gender_F", "grade_level_8_x", "grade_level_10_x", "grade_level_12_x"]
    assert V.features_asof(cols, 9) == ["gender_F", "grade_level_8_x"]
    assert V.features_asof(cols, 10) == ["gender_F", "grade_level_8_x", "grade_level_10_x"]
    assert V.features_asof(cols, 12) == cols


def test_feature_sets(spark):
    rows = [("race", "t", "a", 0), ("race_2more", "t", "b", 0), ("v", "t", "c", 0), ("w", "t", "c", 1), ("z", "t", "id", 0)]
    from cohortline.sources.tables import CATALOG_SCHEMA

    catalog = spark.createDataFrame(rows, CATALOG_SCHEMA)
    sets = {}
    for s, c in as_set(V.feature_sets(catalog)):
        sets.setdefault(s, set()).add(c)
    assert sets == {"a": {"a"}, "b": {"b"}, "c": {"c"}, "a, b": {"a", "b"}, "a, c": {"a", "c"}, "b, c": {"b", "c"}, "a, b, c": {"a", "b", "c"}}
    columns = ["race_H", "race_2more", "grade_level_9_v", "grade_level_9_w", "other"]
    members = catalog.collect()
    assert V.feature_set_columns(members, columns, ["a"]) == ["race_H"]
    assert V.feature_set_columns(members, columns, ["c"]) == ["grade_level_9_v"]
    assert V.feature_set_columns(members, columns, ["all"]) == ["race_H", "race_2more", "grade_level_9_v", "other"]


def test_subsample_sizes(spark):
    df = spark.createDataFrame([(i, int(i < 3)) for i in range(13)], "student_id bigint, label int")
    for ratio, size in ((2.0, 9), (0.5, 4), (0.1, 3), (5.0, 13)):
        out = G.subsample(df, ratio)
        assert out.count() == size and out.where("label = 1").count() == 3
        assert out.distinct().count() == size
    assert as_set(G.subsample(df, 2.0)) == as_set(G.subsample(df.repartition(5), 2.0))


def test_subsample_of_a_large_group_cuts_inside_a_hash_prefix(spark):
    df = spark.range(200000).select(F.col("id").alias("student_id"), (F.col("id") < 20).cast("int").alias("label"))
    out = G.subsample(df, 5000.0)
    assert out.where("label = 0").count() == 100000
    kept = hash_rank(df.where("label = 0"), ["label"], ["student_id"]).where("rank <= 100000").select("student_id")
    assert out.where("label = 0").select("student_id").exceptAll(kept).count() == 0


def test_kfold_is_even_per_label(instances):
    sizes = G.stratified_kfold(instances, 4).groupBy("label", "fold").count().collect()
    assert {(r["label"], r["count"]) for r in sizes} == {(0, 10), (1, 5)}


def test_running_totals_of_a_hot_group(spark):
    """A hot group with most rows, spread over ranges, gives the plain window's totals."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        ((F.col("id") * 7919) % 3001).alias("o"), (F.col("id") % 5).alias("v"))
    got = running_totals(df, ["g"], [F.desc("o")], {"s": F.col("v"), "r": F.lit(1)})
    rows = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], -r[1]))
    want, state = set(), {}
    for g, o, v in rows:
        s, n = state.get(g, (0, 0))
        state[g] = (s + v, n + 1)
        want.add((g, o, v, *state[g]))
    assert as_set(got) == want


def _district_tables(spark):
    static = spark.createDataFrame(
        [(i, 2000 + i % 4, "FM"[i % 2], None if i % 5 == 0 else f"town{i % 7}", float(i % 3)) for i in range(1, 81)],
        "student_id bigint, cohort int, gender string, town string, age double")
    yearly = spark.createDataFrame(
        [(i, 2000 + i % 4, 2009, 9, None if i % 6 == 0 else i % 10, f"track{i % 3}") for i in range(3, 81)],
        "student_id bigint, cohort int, academic_year int, grade_level int, absences int, track string")
    labels = spark.createDataFrame([(i, int(i % 7 in (1, 2, 4))) for i in range(1, 81)], "student_id bigint, outcome_label int")
    return static, yearly, labels


def test_sparse_dataset_equals_the_dense_one(spark, tmp_path):
    from cohortline.plans import dataset as D
    from cohortline.plans import models as M
    from cohortline.plans import sweep as W

    tables = _district_tables(spark)
    dense = D.build_dataset(*tables, [9])
    path = str(tmp_path / "sparse")
    D.build_dataset(*tables, [9], sparse=True).write.parquet(path)
    sparse = spark.read.parquet(path)  # the blocks go to Parquet and back
    blocks = R.blocks_of(sparse)
    assert {c: hi - lo for c, (lo, hi) in blocks.items()} == {"gender": 2, "town": 7, "grade_level_9_track": 3}
    assert not any(c in sparse.columns for c in blocks)
    assert R.feature_columns(sparse) == ["age", "grade_level_9_absences", *blocks]
    for chosen in (list(blocks), ["age", "grade_level_9_absences", "town"], R.feature_columns(sparse)):
        wide = [c for c in R.feature_columns(dense) if any(c == x or c.startswith(x + "_") for x in chosen)]
        got = {}
        for name, data, columns in (("dense", dense, wide), ("sparse", sparse, chosen)):
            train, test = W.prepared(data, columns, 2001, 2002, {"subsample": 2.0, "smote": None, "imputation": "mean"})
            assert train.first()["features"].size == len(wide)
            for learner, params in (("naive_bayes", {"alpha": 0.1}), ("logistic_regression", {"penalty": "l2", "C": 1.0})):
                got[name, learner] = {r[0]: r[1] for r in M.fit_score(train, test, learner, params).select("student_id", "y_prob").collect()}
        for learner in ("naive_bayes", "logistic_regression"):
            assert got["sparse", learner] == pytest.approx(got["dense", learner], abs=1e-5) and len(got["sparse", learner]) == 40
    with pytest.raises(ValueError, match="dense"):
        W.prepared(sparse, ["age", "town"], 2001, 2002, {"subsample": None, "smote": 100, "imputation": "mean"})


def test_sweep_takes_a_sparse_dataset(spark, tmp_path):
    from cohortline.plans import dataset as D
    from cohortline.plans import sweep as W
    from cohortline.sources.shared import durable

    grid = {"dummy": {"strategy": ["uniform"], "random_state": [0]}, "naive_bayes": {"alpha": [0.1, 1.0]}}
    scores = []
    for sparse in (False, True):
        data = durable(D.build_dataset(*_district_tables(spark), [9], sparse=sparse))
        splits = V.temporal_splits(data, test_cohorts=[2003])
        summary, _ = W.sweep(data, R.feature_columns(data), str(tmp_path / f"sweep{sparse}"), splits, grid)
        scores.append({(r["train"], r["grade"], r["params"]): (round(r["acc"], 9), round(r["roc_auc"], 9)) for r in summary.collect()})
    assert scores[0] == scores[1] and scores[0]


def test_fitted_dataset_builds_the_yearly_features_once(spark):
    """Steps, vocabulary and rows read one saved table; nothing behind them goes back to the line items."""
    from checks.queries import queries
    from conftest import SF

    plan = queries()["dataset_fitted"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_returnflag" not in plan
