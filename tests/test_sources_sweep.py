import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cohortline.plans import dataset as D
from cohortline.plans import models as M
from cohortline.plans import sweep as W
from cohortline.operators import splits as V
from cohortline.operators.metrics import TOP_K
from cohortline.sources import results, shared, tables


def test_csv_header_names_the_columns(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("k,v\n1,x\n2,\n")
    target = str(tmp_path / "t")
    assert tables.csv_to_table(spark, str(path), target, "k int, v string")
    assert tables.csv_to_table(spark, str(path), target, "k int, v string")
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect())[:1] == [(1, "x")]
    assert spark.read.parquet(target).count() == 4
    blank = tmp_path / "b.csv"
    blank.write_text("\n")
    assert not tables.csv_to_table(spark, str(blank), target)


def test_write_modes(spark, tmp_path):
    df, target = spark.range(3), str(tmp_path / "t")
    tables.write_table(df, target)
    with pytest.raises(AnalysisException):
        tables.write_table(df, target, "fail")
    tables.write_table(df, target, "append")
    assert spark.read.parquet(target).count() == 6
    tables.write_table(df, target, "replace", {"id": "string"})
    assert spark.read.parquet(target).dtypes == [("id", "string")]
    for bad in ({"nope": "int"}, {"id": 3}):
        with pytest.raises(ValueError):
            tables.write_table(df, target, "replace", bad)
    with pytest.raises(ValueError):
        tables.write_table(df, target, "sometimes")


def test_district_tables(spark, tmp_path):
    one = spark.range(2).withColumnRenamed("id", "student_id")
    tables.save_district(str(tmp_path), "d", cohort=one, static=one, yearly=one, label=one)
    d = tables.load_district(spark, "d", str(tmp_path))
    assert d.cohort.count() == 2 and d.catalog is None
    with pytest.raises(ValueError):
        tables.load_district(spark, "nowhere", str(tmp_path))


def test_dataset_cache_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    for _ in range(2):
        assert tables.cached(spark, str(tmp_path / "c"), build).count() == 5
    assert len(calls) == 1


def test_append_once(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = spark.createDataFrame([("h", 1.0), ("h", 1.0), ("g", 2.0)], "summary_hash string, `pre@0.1%` double")
    for _ in range(2):
        assert results.append_once(rows, path).count() == 2


def test_predictions_keep_numeric_looking_hashes(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(10).select(
        F.col("id").alias("student_id"), F.lit(1.0).alias("y_true"), F.lit(1.0).alias("y_pred"), F.lit(0.5).alias("y_prob"),
        F.lit(9).alias("grade"), F.lit(2002).alias("test"), F.lit(1999).alias("train"), F.lit("m").alias("model"),
        F.lit("0012e4").alias("summary_hash"))
    for _ in range(2):
        out = results.write_predictions(df, path)
    assert out.count() == 10 and {r[0] for r in out.select("summary_hash").distinct().collect()} == {"0012e4"}


def test_fetch_data_assembles_and_caches(spark, tmp_path):
    cohort = spark.createDataFrame([(1, 2009), (2, 2009), (3, 2010)], "student_id bigint, cohort int")
    static = spark.createDataFrame([(1, 2009, "F", "x"), (2, 2009, "M", "y"), (3, 2010, None, "z")],
                                   "student_id bigint, cohort int, gender string, born string")
    yearly = spark.createDataFrame(
        [(1, 2009, 2005, 9, 1, "a"), (1, 2009, 2006, 9, 2, "b"), (2, 2009, 2006, 10, 3, "b"), (9, 2009, 2006, 10, 4, None)],
        "student_id bigint, cohort int, academic_year int, grade_level int, v int, area string")
    label = spark.createDataFrame([(1, 1), (2, None), (3, 0)], "student_id bigint, outcome_label int")
    tables.save_district(str(tmp_path), "d", cohort=cohort, static=static, yearly=yearly, label=label)
    cache = str(tmp_path / "cache")
    for _ in range(2):
        data, catalog = D.fetch_data(spark, "d", str(tmp_path), cache=cache, dropped=["born"])
        assert catalog is None
        rows = {r["student_id"]: r.asDict() for r in data.collect()}
        assert rows[1] == {
            "student_id": 1, "cohort": 2009, "grade_level_9_v": 2, "grade_level_10_v": None, "gender_F": 1, "gender_M": 0,
            "grade_level_9_area_b": 1, "grade_level_10_area_b": 0, "label": 1}
        assert sorted(rows) == [1, 3] and rows[3]["gender_F"] == rows[3]["gender_M"] == 0


class FakeContext:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


class FakeSession:
    def __init__(self, master, **conf):
        self.sparkContext, self.conf = FakeContext(master), {k.replace("_", "."): v for k, v in conf.items()}


def test_shared_folder_comes_from_the_session():
    named = FakeSession("yarn", spark_checkpoint_dir="hdfs:///shared")
    assert shared.shared_dir(named) == "hdfs:///shared" == named.sparkContext.dir
    with pytest.raises(RuntimeError):
        shared.shared_dir(FakeSession("yarn"))
    local = FakeSession("local[2]")
    assert shared.shared_dir(local) == shared.shared_dir(local) == local.sparkContext.dir


def test_grids():
    sizes = {n: len(M.expand({n: g})) for n, g in M.GRIDS.items()}
    assert sizes == {"dummy": 2, "decision_tree": 30, "gradient_boosting": 960, "logistic_regression": 8, "naive_bayes": 4, "random_forest": 300}
    assert len(M.expand(M.DEFAULT_GRID)) == 10 and len(M.expand({"random_forest": M.FOREST_VERY_BEST})) == 1
    with pytest.raises(ValueError):
        M.learner("svm", {})
    assert M.learner("random_forest", {"max_depth": None, "max_features": None}).getMaxDepth() == 30


@pytest.fixture(scope="module")
def instances(spark):
    return spark.range(400).select(
        F.col("id").alias("student_id"), (F.col("id") % 4 + 2000).cast("int").alias("cohort"),
        (F.col("id") % 5 == 0).cast("int").alias("label"),
        F.when(F.col("id") % 7 != 0, (F.col("id") % 5).cast("double")).alias("a"), (F.col("id") % 3 == 1).alias("b"),
        F.when(F.col("id") % 2 == 0, F.col("id") % 11).alias("grade_level_12_late"))


@pytest.mark.parametrize("name, params", [
    ("random_forest", {"n_estimators": 5, "criterion": "entropy", "max_features": "log2", "max_depth": 3}),
    ("decision_tree", {"criterion": "gini", "max_features": None, "max_depth": 5}),
    ("decision_tree", {"criterion": "entropy", "max_features": "sqrt", "max_depth": 3}),
    ("gradient_boosting", {"learning_rate": 0.5, "n_estimators": 5, "max_depth": 3, "subsample": 1.0, "max_features": None}),
    ("logistic_regression", {"penalty": "l1", "C": 10}),
    ("logistic_regression", {"penalty": "l2", "C": 1}),
    ("naive_bayes", {"alpha": 0.1}),
])
def test_learners_score_the_test_rows(instances, name, params):
    train, test = W.prepared(instances, ["a", "b"], 2001, 2003, {"imputation": "mean", "smote": None, "subsample": None})
    rows = M.fit_score(train, test, name, params).collect()
    assert len(rows) == 100 and all(0 <= r["y_prob"] <= 1 for r in rows)


@pytest.mark.parametrize("name, params", [
    ("random_forest", {"n_estimators": 5, "criterion": "entropy", "max_features": None, "max_depth": 4}),
    ("decision_tree", {"criterion": "gini", "max_features": None, "max_depth": 5}),
    ("random_forest", {"n_estimators": 5, "criterion": "entropy", "max_features": "log2", "max_depth": 4}),
])
def test_trees_are_the_same_without_constant_features(instances, name, params, monkeypatch):
    """Features of one value are left out where all features are looked at; scores stay, and draws of features still see all."""
    data = instances.withColumns({"c1": F.lit(3), "c2": F.lit(None).cast("double")}).select("c1", *instances.columns, "c2")
    train, test = W.prepared(data, ["c1", "a", "b", "c2"], 2001, 2003, {"imputation": "mean", "smote": None, "subsample": None})
    rows, size, varying = M.rows_and_varying(train)
    assert (rows, size, varying) == (200, 4, [1, 2]) and M.rows_and_varying(train.where("false")) == (0, 0, [])
    whole = M.fit_score(train, test, name, params, rows).collect()
    widths, plain = [], M.fit
    monkeypatch.setattr(M, "fit", lambda t, *a: widths.append(M.rows_and_varying(t)[1]) or plain(t, *a))
    assert sorted(M.fit_score(train, test, name, params, rows, varying=varying).collect()) == sorted(whole)
    assert widths == [2 if params["max_features"] is None else 4]


def test_dummy_scores_follow_the_prior(instances):
    rows = instances.withColumn("label", (F.col("student_id") % 4 == 0).cast("int"))
    out = M.dummy_scores(rows, spark_units(rows), "stratified")
    assert 0.2 < out.agg(F.avg("y_pred")).first()[0] < 0.3
    assert M.dummy_scores(rows, rows, "uniform").agg(F.min("y_prob"), F.max("y_prob")).first() == (0.5, 0.5)


def spark_units(df):
    spark = df.sparkSession
    return spark.range(5000).select(F.col("id").alias("student_id"), F.lit(0).alias("label"))


def test_resampled_training_sets(instances):
    sizes = {}
    for rate, ratio in ((None, None), (100, None), (None, 1.0), (200, 1.0)):
        train, test = W.prepared(instances, ["a", "b"], 2001, 2003, {"imputation": "mean", "smote": rate, "subsample": ratio})
        counts = dict(train.groupBy("label").count().collect())
        sizes[rate, ratio] = (counts[0.0], counts[1.0])
        assert test.count() == 100
    assert sizes == {(None, None): (160, 40), (100, None): (160, 80), (None, 1.0): (40, 40), (200, 1.0): (120, 120)}


def test_sweep_is_complete_and_restartable(spark, instances, tmp_path):
    splits = V.temporal_splits(instances, grades=[10], test_cohorts=[2003])
    grid = {"dummy": M.GRIDS["dummy"], "naive_bayes": {"alpha": [0.1]}}
    columns = ["a", "b", "grade_level_12_late"]
    path = str(tmp_path / "sweep")
    summary, predictions = W.sweep(instances, columns, path, splits, grid)
    configs = splits.count() * 3
    assert summary.count() == configs and predictions.count() == configs * 100
    assert summary.columns == [*W.SUMMARY_COLUMNS, *[f"{p}@{k}" for p in ("pre", "ap") for k in TOP_K], "baseline"]
    assert summary.where("baseline").count() == splits.count() * 2
    one = summary.where("model = 'MultinomialNB'").first()
    assert json.loads(one["params"]) == {"alpha": 0.1} and one["features"] == "all"
    again, same = W.sweep(instances, columns, path, splits, grid)
    assert again.count() == configs and same.count() == configs * 100


def test_trees_take_few_tasks_and_the_longest_begins(spark, instances, tmp_path, monkeypatch):
    """Many small partitions are gathered for trees alone; the longest fit begins first; all are scored."""
    splits = spark.createDataFrame([(9, [2001], 2003)], "grade int, train array<int>, test int").selectExpr("grade", "test", "train[0] as train")
    grid = {"dummy": {"strategy": ["uniform"]}, "random_forest": {
        "n_estimators": [1, 3], "criterion": ["gini"], "max_features": ["log2", None], "max_depth": [2], "random_state": [0]}}
    cores, seen, plain = spark.sparkContext.defaultParallelism, [], W.fit_score
    monkeypatch.setattr(W, "fit_score", lambda train, test, name, params, *a: seen.append(
        (name, params.get("n_estimators"), train.rdd.getNumPartitions())) or plain(train, test, name, params, *a))
    data = instances.repartition(3 * cores, "student_id")
    summary, _ = W.sweep(data, ["a", "b"], str(tmp_path / "few"), splits, grid, threads=1)
    assert summary.count() == 5
    assert [x[:2] for x in seen] == [("random_forest", 3), ("random_forest", 1), ("random_forest", 3), ("random_forest", 1), ("dummy", None)]
    assert {x[2] for x in seen[:4]} == {cores} and seen[4][2] == 3 * cores
    assert W.fit_tasks(10, 5, 8) == 8 and W.fit_tasks(1 << 24, 100, 8) == 100 and W.fit_tasks(0, 0, 0) == 1


def test_sweep_over_feature_sets(spark, instances, tmp_path):
    catalog = spark.createDataFrame([("a", "t", "x", 0), ("b", "t", "y", 0), ("late", "t", "y", 1)], tables.CATALOG_SCHEMA)
    splits = V.temporal_splits(instances, grades=[11], test_cohorts=[2003], train_only_latest=True)
    summary, _ = W.sweep(instances, ["a", "b", "grade_level_12_late"], str(tmp_path / "s"), splits,
                         {"naive_bayes": {"alpha": [0.1]}}, catalog=catalog)
    assert {r["features"] for r in summary.collect()} == {"all", "x", "y", "x, y"}


def test_half_written_cache_is_built_again(spark, tmp_path):
    path = str(tmp_path / "cache")
    spark.range(2).write.parquet(path)  # what a job that died has left: no note beside it
    assert tables.cached(spark, path, lambda: spark.range(5)).count() == 5
    assert tables.cached(spark, path, lambda: spark.range(9)).count() == 5


def test_half_written_predictions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.range(10).selectExpr(
        "id as student_id", "0d as y_true", "0d as y_pred", "0d as y_prob", "9 as grade", "2003 as test", "2001 as train", "'m' as model",
        "case when id < 8 then 'aa' else 'bb' end as summary_hash")
    rows.where("student_id < 4").write.partitionBy(*results.PARTITIONS).parquet(path)
    assert results.write_predictions(rows, path).count() == 10
    assert results.write_predictions(rows, path).count() == 10
    assert {tuple(r) for r in results.finished(spark, path).collect()} == {("aa", 8), ("bb", 2)}


def test_sweep_without_a_usable_split_is_empty(spark, instances, tmp_path):
    splits = V.temporal_splits(instances, grades=[10], test_cohorts=[2003]).where("false")
    summary, predictions = W.sweep(instances, ["a", "b"], str(tmp_path / "none"), splits, {"naive_bayes": {"alpha": [0.1]}})
    assert summary.count() == 0 and predictions.count() == 0


def test_a_learner_that_fails_is_noted(spark, instances, tmp_path):
    splits = V.temporal_splits(instances, grades=[10], test_cohorts=[2003], train_only_latest=True)
    rows = instances.withColumn("a", -F.col("a") - 1)  # naive Bayes takes no negative values
    path = str(tmp_path / "fails")
    summary, _ = W.sweep(rows, ["a", "b"], path, splits, {"dummy": M.GRIDS["dummy"], "naive_bayes": {"alpha": [0.1]}})
    assert summary.count() == 2 and spark.read.parquet(f"{path}/failed").count() == 1


def test_rows_of_another_dead_attempt_are_never_published(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.range(12).selectExpr(
        "id as student_id", "0d as y_true", "0d as y_pred", "0d as y_prob", "9 as grade", "2003 as test", "2001 as train", "'m' as model",
        "case when id < 10 then 'aa' else 'bb' end as summary_hash")
    rows.where("student_id < 4").write.partitionBy(*results.PARTITIONS).parquet(results.attempt_folder(path, "dead"))
    assert results.read_predictions(spark, path).count() == 0
    results.write_predictions(rows.where("summary_hash = 'bb'"), path)
    assert {tuple(r) for r in results.finished(spark, path).collect()} == {("bb", 2)}
    assert results.write_predictions(rows, path).groupBy("summary_hash").count().orderBy("summary_hash").collect() == [("aa", 10), ("bb", 2)]
    assert results.write_predictions(rows.limit(0), path).columns[:4] == ["student_id", "y_true", "y_pred", "y_prob"]


def test_array_means_from_partial_states(spark):
    from cohortline.operators.impute import array_means

    rows = [([1.0, None, 3.0],), ([2.0, None, None],), (None,), ([None, None, 6.0],)]
    df = spark.createDataFrame(rows, "features array<double>").repartition(3)
    assert array_means(df, 3) == [1.5, 0.0, 4.5]
    assert array_means(df.limit(0), 3) == [0.0, 0.0, 0.0] and array_means(df, 0) == []
    plan = df._jdf.queryExecution().toString()
    assert "Generate" not in plan
