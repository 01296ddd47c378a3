"""Registered queries: every operator applied to the stand-in district tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle as O
from checks.oracle import ATTENDANCE_FROM, CATEGORIES, INCIDENTS_BETWEEN
from checks.standin import Tables
from cohortline.functions import columns as C
from cohortline.operators import cohort as K
from cohortline.operators import impute as I
from cohortline.operators import labels as L
from cohortline.operators import metrics as E
from cohortline.operators import neighbours as N
from cohortline.operators import profile as P
from cohortline.operators import projection_forest as H
from cohortline.operators import reports as X
from cohortline.operators import reshape as R
from cohortline.operators import sampling as G
from cohortline.operators import scores as A
from cohortline.operators import splits as V
from cohortline.operators import static as S
from cohortline.operators import yearly as Y
from cohortline.plans import dataset as D
from cohortline.plans import models as M
from cohortline.plans import sweep as W
from cohortline.plans.session import apply_settings
from cohortline.sources import results, shared
from cohortline.sources import tables as B


class District:
    """Raw tables and the derived tables built on them, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = apply_settings(spark)
        self.sf_dir = sf_dir
        self.raw = Tables(spark, sf_dir)

    def __getitem__(self, name: str) -> DataFrame:
        return self.raw[name]

    @cached_property
    def enrollment(self) -> DataFrame:
        return self["school_enrollment"]

    @cached_property
    def cohort(self) -> DataFrame:
        return K.cohort(self.enrollment)

    @cached_property
    def cohort_all(self) -> DataFrame:
        return K.cohort_all_units(self["student"], self.enrollment)

    @cached_property
    def cby(self) -> DataFrame:
        return K.cohort_by_year(self.enrollment, self.cohort)

    @cached_property
    def steps(self) -> DataFrame:
        """Distinct unit-by-year rows, for what repeated records cannot change."""
        return K.cohort_by_year(self.enrollment, self.cohort, distinct=True)

    @cached_property
    def base(self) -> DataFrame:
        return Y.yearly_base(self.cby)

    @cached_property
    def grad(self) -> DataFrame:
        return L.grad_label(self.cohort, self["graduates"])

    @cached_property
    def label(self) -> DataFrame:
        return L.label(self.grad, self["outcome"])

    @cached_property
    def label12(self) -> DataFrame:
        return L.label_12regular(self.grad, self["outcome"])

    @cached_property
    def static(self) -> DataFrame:
        return S.static_features(self.cohort, self["student_fixed"], self["student"])

    @cached_property
    def first9(self) -> DataFrame:
        return K.first_grade9(self.enrollment)

    @cached_property
    def yearly(self) -> DataFrame:
        return self._yearly(self.cby, True)

    @cached_property
    def yearly_distinct(self) -> DataFrame:
        """The yearly table with each different row once, which is all that a choice among rows needs."""
        return self._yearly(self.cby, False)

    def _yearly(self, cby: DataFrame, repeated: bool) -> DataFrame:
        return Y.yearly_features(
            cby, self["school_attendance"], self["discipline_temp"], self["course_enrollment"], self["course"],
            self.enrollment, self["school"], attendance_from=ATTENDANCE_FROM, incidents_between=INCIDENTS_BETWEEN,
            categories=CATEGORIES, repeated=repeated,
        )

    @cached_property
    def latest(self) -> DataFrame:
        return D.latest_yearly_features(
            self.steps, self["school_attendance"], self["discipline_temp"], self["course_enrollment"], self["course"],
            self.enrollment, self["school"], attendance_from=ATTENDANCE_FROM, incidents_between=INCIDENTS_BETWEEN,
            categories=CATEGORIES,
        )

    @cached_property
    def features(self) -> DataFrame:
        return R.extract_features(
            self.static.drop(*O.STATIC_DROPPED), self.latest, O.TIMES, ties=["current_school_id"], vocabulary=O.VOCABULARY, unique=True,
        )

    @cached_property
    def dataset(self) -> DataFrame:
        return D.build_dataset(
            self.static, self.latest, self.label, O.TIMES, dropped=O.STATIC_DROPPED, ties=["current_school_id"],
            vocabulary=O.VOCABULARY, unique=True,
        )

    @cached_property
    def saved(self) -> DataFrame:
        """The dataset, written once per session and test-data directory."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in SAVED:
            SAVED[key] = shared.new_path(self.spark, "dataset")
        return B.cached(self.spark, SAVED[key], lambda: self.dataset)

    @cached_property
    def splits(self) -> DataFrame:
        return V.temporal_splits(self.saved)

    @cached_property
    def usable(self) -> DataFrame:
        return V.usable_splits(self.saved, self.splits)

    def folds(self, columns: list[str]) -> tuple[DataFrame, DataFrame]:
        """Imputed feature arrays of the train and test rows of one split."""
        rows = M.assemble(self.saved, columns, extra=["cohort"])
        return M.impute_arrays(
            rows.where(F.col("cohort") <= O.TRAIN), rows.where(F.col("cohort") >= O.TEST), len(columns))

    @cached_property
    def minority(self) -> DataFrame:
        """All features of the class-1 rows of a training fold, imputed with its means."""
        train, _ = self.folds(O.X)
        return shared.durable(train.where("label = 1").select(
            "student_id", F.transform("features", lambda x: F.round(x, 6)).alias("features")))

    @cached_property
    def catalog(self) -> DataFrame:
        """The feature catalog, written as CSV with a header and loaded back."""
        path = shared.new_path(self.spark, "catalog")
        rows = self.spark.createDataFrame(O.CATALOG, B.CATALOG_SCHEMA)
        B.write_table(rows.coalesce(1), path, fmt="csv")
        return B.load_feature_catalog(self.spark, path)

    @cached_property
    def coverage(self) -> DataFrame:
        """Non-null values per feature of the static and yearly tables."""
        def counted(df: DataFrame, names: list[str]) -> DataFrame:
            one = df.agg(*[F.count(n).alias(n) for n in names])
            return one.unpivot([], names, "feature_name", "n_values")

        static = ["gender", "race", "race_ethnicity", "home_language_code", *O.STATIC_VALUES]
        return counted(self.static, static).unionByName(counted(self.latest, O.YEARLY_VALUES))


SAVED: dict[tuple[str, str], str] = {}
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    """Register a function of the district tables under a query name."""

    def wrap(build: Callable[[District], DataFrame]) -> Callable[[District], DataFrame]:
        REGISTRY[name] = lambda spark, sf_dir: build(District(spark, sf_dir))
        return build

    return wrap


def queries() -> dict[str, Query]:
    return dict(REGISTRY)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def rounded_all(df: DataFrame) -> DataFrame:
    """Round every double column for comparison."""
    return df.selectExpr(*[f"round(`{n}`, 6) as `{n}`" if t == "double" else f"`{n}`" for n, t in df.dtypes])


def text_date(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("string") for n in names})


# cohorts
query("grade_normalised")(lambda d: K.grade_normalised(d.enrollment))
query("first_enrollment")(lambda d: K.first_enrollment(d.enrollment))
query("transfer_out")(lambda d: K.transfer_out(d.enrollment))
query("cohort")(lambda d: d.cohort)
query("cohort_sizes")(lambda d: X.cohort_sizes(d.cohort))
query("enrollment_rn_ct")(lambda d: K.enrollment_rn_ct(d.enrollment))
query("cohort_all_students")(lambda d: d.cohort_all)
query("cohort_by_year")(lambda d: d.cby)
query("cohort_by_year_v0")(lambda d: K.cohort_by_year_v0(d.enrollment, d.cohort_all))
query("first_grade9")(lambda d: d.first9)
query("last_enrollment")(lambda d: K.last_enrollment(d.enrollment))
query("last_withdrawal")(lambda d: text_date(K.last_withdrawal(d["outcome"]), "withdraw_date"))
query("enrollment_jumps")(lambda d: K.enrollment_jumps(d.steps))

# labels
query("grad_label")(lambda d: d.grad)
query("label")(lambda d: d.label)
query("label_12regular")(lambda d: d.label12)
query("labels2")(lambda d: L.labels2(d.cohort, d.enrollment, d["outcome"]))

# static features
query("cohort_feature")(lambda d: rounded(text_date(d.static, "date_of_birth"), "rel_age_to_cohort"))
query("language_counts")(lambda d: d["student_fixed"].select(
    "id", *[c.alias(n) for n, c in C.language_columns("home_language_code").items()]))
query("race_flags")(lambda d: d["student_fixed"].select(
    "id", *[c.alias(n) for n, c in S.race_flags("race_original", "race_ethnicity").items()]))
query("relative_age")(lambda d: rounded(S.relative_age_to_grade9(d.first9, d["student"]), "rel_age_to_cohort"))
query("act_lookup")(lambda d: A.act_scores(d["test"]))
query("act_composite")(lambda d: A.act_composite(d["test"]))
query("absence_by_offset")(lambda d: S.absence_by_offset(d.first9, d["school_attendance"]))
query("first_model_table")(lambda d: text_date(
    S.first_model_table(d.first9, A.act_composite(d["test"]), d["student"], d["outcome"]), "date_of_birth"))


@query("age_parts")
def _age_parts(d: District) -> DataFrame:
    out = []
    for name, column in S.ENTRY_DATES.items():
        months, days = C.age_parts(column, "date_of_birth")
        out += [months.alias(f"{name}_months"), days.alias(f"{name}_days")]
    return d["student"].select("id", *out)


# yearly features
query("school_year")(lambda d: d["discipline_temp"].groupBy(
    C.school_year("incident_date").alias("school_year")).agg(F.count(F.lit(1)).alias("n")))
query("yf_base")(lambda d: d.base)
query("yf_absences")(lambda d: Y.absences(d.base, d["school_attendance"], since=ATTENDANCE_FROM))
query("incident_categories")(lambda d: Y.incident_categories(d["discipline_temp"], categories=CATEGORIES))
query("yf_discipline")(lambda d: Y.discipline(
    d.base, d["discipline_temp"], categories=CATEGORIES, between=INCIDENTS_BETWEEN))
query("discipline_oct_year")(lambda d: Y.discipline_oct_year(d["discipline_temp"]))
query("course_marks")(lambda d: Y.course_marks(d["course_enrollment"], d["course"]))
query("course_flags")(lambda d: d["course"].select(
    "code", "school_id", *[c.alias(n) for n, c in C.course_flags("name").items()]))
query("yf_courses")(lambda d: rounded(Y.courses(d.base, d["course_enrollment"], d["course"]), "avg_gpa"))
query("school_flags")(lambda d: Y.school_flags(d["school"]))
query("yf_school")(lambda d: Y.school(d.base, d.enrollment, d["school"]))
query("yearly_features")(lambda d: rounded(d.yearly, "avg_gpa"))
query("yf_v0")(lambda d: Y.yearly_features_v0(
    K.cohort_by_year_v0(d.enrollment, d.cohort_all), d["school_attendance"], d["discipline_temp"], d.enrollment,
    d["school"], attendance_from=ATTENDANCE_FROM, incidents_between=INCIDENTS_BETWEEN))

# reports
query("xtab_continued_enrollment")(lambda d: X.continued_enrollment(d.steps, d.label))
query("xtab_only_grade9")(lambda d: X.only_grade9(d.steps, d.label))
query("xtab_only_grade10")(lambda d: X.only_grade10(d.steps, d.label))
query("xtab_outcome")(lambda d: X.outcome_by_cohort(d.label, d.cohort))
query("xtab_outcome_12regular")(lambda d: X.outcome_12regular(d.label12, d.cohort))
query("xtab_cohort_size")(lambda d: X.actual_vs_inferred(d.enrollment, d.cohort))
query("xtab_school_by_year")(lambda d: X.school_by_year(d.enrollment, d["school"]))

# profile
query("profile_status")(lambda d: P.value_counts(d.enrollment, "current_status", counted="current_status"))
query("profile_distinct")(lambda d: P.status_totals(d.enrollment))


@query("distinct_sketched")
def _distinct_sketched(d: District) -> DataFrame:
    """Units per year: exact, and from the sketches of every school and year; whether these agree within three standard errors."""
    rows = d.enrollment.select("academic_year", "current_school_id", "student_id")
    kept = shared.durable(P.distinct_sketches(rows, "student_id", "academic_year", "current_school_id"))
    exact = rows.groupBy("academic_year").agg(F.countDistinct("student_id").alias("units"))
    both = exact.join(P.merged_distinct(kept, "academic_year"), exact["academic_year"].eqNullSafe(kept["academic_year"])).drop(kept["academic_year"])
    return both.select("academic_year", "units", (F.abs(F.col("estimate") - F.col("units")) <= F.lit(3 * 1.04 / 2**7) * F.col("units")).alias("close"))


query("profile_withdraw_codes")(lambda d: P.value_counts(d.enrollment, "withdraw_code", counted="withdraw_code"))
query("profile_null_cohorts")(lambda d: P.null_cohorts(d.cohort_all))
query("profile_school_rows")(lambda d: P.school_records(d.enrollment, [997, 998]))
query("profile_years_in_hs")(lambda d: P.years_in_high_school(d.enrollment, d.cohort))
query("profile_cohort_grades")(lambda d: P.years_in_high_school(d.enrollment, d.cohort, with_years=False))
query("profile_movement")(lambda d: P.grade_repeats(d.enrollment))
query("profile_promotions")(lambda d: P.promotions(d.enrollment))
query("profile_current_grades")(lambda d: P.distinct_values(d.enrollment, "current_grade_level"))
query("profile_course_years")(lambda d: P.distinct_values(d["course_enrollment"], "academic_year"))
query("profile_active_years")(lambda d: P.value_counts(
    d.enrollment.where(C.is_true("active_status")), "academic_year", counted="active_status"))
query("profile_withdraw_reasons")(lambda d: P.value_counts(d["outcome"], "reason_code", counted="student_id"))
query("profile_withdraw_reasons_by_grade")(lambda d: P.value_counts(
    d["outcome"], "grade_level", "reason_code_description", "reason_code", counted="student_id"))
query("profile_out_codes")(lambda d: P.value_counts(d.enrollment, "has_out_code", counted="has_out_code").withColumn(
    "n_codes", F.lit(P.distinct_values(d.enrollment.where("has_out_code is not null"), "has_out_code").count()).cast("bigint")))
query("profile_school_locators")(lambda d: P.distinct_values(d.enrollment, "current_school_number_locator"))
query("profile_left_schools")(lambda d: P.distinct_values(
    d.enrollment.where(F.col("current_school_number_locator").isin("GRD", "OUT")), "current_school_id"))
query("report_newest_first")(lambda d: X.newest_first(X.cohort_sizes(d.cohort), "cohort"))
query("profile_high_schools")(lambda d: d["school"].where(F.col("name").contains("HS")).select("id", "name"))
query("profile_schools_by_year")(lambda d: P.schools_by_year(d.enrollment, d["school"]))
query("profile_grade_moves")(lambda d: P.grade_moves(d.enrollment, d["school"]))
query("profile_enrollment_schools")(lambda d: P.enrollment_schools(d.enrollment, d["school"]))
query("enrollment_summary")(lambda d: P.enrollment_summary(d.enrollment))
query("enrollment_summary_by_year")(lambda d: P.enrollment_summary_by_year(d.enrollment))


# dataset
query("dedup_last")(lambda d: rounded_all(R.dedup_last(
    d.yearly_distinct, ["student_id", "grade_level"], ["academic_year"], ["current_school_id"])))
query("pivot_by_grade")(lambda d: rounded_all(R.pivot_by_time(d.latest.drop("cohort", "academic_year"), O.TIMES)))
query("one_hot")(lambda d: rounded_all(text_date(R.one_hot(d.static), "date_of_birth")))
query("one_hot_sparse")(lambda d: R.one_hot_sparse(d.static.select("student_id", *O.STATIC_VOCABULARY)).select(
    "student_id", F.concat_ws(",", F.transform("indices", lambda i: i.cast("string"))).alias("indices")))


@query("dataset_fitted")
def _dataset_fitted(d: District) -> DataFrame:
    """The dataset with the steps and the vocabulary that the tables themselves show."""
    latest = B.cached(d.spark, shared.new_path(d.spark, "latest"), lambda: d.latest)  # read for the steps, the values and the rows
    times = D.observed_steps(latest)
    vocabulary = D.dataset_vocabulary(d.static, latest, times, dropped=O.STATIC_DROPPED, unique=True)
    rows = D.build_dataset(d.static, latest, d.label, times, dropped=O.STATIC_DROPPED, vocabulary=vocabulary, unique=True)
    unseen = [c for c in d.dataset.columns if c not in rows.columns]  # values that no unit shows at a step: zeros
    return rounded_all(rows.withColumns({c: F.lit(0) for c in unseen}).select(*[F.col(f"`{c}`") for c in d.dataset.columns]))


query("features_merged")(lambda d: rounded_all(d.features))
query("labelled_instances")(lambda d: rounded_all(text_date(
    R.extract_instances(d.static, R.labelled(d.label)), "date_of_birth")))
query("dataset")(lambda d: rounded_all(d.dataset))
query("dataset_cache")(lambda d: rounded_all(d.saved))


@query("load_units")
def _load_units(d: District) -> DataFrame:
    root = shared.new_path(d.spark, "districts")
    B.save_district(root, "standin", cohort=d.cohort, static=d.static, yearly=d.yearly, label=d.label)
    loaded = B.load_district(d.spark, "standin", root)
    parts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"), F.countDistinct("student_id").alias("units"))
        for name, df in (("cohort", loaded.cohort), ("static", loaded.static), ("yearly", loaded.yearly), ("label", loaded.label))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# splits and feature sets
query("temporal_splits")(lambda d: d.splits)
query("split_membership")(lambda d: V.split_membership(d.saved, d.splits))
query("split_class_counts")(lambda d: V.split_class_counts(d.saved, d.splits))
query("usable_splits")(lambda d: d.usable)
query("features_asof_grade")(lambda d: rounded_all(d.saved.select(
    "student_id", *[F.col(f"`{c}`") for c in V.features_asof(R.feature_columns(d.saved), O.ASOF_GRADE)])))
query("feature_catalog")(lambda d: d.catalog.join(d.coverage, "feature_name"))


@query("feature_sets")
def _feature_sets(d: District) -> DataFrame:
    members = d.catalog.where("exclude_when_modeling = 0").select(
        "feature_name", F.col("feature_category_primary").alias("category"))
    return V.feature_sets(d.catalog).join(members, "category").join(d.coverage, "feature_name").groupBy(
        "feature_set", "category").agg(F.sum("n_values").alias("n_values"))


@query("feature_set_members")
def _feature_set_members(d: District) -> DataFrame:
    columns = R.feature_columns(d.saved)
    rows = d.catalog.collect()
    sets: dict[str, list[str]] = {}
    for r in V.feature_sets(d.catalog).collect():
        sets.setdefault(r["feature_set"], []).append(r["category"])
    pairs = [(s, c) for s, cats in sets.items() for c in V.feature_set_columns(rows, columns, cats)]
    members = d.spark.createDataFrame(pairs, "feature_set string, column_name string")
    counts = d.saved.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in columns]).unpivot(
        [], [F.col(f"`{c}`") for c in columns], "column_name", "n_values")
    return members.join(counts, "column_name")


# imputation and sampling
@query("imputed_mean")
def _imputed_mean(d: District) -> DataFrame:
    train, test = d.folds(O.X)
    both = train.withColumn("fold", F.lit("train")).unionByName(test.withColumn("fold", F.lit("test")))
    return both.select(
        "student_id", F.col("label").cast("int").alias("label"), "fold",
        *[F.round(F.col("features")[i], 6).alias(c) for i, c in enumerate(O.X)])


@query("imputed_mode")
def _imputed_mode(d: District) -> DataFrame:
    kept = d.static.select("student_id", *O.MODE_COLUMNS, *[F.col(c).cast("double").alias(c) for c in O.MEAN_COLUMNS])
    return rounded_all(I.fill(kept, I.fit_fill(kept, [*O.MODE_COLUMNS, *O.MEAN_COLUMNS])))


@query("assembled")
def _assembled(d: District) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    v = vector_to_array("features")
    total = F.aggregate(v, F.lit(0.0), lambda a, x: a + F.round(x, 6))
    return M.vectors(d.folds(O.X)[0]).select(
        "student_id", "label", F.size(v).alias("n_features"), F.round(total, 6).alias("feature_sum"))


query("subsample")(lambda d: G.subsample(d.saved.select("student_id", "cohort", "label"), O.RATIO))
query("subsample_by_cohort")(lambda d: G.subsample(
    d.saved.select("student_id", "cohort", "label"), 2.0, by=["cohort"], seed=7))
query("stratified_kfold")(lambda d: G.stratified_kfold(d.saved.select("student_id", "label"), 5))
query("smote_neighbours")(lambda d: rounded_all(N.nearest_neighbours(d.minority, 4)))
query("smote")(lambda d: rounded_all(N.smote(d.minority, 200, 5).select(
    "student_id", "copy", "neighbour", *[F.col("features")[i].alias(f"x{i}") for i in range(len(O.X))])))


@query("smote_forest")
def _smote_forest(d: District) -> DataFrame:
    """The approximate neighbours of all class-1 training rows against the exact ones, and synthetic rows made from them."""
    near = shared.durable(H.approximate_neighbours(d.minority, 4))
    made = N.smote(d.minority, 200, 5, near=near)
    found = H.recall(near, N.nearest_neighbours(d.minority, 4))
    both = found.select("wanted", (F.col("recall") >= 0.9).alias("enough")).unionByName(
        made.agg(F.count(F.lit(1)).alias("made")), allowMissingColumns=True)
    return both.agg(F.max("wanted").alias("wanted"), F.max("enough").alias("enough"), F.max("made").alias("made"))



@query("dummy_baseline")
def _dummy(d: District) -> DataFrame:
    rows = d.saved.select("student_id", "label", "cohort")
    train, test = rows.where(F.col("cohort") <= O.TRAIN), rows.where(F.col("cohort") >= O.TEST)
    a, b = (M.dummy_scores(train, test, s).withColumn("strategy", F.lit(s)) for s in ("stratified", "uniform"))
    return a.unionByName(b)


# sweep tables
def _configs(d: District) -> DataFrame:
    sets = d.spark.createDataFrame([(W.ALL,)], "feature_set string")
    return W.sweep_configs(d.usable, sets, W.modifier_grid(d.spark, W.ALL_MODIFIERS), W.model_grid(d.spark)).select(
        "grade", "test", "train", "learner", "model", "params", "features", "subsample", "smote", "imputation", "summary_hash")


query("sweep_configs")(_configs)
query("config_hash")(lambda d: _configs(d).groupBy("summary_hash").agg(F.count(F.lit(1)).alias("n")))
query("model_grid")(lambda d: _configs(d).groupBy("model", "params").agg(F.count(F.lit(1)).alias("n_fits")))


@query("modifier_grid")
def _modifier_grid(d: District) -> DataFrame:
    """Training class sizes of every split before and after every modifier combination."""
    counts = V.split_class_counts(d.saved, d.splits).where("fold = 'train'").groupBy("grade", "train", "test").agg(
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("zeros"),
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("ones"))
    options = F.array(*[
        F.struct(F.lit(r["subsample"]).cast("double").alias("subsample"), F.lit(r["smote"]).cast("int").alias("smote"),
                 F.lit(r["imputation"]).alias("imputation"))
        for r in W.modifier_grid(d.spark, W.ALL_MODIFIERS).collect()
    ])
    after = F.col("ones") + F.floor(F.col("ones") * F.coalesce(F.col("smote"), F.lit(0)) / 100)
    kept = F.least(F.col("zeros"), F.floor(F.col("subsample") * after))
    return (
        d.usable.join(counts, ["grade", "train", "test"])
        .select("grade", "train", "test", "zeros", "ones", F.explode(options).alias("o"))
        .select("grade", "train", "test", "zeros", "ones", "o.*")
        .withColumn("ones_after", after)
        .withColumn("zeros_after", F.when(F.col("subsample").isNull(), F.col("zeros")).otherwise(kept))
    )


# metrics on a scored table
def _predictions(d: District) -> DataFrame:
    return d["predictions"]


query("confusion_metrics")(lambda d: rounded_all(E.confusion(_predictions(d))))
query("brier")(lambda d: rounded_all(E.brier(_predictions(d))))
query("roc_points")(lambda d: rounded_all(E.roc_points(_predictions(d))))
query("pr_points")(lambda d: rounded_all(E.pr_points(_predictions(d))))
query("roc_auc")(lambda d: rounded_all(E.roc_auc(_predictions(d))))
query("pr_auc")(lambda d: rounded_all(E.pr_auc(_predictions(d))))
query("precision_at_k")(lambda d: rounded_all(E.precision_at_k(_predictions(d))))
query("ap_at_k")(lambda d: rounded_all(E.ap_at_k(_predictions(d))))
query("ap_at_k_ranked")(lambda d: rounded_all(E.ap_at_k_ranked(_predictions(d))))
query("risk_list")(lambda d: E.risk_list(_predictions(d), O.RISK_K))
query("evaluate")(lambda d: rounded_all(E.evaluate(_predictions(d))))


# sinks, checked by reading back
@query("csv_roundtrip")
def _csv_roundtrip(d: District) -> DataFrame:
    source, csv, target = d["graduates"], shared.new_path(d.spark, "csv"), shared.new_path(d.spark, "table")
    B.write_table(source, csv, fmt="csv")
    B.csv_to_table(d.spark, csv, target, source.schema)
    return d.spark.read.parquet(target)


@query("table_sink_modes")
def _table_sink_modes(d: District) -> DataFrame:
    target, rows = shared.new_path(d.spark, "table"), d["graduates"]
    types = {"academic_year": "bigint"}
    for mode, mark in (("fail", 0), ("replace", 1), ("append", 2)):
        B.write_table(rows.withColumn("written", F.lit(mark)), target, mode, types)
    return d.spark.read.parquet(target)


@query("summary_append_once")
def _summary_append_once(d: District) -> DataFrame:
    path, rows = shared.new_path(d.spark, "summary"), shared.durable(rounded_all(E.evaluate(_predictions(d))))
    results.append_once(rows.where("summary_hash = 1"), path)
    results.append_once(rows, path)
    return results.append_once(rows, path)


@query("predictions_partitioned")
def _predictions_partitioned(d: District) -> DataFrame:
    path = shared.new_path(d.spark, "predictions")
    rows = _predictions(d).withColumns({
        "summary_hash": F.sha1(F.col("summary_hash").cast("string")), "grade": F.lit(9), "test": F.lit(2002),
        "train": F.lit(1999), "model": F.lit("given")})
    results.write_predictions(rows, path)
    return results.write_predictions(rows, path)


# learners: what must hold for any of them
def _scores(d: District, name: str, params: dict, columns: list[str] | None = None) -> DataFrame:
    train, test = d.folds(O.X if columns is None else columns)
    scored = M.fit_score(shared.durable(M.vectors(train)), M.vectors(test), name, params)
    return scored.select(
        "student_id", "y_true", F.col("y_prob").between(0, 1).alias("in_range"),
        (F.col("y_pred") == (F.col("y_prob") > 0.5).cast("double")).alias("consistent"))


def _planted(d: District, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both folds with the label itself as the last feature."""
    add = lambda df: df.withColumn("features", F.concat("features", F.array(F.col("label").cast("double"))))
    train, test = d.folds(columns)
    return shared.durable(M.vectors(add(train))), M.vectors(add(test))


COUNTS = [c for c in O.X if c.startswith("grade_level_") and ("mark_is" in c or "course" in c or "disc_" in c)]
FOREST = {"n_estimators": 50, "criterion": "entropy", "max_features": None, "max_depth": 3, "bootstrap": True, "random_state": 0}
query("rf_scores")(lambda d: _scores(d, "random_forest", FOREST))
query("dt_scores")(lambda d: _scores(d, "decision_tree", {"criterion": "gini", "max_features": None, "max_depth": 5}))
query("gbt_scores")(lambda d: _scores(
    d, "gradient_boosting", {"learning_rate": 0.1, "n_estimators": 5, "max_depth": 3, "subsample": 0.5, "max_features": "sqrt"}))
query("lr_scores")(lambda d: _scores(d, "logistic_regression", {"penalty": "l2", "C": 0.01}))
query("nb_scores")(lambda d: _scores(d, "naive_bayes", {"alpha": 0.1}, COUNTS))


@query("nb_sparse")
def _nb_sparse(d: District) -> DataFrame:
    """Naive Bayes on the sparse dataset: the counts, which are never negative, and every category. Scores have a closed form."""
    data = shared.durable(D.build_dataset(d.static, d.latest, d.label, O.TIMES, dropped=O.STATIC_DROPPED, unique=True, sparse=True))
    train, test = W.imputed_folds(data, [*COUNTS, *R.blocks_of(data)], O.TRAIN, O.TEST)
    scored = M.fit_score(shared.durable(M.vectors(train)), M.vectors(test), "naive_bayes", {"alpha": 0.1})
    return scored.select("student_id", "y_true", F.round("y_prob", 6).alias("y_prob"))


query("feature_importance")(lambda d: E.feature_importance(
    M.fit(_planted(d, O.X)[0], "decision_tree", {"criterion": "gini", "max_features": None, "max_depth": 1}), [*O.X, "planted"]))


@query("learners_planted")
def _learners_planted(d: District) -> DataFrame:
    """Predicted labels where one feature is the label."""
    train, test = _planted(d, O.X[:20])
    params = {
        "random_forest": FOREST, "decision_tree": {"criterion": "gini", "max_features": None, "max_depth": 5},
        "gradient_boosting": {"learning_rate": 0.1, "n_estimators": 5, "max_depth": 3, "subsample": 1.0, "max_features": None},
        "logistic_regression": {"penalty": "l1", "C": 1000},
    }
    parts = [M.fit_score(train, test, n, p).select(F.lit(n).alias("learner"), "student_id", "y_true", "y_pred")
             for n, p in params.items()]
    return reduce(DataFrame.unionByName, parts)


@query("sweep_summary")
def _sweep(d: District) -> DataFrame:
    """The sweep of the default grid over the splits of one test year, from the saved dataset to the summary: its nine descriptive
    columns, the hard metrics of the baselines, and for every row whether all metrics lie in their range."""
    splits = V.temporal_splits(d.saved, test_cohorts=[O.TEST])
    summary, _ = W.sweep(d.saved, R.feature_columns(d.saved), shared.new_path(d.spark, "sweep"), splits)
    metrics = [c for c in summary.columns if c not in (*W.SUMMARY_COLUMNS[:9], "baseline")]
    sound = F.forall(F.array(*[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).cast("double") for c in metrics]), lambda x: x.between(0.0, 1.0))
    hard = [F.when(F.col("baseline"), F.round(c, 6)).alias(c) for c in ("acc", "pre", "recall", "f1", "brier")]
    return summary.select(*W.SUMMARY_COLUMNS[:9], "baseline", sound.alias("sound"), *hard)
