"""Learners, their parameter grids and scoring, on Spark ML."""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions.hashing import uniform
from cohortline.operators.impute import array_means, feature_array, fill_array
from cohortline.operators.reshape import block_positions, blocks_of
from cohortline.roles import DEFAULT, Roles

Grid = Mapping[str, Mapping[str, Sequence]]
ONES = "ones"  # positions of the categories of a sparse dataset
MAX_DEPTH = 30  # deepest tree Spark ML can build; stands for "no limit"

# Parameter grids per learner. None means "all features" or "no limit".
GRIDS: dict[str, dict[str, list]] = {
    "dummy": {"strategy": ["stratified", "uniform"], "random_state": [0]},
    "decision_tree": {
        "criterion": ["entropy", "gini"],
        "max_features": ["sqrt", "log2", None],
        "max_depth": [3, 5, 10, 25, None],
        "random_state": [0],
    },
    "gradient_boosting": {
        "learning_rate": [0.01, 0.1, 0.5, 1],
        "n_estimators": [5, 10, 25, 100],
        "max_depth": [3, 5, 10, 25, None],
        "subsample": [0.01, 0.1, 0.5, 1],
        "max_features": ["sqrt", "log2", None],
        "random_state": [0],
    },
    "logistic_regression": {"penalty": ["l1", "l2"], "C": [0.001, 0.01, 1, 10], "random_state": [0]},
    "naive_bayes": {"alpha": [0.0001, 0.001, 0.01, 0.1]},
    "random_forest": {
        "n_estimators": [5, 10, 25, 50, 100],
        "criterion": ["entropy", "gini"],
        "max_features": ["sqrt", "log2", None],
        "max_depth": [3, 5, 10, 25, None],
        "bootstrap": [True, False],
        "random_state": [0],
    },
}
# The two short forest grids.
FOREST_BEST = {
    "n_estimators": [5, 50],
    "criterion": ["entropy"],
    "max_features": [None, "log2"],
    "max_depth": [3, 10],
    "bootstrap": [True],
    "random_state": [0],
}
FOREST_VERY_BEST = {
    "n_estimators": [50],
    "criterion": ["entropy"],
    "max_features": [None],
    "max_depth": [3],
    "bootstrap": [True],
    "random_state": [0],
}
DEFAULT_GRID: Grid = {"dummy": GRIDS["dummy"], "random_forest": FOREST_BEST}

CLASS_NAMES = {
    "dummy": "DummyClassifier",
    "decision_tree": "DecisionTreeClassifier",
    "gradient_boosting": "GradientBoostingClassifier",
    "logistic_regression": "LogisticRegression",
    "naive_bayes": "MultinomialNB",
    "random_forest": "RandomForestClassifier",
}


def expand(grid: Grid) -> list[tuple[str, dict]]:
    """(learner, parameters) for every combination of every learner's values."""
    return [
        (name, dict(zip(options, values)))
        for name, options in grid.items()
        for values in itertools.product(*options.values())
    ]


def params_json(params: Mapping) -> str:
    return json.dumps(params, sort_keys=True)


def _subset(max_features: str | None) -> str:
    return "all" if max_features is None else max_features


def _depth(max_depth: int | None) -> int:
    return MAX_DEPTH if max_depth is None else max_depth


def learner(name: str, params: Mapping, train_rows: int = 1, roles: Roles = DEFAULT):
    """The Spark ML estimator for a learner name and its parameters."""
    common = {"featuresCol": "features", "labelCol": roles.label}
    seed = params.get("random_state", 0)
    if name == "random_forest":
        return RandomForestClassifier(
            **common, numTrees=params.get("n_estimators", 10), impurity=params.get("criterion", "gini"),
            featureSubsetStrategy=_subset(params.get("max_features")), maxDepth=_depth(params.get("max_depth")),
            bootstrap=params.get("bootstrap", True), seed=seed,
        )
    if name == "decision_tree":
        if params.get("max_features") is None:
            return DecisionTreeClassifier(
                **common, impurity=params.get("criterion", "gini"), maxDepth=_depth(params.get("max_depth")), seed=seed
            )
        return RandomForestClassifier(
            **common, numTrees=1, bootstrap=False, impurity=params.get("criterion", "gini"),
            featureSubsetStrategy=params["max_features"], maxDepth=_depth(params.get("max_depth")), seed=seed,
        )
    if name == "gradient_boosting":
        return GBTClassifier(
            **common, lossType="logistic", stepSize=params.get("learning_rate", 0.1),
            maxIter=params.get("n_estimators", 100), maxDepth=_depth(params.get("max_depth", 3)),
            subsamplingRate=params.get("subsample", 1.0), featureSubsetStrategy=_subset(params.get("max_features")), seed=seed,
        )
    if name == "logistic_regression":
        return LogisticRegression(
            **common, elasticNetParam=1.0 if params.get("penalty", "l2") == "l1" else 0.0,
            regParam=1.0 / (params.get("C", 1.0) * max(train_rows, 1)),
            standardization=False,  # the penalty is on the coefficients of the features as given
        )
    if name == "naive_bayes":
        return NaiveBayes(**common, modelType="multinomial", smoothing=params.get("alpha", 1.0))
    raise ValueError(f"unknown learner {name!r}")


def assemble(df: DataFrame, columns: Sequence[str], roles: Roles = DEFAULT, extra: Iterable[str] = ()) -> DataFrame:
    """Unit, label and one array of features, nulls kept for imputation. Of a sparse dataset the array has the numbers only, and
    ONES the positions of the chosen categories behind them."""
    blocks = blocks_of(df)
    dense = [c for c in columns if c not in blocks]
    out = [feature_array(dense, dict(df.dtypes)).alias("features")]
    if len(dense) < len(columns):
        ones, size = block_positions(blocks, [c for c in columns if c in blocks])
        out.append(ones.cast("array<string>").alias(ONES, metadata={"size": size}))
    return df.select(roles.unit, F.col(roles.label).cast("double").alias(roles.label), *extra, *out)


def impute_arrays(train: DataFrame, test: DataFrame, size: int, per_fold: bool = False) -> tuple[DataFrame, DataFrame]:
    """Mean imputation of both folds from the training fold (or each from itself)."""
    means = array_means(train, size)
    return fill_array(train, means), fill_array(test, array_means(test, size) if per_fold else means)


def vectors(df: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Feature arrays (and positions of ones, if any) as ML vectors; a missing value is an error."""
    complete = F.when(~F.exists("features", lambda x: x.isNull()), F.col("features")).otherwise(
        F.raise_error(F.lit("features contain a missing value"))
    )
    dense = array_to_vector(complete)
    if ONES not in df.columns or not df.schema[ONES].metadata["size"]:
        return df.select(roles.unit, roles.label, dense.alias("features"))
    # Positions are the words of a counted text whose vocabulary is the numbers: a sparse vector without a row of Python.
    names = [str(i) for i in range(df.schema[ONES].metadata["size"])]
    counted = CountVectorizerModel.from_vocabulary(names, inputCol=ONES, outputCol="_ones")
    parts = counted.transform(df.select(roles.unit, roles.label, dense.alias("_dense"), ONES))
    both = VectorAssembler(inputCols=["_dense", "_ones"], outputCol="features").transform(parts)
    return both.select(roles.unit, roles.label, "features")


def _scored(df: DataFrame, pred, prob, roles: Roles) -> DataFrame:
    return df.select(
        roles.unit, F.col(roles.label).cast("double").alias("y_true"), pred.cast("double").alias("y_pred"),
        prob.cast("double").alias("y_prob"),
    )


def dummy_scores(train: DataFrame, test: DataFrame, strategy: str, roles: Roles = DEFAULT, seed: int = 0) -> DataFrame:
    """Baselines: labels drawn from the training prior (`stratified`) or evenly
    (`uniform`). Draws are a hash of the unit."""
    u = uniform(roles.unit, seed=seed)
    if strategy == "uniform":
        return _scored(test, F.when(u < 0.5, 1.0).otherwise(0.0), F.lit(0.5), roles)
    if strategy != "stratified":
        raise ValueError(f"unknown strategy {strategy!r}")
    prior = train.agg(F.avg(F.col(roles.label).cast("double"))).first()[0] or 0.0
    drawn = F.when(u < F.lit(prior), 1.0).otherwise(0.0)
    return _scored(test, drawn, drawn, roles)


TREES = ("random_forest", "decision_tree", "gradient_boosting")


def effort(name: str, params: Mapping) -> int:
    """Levels of all trees of a learner, those that look at all features before the others: what is fitted longest has most."""
    if name not in TREES:
        return 0
    levels = params.get("n_estimators", 1) * _depth(params.get("max_depth"))
    return levels * (10 if params.get("max_features") is None else 1)


def rows_and_varying(train: DataFrame) -> tuple[int, int, list[int]]:
    """Number of rows, of features, and the features that have more than one value."""
    if train.isEmpty():  # the summary needs a row
        return 0, 0, []
    found = train.agg(Summarizer.metrics("count", "min", "max").summary(F.col("features")).alias("s")).select("s.*").first()
    low, high = found["min"].toArray(), found["max"].toArray()
    return found["count"], len(low), [i for i in range(len(low)) if low[i] != high[i]]


def sliced(df: DataFrame, positions: Sequence[int], roles: Roles = DEFAULT) -> DataFrame:
    """The features at the given positions."""
    some = VectorSlicer(inputCol="features", outputCol="_some", indices=list(positions)).transform(df)
    return some.select(roles.unit, roles.label, F.col("_some").alias("features"))


def fit(train: DataFrame, name: str, params: Mapping, train_rows: int | None = None, roles: Roles = DEFAULT):
    rows = train.count() if train_rows is None and name == "logistic_regression" else (train_rows or 1)
    return learner(name, params, rows, roles).fit(train)


def score(model, test: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Outcome, predicted label and probability of class 1 per test row."""
    return _scored(
        model.transform(test), F.col("prediction"), vector_to_array("probability")[1], roles
    )


def fit_score(train: DataFrame, test: DataFrame, name: str, params: Mapping, train_rows: int | None = None,
              roles: Roles = DEFAULT, varying: Sequence[int] | None = None) -> DataFrame:
    """`varying`: the features with more than one value. Trees that look at all features never split at the others, so that they are
    the same trees without them; learners that draw features, or weigh them, get all."""
    if name == "dummy":
        return dummy_scores(train, test, params["strategy"], roles, params.get("random_state", 0))
    if varying and name in TREES and params.get("max_features") is None:
        train, test = sliced(train, varying, roles), sliced(test, varying, roles)
    return score(fit(train, name, params, train_rows, roles), test, roles)
