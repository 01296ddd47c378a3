"""Quality classifier by compression: zstandard dictionaries of good and of bad text.

A text that is like the good training text compresses better with the good dictionary. The score is a logistic
calibration of the two compressed sizes per byte: their difference, their normalised difference, the
sizes themselves and the length. Dictionaries and calibration use separate rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import staged, whole_text

LEVEL = 3
#: The columns of _features.
SIZES = ("x0", "x1", "x2", "x3", "x4", "x5")


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries, and the calibration: mean, spread and weight of each feature. Without dictionaries every score is 1."""

    good: bytes = b""
    bad: bytes = b""
    mean: tuple[float, ...] = ()
    spread: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()


def _compressors(good: bytes, bad: bytes) -> list[zstandard.ZstdCompressor]:
    found = []
    for raw in (good, bad):
        data = zstandard.ZstdCompressionDict(raw)
        data.precompute_compress(level=LEVEL)
        found.append(zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False))
    return found


def _features(texts: list[str], compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    rows = np.empty((len(texts), 3))
    for i, t in enumerate(texts):
        raw = t.encode("utf-8", "surrogatepass")
        rows[i] = (*(len(c.compress(raw)) for c in compressors), len(raw) + 1)
    good, bad, n = rows[:, 0] / rows[:, 2], rows[:, 1] / rows[:, 2], rows[:, 2]
    return np.stack([bad - good, (bad - good) / (bad + good), good, bad, np.log(n), good**2], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, weigh: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights (the intercept first) of a ridge logistic regression, by Newton steps; `weigh` says for how many rows each row stands."""
    x = np.c_[np.ones(len(x)), x]
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-6, *[1e-2] * (x.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (weigh * (p * (1 - p) + 1e-9))) @ x + ridge, x.T @ (weigh * (y - p)) - ridge @ w)
        w = w + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def train_quality(docs: DataFrame, labels: DataFrame, sample: int = 4000, dictionary: int = 65_536,
                  longest: int = 20_000, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> QualityModel:
    """Fit on labelled rows.

    At most `sample` rows of each class are used, those with the smallest hash of the id: this bounds what the driver trains on, whatever
    the size of the tables. In the calibration a class weighs as many rows as it has labels, so that a score means the same whether or not
    `sample` binds. Of each class two fifths go to the dictionary, at most `longest` characters of a text, and the rest to the
    calibration, whose texts are compressed whole in tasks. Rows with a null label or id are left out; an id labelled
    twice counts with its smaller label. With fewer than ten labelled rows of either class nothing is learned."""
    named = labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).cast("long").alias("_id")).agg(
        F.min(label_col).cast("int").alias("_label")).filter("_id is not null")
    order = F.xxhash64("_id")
    picked = named.filter("_label = 1").orderBy(order).limit(sample).union(
        named.filter("_label = 0").orderBy(order).limit(sample))  # bounded by 2 * sample rows
    rows = staged(docs.select(F.col(id_col).cast("long").alias("_id"), whole_text(text_col).alias("_text")).join(
        F.broadcast(picked), "_id").groupBy(order.alias("_h")).agg(F.min("_label").alias("_label"), F.min("_text").alias("_text")), "labelled")
    of = {k: sorted(r["_h"] for r in rows.filter(F.col("_label") == k).select("_h").collect()) for k in (0, 1)}
    if min(map(len, of.values())) < 10:
        return QualityModel()
    last = {k: v[max(5, len(v) * 2 // 5) - 1] for k, v in of.items()}  # the largest hash of the dictionary's rows
    raw = {}
    for k in (0, 1):
        own = rows.filter((F.col("_label") == k) & (F.col("_h") <= last[k]))
        texts = sorted(own.select("_h", F.substring("_text", 1, longest).alias("_text")).collect())
        parts = [r["_text"].encode("utf-8", "surrogatepass") for r in texts]
        try:
            raw[k] = zstandard.train_dictionary(min(dictionary, max(1024, sum(map(len, parts)) // 10)), parts).as_bytes()
        except zstandard.ZstdError:  # too little text to train on: the text itself serves as a dictionary
            raw[k] = b" ".join(parts)[-dictionary:] or b" "

    def features(batches):
        compressors = _compressors(raw[1], raw[0])
        for b in batches:
            x = _features(b["_text"].to_pylist(), compressors)
            yield pa.RecordBatch.from_arrays([b["_h"], b["_label"], *map(pa.array, x.T)], ["_h", "_label", *SIZES])

    schema = ", ".join(["_h long, _label int", *[f"{c} double" for c in SIZES]])
    rest = rows.filter(F.col("_h") > F.when(F.col("_label") == 1, last[1]).otherwise(last[0]))
    found = np.array(sorted(map(tuple, rest.mapInArrow(features, schema).select("_h", "_label", *SIZES).collect())), object)
    x, y = found[:, 2:].astype(float), found[:, 1].astype(float)
    labelled = {r["_label"]: r["count"] for r in named.groupBy("_label").count().collect()}
    share = np.where(y == 1, labelled[1] / sum(y == 1), labelled[0] / sum(y == 0))
    weigh = share / share.mean()
    mean = np.average(x, axis=0, weights=weigh)
    spread = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=weigh)) + 1e-9
    weights = _logistic((x - mean) / spread, y, weigh)
    return QualityModel(raw[1], raw[0], tuple(mean), tuple(spread), tuple(weights))


def quality_score(model: QualityModel, text: Column | str) -> Column:
    """The probability that the text is good; empty (or null) texts get the score of their sizes like any other."""

    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compressors = _compressors(model.good, model.bad) if model.weights else None
        for texts in parts:
            if compressors is None:
                yield pd.Series(np.ones(len(texts)))
                continue
            x = (_features([t or "" for t in texts], compressors) - np.array(model.mean)) / np.array(model.spread)
            z = model.weights[0] + x @ np.array(model.weights[1:])
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return F.pandas_udf(score, "double")(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def classify(docs: DataFrame, model: QualityModel, threshold: float = 0.7, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted (1 if the score reaches the threshold) of each row, repeated rows and null ids too."""
    return docs.select(F.col(id_col).alias("doc_id"), quality_score(model, text_col).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def drop_bad(docs: DataFrame, model: QualityModel, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose score reaches the threshold, with their columns.

    Each row counts for itself, whatever its id: repeated rows stay or go together. Null counts as empty, and an empty text has a score
    like any other. Long texts are scored whole; an empty table stays empty."""
    return docs.filter(quality_score(model, F.col(text_col)) >= threshold)
