"""Approximate nearest neighbours by a forest of random projections, for many features.

A tree is fitted on a bounded sample: each node cuts its part of the sample at the median along the line through two
random points of it, until a leaf stands for about `leaf_rows` rows of the whole table. Every row then goes down every tree, and is compared
with the rows of its leaves. A row's neighbours are the closest it met in any tree, so recall grows with the trees. Leaves that are more
crowded than the sample promised (rows can be as unevenly spread as they like) are cut into chunks whose pairs are compared by tasks
of their own, so that no task holds more than two chunks and no pair of a leaf is left out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.functions.hashing import digest
from cohortline.operators import neighbours as exact
from cohortline.roles import DEFAULT, Roles
from cohortline.sources.shared import durable

#: Rows that the trees are fitted on, at most.
SAMPLE = 10_000


class Tree:
    """Cuts (direction, threshold) and children of the inner nodes; a negative child -1 - i is leaf i."""

    def __init__(self, sample: np.ndarray, leaf: float, draw: np.random.Generator) -> None:
        self.directions: list[np.ndarray] = []
        self.thresholds: list[float] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.root = self._grow(sample, leaf, draw, 0)

    def _grow(self, part: np.ndarray, leaf: float, draw: np.random.Generator, depth: int) -> int:
        if len(part) > max(2.0, leaf) and depth < 40:
            for _ in range(5):  # two equal points give no direction
                a, b = part[draw.integers(len(part), size=2)]
                along = part @ (b - a)
                low = along <= (cut := float(np.median(along)))
                if 0 < low.sum() < len(part):
                    node = len(self.children)
                    self.directions.append(b - a)
                    self.thresholds.append(cut)
                    self.children.append([0, 0])
                    self.children[node] = [self._grow(part[low], leaf, draw, depth + 1), self._grow(part[~low], leaf, draw, depth + 1)]
                    return node
        self.leaves += 1
        return -self.leaves

    def leaves_of(self, rows: np.ndarray) -> np.ndarray:
        """The number of each row's leaf."""
        found = np.zeros(len(rows), np.int64)
        stack = [(self.root, np.arange(len(rows)))]
        while stack:
            node, who = stack.pop()
            if node < 0 or not len(who):
                found[who] = -1 - node
                continue
            low = rows[who] @ self.directions[node] <= self.thresholds[node]
            stack += [(self.children[node][0], who[low]), (self.children[node][1], who[~low])]
        return found


def fit_forest(vectors: DataFrame, trees: int, leaf_rows: int, seed: int = 0) -> list[Tree]:
    """Trees over the column `v`, fitted on the SAMPLE rows of smallest hash."""
    rows = vectors.orderBy(digest("vid", seed=seed)).limit(SAMPLE).select("v").collect()  # bounded by SAMPLE
    sample = np.array([r["v"] for r in rows], float).reshape(len(rows), -1)
    share = len(rows) / max(1, vectors.count())
    draw = np.random.default_rng(seed)
    return [Tree(sample, leaf_rows * share, draw) for _ in range(trees)]


def approximate_neighbours(points: DataFrame, k: int, roles: Roles = DEFAULT, features: str = "features", trees: int = 24,
                           leaf_rows: int = 256, seed: int = 0) -> DataFrame:
    """About the k nearest other rows of every row: (unit, rank, neighbour, distance), as `nearest_neighbours` gives exactly.

    `features` is an array of doubles without nulls; units are unique. Exact copies are always found, distances are exact, and ties go by unit; a
    row whose leaves hold fewer than k others has fewer neighbours."""
    unit = roles.unit
    id_type = points.schema[unit].dataType.simpleString()
    vectors = durable(exact.distinct_vectors(points, k, unit, features))
    forest = points.sparkSession.sparkContext.broadcast(fit_forest(vectors, trees, leaf_rows, seed))  # bounded by the sample

    def descend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                rows = np.stack([np.asarray(v, float) for v in b["v"]])
                for number, tree in enumerate(forest.value):
                    yield pd.DataFrame({"tree": number, "leaf": tree.leaves_of(rows), "vid": b["vid"]})

    placed = durable(vectors.select("vid", "v").mapInPandas(descend, f"tree int, leaf long, vid {id_type}"))
    chunks = placed.groupBy("tree", "leaf").agg(
        F.count(F.lit(1)).alias("rows"), F.ceil(F.count(F.lit(1)) / (2 * leaf_rows)).cast("int").alias("chunks"))
    own = placed.join(chunks.drop("rows"), ["tree", "leaf"]).withColumn("own", F.pmod(F.xxhash64("vid"), F.col("chunks")).cast("int"))
    # A row asks every chunk of its leaf, and is asked by every chunk; in its own chunk it does both as one row.
    numbers, mine = F.sequence(F.lit(0), F.col("chunks") - 1), F.col("own")
    where = F.flatten(F.transform(numbers, lambda c: F.when(c == mine, F.array(F.struct(mine.alias("i"), c.alias("j")))).otherwise(
        F.array(F.struct(mine.alias("i"), c.alias("j")), F.struct(c.alias("i"), mine.alias("j"))))))
    dealt = own.select("tree", "leaf", "vid", "own", F.explode(where).alias("p")).select(
        "tree", "leaf", "vid", "p.i", "p.j", (F.col("p.i") == mine).alias("asks"), (F.col("p.j") == mine).alias("asked"))
    width = vectors.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]
    crossings = chunks.agg(F.coalesce(F.sum(F.col("rows") * (2 * F.col("chunks") - 1)), F.lit(0))).first()[0]
    key = ["tree", "leaf", "i", "j"]
    rows = dealt.join(vectors.select("vid", "v"), "vid").repartition(exact.tasks_for(points.sparkSession, crossings, width), *key)

    def best(met: pd.DataFrame) -> pd.DataFrame:
        asks, asked = met["asks"].to_numpy(), met["asked"].to_numpy()
        if not asks.any() or not asked.any():
            return pd.DataFrame({"vid": [], "nid": [], "d2": []})
        m, ids = exact._matrix(met["v"]), met["vid"].to_numpy()
        who, whom, d2 = exact._closest(m[asks], ids[asks], m[asked], ids[asked], k)
        return pd.DataFrame({"vid": ids[asks][who], "nid": ids[asked][whom], "d2": d2})

    met = rows.groupBy(*key).applyInPandas(best, f"vid {id_type}, nid {id_type}, d2 double")
    found = met.groupBy("vid", "nid").agg(F.min("d2").alias("d2"))  # at most k a tree and chunk
    return exact.with_copies(points, vectors, found, k, unit, features)


def recall(approximate: DataFrame, true: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """One row: `wanted` neighbours of the exact lists, and the share of them found. A neighbour counts as found when the approximate one of
    the same rank is as close, so that ties don't count as losses."""
    both = true.select(roles.unit, "rank", F.col("distance").alias("d")).join(
        approximate.select(roles.unit, "rank", "distance"), [roles.unit, "rank"], "left")
    hit = F.coalesce(F.col("distance") <= F.col("d") * (1 + 1e-9) + 1e-9, F.lit(False))
    return both.agg(F.count(F.lit(1)).alias("wanted"), F.avg(hit.cast("double")).alias("recall"))
