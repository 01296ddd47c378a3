"""Connected components of a graph given as edges: contraction inside tasks, alternating star steps on tables while many edges are left."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import brief_shuffles, staged


#: Edges that one task contracts alone.
FEW = 100_000


def _contracted(edges: DataFrame, roots: bool = False, few: int = FEW) -> DataFrame:
    """The edges of a task as stars around the smallest nodes, at least `few` edges at once: the same components, never more edges. With
    `roots` each smallest node also has an edge to itself."""

    def contract(batches):
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while parent.setdefault(top, top) != top:
                top = parent[top]
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        def stars() -> pa.RecordBatch:
            pairs = [(x, top) for x in parent if (top := root(x)) != x or roots]
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])

        for b in batches:
            for x, y in zip(b["a"].to_pylist(), b["b"].to_pylist()):
                x, y = root(x), root(y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            if len(parent) > 2 * few:  # never with `few` edges
                yield stars()
                parent.clear()
        yield stars()

    return edges.select("a", "b").mapInArrow(contract, "a long, b long")


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star step on edges a > b. Large: each larger neighbour of a node is tied to the least node around it; small: the
    node and its smaller neighbours are. Both keep the components; partial sums reduce a node with very many
    edges before the shuffle, and Spark splits its side of the join."""
    both = edges if small else edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    tied = both.hint("merge").join(least, "a")
    if small:
        tied = tied.select("b", "m").union(least.select(F.col("a").alias("b"), "m"))
    else:
        tied = tied.filter("b > a").select("b", "m")
    return tied.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """node, component (its smallest node) for every node of `edges` (a, b: longs, a <> b).

    Tasks contract the edges that they have. Up to `few` edges that are left go to one task, which decides. More go through large-star and small-star steps,
    which join what lies in several tasks, until nothing changes or few are left: a path of n nodes takes about log n rounds. Each round is written to the shared folder.
    Repeated edges count once; rows with a null, and edges from a node to itself, must not occur; without edges there are no rows."""
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = staged(_contracted(ordered), "edges")
    mark = None
    while True:
        with brief_shuffles(now.sparkSession):
            if now.count() <= few:
                return staged(_contracted(now.coalesce(1), roots=True, few=few), "edges").select(
                    F.col("a").alias("node"), F.col("b").alias("component"))
            new = tuple(now.distinct().agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if new == mark:
            break
        mark = new
        now = staged(_contracted(_star(_star(now, small=False), small=True).distinct()), "edges")
    now = now.distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
