"""Best-fit packing with large-item matching: few sequences of bounded length, documents cut only when longer than one.

Pieces of more than a third of a sequence go at most two to a sequence, so that filling those is a matching: the longest piece
takes the longest one that still fits beside it. This makes as many pairs as can be, since what fits beside a piece also fits
beside every shorter one. Pieces of a third or less then go, from the longest down, into the smallest gap that takes
them, or else into new sequences.

Pieces of one length are alike, so the plan needs only how many there are of each length: at most `window` numbers, whatever
the size of the corpus. It places runs of equal pieces into runs of equal sequences (`Plan`), and each run that is placed halves
a gap at least, so that the plan is short too. A task numbers its pieces of each length; numbers of tasks are
added up by a window over tasks; then every piece finds its run, its sequence and its offset by its rank.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortline.llm.common import staged, whole_text
from cohortline.llm.tokens import encoded

PIECES = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"


class Plan:
    """Places for `counts` pieces (length: how many) in sequences of `window`.

    runs: (length, first rank, first sequence, pieces in one sequence, offset): the pieces of a length from this rank on, up to
    the first rank of the next run of the length, lie side by side from the offset on, so many in a sequence, in
    consecutive sequences. sequences: how many there are."""

    def __init__(self, counts: dict[int, int], window: int) -> None:
        self.window, self.sequences = window, 0
        self.runs: list[tuple[int, int, int, int, int]] = []
        self._ranks: dict[int, int] = {}
        self._gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs (first sequence, how many)
        self._order: list[int] = []  # the gaps that there are, ascending
        left = {size: n for size, n in counts.items() if n > 0}
        self._match({s: n for s, n in left.items() if 3 * s > window})
        for size in sorted((s for s in left if 3 * s <= window), reverse=True):
            self._fill(size, left[size])

    def _place(self, size: int, n: int, first: int, each: int, offset: int) -> None:
        rank = self._ranks.get(size, 0)
        self.runs.append((size, rank, first, each, offset))
        self._ranks[size] = rank + n

    def _open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _leave(self, gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in self._gaps:
                self._gaps[gap] = []
                insort(self._order, gap)
            self._gaps[gap].append((first, n))

    def _match(self, left: dict[int, int]) -> None:
        sizes = sorted(left)
        while sizes:
            size = sizes[-1]
            partner = bisect_left(sizes, self.window - size + 1) - 1
            other = sizes[partner] if partner >= 0 else 0
            if other == size and left[size] > 1:  # pairs of one length
                n = left[size] // 2
                first = self._open(n)
                self._place(size, 2 * n, first, 2, 0)
                self._leave(self.window - 2 * size, first, n)
                left[size] -= 2 * n
            elif other and other != size:
                n = min(left[size], left[other])
                first = self._open(n)
                self._place(size, n, first, 1, 0)
                self._place(other, n, first, 1, size)
                self._leave(self.window - size - other, first, n)
                left[size] -= n
                left[other] -= n
                if not left[other]:
                    del sizes[partner]
            elif other == size and partner > 0:  # one is left of this length: beside the next shorter one
                other = sizes[partner - 1]
                first = self._open(1)
                self._place(size, 1, first, 1, 0)
                self._place(other, 1, first, 1, size)
                self._leave(self.window - size - other, first, 1)
                left[size] -= 1
                left[other] -= 1
                if not left[other]:
                    del sizes[partner - 1]
            else:
                n = left[size]
                first = self._open(n)
                self._place(size, n, first, 1, 0)
                self._leave(self.window - size, first, n)
                left[size] = 0
            if not left[size]:
                sizes.pop()

    def _fill(self, size: int, n: int) -> None:
        at = bisect_left(self._order, size)
        while n and at < len(self._order):
            gap = self._order[at]
            runs, each = self._gaps[gap], gap // size
            while n and runs:
                first, many = runs.pop()
                offset, whole = self.window - gap, min(many, n // each)
                if whole:
                    self._place(size, whole * each, first, each, offset)
                    n -= whole * each
                    self._leave(gap - each * size, first, whole)
                if whole < many:
                    if n:  # fewer than a sequence takes
                        self._place(size, n, first + whole, n, offset)
                        self._leave(gap - n * size, first + whole, 1)
                        whole, n = whole + 1, 0
                    if whole < many:
                        runs.append((first + whole, many - whole))
            if not runs:
                del self._gaps[gap]
                self._order.remove(gap)
            at = bisect_left(self._order, size)  # what is left of a gap is smaller than the piece, or the pieces are used up
        if n:
            each = self.window // size
            whole = n // each
            if whole:
                first = self._open(whole)
                self._place(size, whole * each, first, each, 0)
                self._leave(self.window - each * size, first, whole)
                n -= whole * each
            if n:
                first = self._open(1)
                self._place(size, n, first, n, 0)
                self._leave(self.window - n * size, first, 1)

    def columns(self) -> tuple[np.ndarray, ...]:
        """The runs by length and rank, as columns."""
        return tuple(np.array(c, np.int64) for c in zip(*sorted(self.runs))) if self.runs else (np.empty(0, np.int64),) * 5


def token_pieces(docs: DataFrame, path: str, end_id: int, window: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, piece, start, length, ids, part, nth: pieces of `window` ids at most; the nth of its length in the part, which is the task."""

    def cut(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        for b in batches:
            names, rows = b["id"].to_pylist(), []

            def batch():
                columns = list(zip(*rows)) or [()] * 7
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [
                    pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()])],
                    ["doc_id", "piece", "start", "length", "ids", "part", "nth"])

            for name, ids in zip(names, encoded(b["t"], path, end_id)):
                for piece, at in enumerate(range(0, len(ids), window)):
                    some = ids[at:at + window]
                    rows.append((name, piece, at, len(some), some.astype("<u4").tobytes(), part, int(seen[len(some)])))
                    seen[len(some)] += 1
                if len(rows) >= 4000:
                    yield batch()
                    rows = []
            yield batch()

    texts = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("t"))
    return texts.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary, part long, nth long")


def pack_matched(docs: DataFrame, path: str, end_id: int = 0, window: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Pieces of documents in as few sequences of at most `window` ids as matching and best fit need; columns: PIECES.

    A document is the ids of its text and the end id; one longer than `window` is cut into pieces of that length and a rest.
    `ids` are unsigned 32-bit little-endian. A null text counts as empty and has only its end id; rows that repeat, or share an id,
    are packed as often as they come; a null id stays null. An empty table gives no piece; other columns are left out."""
    pieces = staged(token_pieces(docs, path, end_id, window, id_col, text_col), "pieces")
    numbers = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    bases = staged(numbers.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "bases")
    counts = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `window` rows
    runs = docs.sparkSession.sparkContext.broadcast(Plan(counts, window).columns())  # bounded by the window

    def lay(batches):
        length, rank, first, each, offset = runs.value
        key = length << 44 | rank
        for b in batches:
            own, at = b["length"].to_numpy(), b["rank"].to_numpy()
            run = np.searchsorted(key, own << 44 | at, side="right") - 1
            past = at - rank[run]
            yield pa.RecordBatch.from_arrays(
                [*(b[c] for c in ("doc_id", "piece", "start", "length", "ids")), pa.array(first[run] + past // each[run]),
                 pa.array(offset[run] + past % each[run] * own)],
                ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"])

    ranked = pieces.join(bases.select("part", "length", "base"), ["part", "length"])
    return ranked.select("doc_id", "piece", "start", "length", "ids", (F.col("base") + F.col("nth")).alias("rank")).mapInArrow(lay, PIECES)
