"""Exact deduplication by a tree-merge of sorted digest runs.

Every row becomes a fixed-width entry: digest of the normalised text, its length and a second
hash (both verify that equal digests are equal texts), then the order of preference. A task sorts its entries into a
run. Slots then exchange parts of runs in rounds over a tree with `fan_in` children: in round r a
slot keeps what belongs to its own r-th digit of the digest and passes on the rest, merges what it gets and
retains one entry a text, with the smallest key and the summed count. After the last round each
slot holds a disjoint part of the digests. A text with a third of all rows is one entry a run from the
first step on, so no slot gets more than `fan_in` entries of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import SPACE, free_name, partitions, staged, whole_text

#: sha-256, characters of the normalised text, xxhash64; then the preference: characters, id, row.
VERIFIED, ENTRY = 32 + 8 + 8, 32 + 8 + 8 + 8 + 9 + 8
RUN = "slot int, entries binary, counts binary, ties binary"
OUT = "sha binary, norm_chars long, check long, keep_row long, group_size long, ties long"


def _big(values: np.ndarray, flip: bool = True) -> np.ndarray:
    """Signed 64-bit integers as bytes that sort like the numbers."""
    u = values.astype(np.int64).view(np.uint64)
    if flip:
        u = u ^ np.uint64(1 << 63)
    return u.astype(">u8").view(np.uint8).reshape(-1, 8)


def _small(raw: np.ndarray, flip: bool = True) -> np.ndarray:
    u = np.ascontiguousarray(raw).view(">u8").ravel().astype(np.uint64)
    return (u ^ np.uint64(1 << 63) if flip else u).view(np.int64)


def _merge(entries: np.ndarray, counts: np.ndarray, ties: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One sorted run of sorted runs laid end to end; of equal texts the first entry stays.

    The stable sort finds the ascending runs and merges them."""
    if not len(entries):
        return entries, counts, ties
    order = np.argsort(np.ascontiguousarray(entries).view(f"S{ENTRY}").ravel(), kind="stable")
    entries, counts, ties = entries[order], counts[order], ties[order]
    new = np.r_[True, (entries[1:, :VERIFIED] != entries[:-1, :VERIFIED]).any(axis=1)]
    first = np.flatnonzero(new)
    best = np.repeat(first, np.diff(np.r_[first, len(entries)]))
    same = (entries[:, : ENTRY - 8] == entries[best, : ENTRY - 8]).all(axis=1)
    return entries[first], np.add.reduceat(counts, first), np.add.reduceat(np.where(same, ties, 0), first)


def _digit(entries: np.ndarray, level: int, fan_in: int) -> np.ndarray:
    head = np.ascontiguousarray(entries[:, :8]).view(">u8").ravel().astype(np.uint64)
    return ((head // np.uint64(fan_in**level)) % np.uint64(fan_in)).astype(np.int64)


def _parts(slot: int, run, level: int, fan_in: int) -> pa.RecordBatch:
    """The run cut by the digit of `level`; each part goes to the slot with that digit."""
    digit = _digit(run[0], level, fan_in)
    base = slot - (slot // fan_in**level) % fan_in * fan_in**level
    rows = [(base + d * fan_in**level, *(x[digit == d].tobytes() for x in run)) for d in np.unique(digit)]
    slots, *columns = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)],
                                      ["slot", "entries", "counts", "ties"])


def _read(t: pa.Table):
    join = lambda name: b"".join(t[name].to_pylist())
    return (np.frombuffer(join("entries"), np.uint8).reshape(-1, ENTRY),
            np.frombuffer(join("counts"), np.int64), np.frombuffer(join("ties"), np.int64))


def text_facts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, sha (of the text without white space), norm_chars, check, chars of each row."""
    norm = F.regexp_replace(whole_text(text_col), SPACE, "")
    return docs.select(
        F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("t"), norm.alias("n"),
    ).select("id", F.unhex(F.sha2("n", 256)).alias("sha"), F.char_length("n").cast("long").alias("norm_chars"),
             F.xxhash64("n").alias("check"), F.char_length("t").cast("long").alias("chars"))


def keepers(facts: DataFrame, fan_in: int = 8) -> DataFrame:
    """sha, norm_chars, check, keep_row, group_size, ties (rows with the kept row's id and length), one row a text.

    `facts`: the columns of text_facts and `row`, a stable number of each row."""
    spark = facts.sparkSession
    rounds = 1
    while fan_in**rounds < partitions(spark):
        rounds += 1
    slots = fan_in**rounds

    def leaves(batches):
        slot = TaskContext.get().partitionId() % slots
        for b in batches:
            ids = np.array([0 if x is None else x for x in b["id"].to_pylist()], np.int64)
            missing = np.array([x is None for x in b["id"].to_pylist()], np.uint8)
            number = lambda name: b[name].to_numpy(zero_copy_only=False)
            entries = np.concatenate([
                np.frombuffer(b"".join(b["sha"].to_pylist()), np.uint8).reshape(-1, 32), _big(number("norm_chars")),
                _big(number("check")), _big(-number("chars")), missing[:, None], _big(ids), _big(number("row")),
            ], axis=1)
            ones = np.ones(len(entries), np.int64)
            yield _parts(slot, _merge(entries, ones, ones), 0, fan_in)

    def inner(level):
        def merge(key, t):
            return pa.Table.from_batches([_parts(key[0].as_py(), _merge(*_read(t)), level, fan_in)])
        return merge

    def last(t):
        entries, counts, ties = _merge(*_read(t))
        cut = lambda a, b: _small(entries[:, a:b])
        return pa.table({
            "sha": pa.array([x.tobytes() for x in entries[:, :32]], pa.binary()), "norm_chars": cut(32, 40),
            "check": cut(40, 48), "keep_row": cut(ENTRY - 8, ENTRY), "group_size": counts, "ties": ties,
        })

    runs = facts.mapInArrow(leaves, RUN)
    for level in range(1, rounds):
        runs = runs.groupBy("slot").applyInArrow(inner(level), RUN)
    return runs.groupBy("slot").applyInArrow(last, OUT)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and chars, repeats: one row for each input row.

    Texts are equal when they are identical without ASCII white space. Of equal texts the one with the most code
    points stays, then the smallest id; a null id comes last; of rows that agree in all this any one stays, and only that one is
    `kept`. A null text counts as empty, and empty texts are copies of each other. `repeats` counts the
    rows that share the kept row's id and length. An empty table gives an empty result; other columns of the input are
    ignored. Copies of one text may be a third of all rows: they meet as one entry a run, and the
    verdict goes back by a join whose hot side Spark splits."""
    facts = staged(text_facts(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "facts")
    best = staged(keepers(facts, fan_in), "keepers")
    best = best.join(facts.select(F.col("row").alias("keep_row"), F.col("id").alias("keep_id")), "keep_row")
    return facts.join(best, ["sha", "norm_chars", "check"]).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "chars", F.col("ties").alias("repeats"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8) -> DataFrame:
    """The rows of `docs` that exact_dedup keeps, with their columns, which may have any name.

    Null and empty texts are equal, so one of them stays; of rows with one id and one text one stays; a null id is an id like any other. An
    empty table stays empty."""
    verdict = staged(exact_dedup(docs, id_col, text_col, fan_in).filter("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.col("chars").alias("_chars"),
        F.col("repeats").alias("_repeats")), "kept")
    names = [free_name(docs, x) for x in ("key_id", "key_sha", "key_chars", "key_repeats")]
    verdict = verdict.toDF(*names)
    text = whole_text(text_col)
    found = docs.join(
        verdict, docs[id_col].cast("long").eqNullSafe(verdict[names[0]])
        & (F.sha2(F.regexp_replace(text, SPACE, ""), 256) == verdict[names[1]])
        & (F.char_length(text) == verdict[names[2]]))
    once = found.filter(F.col(names[3]) == 1).select(*docs.columns)
    if verdict.filter(F.col(names[3]) > 1).isEmpty():
        return once
    return once.unionByName(found.filter(F.col(names[3]) > 1).dropDuplicates(names[:3]).select(*docs.columns))
