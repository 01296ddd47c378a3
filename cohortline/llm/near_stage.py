"""The near-copy stage of the pipeline: SimHash fingerprints and prefixes of five-word shingle sets find candidates, whole sets decide.

First the operator of `simhash` links documents whose fingerprints differ in few bits (pigeonhole blocks, verified Hamming distance); of these
links those hold whose whole sets have the Jaccard similarity. Fingerprints alone would miss pairs, since sets of similarity 0.8 lie about ten bits apart.
So an exact search completes them; its rounds leave out what is connected already.

Shingles have one order for all documents (those in many documents last, the more the later, otherwise by hash). Two sets of n and m shingles with a
Jaccard similarity of t share at least t * max(n, m), so that the first n - t * n + 1 shingles of the one and of the other have a shingle in common
(prefix filter). A join on those meets every pair of similarity t or more, whatever the order is: nothing is estimated, and which
shingles count as common only changes the time. Candidates whose lengths and places of the shared shingle leave t possible go on to
their outlines: how many shingles of a set lie in each of about n / 4 equal ranges of the hash. Two sets can't share more than the smaller
number in each range, which rules out unrelated texts exactly and with a fraction of their bytes. What is left is decided by
the whole sets. Links make components, and the smallest id of each stays.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortline.llm.common import brief_shuffles, free_name, ranges, staged, whole_text
from cohortline.llm.components import components
from cohortline.llm.simhash import fingerprint_of, shingle_hashes
from cohortline.llm.simhash import links as fingerprint_links
from cohortline.llm.tokens import forget

#: Shingles shared by at most this many sets compare all pairs at once. Those shared by more go by rounds (`near_components`), which
#: leave out only pairs that are connected already; either way finds the same components.
CROWDED = 8
#: At most so many common shingles are put last.
COMMON = 200_000
#: A row of a crowded shingle carries at most so many earlier ones. With more of them in a prefix some pairs are met more than once.
EARLIER = 32
#: Bits of the sketch of shared shingles. A fuller sketch only lets more rows through to the join.
SKETCH = 1 << 26


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct shingle hashes of a text in order."""
    return np.unique(shingle_hashes(text or "", words, 0))


def prefix_length(n: int, similarity: float) -> int:
    """So many first shingles of a set of n that any set of the similarity has one of them in its own prefix."""
    return n - math.ceil(similarity * n - 1e-9) + 1


def common_shingles(docs: DataFrame, words: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that more than CROWDED documents have, the most frequent COMMON of them, in order, and the binary logarithm of how many do.

    The prefixes in hash order show which documents have any; all shingles of those documents are counted. Counting the prefixes alone
    would miss the rest of a passage that many share, which then moves up into the prefixes."""

    def most_frequent(tokens: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        counted = tokens.groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") > CROWDED)
        with brief_shuffles(docs.sparkSession):
            rows = counted.orderBy(F.desc("n"), "token").limit(COMMON).toArrow()  # bounded by COMMON rows
        found, n = rows["token"].to_numpy().view(np.uint64), rows["n"].to_numpy()
        order = np.argsort(found)
        return found[order], np.log2(n[order]).astype(np.int8)

    def tokens(chosen):
        def emit(batches):
            forget()
            for b in batches:
                found = [chosen(shingle_set(t.as_py(), words)) for t in b["text"]]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64))], ["token"])

        return docs.select("text").mapInArrow(emit, "token long")

    hot = docs.sparkSession.sparkContext.broadcast(most_frequent(tokens(lambda s: s[: prefix_length(len(s), similarity)]))[0])

    def all_if_hot(s: np.ndarray) -> np.ndarray:
        return s if places_of(s[: prefix_length(len(s), similarity)], hot.value)[1].any() else s[:0]

    return most_frequent(tokens(all_if_hot))


def places_of(tokens: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where in the sorted `known` each token is, and whether it is there at all."""
    if not len(known):
        return np.zeros(len(tokens), np.int64), np.zeros(len(tokens), bool)
    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
    return at, known[at] == tokens


def outline(s: np.ndarray) -> bytes:
    """For each of 2^k equal ranges of the hash (about len(s) / 4 of them) how many shingles of the set lie there, a byte each. Empty if
    a byte doesn't do, which leaves the set to the comparison of whole sets."""
    k = max(1, (len(s) // 4).bit_length())
    counts = np.bincount((s >> np.uint64(64 - k)).astype(np.int64), minlength=1 << k)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def most_shared(x: bytes, y: bytes) -> int | None:
    """No two sets of these outlines share more shingles; None if an outline is empty."""
    if not x or not y:
        return None
    u, v = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
    while len(u) != len(v):
        u, v = (u.reshape(-1, 2).sum(axis=1), v) if len(u) > len(v) else (u, v.reshape(-1, 2).sum(axis=1))
    return int(np.minimum(u, v).sum())


def prefixes(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """doc_id, key, fp, n, tokens, outline: digest, SimHash fingerprint, size, prefix and outline of the set of each row of `docs` (doc_id,
    text) that has words."""
    spread = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, words, similarity))

    def compute(batches):
        forget()
        last, grade = spread.value
        for b in batches:
            rows = []
            for i, t in zip(b["doc_id"].to_pylist(), b["text"]):
                hashes = shingle_hashes(t.as_py() or "", words, 0)
                s = np.unique(hashes)
                if len(s):
                    fp = int(fingerprint_of([hashes]).view(np.int64)[0])
                    at, late = places_of(s, last)
                    grades = np.zeros(len(s), np.int8)
                    grades[late] = grade[at[late]]
                    ordered = s[np.argsort(grades, kind="stable")][: prefix_length(len(s), similarity)]
                    rows.append((i, xxhash.xxh3_128_digest(s.tobytes()), fp, len(s), ordered.tobytes(), outline(s)))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "key", "fp", "n", "tokens", "outline"])

    return docs.mapInArrow(compute, "doc_id long, key binary, fp long, n long, tokens binary, outline binary")


def buckets(nodes: DataFrame) -> DataFrame:
    """token, id, n, place, m: of each prefix shingle that m > 1 of `nodes` (doc_id, n, tokens) have, who has it and where.

    Shingles are counted first. A bit sketch of those that several have, of SKETCH bits at most, keeps most of the others out of the
    shuffle; the join on the counts decides."""

    def tokens_of(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(b["tokens"].to_pylist()), np.int64), np.array([len(t.as_buffer()) // 8 for t in b["tokens"]], np.int64)

    def each(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(tokens_of(b)[0])], ["token"])

    counts = staged(nodes.select("tokens").mapInArrow(each, "token long").groupBy("token").agg(F.count("*").alias("m")).filter("m > 1"), "counts")
    width = min(SKETCH, max(1 << 10, 1 << (8 * counts.count()).bit_length()))
    bit = F.col("token").bitwiseAND(F.lit(width - 1))
    with brief_shuffles(nodes.sparkSession):
        words = counts.select(F.shiftright(bit, 6).alias("word"), F.expr("shiftleft(1L, cast(token & 63 as int))").alias("bit")).groupBy(
            "word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most SKETCH / 64 rows
    sketch = np.zeros(width // 64, np.int64)
    sketch[words["word"].to_numpy()] = words["bits"].to_numpy()
    shared = nodes.sparkSession.sparkContext.broadcast(sketch)

    def spread(batches):
        for b in batches:
            tokens, sizes = tokens_of(b)
            place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            at = tokens & (width - 1)
            keep = (shared.value[at >> 6] >> (at & 63) & 1).astype(bool)
            columns = [tokens, *(np.repeat(b[c].to_numpy(), sizes) for c in ("doc_id", "n")), place]
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in columns], ["token", "id", "n", "place"])

    rows = nodes.select("doc_id", "n", "tokens").mapInArrow(spread, "token long, id long, n long, place long")
    return rows.join(counts.hint("merge"), "token")


def with_earlier(met: DataFrame) -> DataFrame:
    """token, id, n, place, before, skipped: the rows of `met` whose shingle is crowded. `before` has at most EARLIER crowded shingles that
    come earlier in the prefix, `skipped` the number of other earlier ones that several sets have."""

    def compute(batches):
        for b in batches:
            for i, n, raw in zip(b["id"].to_pylist(), b["n"].to_pylist(), b["rows"]):
                rows = raw.values
                place, token, crowded = (rows.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                at = np.flatnonzero(crowded)
                sizes = np.minimum(np.arange(len(at)), EARLIER)
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                before = pa.ListArray.from_arrays(ends, pa.array(token[at][ranges(np.zeros(len(at), np.int64), sizes)], pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    pa.array(token[at], pa.int64()), pa.array([i] * len(at), pa.int64()), pa.array([n] * len(at), pa.int64()),
                    pa.array(place[at], pa.int64()), before, pa.array(at - sizes, pa.int64())],
                    ["token", "id", "n", "place", "before", "skipped"])

    crowded = F.col("m") > CROWDED
    rows = met.groupBy("id").agg(F.first("n").alias("n"), F.max(crowded).alias("any"), F.sort_array(F.collect_list(
        F.struct("place", "token", crowded.alias("crowded")))).alias("rows"))
    return rows.filter("any").select("id", "n", "rows").mapInArrow(
        compute, "token long, id long, n long, place long, before array<long>, skipped long")


def possible(similarity: float, earlier: Column) -> Column:
    """Whether sets of n and o_n shingles that share the ones at `place` and `o_place`, and at most `earlier` before, can have the similarity."""
    most = F.least("place", "o_place", earlier) + F.least(F.col("n") - F.col("place"), F.col("o_n") - F.col("o_place"))
    return (most * (1 + similarity) >= similarity * (F.col("n") + F.col("o_n")) - 1e-6) & (
        F.least("n", "o_n") >= similarity * F.greatest("n", "o_n") - 1e-6)


def meeting(left: DataFrame, right: DataFrame, similarity: float) -> DataFrame:
    """a, b (a > b): who of `left` and who of `right` share a shingle and may be similar; rows of one `label` don't count.

    With the columns of `with_earlier` a pair is met at the first crowded shingle that both have (later ones find a common one in `before`,
    except where that is full), where the places bound best what they share: a common earlier shingle is one that both skipped, or one of
    them if a `before` is full."""
    kept = ["id", "n", "place", "label", *(c for c in ("before", "skipped") if c in left.columns)]
    other = right.select("token", *[F.col(c).alias(f"o_{c}") for c in kept])
    fits = F.col("label") != F.col("o_label")
    if "before" in kept:
        full = F.greatest(F.size("before"), F.size("o_before")) >= EARLIER
        earlier = F.when(full, F.col("skipped") + F.col("o_skipped")).otherwise(F.least("skipped", "o_skipped"))
        fits = fits & possible(similarity, earlier) & ~F.arrays_overlap("before", "o_before")
    else:
        fits = fits & possible(similarity, F.col("place"))
    met = left.hint("merge").join(other, "token").filter(fits)
    return met.select(F.greatest("id", "o_id").alias("a"), F.least("id", "o_id").alias("b")).distinct()


def plausible(pairs: DataFrame, outlines: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose outlines (doc_id, n, outline) leave the similarity possible."""

    def compare(batches):
        for b in batches:
            keep = []
            for x, y, n, o_n in zip(b["x"].to_pylist(), b["y"].to_pylist(), b["n"].to_pylist(), b["o_n"].to_pylist()):
                most = most_shared(x, y)
                keep.append(most is None or most * (1 + similarity) >= similarity * (n + o_n) - 1e-6)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.hint("merge").join(outlines.select(F.col("doc_id").alias("a"), "n", F.col("outline").alias("x")), "a").join(
        outlines.select(F.col("doc_id").alias("b"), F.col("n").alias("o_n"), F.col("outline").alias("y")), "b")
    return both.select("a", "b", "n", "o_n", "x", "y").mapInArrow(compare, "a long, b long")


def similar(pairs: DataFrame, docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The pairs (a, b) whose sets of shingles have the Jaccard similarity; `docs`: doc_id, text. Texts without words are not similar.

    Pairs are grouped by one side, so that its set is sent once for up to 256 partners and not once a pair."""

    def sets(batches):
        for b in batches:
            raw = [shingle_set(t.as_py(), words).tobytes() for t in b["text"]]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(map(xxhash.xxh3_128_digest, raw), pa.binary()), pa.array(raw, pa.binary())],
                                             ["doc_id", "key", "shingles"])

    def compare(key, rows):
        own = next((np.frombuffer(x.as_buffer(), np.uint64) for x in rows["x"] if x.is_valid), np.empty(0, np.uint64))
        found = []
        for other, y in zip(rows["a"], rows["y"]):
            if y.is_valid:
                v = np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(own, v, True)) if min(len(own), len(v)) >= similarity * max(len(own), len(v)) else 0
                if shared > 0 and shared >= similarity * (len(own) + len(v) - shared):
                    found.append(other.as_py())
        return pa.table({"a": pa.array(found, pa.int64()), "b": pa.array([key[0].as_py()] * len(found), pa.int64())})

    ids = staged(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "wanted")  # its size decides the join
    found = staged(docs.join(ids, "doc_id", "left_semi").mapInArrow(sets, "doc_id long, key binary, shingles binary").filter(
        F.length("shingles") > 0).groupBy("doc_id").agg(F.min(F.struct("key", "shingles")).alias("s")).select(
        "doc_id", F.col("s.shingles").alias("shingles")), "shingles")
    sizes = pairs.groupBy("b").agg(F.ceil(F.count("*") / 256).alias("parts"))
    parts = staged(pairs.join(sizes, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("parts")).alias("part")), "dealt")
    partners = parts.join(found.select(F.col("doc_id").alias("a"), F.col("shingles").alias("y")), "a").select(
        "b", "part", "a", F.lit(None).cast("binary").alias("x"), "y")
    owners = parts.select("b", "part").distinct().join(found.select(F.col("doc_id").alias("b"), F.col("shingles").alias("x")), "b").select(
        "b", "part", F.lit(None).cast("long").alias("a"), "x", F.lit(None).cast("binary").alias("y"))
    return partners.unionByName(owners).groupBy("b", "part").applyInArrow(compare, "a long, b long")


def fingerprint_pairs(nodes: DataFrame, radius: int = 2, blocks: int = 4) -> DataFrame:
    """a, b (a > b): documents of `nodes` (doc_id, fp) whose fingerprints differ in at most `radius` bits, by the operator of `simhash`.

    The smallest id of a fingerprint stands for it in the links to others, and is tied to its other documents."""
    prints = staged(nodes.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")), "fingerprints")
    of = lambda fp, name: prints.select(F.col("fp").alias(fp), F.col("first").alias(name))
    close = fingerprint_links(prints, radius, blocks).withColumnsRenamed({"a": "x", "b": "y"}).join(of("x", "i"), "x").join(of("y", "j"), "y")
    same = nodes.select("doc_id", "fp").hint("merge").join(prints.filter("rows > 1"), "fp").filter("doc_id > first")
    return close.select(F.greatest("i", "j").alias("a"), F.least("i", "j").alias("b")).union(same.select("doc_id", "first"))


def near_components(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """node, component: ids of `docs` (doc_id, text) that are linked to another, and the smallest id of their component.

    Pairs come from the SimHash operator (`fingerprint_pairs`) and from the prefix filter, each once, and whole sets decide.
    Of rows that share an id the set of the smallest digest counts; documents of equal sets are linked to the smallest id, which stands for
    them. Pairs that meet in a crowded bucket are compared in rounds: some documents of each bucket, those with most links first, are
    compared with all others there that aren't connected to them yet, and are then done. Only when no bucket has two documents that are
    neither done nor connected is the search over, so that no pair is left out that could join two components. The number of documents
    taken grows eightfold a round."""
    docs = docs.filter("doc_id is not null")
    sets = staged(prefixes(docs, words, similarity), "prefixes")
    keys = sets.groupBy("doc_id").agg(F.min("key").alias("key"))
    first = staged(keys.groupBy("key").agg(F.min("doc_id").alias("id")), "firsts")
    equal = keys.join(first.hint("merge"), "key").filter("doc_id > id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    nodes = sets.hint("merge").join(first.withColumnRenamed("id", "doc_id"), ["doc_id", "key"], "left_semi").dropDuplicates(["doc_id", "key"])
    met = staged(buckets(nodes), "met")
    outlines = staged(nodes.select("doc_id", "n", "outline"), "outlines")
    few = met.filter(F.col("m") <= CROWDED).withColumn("label", F.col("id"))
    close = fingerprint_pairs(nodes).union(meeting(few, few, similarity)).distinct()
    pairs = staged(plausible(close, outlines, similarity), "candidates")
    links = staged(similar(pairs, docs, words, similarity).union(equal), "links")
    names = staged(components(links), "components")
    crowd = with_earlier(met).withColumn("done", F.lit(False))
    row = ["token", "id", "n", "place", "before", "skipped"]
    take = 1
    while True:
        degree = links.select(F.col("a").alias("id")).union(links.select("b")).groupBy("id").agg(F.count("*").alias("degree"))
        now = crowd.join(names.select(F.col("node").alias("id"), "component"), "id", "left").join(degree, "id", "left").select(
            *row, "done", F.coalesce("component", "id").alias("label"), F.coalesce("degree", F.lit(0)).alias("degree"))
        now = staged(now, "crowd")
        undone = now.filter("not done")
        still = undone.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("token")
        now = staged(undone.join(still, "token", "left_semi"), "open")
        rank = F.row_number().over(Window.partitionBy("token").orderBy(F.desc("degree"), F.xxhash64("id")))
        taken = staged(now.select("id", rank.alias("rank")).filter(F.col("rank") <= take).select("id").distinct(), "taken")
        if taken.isEmpty():
            return names
        pairs = staged(plausible(meeting(now.join(taken, "id", "left_semi"), now, similarity), outlines, similarity), "candidates")
        new = staged(similar(pairs, docs, words, similarity), "links")
        links = links.union(new)
        names = staged(components(names.filter("node <> component").select(
            F.col("node").alias("a"), F.col("component").alias("b")).union(new)), "components")
        crowd = now.join(taken.withColumn("now", F.lit(True)), "id", "left").select(
            *row, F.coalesce("now", F.lit(False)).alias("done"))
        take *= 8


def drop_near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The rows of `docs` without near copies: of each component the rows of the smallest id stay, with their columns.

    Rows with a null id stay; rows that share an id count as one document; null and empty texts are never near copies; texts of fewer than
    `words` words are compared as one shingle. An empty table stays empty."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    gone = free_name(docs, "near_copy")
    copies = near_components(named, words, similarity).filter("node <> component").select(F.col("node").alias(gone)).distinct()
    return docs.join(copies, docs[id_col].cast("long") == F.col(gone), "left_anti")
