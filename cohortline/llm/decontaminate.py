"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

Only DataFrame functions. A window can reach a similarity of 0.8 only if it holds shingles of the item, and
the best window can be taken to start at one; so windows start where a document holds a shingle of the benchmark. A bit
sketch finds these places inside each row, without a shuffle. Windows of equal content are fingerprinted once. Each block
of an item's fingerprint is indexed with all values that differ in few bits, so that a join of blocks meets every
fingerprint within the radius. What it meets is compared by the weighted Jaccard similarity of the shingles.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import free_name, staged, whole_text

#: Two counters of 32 bits a long: bits r and r + 32 of a hash.
LANES = 0x0000000100000001


def let(value: Column, use) -> Column:
    """`use` of a value that is worked out once a row, also where `use` reads it in a loop."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    """Words in lower case, without ASCII punctuation."""
    return F.array_remove(F.split(F.lower(text), r"[\s\p{Punct}]+"), "")


def shingles_of(words: Column, size: int) -> Column:
    """A hash of each run of `size` words; none if there are fewer."""
    places = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(
        F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)]))


def simhash(hashes: Column) -> Column:
    """64-bit fingerprint: a bit is 1 if it is set in over half of the hashes."""
    sums = F.aggregate(
        hashes, F.array_repeat(F.lit(0).cast("long"), 32),
        lambda acc, h: F.transform(acc, lambda c, r: c + F.call_function("shiftrightunsigned", h, r).bitwiseAND(F.lit(LANES))))
    n = F.size(hashes)

    def bits(c: Column, r: Column) -> Column:
        low, high = c.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(c, 32)
        one = lambda count, at: F.call_function("shiftleft", (count * 2 > n).cast("long"), at)
        return one(low, r).bitwiseOR(one(high, r + 32))

    return F.aggregate(F.transform(sums, bits), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Sum of the smaller over sum of the larger counts of each hash."""
    times = lambda hashes, x: F.size(F.filter(hashes, lambda y: y == x))
    shared = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, x: s + F.least(times(a, x), times(b, x)))
    return shared / (F.size(a) + F.size(b) - shared)


def _sketch(hashes: DataFrame) -> tuple[str, int]:
    """A Bloom filter of three bits a hash: its words as text and its number of bits, 32 a hash, between 2^14 and 2^22."""
    n = hashes.count()
    bits = 1 << min(22, max(14, (32 * n).bit_length()))
    places = F.explode(F.array(*[_place(F.col("h"), k, bits) for k in range(3)]))
    found = dict(hashes.select(places.alias("b")).groupBy(F.shiftright("b", 6).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("b").bitwiseAND(F.lit(63)).cast("int"))).alias("v")
    ).collect())  # at most bits / 64 rows
    return ",".join(str(found.get(i, 0)) for i in range(bits // 64)), bits


def _place(h: Column, k: int, bits: int) -> Column:
    return F.shiftrightunsigned(h, 20 * k).bitwiseAND(F.lit(bits - 1))


def _in_sketch(h: Column, words: str, bits: int) -> Column:
    table = F.split(F.lit(words), ",").cast("array<bigint>")  # folded into one constant
    tests = [F.call_function("getbit", F.get(table, F.shiftright(_place(h, k, bits), 6).cast("int")),
                             _place(h, k, bits).bitwiseAND(F.lit(63)).cast("int")) == 1 for k in range(3)]
    return reduce(Column.__and__, tests)


def _blocks(n: int) -> list[tuple[int, int]]:
    """First bit and width of each of n blocks."""
    edges = [round(i * 64 / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, shingle: int = 5, radius: int = 20,
                 blocks: int = 7, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, similarity, start, n_windows: documents that hold a window similar to an item.

    A window has as many words as the item (fewer at the end of the document). `similarity` is the best of the windows, `start` the first
    word of the first window that reaches it. All fingerprints within `radius` bits are compared; windows of 0.8 lie about 10 bits
    from their item, so that 20 leaves out hardly any. Null and empty texts hold nothing; items of fewer than `shingle` words are no
    evidence and never match; equal items are each reported; repeated rows are reported once; a null id is an id like any other. Empty tables give
    an empty result. The cost follows the hits; an item of n words that is copied whole has n windows of n words."""
    items = benchmark.select(F.col(item_col).alias("item_id"), words_of(whole_text(item_text_col)).alias("words")).select(
        "item_id", F.size("words").alias("n_words"), let(F.col("words"), lambda w: shingles_of(w, shingle)).alias("item")).filter(
        F.size("item") > 0).distinct()
    items = staged(items.withColumn("fp", simhash(F.col("item"))), "items")
    starts = items.select(F.explode(F.array_distinct("item")).alias("h"), "n_words").distinct()
    table, bits = _sketch(starts.select("h").distinct())
    widest = items.agg(F.max(F.size("item"))).first()[0] or 1

    def cut_windows(hs: Column) -> Column:
        found = F.transform(hs, lambda h, i: F.when(_in_sketch(h, table, bits), i))
        return F.transform(F.filter(found, lambda i: i.isNotNull()), lambda i: F.struct(
            i.alias("start"), F.slice(hs, i + 1, F.lit(widest)).alias("win")))

    windows = docs.select(F.col(id_col).alias("doc_id"), F.explode(let(
        words_of(whole_text(text_col)), lambda w: let(shingles_of(w, shingle), cut_windows))).alias("w"))
    windows = windows.select("doc_id", "w.start", "w.win", F.get("w.win", F.lit(0)).alias("h")).join(starts, "h").select(
        "doc_id", "start", "n_words", F.slice("win", 1, F.col("n_words") - shingle + 1).alias("win"))
    windows = staged(windows.withColumn("content", F.xxhash64("win")), "windows")

    contents = windows.groupBy("n_words", "content").agg(F.first("win").alias("win"))
    contents = staged(contents.withColumn("fp", simhash(F.col("win"))), "contents")
    spans, near = _blocks(blocks), radius // blocks
    cut = lambda first, width: F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))
    asked = contents.select("n_words", "content", "fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("block"), cut(a, w).alias("value")) for k, (a, w) in enumerate(spans)])).alias("b"))
    flips = [F.array(*[F.lit(sum(1 << x for x in chosen)).cast("long") for t in range(near + 1)
                       for chosen in combinations(range(w), t)]) for _, w in spans]
    near_values = lambda k: F.transform(flips[k], cut(*spans[k]).bitwiseXOR)
    index = items.select("item_id", "n_words", F.col("fp").alias("item_fp"), F.explode(F.array(*[
        F.struct(F.lit(k).alias("block"), near_values(k).alias("values")) for k in range(blocks)])).alias("b")).select(
        "item_id", "n_words", "item_fp", "b.block", F.explode("b.values").alias("value"))
    met = asked.select("n_words", "content", "fp", "b.block", "b.value").join(index, ["n_words", "block", "value"])
    met = met.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius).select(
        "n_words", "content", "item_id").distinct()
    sized = met.join(contents.select("n_words", "content", "win"), ["n_words", "content"]).join(
        items.select(F.col("item_id").alias("_item"), F.col("n_words").alias("_n"), "item"),
        F.col("item_id").eqNullSafe(F.col("_item")) & (F.col("n_words") == F.col("_n")))
    sized = sized.select("n_words", "content", "item_id", weighted_jaccard(F.col("win"), F.col("item")).alias("similarity"))
    return windows.join(sized.filter(F.col("similarity") >= similarity), ["n_words", "content"]).groupBy("doc_id", "item_id").agg(
        F.max("similarity").alias("similarity"), F.max_by("start", F.struct("similarity", -F.col("start"))).alias("start"),
        F.countDistinct("start").alias("n_windows"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` whose text isn't found contaminated, with their columns.

    Rows are told apart by 128 bits of their text, not by their id: of rows that share an id, or have none, only those go that hold a
    passage, and equal texts go together. Null and empty texts stay; an empty table stays empty; an empty benchmark drops nothing. Columns may have any name."""
    key = lambda: F.struct(F.xxhash64(whole_text(text_col)).alias("a"), F.xxhash64(F.lit(1), whole_text(text_col)).alias("b"))
    named = docs.select(key().alias("doc_id"), F.col(text_col).alias("text"))
    leaked = free_name(docs, "leaked")
    found = contaminated(named, benchmark, **options).select(F.col("doc_id").alias(leaked)).distinct()
    return docs.join(found, key() == F.col(leaked), "left_anti")
