"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified Hamming distance, components.

Fingerprints are 64-bit. Split into `blocks` blocks, two fingerprints that differ in at most `radius` bits agree on
`blocks - radius` of them at least, so a join on every choice of that many blocks meets every close pair.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import staged, whole_text
from cohortline.llm.components import components

#: Buckets with more fingerprints than this are searched by masks instead of by pairs; either way finds the same links.
CROWDED = 32


def shingle_hashes(text: str, words: int, seed: int) -> np.ndarray:
    """XXH64 of each run of `words` words of the text in lower case (of all words, if they are fewer)."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    whole, n = b" ".join(found), max(1, len(found) - words + 1)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = [0, *ends[: n - 1].tolist()]
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(whole[a:b], seed) for a, b in zip(starts, stops)), np.uint64, n)


def fingerprint_of(hashes: list[np.ndarray]) -> np.ndarray:
    """A 64-bit fingerprint a document: a bit is 1 if it is set in over half of the document's hashes."""
    out = np.zeros(len(hashes), np.uint64)
    for i, h in enumerate(hashes):
        set_bits = np.zeros(64, np.int64)
        for part in range(0, len(h), 65_536):  # bounded memory for very long documents
            rows = h[part : part + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
            set_bits += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(set_bits * 2 > len(h)).view(">u8")[0]
    return out


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, fp (long): the fingerprint of each row's whole text; zero if it has no word (also null)."""

    def compute(batches):
        for b in batches:
            hashes = [shingle_hashes(t.as_py() or "", words, seed) for t in b["t"]]
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(fingerprint_of(hashes).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("t")).mapInArrow(
        compute, "doc_id long, fp long")


def distance(a: Column | str, b: Column | str) -> Column:
    """Differing bits."""
    as_col = lambda x: F.col(x) if isinstance(x, str) else x
    return F.bit_count(as_col(a).bitwiseXOR(as_col(b)))


def block_masks(blocks: int, agree: int) -> list[int]:
    """For every choice of `agree` of the `blocks` blocks, the mask of their bits (as a signed long)."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    each = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    masks = (sum(each[i] for i in chosen) for chosen in combinations(range(blocks), agree))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, radius: int = 2, blocks: int = 4) -> DataFrame:
    """a, b (a > b): links between distinct fingerprints of `prints` (fp), enough to connect all within `radius` bits.

    A pair that agrees on some choice of blocks meets in a bucket. Buckets of up to CROWDED fingerprints
    compare their pairs. In a fuller bucket the rest of the bits is searched by masks: each fingerprint is keyed with every choice
    of `radius` free bits blanked, and fingerprints of one key, which are within the radius by construction, are tied to
    its smallest. That is linear in the bucket, and loses no connection."""
    masks = block_masks(blocks, blocks - radius)
    tables = F.array(*[F.lit(m).cast("long") for m in masks])
    keyed = prints.select("fp").distinct().select("fp", F.explode(tables).alias("mask")).select(
        "fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("block"))
    sizes = keyed.groupBy("mask", "block").agg(F.count("*").alias("n")).filter("n > 1")
    keyed = staged(keyed.join(sizes, ["mask", "block"]), "buckets")
    few = keyed.filter(F.col("n") <= CROWDED).hint("merge")  # what grows with the input is never broadcast
    pairs = few.select("mask", "block", F.col("fp").alias("a")).join(
        few.select("mask", "block", F.col("fp").alias("b")), ["mask", "block"]).filter("a > b")
    pairs = pairs.filter(distance("a", "b") <= radius).select("a", "b")

    free = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function(
        "getbit", F.col("mask"), i) == 0)
    bits = F.transform(free, lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i))
    blanked = bits
    for _ in range(radius - 1):
        blanked = F.flatten(F.transform(blanked, lambda x: F.transform(F.filter(bits, lambda y: y.bitwiseAND(x) == 0),
                                                                       lambda y: x.bitwiseOR(y))))
    crowd = keyed.filter(F.col("n") > CROWDED).select("fp", "mask", F.explode(F.array_distinct(blanked)).alias("blank"))
    crowd = crowd.select("fp", "mask", "blank", F.col("fp").bitwiseAND(F.bitwise_not("blank")).alias("rest"))
    least = crowd.groupBy("mask", "blank", "rest").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).filter("b < top")
    starred = crowd.hint("merge").join(least, ["mask", "blank", "rest"]).filter("fp > b").select(F.col("fp").alias("a"), "b")
    return pairs.union(starred).distinct()


def near_duplicates(docs: DataFrame, words: int = 3, seed: int = 42, radius: int = 2, blocks: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, component_id: the smallest id that a document reaches by links of at most `radius` differing bits.

    Null and empty texts have fingerprint zero and are linked like any other; an id of null joins a component without
    naming it (a component of null ids only is null). Repeated rows come back as often as they came. Equal fingerprints are
    one node, so a group of copies costs one entry; an empty table gives an empty result."""
    prints = staged(fingerprints(docs, words, seed, id_col, text_col), "fingerprints")
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    parts = components(links(nodes, radius, blocks))
    nodes = nodes.join(parts, nodes["fp"] == parts["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("part"))
    named = nodes.groupBy("part").agg(F.min("first").alias("component_id"))
    return prints.join(nodes.join(named, "part").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")
