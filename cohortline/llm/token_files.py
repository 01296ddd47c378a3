"""Token ids in binary files: a shared zstandard dictionary, one frame a document, an offset index.

A written folder has two tables. `dictionary` has one row: the dictionary and its SHA-256. `shards` has one row a shard of
consecutive documents in ascending order of id:

    payload = magic "TIDS1", id width in bytes (2 or 4), SHA-256 of the dictionary, number of documents n,
              n + 1 offsets into the frames (u64), n numbers of ids (u64), n ids of documents (i64), n null marks (u8), frames

All numbers are little-endian. A reader of one document takes its shard by first_id and last_id, its frame by the
offsets, and decompresses nothing else.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortline.llm.common import partitions, whole_text
from cohortline.llm.tokens import encoded, encoder

MAGIC, LEVEL = b"TIDS1", 3
HEAD = struct.Struct("<5sB32sQ")


def train_dictionary(docs: DataFrame, path: str, sample: int = 1000, size: int = 65_536, longest: int = 20_000,
                     width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """A dictionary trained on the serialized ids of at most `sample` documents, those with the smallest hash of the id, and of
    each at most `longest` characters. The bound only concerns what the dictionary learns from. Too little text gives the raw ids as
    the dictionary."""
    picked = docs.select(F.col(id_col).alias("_id")).distinct().orderBy(F.xxhash64("_id")).limit(sample)
    texts = sorted(r[0] for r in docs.select(F.col(id_col).alias("_id"), F.substring(whole_text(text_col), 1, longest).alias("t")).join(
        F.broadcast(picked), "_id", "left_semi").select("t").limit(2 * sample).collect())
    parts = [ids.astype(f"<u{width}").tobytes() for ids in encoded(pa.array(texts, pa.string()), path, 0)]
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, parts)) // 10)), parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-size:] or bytes(width)


def pack_shard(ids: list[int | None], frames: list[bytes], counts: list[int], dictionary: bytes, width: int) -> bytes:
    """The payload of one shard."""
    missing = np.array([x is None for x in ids], np.uint8)
    offsets = np.cumsum([0, *map(len, frames)]).astype("<u8")
    return b"".join([
        HEAD.pack(MAGIC, width, hashlib.sha256(dictionary).digest(), len(ids)), offsets.tobytes(),
        np.array(counts, "<u8").tobytes(), np.array([x or 0 for x in ids], "<i8").tobytes(), missing.tobytes(), *frames])


class Shard:
    """Reads a payload: `ids` of the documents, and `tokens(i)` of one of them."""

    def __init__(self, payload: bytes, dictionary: bytes) -> None:
        magic, self.width, digest, n = HEAD.unpack_from(payload)
        if magic != MAGIC or digest != hashlib.sha256(dictionary).digest():
            raise ValueError("not a shard of this dictionary")
        at = HEAD.size
        self.offsets = np.frombuffer(payload, "<u8", n + 1, at).astype(np.int64)
        self.counts = np.frombuffer(payload, "<u8", n, at + 8 * (n + 1)).astype(np.int64)
        ids = np.frombuffer(payload, "<i8", n, at + 8 * (2 * n + 1))
        missing = np.frombuffer(payload, np.uint8, n, at + 8 * (3 * n + 1))
        self.ids = [None if m else int(x) for x, m in zip(ids, missing)]
        self.base, self.payload = at + 8 * (3 * n + 1) + n, payload
        self.decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))

    def tokens(self, i: int) -> np.ndarray:
        frame = self.payload[self.base + self.offsets[i] : self.base + self.offsets[i + 1]]
        raw = self.decompressor.decompress(frame, max_output_size=int(self.counts[i]) * self.width)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int = 1, shard_ids: int = 4_000_000,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every whole text, the end id last, in ascending order of id (null ids first, rows of one id by their text).

    A shard ends when it has `shard_ids` ids or more. Ids are spread by ranges, so shards of a part follow each other
    and no task holds more than one of them. A null text counts as empty: it has only its end id. An empty table
    gives a folder without shards."""
    spark = docs.sparkSession
    width = 2 if encoder(path).tokenizer.get_vocab_size() <= 65_536 and end_id < 65_536 else 4
    dictionary = train_dictionary(docs, path, width=width, id_col=id_col, text_col=text_col)
    spark.createDataFrame([(dictionary, hashlib.sha256(dictionary).digest())], "dictionary binary, sha binary").coalesce(
        1).write.parquet(f"{folder}/dictionary")

    def shards(batches):
        part, number = TaskContext.get().partitionId(), 0
        data = zstandard.ZstdCompressionDict(dictionary)
        data.precompute_compress(level=LEVEL)
        press = zstandard.ZstdCompressor(dict_data=data, write_dict_id=False)
        ids, frames, counts = [], [], []

        def row():
            known = [x for x in ids if x is not None]
            values = [part, number, min(known, default=None), max(known, default=None), len(ids), sum(counts),
                      pack_shard(ids, frames, counts, dictionary, width)]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, [pa.int64()] * 6 + [pa.binary()])],
                ["part", "number", "first_id", "last_id", "n_docs", "n_ids", "payload"])

        for b in batches:
            for doc_id, own in zip(b["id"].to_pylist(), encoded(b["t"], path, end_id)):
                ids.append(doc_id)
                frames.append(press.compress(own.astype(f"<u{width}").tobytes()))
                counts.append(len(own))
                if sum(counts[-1:]) and len(counts) % 64 == 0 and sum(counts) >= shard_ids:
                    yield row()
                    number, ids, frames, counts = number + 1, [], [], []
        if ids:
            yield row()

    schema = "part long, number long, first_id long, last_id long, n_docs long, n_ids long, payload binary"
    ordered = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("t")).repartitionByRange(
        partitions(spark), F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("t"))
    ordered.mapInArrow(shards, schema).write.option("compression", "none").parquet(f"{folder}/shards")


def read_tokens(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (binary, unsigned 32-bit little-endian).

    With `doc_ids` only shards that can hold them are read and only their frames are decompressed."""
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first()["dictionary"])  # bounded by its trained size
    found = spark.read.schema("part long, number long, first_id long, last_id long, n_docs long, n_ids long, payload binary").parquet(
        f"{folder}/shards")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # one small row a shard
    totals = found.select("part", "number", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))
    if doc_ids is not None:
        found = found.filter(F.exists(F.array(*[F.lit(x) for x in doc_ids]), lambda x: x.between(F.col("first_id"), F.col("last_id"))))
    wanted = None if doc_ids is None else set(doc_ids)

    def rows(batches):
        for b in batches:
            for payload, start in zip(b["payload"], b["before"].to_pylist()):
                shard = Shard(payload.as_py(), dictionary)
                starts = start + np.cumsum(shard.counts) - shard.counts
                pick = [i for i, x in enumerate(shard.ids) if wanted is None or x in wanted]
                for at in range(0, len(pick), 2000):
                    some = pick[at : at + 2000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([shard.ids[i] for i in some], pa.int64()), pa.array(starts[some]), pa.array(shard.counts[some]),
                        pa.array([shard.tokens(i).tobytes() for i in some], pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return found.join(totals, ["part", "number"]).select("payload", "before").mapInArrow(
        rows, "doc_id long, start long, n_tokens long, ids binary")


def ids_crc32(ids: bytes | np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids if isinstance(ids, bytes) else ids.astype("<u4").tobytes())
