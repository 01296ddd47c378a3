"""Alignment of two tokenizers over a corpus: groups of tokens between common ends, links of overlapping tokens, pair counts.

Text goes through Arrow in blocks of a bounded number of bytes. The id lists of a block are flattened, with the parent index of
each token; a cumulative sum of token lengths, less what lies before the document, gives the byte where a token
ends. A full outer hash join of both sides on (document, end) has one row for each end: the rows that both sides have are the
common cuts, and since a token covers everything up to its end, filling the gaps backwards makes each row the link of the
two tokens around it. A block numbers its pairs by frequency and counts them (Table.group_by); Spark sums the
counts of all blocks, finds the highest of each B id, and sends every block the figures of its own pairs. So only distinct pairs
of blocks are shuffled by pair, nothing is broadcast, and no key has more rows than there are blocks.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortline.llm.common import staged
from cohortline.llm.tokens import BYTES

RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
BLOCK = pa.schema([
    ("block", pa.int64()), ("is_doc", pa.bool_()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("codes", pa.binary()),
    ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
BLOCK_SQL = ("block long, is_doc boolean, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
             "codes binary, pairs array<long>, counts array<long>")


class Side:
    """One tokenizer: ids of texts, and the bytes that each id stands for."""

    def __init__(self, values: list[bytes]) -> None:
        self.bytes = pa.array(values, pa.binary())
        self.lengths = np.array([len(v) for v in values], np.int64)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        raise NotImplementedError


class ByteSide(Side):
    """A byte-level vocabulary (a `tokenizers` file), over a space and the text; strings of special tokens are plain text.

    Ids in the order of the merges are ranks, so that the merges can be left to `tiktoken`, which is faster; in another order the
    file's own library encodes."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        vocab, merges = model["model"]["vocab"], model["model"]["merges"]
        special = {t["content"] for t in model["added_tokens"]}
        byte = {letter: i for i, letter in enumerate(BYTES)}
        listed = {i: v.encode() if v in special else bytes(byte[c] for c in v) for v, i in vocab.items()}
        listed.update((t["id"], t["content"].encode()) for t in model["added_tokens"])
        super().__init__([listed.get(i, b"") for i in range(max(listed) + 1)])
        joined = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        if joined == sorted(joined):
            import public_tokenizers
            import tiktoken

            ranks = {listed[i]: i for v, i in vocab.items() if v not in special}
            encoding = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._encode = lambda texts: [encoding.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            self._encode = lambda texts: [
                np.array(e.ids, np.uint32) for e in tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return self._encode(texts)


class PieceSide(Side):
    """A SentencePiece model, which puts the space before the text itself; U+2581 is a space, byte pieces are their bytes."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        super().__init__([
            bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.uint32) for x in self.model.encode(texts, num_threads=1)]


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str) -> tuple[Side, Side, pa.Array]:
    """The worker's tokenizers, and how ids are written before each separator: `id,` `id|` `id;` and the id alone."""
    pa.set_cpu_count(1)
    a, b = ByteSide(path_a), PieceSide(path_b)
    top = max(len(a.lengths), len(b.lengths))
    return a, b, pa.array([f"{i}{s}" for i in range(top) for s in (",", "|", ";", "")])


def faithful(side: Side, ids: list[np.ndarray], texts: list[bytes]) -> list[bool]:
    """For each text whether the bytes of its tokens are a space and the text."""
    flat = side.bytes.take(pa.array(np.concatenate([np.empty(0, np.uint32), *ids])))
    data, ends = memoryview(flat.buffers()[2] or b""), np.frombuffer(flat.buffers()[1], np.int32)
    at = np.cumsum([0, *map(len, ids)])
    return [bytes(data[ends[p]:ends[q]]) == b" " + t for p, q, t in zip(at[:-1], at[1:], texts)]


def token_ends(side: Side, ids: list[np.ndarray]) -> tuple[np.ndarray, pa.Table]:
    """The ids of all documents end to end, and for each its key (document, end byte) and its place."""
    lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, ids)]).astype(np.int32), np.concatenate([np.empty(0, np.uint32), *ids]))
    flat, parent = pc.list_flatten(lists).to_numpy(), pc.list_parent_indices(lists).to_numpy().astype(np.int64)
    ends = np.cumsum(side.lengths[flat])
    before = np.r_[0, ends][lists.offsets.to_numpy()[:-1]]
    return flat, pa.table({"key": parent << 32 | (ends - before[parent]), "place": np.arange(len(flat), dtype=np.int32)})


def align(a: Side, b: Side, written: pa.Array, ids_a: list[np.ndarray], ids_b: list[np.ndarray]) -> dict:
    """Links and groups of a block of documents whose tokens on both sides have the same bytes.

    n_groups, n_links: per document; link_a, link_b: ids of the links in order; groups: the written groups of each document."""
    flat_a, left = token_ends(a, ids_a)
    flat_b, right = token_ends(b, ids_b)
    ends = left.rename_columns(["key", "a"]).join(
        right.rename_columns(["key", "b"]), "key", join_type="full outer", use_threads=False).combine_chunks()
    ends = ends.take(pc.sort_indices(ends["key"]))
    cut = pc.and_(pc.is_valid(ends["a"]), pc.is_valid(ends["b"])).to_numpy()
    document = ends["key"].to_numpy() >> 32
    at_a, at_b = (pc.fill_null_backward(ends[c]).to_numpy() for c in ("a", "b"))
    cut_a, cut_b = at_a[cut].astype(np.int64), at_b[cut].astype(np.int64)  # the last token of each group

    total = len(flat_a) + len(flat_b)
    tokens, last = np.empty(total, np.int64), np.zeros(total, np.int64)
    group_a = np.searchsorted(cut_a, np.arange(len(flat_a)))
    group_b = np.searchsorted(cut_b, np.arange(len(flat_b)))
    place_a = np.arange(len(flat_a)) + np.r_[0, cut_b + 1][group_a]
    place_b = np.arange(len(flat_b)) + cut_a[group_b] + 1
    tokens[place_a], tokens[place_b] = flat_a, flat_b
    last[place_a[cut_a]], last[place_b[cut_b]] = 1, 2
    sizes = np.array([len(x) + len(y) for x, y in zip(ids_a, ids_b)], np.int64)
    stops = np.cumsum(sizes)
    last[stops[sizes > 0] - 1] = 3
    text = written.take(pa.array(tokens * 4 + last))
    data, offsets = memoryview(text.buffers()[2] or b""), np.frombuffer(text.buffers()[1], np.int32)[: total + 1]
    return {
        "n_groups": np.bincount(document[cut], minlength=len(ids_a)), "n_links": np.bincount(document, minlength=len(ids_a)),
        "link_a": flat_a[at_a], "link_b": flat_b[at_b],
        "groups": [data[offsets[p]:offsets[q]] for p, q in zip(stops - sizes, stops)]}


def numbered(link_a: np.ndarray, link_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each link's pair, the pairs in order of these numbers (the most frequent first), and their counts."""
    pairs = pa.array(link_a.astype(np.int64) << 32 | link_b).dictionary_encode()
    counted = pa.table({"code": pairs.indices}).group_by("code", use_threads=False).aggregate([([], "count_all")])
    order = pc.sort_indices(counted, sort_keys=[("count_all", "descending"), ("code", "ascending")])
    codes = counted["code"].to_numpy()[order]
    number = np.empty(len(codes), "<u2" if len(codes) <= 65_536 else "<u4")
    number[codes] = np.arange(len(codes))
    return number[pairs.indices.to_numpy()], pairs.dictionary.to_numpy()[codes], counted["count_all"].to_numpy()[order]


def align_tokens(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = 3_000_000, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (see RESULT).

    A is a byte-level file over a space and the text, B a SentencePiece model over the text. A block has about `block_bytes` of text, a
    longer text is a block of its own; blocks change no result. Null and empty texts, and texts that either side
    doesn't give back byte by byte, have no tokens: zeros and an empty string. Every row counts, rows with an id that repeats or
    is null too. An empty table gives no rows; other columns are left out."""

    def blocks(batches):
        a, b, written = sides(path_a, path_b)
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            batch_ids, texts = batch["id"].to_pylist(), batch["t"]
            lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
            cuts = np.flatnonzero(np.diff((np.cumsum(lengths) - lengths) // block_bytes)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
                block = part << 32 | number
                number += 1
                names, some = batch_ids[lo:hi], texts[lo:hi].to_pylist()
                full = [i for i, t in enumerate(some) if t]
                plain = [some[i] for i in full]
                raw = [t.encode() for t in plain]
                ids_a, ids_b = a.ids(plain), b.ids(plain)
                kept = [i for i, x, y in zip(range(len(full)), faithful(a, ids_a, raw), faithful(b, ids_b, raw)) if x and y]
                ids_a, ids_b = [ids_a[i] for i in kept], [ids_b[i] for i in kept]
                found = align(a, b, written, ids_a, ids_b)
                codes, pairs, counts = numbered(found["link_a"], found["link_b"])
                stops = np.cumsum(found["n_links"])
                size = len(names)
                columns = {c: [0] * size for c in ("n_a", "n_b", "n_groups", "n_links")}
                digests, links = [""] * size, [b""] * size
                for k, i in enumerate(kept):
                    row = full[i]
                    columns["n_a"][row], columns["n_b"][row] = len(ids_a[k]), len(ids_b[k])
                    columns["n_groups"][row], n = int(found["n_groups"][k]), int(found["n_links"][k])
                    columns["n_links"][row] = n
                    digests[row] = hashlib.sha256(found["groups"][k]).hexdigest()
                    links[row] = codes[stops[k] - n:stops[k]].tobytes()
                none = [None]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip([
                    [block] * (size + 1), [True] * size + [False], names + none, *(columns[c] + none for c in columns),
                    digests + none, links + none, [None] * size + [pairs], [None] * size + [counts]], BLOCK.types)], schema=BLOCK)

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    found = staged(texts.mapInArrow(blocks, BLOCK_SQL), "aligned")
    own = found.filter("not is_doc").select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("code", "x")).select(
        "block", "code", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    merged = own.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    highest = F.max("count").over(Window.partitionBy("b"))  # at most one row an A id
    merged = merged.select("pair", "count", (F.col("count") == highest).alias("best"))
    figures = own.join(merged.hint("merge"), "pair").select(F.col("block").alias("its_block"), "code", "count", "best")

    def score(links: pa.Table, pairs: pa.Table) -> pa.Table:
        size = len(pairs)
        count, best = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
        code = pairs["code"].to_numpy()
        count[code], best[code] = pairs["count"].to_numpy(), pairs["best"].to_numpy()
        kind = "<u2" if size <= 65_536 else "<u4"
        n_best, total = [], []
        for raw in links["codes"]:
            at = np.frombuffer(raw.as_buffer(), kind)
            n_best.append(int(best[at].sum()))
            total.append(int(count[at].sum()))
        rows = links.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        rows = rows.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))
        return rows.append_column("groups_sha256", links["groups_sha256"])

    lines = found.filter("is_doc").drop("pairs", "counts", "is_doc")
    return lines.groupBy("block").cogroup(figures.groupBy("its_block")).applyInArrow(score, RESULT)
