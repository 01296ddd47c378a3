"""Packing by lexical retrieval: a sharded BM25 index over all documents gives each seed document its unused neighbours.

Seeds are the rows whose id is divisible by `every`. Each shard is an inverted index over its documents, with
document frequencies and the average length of the whole corpus; every seed asks every shard with all its terms. Seeds and documents of
like words and sizes are scored together by a product of matrices, and only where bounds leave a better score possible: the result is that
of scoring all pairs. A document is a neighbour of several seeds but used once: by the seed for which its score, over the root of the seed's number of
terms, is largest. That needs only the document's own shard, which has seen all seeds, so that no lists of neighbours are shuffled. A seed fills its window with its own ids, then with its
neighbours, the best first; what doesn't fit opens the next window. Only the end of a task's ids is shorter than a window, and is cut
into powers of two, which need no padding.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import partitions, ranges, staged, whole_text
from cohortline.llm.token_files import ids_crc32
from cohortline.llm.tokens import encoded, vocabulary_size
from cohortline.sources.shared import new_path

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
K1, B = 1.2, 0.75
#: Seeds that are scored together, documents that are scored together, seeds that a shard holds at once, kinds of texts.
ASKED, GROUP, HELD, KINDS = 128, 512, 16_384, 8
#: Kinds are fitted on at most so many documents of a shard, by so many of the most frequent terms. They only save time.
SAMPLE, FREQUENT = 1024, 512
#: Documents whose ids are counted at once; their numbers fit 16 bits.
COUNTED = 4000
#: Scores that differ by less than this share are equal: sums of other order differ in their last digits.
TIE = 1e-6


def terms_of(ids: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each document its distinct ids in order, and how often each occurs; the end id is left out."""
    kind = ids[0].dtype
    bits, wide = 8 * kind.itemsize, np.dtype(f"<u{2 * kind.itemsize}")
    key = np.concatenate([x[:-1] for x in ids]).astype(wide)
    key |= np.repeat(np.arange(len(ids), dtype=wide) << wide.type(bits), [len(x) - 1 for x in ids])
    key.sort()  # all documents at once
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    found, tf = key[first], np.diff(np.r_[first, len(key)])
    ends = np.searchsorted(found >> wide.type(bits), np.arange(1, len(ids)))
    return np.split(found.astype(kind), ends), np.split(tf.astype("<u4"), ends)


class Corpus:
    """What all shards know: the inverse document frequencies, the mean length, and the most frequent terms."""

    def __init__(self, df: np.ndarray, n: int, total: int, kind: str) -> None:
        self.idf = np.log(1 + (n - df + 0.5) / (df + 0.5)).astype(np.float32)
        self.mean_length, self.kind = max(1.0, total / max(1, n)), kind
        self.frequent = np.argsort(-df, kind="stable")[:FREQUENT]
        self.slot = np.full(len(df), -1)
        self.slot[self.frequent] = np.arange(len(self.frequent))

    def weights(self, terms: np.ndarray, tf: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """BM25 weight of each posting; lengths are of the posting's document."""
        norm = (K1 * (1 - B + B / self.mean_length * lengths)).astype(np.float32)
        return self.idf[terms] * tf * np.float32(K1 + 1) / (tf + norm)

    def profiles(self, terms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A row of unit length for each text: the idf of the frequent terms that it has."""
        out = np.zeros((len(sizes), len(self.frequent)), np.float32)
        owner, at = np.repeat(np.arange(len(sizes)), sizes), self.slot[terms]
        out[owner[at >= 0], at[at >= 0]] = self.idf[terms[at >= 0]]
        return out / np.maximum(1e-9, np.sqrt((out * out).sum(axis=1, keepdims=True)))


class Texts:
    """Distinct terms of some texts end to end, `sizes` of each and `first` of each."""

    def __init__(self, raw: list[bytes], kind: str) -> None:
        self.terms = np.frombuffer(b"".join(raw), kind).astype(np.int32)
        self.sizes = np.array([len(x) for x in raw], np.int64) // np.dtype(kind).itemsize
        self.first = np.cumsum(self.sizes) - self.sizes

    def at(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the terms of some texts are, and the place of each one's text in `some`."""
        return ranges(self.first[some], self.sizes[some]), np.repeat(np.arange(len(some)), self.sizes[some])

    def in_order(self, corpus: Corpus, centres: np.ndarray) -> np.ndarray:
        """The texts by kind (the nearest centre) and size."""
        kinds = [np.empty(0, np.int64)]
        for a in range(0, len(self.sizes), 4096):
            at, _ = self.at(some := np.arange(a, min(a + 4096, len(self.sizes))))
            kinds.append((corpus.profiles(self.terms[at], self.sizes[some]) @ centres.T).argmax(axis=1))
        return np.lexsort((self.sizes, np.concatenate(kinds)))


class Shard:
    """BM25 scores of some documents; `ask` takes seeds, `rows` tells each document's best seed.

    Documents of one kind and size are a group, such seeds a block. No seed of a block scores more for a document than the document's
    heaviest postings, as many as the block's largest seed has terms, nor more than all its postings of the block's terms, either
    over the root of the smallest seed's number of terms. Only documents whose best score so far isn't above that meet the block, by a matrix product;
    blocks that promise most come first."""

    def __init__(self, corpus: Corpus) -> None:
        self.corpus, self.parts, self.asked, self.ready = corpus, [], {}, False

    def add(self, part: pa.RecordBatch) -> None:
        self.parts.append([part["row"].to_numpy(), part["n"].to_numpy(), part["terms"].to_pylist(), part["tf"].to_pylist()])

    def _build(self) -> None:
        c, self.ready = self.corpus, True
        self.row = np.concatenate([p[0] for p in self.parts] or [np.empty(0, np.int64)])
        lengths = np.concatenate([p[1] for p in self.parts] or [np.empty(0, np.int64)])
        tf = np.frombuffer(b"".join(x for p in self.parts for x in p[3]), "<u4").astype(np.float32)
        self.docs = Texts([x for p in self.parts for x in p[2]], c.kind)
        self.parts, n, sizes = [], len(self.row), self.docs.sizes
        self.weight = c.weights(self.docs.terms, tf, np.repeat(lengths, sizes))
        key = np.repeat(np.arange(n, dtype=np.uint64) << np.uint64(32), sizes) | (np.uint32(0xFFFFFFFF) - self.weight.view(np.uint32))
        key.sort()  # each document's weights, the heaviest first
        self.heaviest = np.r_[0, np.cumsum((np.uint32(0xFFFFFFFF) - key.astype(np.uint32)).view(np.float32), dtype=float)]
        some = np.unique(np.linspace(0, n - 1, min(n, SAMPLE)).astype(np.int64)) if n else np.empty(0, np.int64)
        seen = c.profiles(self.docs.terms[self.docs.at(some)[0]], sizes[some])
        self.centres = seen[:: max(1, len(seen) // KINDS)][:KINDS]
        for _ in range(5):
            nearest = (seen @ self.centres.T).argmax(axis=1) if n else some
            sums = np.stack([seen[nearest == k].sum(axis=0) for k in range(len(self.centres))]) if n else self.centres
            self.centres = sums / np.maximum(1e-9, np.sqrt((sums * sums).sum(axis=1, keepdims=True)))
        self.order = self.docs.in_order(c, self.centres)
        self.score, self.seed = np.zeros(n, np.float32), np.full(n, -1, np.int64)

    def ask(self, part: pa.RecordBatch) -> None:
        if not self.ready:
            self._build()
        for row, terms in zip(part["row"].to_pylist(), part["terms"].to_pylist()):
            if terms and len(self.row):
                self.asked[terms] = min(row, self.asked.get(terms, row))  # of equal seeds the first
            if len(self.asked) == HELD:
                self._meet()

    def _meet(self) -> None:
        """All documents meet the seeds that are held."""
        rows, seeds, vocabulary = np.array(list(self.asked.values()), np.int64), Texts(list(self.asked), self.corpus.kind), len(self.corpus.idf)
        self.asked = {}
        order = seeds.in_order(self.corpus, self.centres)
        blocks = [x[np.argsort(rows[x])] for x in np.split(order, range(ASKED, len(order), ASKED))]
        held = np.zeros((len(blocks), vocabulary), np.float32)  # the share of a block's seeds that have the term
        own, terms_of_block = [], []
        for i, some in enumerate(blocks):
            at, owner = seeds.at(some)
            counts = np.bincount(seeds.terms[at], minlength=vocabulary)
            held[i] = counts / np.float32(len(some))
            terms_of_block.append(np.flatnonzero(counts))
            own.append(np.zeros((len(some), len(terms_of_block[-1])), bool))
            own[-1][owner, np.searchsorted(terms_of_block[-1], seeds.terms[at])] = True
        sizes = np.unique(seeds.sizes)
        least, most = (np.searchsorted(sizes, [f(seeds.sizes[x]) for x in blocks], side) for f, side in ((np.min, "left"), (np.max, "right")))
        mean = np.array([seeds.sizes[x].mean() for x in blocks])
        slot = np.full(vocabulary, -1)
        for a in range(0, len(self.order), GROUP):
            group = self.order[a : a + GROUP]
            at, owner = self.docs.at(group)
            here = np.unique(self.docs.terms[at])
            slot[here] = np.arange(len(here))
            matrix = np.zeros((len(here), len(group)), np.float32)
            matrix[slot[self.docs.terms[at]], owner] = self.weight[at]
            share = held[:, here]
            first = self.docs.first[group]
            heavy = (self.heaviest[first + np.minimum(sizes[:, None], self.docs.sizes[group])] - self.heaviest[first]) / np.sqrt(sizes)[:, None]
            heavy = np.stack([heavy[x:y].max(axis=0) for x, y in zip(least, most)])
            bound = np.minimum(heavy, (share > 0).astype(np.float32) @ matrix / np.sqrt(sizes[least])[:, None]) * (1 + 1e-5)
            promise = (share @ matrix).sum(axis=1) / np.sqrt(mean)
            for i in np.argsort(-promise, kind="stable"):
                open_ = np.flatnonzero((bound[i] > 0) & (bound[i] >= self.score[group]))
                if len(open_):
                    there = slot[terms_of_block[i]]
                    some = matrix[there[there >= 0]]
                    found = own[i][:, there >= 0].astype(np.float32) @ (some if 4 * len(open_) > 3 * len(group) else some[:, open_])
                    found /= np.sqrt(seeds.sizes[blocks[i]].astype(np.float32))[:, None]
                    self._better(group[open_], found if found.shape[1] == len(open_) else found[:, open_], rows[blocks[i]])
            slot[here] = -1

    def _better(self, docs: np.ndarray, found: np.ndarray, rows: np.ndarray) -> None:
        """Takes over the best seed (a row of `found`, in the order of `rows`) of each document where it is better than the one so far."""
        score = found.max(axis=0)
        row = rows[(found >= score * np.float32(1 - TIE)).argmax(axis=0)]
        old, seed = self.score[docs], self.seed[docs]
        equal = (score >= old * (1 - TIE)) & (score <= old * (1 + TIE))
        new = (score > 0) & np.where(equal, row < seed, score > old)
        self.seed[docs[new]] = row[new]
        self.score[docs] = np.maximum(old, score)

    def rows(self) -> pa.RecordBatch:
        if not self.ready:
            self._build()
        if self.asked:
            self._meet()
        return pa.RecordBatch.from_arrays(
            [pa.array(self.row), pa.array(self.seed, mask=self.seed < 0), pa.array(self.score.astype(float))], ["row", "seed", "score"])


class Packer:
    """Lays pieces into windows; gives rows of PIECES."""

    def __init__(self, window: int, first_sequence: int) -> None:
        self.window, self.sequence = window, first_sequence
        self.open: list[tuple] = []  # pieces of the open window: doc_id, start, ids, doc_tokens
        self.filled, self.rows = 0, []

    def put(self, doc_id: int | None, start: int, ids: np.ndarray, total: int) -> int:
        """Lays down ids up to the end of the window and tells how many."""
        n = min(len(ids), self.window - self.filled)
        self.open.append((doc_id, start, ids[:n], total))
        self.filled += n
        if self.filled == self.window:
            self._close(self.window)
        return n

    def _close(self, size: int) -> None:
        offset, rest = 0, []
        for doc_id, start, ids, total in self.open:
            n = min(len(ids), size - offset)
            if n:
                self.rows.append((doc_id, start, n, ids_crc32(ids[:n]), total, self.sequence, offset))
            if n < len(ids):
                rest.append((doc_id, start + n, ids[n:], total))
            offset += n
        self.sequence += 1
        self.open, self.filled = rest, self.filled - size

    def end(self) -> None:
        """Cuts an unfinished window into powers of two."""
        while self.filled:
            self._close(1 << (self.filled.bit_length() - 1))

    def lay(self, doc_id: int | None, ids: np.ndarray) -> None:
        """Every id of a document is laid down; the window may stay open."""
        done = 0
        while done < len(ids):
            done += self.put(doc_id, done, ids[done:], len(ids))


def tokenized(docs: DataFrame, path: str, end_id: int, kind: str, id_col: str, text_col: str) -> DataFrame:
    """row, id, n, ids, terms, tf of each document, in a table bucketed by row, so that its seed is joined without moving the ids.

    row numbers the rows; ids and terms (distinct ids but the last) are little-endian numbers of `kind`, tf of 32 bits."""

    def tokenize(batches):
        for b in batches:
            ids = [x.astype(kind) for x in encoded(b["t"], path, end_id)]  # 16 bits are sorted faster
            counted = [x for at in range(0, len(ids), COUNTED) for x in zip(*terms_of(ids[at : at + COUNTED]))]
            yield pa.RecordBatch.from_arrays([
                b["row"], b["id"], pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary()),
                pa.array([t.tobytes() for t, _ in counted], pa.binary()),
                pa.array([c.tobytes() for _, c in counted], pa.binary())], ["row", "id", "n", "ids", "terms", "tf"])

    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("t"))
    name = f"tokens_{uuid.uuid4().hex}"
    rows.mapInArrow(tokenize, "row long, id long, n long, ids binary, terms binary, tf binary").write.option("compression", "zstd").option(
        "path", new_path(spark, "tokens")).bucketBy(partitions(spark), "row").saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the catalog's entry only: the files have a path of their own
    return found


def best_seeds(tokens: DataFrame, terms: int, kind: str, every: int, shard_postings: int) -> DataFrame:
    """row, seed (row number of the seed that uses it; null if it shares no term with any), score for each row of `tokenized`."""

    def frequencies(batches):
        df, n, total = np.zeros(terms, np.int64), 0, 0
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b["terms"].to_pylist()), kind), minlength=terms)
            n, total = n + len(b["n"]), total + sum(b["n"].to_pylist())
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, -1, -2]), pa.array(np.r_[df[at], n, total])], ["term", "n"])

    few = lambda df: df.coalesce(partitions(tokens.sparkSession))  # noqa: E731 - a file for each task and bucket: no task for each
    found = dict(map(tuple, few(tokens.select("terms", "n")).mapInArrow(frequencies, "term long, n long").groupBy("term").agg(
        F.sum("n")).collect()))  # at most one row an entry of the vocabulary
    n, total = found.pop(-1, 0), found.pop(-2, 0)
    df = np.zeros(terms)
    df[np.array(list(found), np.int64)] = list(found.values())
    corpus, shards = Corpus(df, n, total, kind), max(1, -(-int(df.sum()) // shard_postings))

    def search(batches):
        shard = index = None
        for b in batches:
            key = b["shard"].to_numpy() * 2 + b["asks"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for a, z in zip(cuts, cuts[1:]):
                if a == z:
                    continue
                if key[a] // 2 != shard:
                    if index is not None:
                        yield index.rows()
                    shard, index = key[a] // 2, Shard(corpus)
                (index.ask if key[a] % 2 else index.add)(b.slice(a, z - a))
        if index is not None:
            yield index.rows()

    indexed = few(tokens).select(F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("asks"), "row", "n", "terms", "tf")
    seeds = few(tokens).filter(F.col("id") % every == 0).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("asks"), "row", "n", "terms", F.lit(b"").alias("tf"))
    spread = indexed.union(seeds).repartitionById(shards, "shard").sortWithinPartitions("shard", "asks", "row")
    return spread.mapInArrow(search, "row long, seed long, score double")


def pack_documents(docs: DataFrame, path: str, end_id: int = 2, window: int = 4096, every: int = 20, shard_postings: int = 4_000_000,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents in sequences of at most `window` ids: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each id of each document, with the end id, lies in exactly one piece. A sequence is full or a power of two long. Seeds are the rows
    whose id `every` divides; documents that share no term with a seed come first, in the order of the rows. Equally good seeds: the first row. The
    search scores each document against each seed, so its cost grows with rows x rows / `every`; a shard has about
    `shard_postings` postings and meets the seeds in blocks. A null text counts as empty and has only its end id; repeated rows
    and rows of one id are packed as often as they come; a null id stays null and is no seed. Further columns are not read. An empty table gives no piece."""
    spark = docs.sparkSession
    terms = max(vocabulary_size(spark, path), end_id + 1)
    kind = "<u2" if terms <= 65_536 else "<u4"
    tokens = tokenized(docs, path, end_id, kind, id_col, text_col)
    used = staged(best_seeds(tokens, terms, kind, every, shard_postings), "seeds")
    own = F.col("id") % every == 0
    ordered = tokens.select("row", "id").join(used, "row").select(
        F.when(own, F.col("row")).otherwise(F.col("seed")).alias("seed"),
        F.when(own, F.lit(float("-inf"))).otherwise(-F.col("score")).alias("place"), "row")
    dealt = staged(ordered.repartitionByRange(partitions(spark), "seed", "place", "row").withColumn("part", F.spark_partition_id()), "dealt")

    def pack(batches):
        packer = Packer(window, TaskContext.get().partitionId() << 32)

        def rows():
            columns = list(zip(*packer.rows)) or [()] * 7
            packer.rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        names = [x.split()[0] for x in PIECES.split(", ")]
        for b in batches:
            for doc_id, raw in zip(b["id"].to_pylist(), b["ids"]):
                packer.lay(doc_id, np.frombuffer(raw.as_py(), kind))
            yield rows()
        packer.end()
        yield rows()

    # the ids move once: ranges were found without them
    spread = tokens.select("row", "id", "ids").join(dealt, "row").repartitionById(partitions(spark), "part").sortWithinPartitions("seed", "place", "row")
    return spread.select("id", "ids").mapInArrow(pack, PIECES)
