"""Prefix trie of conversations by hashing blocks of a fixed number of turns.

A digest of a prefix is a sum over its turns of hashes of (place, role, text), so that prefixes of many turns are summed
up from blocks. Conversations are first grouped by the digests at the ends of their blocks. Where all conversations that came
so far go on with the same block, its turns are nodes as they stand. Only where siblings diverge, the turns of one representative
(the smallest id) of each different block are grouped by the digest of every turn. So nothing but block digests is grouped
for all conversations.

A node belongs to its smallest member. A conversation then owns the nodes from some depth on, and what is summed over the subtree of a node
is the sum over its members of what they own, less what they own above the node. That needs sums by block digest and the
representatives' turns, but no walk over levels: the depth of the trie costs no rounds.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortline.llm.common import partitions, staged
from cohortline.operators.ranking import running_totals

SUMS = ["s1", "s2", "s3", "s4"]
MASK = 0xFFFFFFFF
EMPTY = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """conv_id, place (from 1), role, text: the turns in the order of the turn number, null first; ties by role, then text.

    Null roles and texts become empty; rows without a conversation are left out; repeated rows are turns of their own."""
    named = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    placed = running_totals(named, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], {"place": F.lit(1)})
    return placed.select("conv_id", "place", "role", "text")


def shared_heads(turns: DataFrame, family: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame]:
    """(conv_id of all, turns) of conversations rebuilt with the head of the first of their family.

    Conversation c takes the first h turns of c - c % family, then its own turns after its first h; h is the crc32 of the decimal c
    modulo longest + 1. A family is bounded, so no head is copied more than about `family` times."""
    sizes = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    convs = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("first"),
                         (F.crc32(F.col("conv_id").cast("string")) % (longest + 1)).alias("h"))
    firsts = sizes.filter(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("first"), F.col("n").alias("first_n"))
    convs = staged(convs.join(firsts, "first", "left").withColumn("taken", F.least("h", F.coalesce("first_n", F.lit(0)))), "families")
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").filter("place > h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "role", "text")
    heads = turns.filter(F.col("place") <= longest).withColumnRenamed("conv_id", "first").join(
        convs.filter("h > 0").select("conv_id", "first", "h"), "first").filter("place <= h").select("conv_id", "place", "role", "text")
    return convs.select("conv_id"), own.unionByName(heads)


@dataclass
class Trie:
    """nodes: key_a, key_b (digest), conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens;
    the text of a node is turn `depth` of its conv_id. ends: conv_id, key_a, key_b of the node where each conversation ends."""

    nodes: DataFrame
    ends: DataFrame


def _key(a: str, sums: list[Column]) -> list[Column]:
    """The two halves of a digest, from its four sums."""
    s = sums
    return [s[0].bitwiseXOR(F.shiftleft(s[1], 32)).alias(f"{a}_a"), s[2].bitwiseXOR(F.shiftleft(s[3], 32)).alias(f"{a}_b")]


def _keys(a: str) -> list[str]:
    return [f"{a}_a", f"{a}_b"]


def _as(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnsRenamed(dict(zip(_keys(old), _keys(new))))


def prefix_trie(convs: DataFrame, turns: DataFrame, block: int = 4) -> Trie:
    """The trie of all prefixes of the conversations; `convs`: conv_id, distinct; `turns`: conv_id, place (1, 2, ...), role, text.

    A node is a distinct sequence of the first d turns (role and text), from the root (d = 0) on; its members are the conversations that
    begin with it, those without turns only with the root. saved_tokens adds up (n_convs - 1) times the code points of the last text
    over the subtree, the node included; n_leaves counts its nodes without children. No conversations: no nodes."""
    mixed = [F.xxhash64(F.lit(i), "place", "role", "text") for i in (1, 2)]
    halves = [x for h in mixed for x in (h.bitwiseAND(F.lit(MASK)), F.shiftrightunsigned(h, 32))]
    rows = staged(turns.select("conv_id", "place", F.floor((F.col("place") - 1) / block).cast("long").alias("block"),
                               F.length("text").cast("long").alias("chars"), *[h.alias(s) for h, s in zip(halves, SUMS)]), "turns")

    blocks = rows.groupBy("conv_id", "block").agg(*[F.sum(s).alias(s) for s in SUMS])
    chain = running_totals(blocks, ["conv_id"], [F.col("block")], {f"c{s}": F.col(s) for s in SUMS})
    chain = staged(chain.select(
        "conv_id", "block", *[(F.col(f"c{s}") - F.col(s)).alias(f"p{s}") for s in SUMS],
        *_key("parent", [F.col(f"c{s}") - F.col(s) for s in SUMS]), *_key("end", [F.col(f"c{s}") for s in SUMS])), "blocks")

    distinct = chain.groupBy(*_keys("parent"), *_keys("end")).agg(
        F.count("*").alias("n"), F.min(F.struct("conv_id", "block", *[f"p{s}" for s in SUMS])).alias("r")).select(
        *_keys("parent"), *_keys("end"), "n", "r.*")
    distinct = staged(distinct, "block-groups")
    fans = staged(distinct.groupBy(*_keys("parent")).agg((F.count("*") > 1).alias("diverges")), "fans")  # so that Spark can split a hot parent
    chosen = distinct.join(fans.hint("merge"), _keys("parent")).drop(*_keys("parent"))

    inside = Window.partitionBy("conv_id", "block").orderBy("place")  # at most `block` rows
    upto = [F.col(f"p{s}") + F.sum(s).over(inside.rowsBetween(Window.unboundedPreceding, 0)) for s in SUMS]
    paths = rows.join(chosen.hint("merge"), ["conv_id", "block"]).withColumns({f"x{s}": u for s, u in zip(SUMS, upto)})
    paths = staged(paths.select("conv_id", "block", "place", "chars", "n", "diverges", *_keys("end"),
                                *_key("key", [F.col(f"x{s}") for s in SUMS]),
                                *_key("parent", [F.col(f"x{s}") - F.col(s) for s in SUMS])), "paths")

    straight = paths.filter("not diverges").select(*_keys("key"), *_keys("parent"), "conv_id", "n", "place", "block", "chars")
    refined = paths.filter("diverges").groupBy(*_keys("key")).agg(
        *[F.min(c).alias(c) for c in (*_keys("parent"), "conv_id")], F.sum("n").alias("n"), *[F.min(c).alias(c) for c in ("place", "block", "chars")])
    weight = (F.col("n") - 1) * F.col("chars")
    nodes = staged(straight.unionByName(refined).withColumn("w", weight), "nodes")

    last = chain.groupBy("conv_id").agg(F.max(F.struct("block", *_keys("end"))).alias("l")).select("conv_id", F.col("l.end_a").alias("key_a"), F.col("l.end_b").alias("key_b"))
    ends = staged(convs.join(last, "conv_id", "left").na.fill(0, _keys("key")), "ends")
    n_ends = ends.groupBy(*_keys("key")).agg(F.count("*").alias("n_ends"))
    owned = staged(nodes.join(n_ends, _keys("key"), "left").groupBy("conv_id").agg(
        F.sum("w").alias("w"), F.max(F.when(F.col("n_ends") == F.col("n"), 1).otherwise(0)).alias("leaf")), "owned")

    below = chain.join(owned, "conv_id").groupBy(*_keys("end")).agg(F.sum("w").alias("w_below"), F.sum("leaf").alias("leaves"))
    by_block = running_totals(nodes.groupBy("conv_id", "block").agg(F.sum("w").alias("w")), ["conv_id"], [F.col("block")], {"sofar": F.col("w")})
    by_block = by_block.select("conv_id", "block", (F.col("sofar") - F.col("w")).alias("earlier"))
    above = F.coalesce(F.sum("w").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("earlier")
    valued = paths.join(by_block.hint("merge"), ["conv_id", "block"]).join(
        nodes.select("conv_id", "place", "w"), ["conv_id", "place"], "left").withColumn("above", above)
    sums = valued.join(below.hint("merge"), _keys("end")).groupBy(*_keys("key")).agg(
        F.sum(F.col("w_below") - F.col("above")).alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    totals = owned.agg(F.coalesce(F.sum("w"), F.lit(0)).alias("saved_tokens"), F.coalesce(F.sum("leaf"), F.lit(1)).alias("n_leaves")).first()
    top = root.first()
    fan = nodes.groupBy(*_keys("parent")).agg(F.count("*").alias("n_children"))
    owner = _as(nodes.select(*_keys("key"), F.col("conv_id").alias("parent_conv_id")), "key", "parent")
    whole = nodes.join(sums.hint("merge"), _keys("key")).join(_as(fan, "parent", "key").hint("merge"), _keys("key"), "left").join(
        owner.hint("merge"), _keys("parent"), "left")
    whole = whole.select(
        *_keys("key"), "conv_id", F.col("place").alias("depth"),
        F.coalesce("parent_conv_id", F.lit(top and top["conv_id"]).cast("long")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens")
    first = fan.filter("parent_a = 0 and parent_b = 0").agg(F.coalesce(F.sum("n_children"), F.lit(0))).first()[0]
    trunk = root.select(
        *[F.lit(0).cast("long").alias(k) for k in _keys("key")], "conv_id", F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", F.lit(first).cast("long").alias("n_children"),
        F.lit(totals["n_leaves"]).cast("long").alias("n_leaves"), F.lit(totals["saved_tokens"]).cast("long").alias("saved_tokens"))
    return Trie(whole.unionByName(trunk), ends)


def end_digests(ends: DataFrame, chunk: int = 50_000) -> DataFrame:
    """key_a, key_b, ends_sha256: SHA-256 (hex) of the decimal conv_ids that end in a node, ascending, with commas between.

    A digest of one node must see its ids in order. So ranges of (node, id) are written as text in chunks by many tasks first, and
    only these chunks go, in order, through the task of their node, which holds one at a time."""

    def write(batches):
        key, first, ids = None, None, []

        def rows(found):
            columns = list(zip(*found)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [*[pa.int64()] * 3, pa.binary()])],
                                              ["key_a", "key_b", "first", "part"])

        for b in batches:
            found = []
            for x, y, c in zip(*(b[k].to_pylist() for k in ("key_a", "key_b", "conv_id"))):
                if ids and ((x, y) != key or len(ids) >= chunk):
                    found.append((*key, ids[0], ",".join(map(str, ids)).encode()))
                    ids = []
                key = (x, y)
                ids.append(c)
            yield rows(found)
        if ids:
            yield rows([(*key, ids[0], ",".join(map(str, ids)).encode())])

    def digest(batches):
        key, state = None, None

        def rows(found):
            columns = list(zip(*found)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.string()])],
                                              ["key_a", "key_b", "ends_sha256"])

        for b in batches:
            found = []
            for x, y, part in zip(b["key_a"].to_pylist(), b["key_b"].to_pylist(), b["part"]):
                if (x, y) != key:
                    if state is not None:
                        found.append((*key, state.hexdigest()))
                    key, state = (x, y), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(part.as_buffer())
            yield rows(found)
        if state is not None:
            yield rows([(*key, state.hexdigest())])

    n = partitions(ends.sparkSession)
    spread = ends.select("key_a", "key_b", "conv_id").repartitionByRange(n, "key_a", "key_b", "conv_id").sortWithinPartitions(
        "key_a", "key_b", "conv_id")
    parts = spread.mapInArrow(write, "key_a long, key_b long, first long, part binary")
    return parts.repartition(n, "key_a", "key_b").sortWithinPartitions("key_a", "key_b", "first").mapInArrow(
        digest, "key_a long, key_b long, ends_sha256 string")


def with_ends(trie: Trie) -> DataFrame:
    """The nodes with ends_sha256, that of no ids where no conversation ends."""
    found = trie.nodes.join(end_digests(trie.ends).hint("merge"), ["key_a", "key_b"], "left")
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))
