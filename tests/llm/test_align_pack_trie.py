"""Token alignment, matched packing and the prefix trie, against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortline.llm.align_tokens import align_tokens, sides
from cohortline.llm.common import table
from cohortline.llm.matched_packing import Plan, pack_matched
from cohortline.llm.prefix_trie import end_digests, ordered_turns, prefix_trie, shared_heads, with_ends
from cohortline.llm.queries import op13_prefix_trie, queries
from cohortline.llm.tokens import vocabulary
from conftest import SF

PATH_A, PATH_B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
ODD = ["Hello, World. Don't", None, "", " ", " \n ", "  two  spaces ", "<|endoftext|> <s> </s> <unk> <0x41>", "J̌ W̊ İI. K don't.", "日本語。 ok. 🙂",
       "a▁b", "tab\tnew\r\nline", "a\0b", "x" * 5000, " " * 3000, "word " * 8000, "Hello, World. Don't", "é́", "ﬁ Å", "½²"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i * 3, t, 1, "clash") for i, t in enumerate(ODD)] + [(None, "no id", 2, "x"), (0, "Hello, World. Don't", 3, "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_a int, codes string").repartition(3)


# --- token alignment ------------------------------------------------------------------------------------------------------------------


@lru_cache
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def tokens_of(text):
    """(id, start byte, end byte) on both sides by the tokenizers themselves, or None."""
    a, b = tokenizers()
    if not text:
        return None
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [x for x in range(256) if x not in shown]
    byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(hidden)}
    side_a = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    side_b = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
              for i in b.encode(text)]
    found = []
    for side in (side_a, side_b):
        if b"".join(x for _, x in side) != b" " + text.encode():
            return None
        at, spans = 0, []
        for i, x in side:
            spans.append((i, at, at + len(x)))
            at += len(x)
        found.append(spans)
    return found


def brute_alignment(rows):
    docs, counts = [], Counter()
    for doc_id, text in rows:
        found = tokens_of(text)
        if found is None:
            docs.append((doc_id, None, [], 0, ""))
            continue
        a, b = found
        links, j = [], 0
        for x in a:
            while j and b[j][2] > x[1]:
                j -= 1
            while b[j][2] <= x[1]:
                j += 1
            while j < len(b) and b[j][1] < x[2]:
                links.append((x[0], b[j][0]))
                j += 1
            j = min(j, len(b) - 1)
        cuts = sorted({x[2] for x in a} & {x[2] for x in b})
        written, i, j = [], 0, 0
        for c in cuts:
            left, right = [], []
            while i < len(a) and a[i][2] <= c:
                left.append(str(a[i][0]))
                i += 1
            while j < len(b) and b[j][2] <= c:
                right.append(str(b[j][0]))
                j += 1
            written.append(",".join(left) + "|" + ",".join(right))
        counts.update(links)
        docs.append((doc_id, found, links, len(cuts), hashlib.sha256(";".join(written).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return Counter((
        d, len(f[0]) if f else 0, len(f[1]) if f else 0, g, len(links), sum(counts[p] == best[p[1]] for p in links),
        sum(counts[p] for p in links), h) for d, f, links, g, h in docs)


@pytest.mark.parametrize("block_bytes", [100, 3_000_000])
def test_alignment_of_odd_texts_equals_brute_force(odd, block_bytes):
    got = Counter(map(tuple, align_tokens(odd, PATH_A, PATH_B, block_bytes=block_bytes).collect()))
    assert got == brute_alignment([(r["doc_id"], r["text"]) for r in odd.collect()])


def test_alignment_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    assert Counter(map(tuple, queries()["op11_align_tokens"](spark, SF).collect())) == brute_alignment(docs)


def test_alignment_of_no_rows(odd):
    assert align_tokens(odd.limit(0), PATH_A, PATH_B).collect() == []
    rows = align_tokens(odd.filter("text is null or text = ''"), PATH_A, PATH_B).collect()
    assert len(rows) == 2 and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in rows)


def test_fast_side_equals_the_tokenizer():
    a, _, _ = sides(PATH_A, PATH_B)
    draw = random.Random(5)
    texts = ["".join(draw.choice("abAB '.,!<|>̌é3 \n\t\x1c 　日🙂's'll") for _ in range(draw.randint(1, 40))) for _ in range(3000)]
    want = tokenizers()[0].encode_batch([" " + t for t in texts], add_special_tokens=False)
    assert [x.tolist() for x in a.ids(texts)] == [w.ids for w in want]


# --- matched packing ------------------------------------------------------------------------------------------------------------------


def laid(counts, window):
    """Contents of the plan's sequences: offset and length of every piece; every rank has one place."""
    plan = Plan(counts, window)
    length, rank, first, each, offset = plan.columns()
    bins, done = defaultdict(list), Counter()
    for k in range(len(length)):
        size = int(length[k])
        stop = int(rank[k + 1]) if k + 1 < len(length) and length[k + 1] == size else counts[size]
        for r in range(int(rank[k]), stop):
            past = r - int(rank[k])
            bins[int(first[k]) + past // int(each[k])].append((int(offset[k]) + past % int(each[k]) * size, size))
            done[size] += 1
    assert done == Counter(counts) and sorted(bins) == list(range(plan.sequences))
    for pieces in bins.values():
        at = 0
        for start, size in sorted(pieces):
            assert start == at
            at += size
        assert at <= window
    return bins


def simulated(counts, window):
    """The same method piece by piece: how full each sequence is."""
    large = sorted((s for s, n in counts.items() for _ in range(n) if 3 * s > window), reverse=True)
    small = sorted((s for s, n in counts.items() for _ in range(n) if 3 * s <= window), reverse=True)
    full = []
    while large:
        size = large.pop(0)
        other = next((i for i, s in enumerate(large) if s + size <= window), None)
        full.append(size + (large.pop(other) if other is not None else 0))
    for size in small:
        fits = [i for i, f in enumerate(full) if f + size <= window]
        if fits:
            full[max(fits, key=lambda i: full[i])] += size
        else:
            full.append(size)
    return sorted(full)


def most_pairs(sizes, window):
    @lru_cache(None)
    def best(rest):
        if len(rest) < 2:
            return 0
        head, tail = rest[0], rest[1:]
        found = best(tail)
        for i, s in enumerate(tail):
            if s + head <= window:
                found = max(found, 1 + best(tail[:i] + tail[i + 1:]))
        return found

    return best(tuple(sizes))


def test_plan_equals_packing_piece_by_piece():
    draw = random.Random(3)
    for trial in range(400):
        window = draw.choice([7, 12, 30, 64])
        counts = {draw.randint(1, window): draw.randint(1, 9) for _ in range(draw.randint(0, 12))}
        bins = laid(counts, window)
        assert sorted(sum(s for _, s in b) for b in bins.values()) == simulated(counts, window), counts


def test_large_pieces_make_as_many_pairs_as_can_be():
    draw = random.Random(4)
    for trial in range(100):
        sizes = sorted(draw.randint(11, 30) for _ in range(draw.randint(1, 9)))
        bins = laid(dict(Counter(sizes)), 30)
        assert len(bins) == len(sizes) - most_pairs(sizes, 30)


def check_pieces(rows, texts, window, end_id):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(vocabulary())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for doc_id, text in set(texts):
        ids = [*encode.encode(text or "", add_special_tokens=False).ids, end_id]
        want = Counter((k, at, len(ids[at:at + window]), np.array(ids[at:at + window], "<u4").tobytes())
                       for k, at in enumerate(range(0, len(ids), window)))
        times = sum(1 for x in texts if x == (doc_id, text))
        got = Counter((r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in pieces[doc_id])
        assert all(got[k] >= n * times for k, n in want.items())
    assert len(rows) == sum(max(1, math.ceil((len(encode.encode(t or "", add_special_tokens=False).ids) + 1) / window)) for _, t in texts)
    for some in sequences.values():
        at = 0
        for r in sorted(some, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    return len(sequences), Counter(r["length"] for r in rows)


@pytest.mark.parametrize("window", [16, 2048])
def test_matched_packing_of_odd_texts(odd, window):
    rows = pack_matched(odd, vocabulary(), window=window).collect()
    n, sizes = check_pieces(rows, [(r["doc_id"], r["text"]) for r in odd.collect()], window, 0)
    assert n == Plan(sizes, window).sequences
    assert pack_matched(odd.limit(0), vocabulary()).collect() == []


def test_matched_packing_query(spark):
    rows = pack_matched(table(spark, SF, "documents"), vocabulary()).collect()
    n, sizes = check_pieces(rows, [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()], 2048, 0)
    assert n == len(simulated(sizes, 2048)) and n <= 1.02 * math.ceil(sum(s * k for s, k in sizes.items()) / 2048) + 1
    got = {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in queries()["op12_matched_packing"](spark, SF).collect()}
    assert got == {(r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(bytes(r["ids"]))) for r in rows}


# --- prefix trie ----------------------------------------------------------------------------------------------------------------------


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    return out


def brute_trie(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)

    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in kids[path]) or 1
        saved[path] = sum(saved[k] for k in kids[path]) + (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
    return Counter((
        m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(kids[p]), leaves[p], saved[p],
        hashlib.sha256(",".join(str(c) for c in m if len(convs[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, place string, block int").repartition(5)


def drawn(seed, n):
    draw = random.Random(seed)
    rows = []
    for c in [*range(n), 100, 200, 205, -3, -150, 399, 407]:
        for t in range(draw.choice([0, 1, 2, 3, 5, 6, 9, 14])):
            rows.append((c, t, draw.choice(["user", None, ""]), draw.choice(["a", "a", "a", "", None, "日本"])))
    rows += [(None, 1, "user", "no conversation"), (3, None, "user", "first"), (3, None, "user", "first"), (4, 2, "x", "tie"), (4, 2, "x", "also")]
    rows += [(7, t, "user", "a") for t in range(300)] + [(8, t, "user", "a") for t in range(300)] + [(9, t, "user", "b") for t in range(90)]
    return rows


@pytest.mark.parametrize("block", [1, 2, 4, 7])
def test_trie_equals_brute_force(spark, block):
    rows = drawn(block, 60)
    convs, turns = shared_heads(ordered_turns(conversations(spark, rows)))
    want = rebuilt(rows)
    found = defaultdict(list)
    for r in turns.orderBy("conv_id", "place").collect():
        found[r["conv_id"]].append((r["role"], r["text"]))
        assert r["place"] == len(found[r["conv_id"]])
    assert {c: found[c] for c in want} == want and {r[0] for r in convs.collect()} == set(want)
    got = Counter(map(tuple, with_ends(prefix_trie(convs, turns, block)).select(*COLUMNS).collect()))
    assert got == brute_trie(want)


def test_trie_query_equals_brute_force(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table(spark, SF, "conversations").collect()]
    found = op13_prefix_trie(spark, SF)
    assert found.columns == COLUMNS
    assert Counter(map(tuple, found.collect())) == brute_trie(rebuilt(rows))


def test_trie_without_turns(spark):
    convs = spark.createDataFrame([(5,), (3,)], "conv_id long")
    none = spark.createDataFrame([], "conv_id long, place long, role string, text string")
    rows = with_ends(prefix_trie(convs, none)).select(*COLUMNS).collect()
    assert [tuple(r) for r in rows] == [(3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,5").hexdigest())]
    assert with_ends(prefix_trie(convs.limit(0), none)).collect() == []
    empty = conversations(spark, [])
    assert with_ends(prefix_trie(*shared_heads(ordered_turns(empty)))).collect() == []


def test_end_digests_go_through_chunks(spark):
    ends = spark.range(1, 3001).select(F.lit(1).cast("long").alias("key_a"), F.lit(2).cast("long").alias("key_b"), F.col("id").alias("conv_id"))
    other = ends.limit(10).withColumn("key_b", F.lit(3).cast("long"))
    got = {r["key_b"]: r["ends_sha256"] for r in end_digests(ends.union(other).repartition(7), chunk=64).collect()}
    assert got[2] == hashlib.sha256(",".join(map(str, range(1, 3001))).encode()).hexdigest() and set(got) == {2, 3}
