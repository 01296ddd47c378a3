"""Exact, suffix-array and SimHash deduplication against brute force."""

import hashlib
import random
import re
import time
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortline.llm import components as components_module
from cohortline.llm import near_stage, simhash, suffix_dedup
from cohortline.llm.common import CLEANUP, staged
from cohortline.llm.components import components
from cohortline.llm.exact_dedup import drop_copies, exact_dedup
from cohortline.llm.suffix_dedup import NO_ID, remove_repeats, string_classes, suffix_ranks

#: Nulls, empty and blank texts, ties, repeated rows, a null id, columns whose names the operators use inside.
ROWS = [
    (1, "a b", "x", 0), (2, "ab", "x", 0), (3, "a\tb ", "x", 0), (4, "a  b", "y", 0), (5, None, None, 0), (6, "", "x", 0),
    (7, " \n\x0b", "x", 0), (8, "ä ö", None, 0), (9, "äö", "z", 0), (None, "ab", "z", 0), (4, "a  b", "y", 0), (10, "w " * 40000, "z", 0),
    (11, "unique text", "z", 0),
]
SCHEMA = "doc_id long, text string, fp string, row int"


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def test_exact_dedup_matches_brute_force(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    spark.conf.set("spark.sql.shuffle.partitions", "12")  # more slots than one round can serve
    try:
        got = [r.asDict() for r in exact_dedup(df, fan_in=2).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(got) == len(ROWS)
    for t in {norm(r[1]) for r in ROWS}:
        same = [r for r in ROWS if norm(r[1]) == t]
        keep = min(same, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0]))
        mine = [g for g in got if g["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()]
        assert len(mine) == len(same) and {(g["keep_id"], g["group_size"]) for g in mine} == {(keep[0], len(same))}
        assert sum(g["kept"] for g in mine) == 1
    kept = drop_copies(df)
    assert kept.columns == df.columns
    assert sorted(norm(r["text"]) for r in kept.collect()) == sorted({norm(r[1]) for r in ROWS})


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    for df in (exact_dedup(none), drop_copies(none), remove_repeats(none), simhash.near_duplicates(none), near_stage.drop_near_copies(none)):
        assert df.count() == 0


def brute_repeats(rows):
    key = lambda i: NO_ID if i is None else i
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        for p in range(len(raw) - 49):
            first[raw[p : p + 50]] = min(key(i), first.get(raw[p : p + 50], NO_ID))
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 49):
            if first[raw[p : p + 50]] < key(i):
                gone[p : p + 50] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = sum(bool(gone[p]) and not (p and gone[p - 1]) for p in range(len(raw)))
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [2000, 5])
def test_repeats_match_brute_force(spark, hot):
    draw = random.Random(hot)
    noise = lambda n: "".join(draw.choice("abcdeé ") for _ in range(n))
    line = noise(130)
    rows = [(i, noise(draw.randint(0, 90)) + line[draw.randint(0, 40) : draw.randint(80, 130)] + noise(draw.randint(0, 70))) for i in range(60)]
    rows += [(70, rows[3][1]), (71, rows[3][1]), (71, rows[3][1]), (None, rows[3][1]), (80, None), (81, ""), (82, "x" * 49), (83, "x" * 50),
             (84, "x" * 3000), (85, "x" * 51), (86, noise(20000) + line)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, block string").repartition(3)
    got = remove_repeats(df, block_bytes=6000, hot_docs=hot).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats(rows)


def test_repeats_take_turns(spark, monkeypatch):
    """Copies of all texts send more than the input holds, so the shards take turns; rows stay the same."""
    draw = random.Random(7)
    text = ["".join(draw.choice("abcdeé ") for _ in range(draw.randint(200, 900))) for _ in range(25)]
    rows = [(i, text[i % 25][: 300 + 10 * i]) for i in range(75)] + [(None, text[0]), (80, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    names = []
    monkeypatch.setattr(suffix_dedup, "staged", lambda d, name: names.append(name) or staged(d, name))
    for hot in (2000, 4):
        names.clear()
        got = remove_repeats(df, block_bytes=4000, hot_docs=hot, share=1.0).drop("kept").collect()
        assert sorted(map(tuple, got), key=str) == brute_repeats(rows)
        assert names.count("answers") > 3
    assert [suffix_dedup.turns_for(*x, 2.0) for x in ((0, 0), (5, 0), (200, 100), (201, 100), (500, 100))] == [1, 5, 1, 2, 3]


def test_suffix_array_is_sorted():
    draw = random.Random(4)
    for letters in (1, 2, 5, 200):
        for n in (0, 1, 2, 3, 4, 50, 301):
            text = bytes(draw.randrange(letters) for _ in range(n))
            array = suffix_ranks(np.frombuffer(text, np.uint8).astype(np.int64) + 1, 10**9)[0].tolist()
            assert array == sorted(range(n), key=lambda i: text[i:])
    text = np.frombuffer(b"ab" * 200, np.uint8)
    assert len(set(string_classes(text, np.arange(300)).tolist())) == 2


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(values, linked):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in combinations(values, 2):
        if linked(a, b):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {v: root(v) for v in values}


def test_simhash_matches_brute_force(spark):
    draw = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    base = [[draw.choice(words) for _ in range(200)] for _ in range(8)]
    rows = [(100 + i, " ".join(b)) for i, b in enumerate(base)]
    for i in range(60):
        copy = list(base[i % 8])
        for _ in range(draw.randint(0, 2)):
            copy[draw.randrange(200)] = draw.choice(words)
        rows.append((i, " ".join(copy)))
    rows += [(200, None), (201, ""), (202, "One"), (203, "one  TWO"), (204, "ONE two"), (205, "É a b"), (205, "É a b"), (206, "w " * 30000)]
    got = {r["doc_id"]: (r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.near_duplicates(
        spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fp int")).collect()}
    prints = {i: brute_print(t) for i, t in rows}
    assert {i: g[0] for i, g in got.items()} == prints
    groups = brute_groups(sorted(prints), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 2)
    assert {i: g[1] for i, g in got.items()} == groups


def test_crowded_buckets_lose_no_link(spark):
    draw = random.Random(5)
    start = draw.getrandbits(64)
    prints = {start}
    for _ in range(120):  # all in the same lower blocks
        prints.add(start ^ sum(1 << b for b in draw.sample(range(32, 64), draw.randint(1, 5))))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    assert len(signed) > simhash.CROWDED
    found = components(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")))
    got = {r["node"]: r["component"] for r in found.collect()}
    want = brute_groups(sorted(signed), lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1") <= 2)
    assert all(got.get(p, p) == want[p] for p in signed)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 90)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()))
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(90)}


def test_components_of_few_edges_take_one_task_and_of_many_the_star_steps(spark, monkeypatch):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 90)] + [(5, 3)], "a long, b long").repartition(7)
    want, steps = {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(90)}, []
    monkeypatch.setattr(components_module, "_star", lambda *a, star=components_module._star, **k: steps.append(1) or star(*a, **k))
    assert sorted(map(tuple, components(edges).collect())) == sorted(want.items())
    assert not steps
    for few in (0, 20):
        assert sorted(map(tuple, components(edges, few).collect())) == sorted(want.items())
    assert steps
    assert not components(edges.limit(0)).collect()


def test_staged_rows_leave_no_shuffle_files(spark):
    numbers = spark.range(1000).selectExpr("id % 7 as k", "id")
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {f for b in tracker.getAllFiles().mkString("\n").split("\n") if "shuffle_" in (f := b.rsplit("/", 1)[-1])}

    before = shuffles()
    rows = staged(numbers.groupBy("k").agg(F.sum("id").alias("s")), "sums")
    for _ in range(50):  # files go in the background
        if not (left := shuffles() - before):
            break
        time.sleep(0.1)
    assert not left and rows.count() == 7
    assert spark.conf.get(CLEANUP) == "false"


def test_near_stage_keeps_one_of_each_group(spark):
    draw = random.Random(9)
    words = [f"w{i}" for i in range(2000)]
    rows, group = [], {}
    for g in range(12):
        base = [draw.choice(words) for _ in range(300)]
        for c in range(1 + g):
            copy = list(base)
            if c:
                copy[draw.randrange(300)] = "changed"
            rows.append((g * 100 + c, " ".join(copy), "near"))
            group[g * 100 + c] = g
    rows += [(5000, None, "near"), (5001, "", "near"), (None, rows[0][1], "near"), (5002, "three short words", "near")]
    df = spark.createDataFrame(rows, "doc_id long, text string, near_copy string")
    out = near_stage.drop_near_copies(df)
    kept = {r["doc_id"] for r in out.collect()}
    assert out.columns == df.columns and {5000, 5001, 5002, None} <= kept
    assert sorted(group[i] for i in kept if i in group) == list(range(12)) and all(i % 100 == 0 for i in kept if i in group)


@pytest.mark.parametrize("copies", [300, 2000])
def test_near_copies_linked_only_through_their_original(spark, copies):
    draw = random.Random(copies)
    base = [f"w{draw.randrange(5000)}" for _ in range(400)]
    rows = [(copies, " ".join(base))]  # the original has the largest id
    for i in range(copies):
        own = list(base)
        for k, at in enumerate(range(10 + draw.randrange(20), 400, 62)):
            own[at] = f"own{i}x{k}"
        rows.append((i, " ".join(own)))
    out = near_stage.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    assert [r["doc_id"] for r in out.collect()] == [0]


def test_near_stage_matches_brute_force_just_above_the_limit(spark):
    draw = random.Random(3)
    rows = []
    line = " ".join(f"common{k}" for k in range(12))  # a shared line crowds its buckets
    for _ in range(40):
        base = [f"w{draw.randrange(900)}" for _ in range(draw.choice((4, 9, 60, 150)))]
        for _ in range(6):
            own = list(base)
            for _ in range(draw.randint(0, 1 + len(own) // 40)):
                own[draw.randrange(len(own))] = f"x{draw.randrange(10**6)}"
            rows.append((len(rows), " ".join(own) + (" " + line if draw.random() < 0.6 else "")))
    sets = {i: set(near_stage.shingle_set(t, 5).tolist()) for i, t in rows}
    want = brute_groups(sorted(sets), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    out = near_stage.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(set(want.values()))


@pytest.mark.parametrize("earlier", [1, 32])
def test_near_stage_of_a_loose_group_matches_brute_force(spark, monkeypatch, earlier):
    """Variants of one text, a third of all pairs similar: each pair is met at the first crowded shingle that both have, also
    where only one earlier shingle is carried."""
    monkeypatch.setattr(near_stage, "EARLIER", earlier)
    monkeypatch.setattr(near_stage, "CROWDED", 3)
    draw = random.Random(earlier)
    base = [f"w{i}" for i in range(140)]
    rows = []
    for i in range(120):
        own = list(base)
        for at in draw.sample(range(140), draw.choice((1, 2, 3, 4, 6, 9))):
            own[at] = f"x{draw.randrange(6)}"  # edits meet as well
        rows.append((i, " ".join(own)))
    sets = {i: set(near_stage.shingle_set(t, 5).tolist()) for i, t in rows}
    want = brute_groups(sorted(sets), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    assert 3 < len(set(want.values())) < 100
    out = near_stage.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(set(want.values()))


def test_outlines_never_rule_out_similar_sets():
    draw = np.random.default_rng(5)
    for n in (1, 2, 5, 17, 300, 3000):
        for changed in (0, 1, n // 12, n // 9, n // 2):
            x = np.unique(draw.integers(0, 2**64, n, dtype=np.uint64))
            y = np.unique(np.r_[x[changed:], draw.integers(0, 2**64, changed + n // 50, dtype=np.uint64)])
            shared = len(np.intersect1d(x, y))
            assert near_stage.most_shared(near_stage.outline(x), near_stage.outline(y)) >= shared
    assert near_stage.most_shared(near_stage.outline(x), b"") is None
    same = np.arange(2000, dtype=np.uint64)  # all in one range
    assert near_stage.outline(same) == b""
    far = [np.unique(draw.integers(0, 2**64, 400, dtype=np.uint64)) for _ in range(2)]
    most = near_stage.most_shared(*map(near_stage.outline, far))
    assert most / (800 - most) < 0.8  # unrelated sets are ruled out


def test_near_stage_goes_through_simhash(spark, monkeypatch):
    """Fingerprints within two bits are met by the SimHash operator and go to the comparison of whole sets, which decides."""
    draw = random.Random(21)
    rows = []
    for g in range(8):
        base = [f"w{draw.randrange(4000)}" for _ in range(600)]
        for c in range(4):
            own = list(base)
            if c:
                own[draw.randrange(600)] = f"own{g}x{c}"
            rows.append((g * 10 + c, " ".join(own)))
    rows += [(900 + k, " ".join(f"z{k}v{j}" for j in range(60))) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = {i: int(simhash.fingerprint_of([simhash.shingle_hashes(t, 5, 0)])[0]) for i, t in rows}
    near = {(a, b) for a in prints for b in prints if a > b and bin(prints[a] ^ prints[b]).count("1") <= 2}
    nodes = near_stage.prefixes(docs, 5, 0.8)
    assert {r["doc_id"]: r["fp"] & (2**64 - 1) for r in nodes.collect()} == prints
    met = {tuple(r) for r in near_stage.fingerprint_pairs(nodes).collect()}
    assert near and met <= near and brute_groups(sorted(prints), lambda a, b: (max(a, b), min(a, b)) in near) == brute_groups(
        sorted(prints), lambda a, b: (max(a, b), min(a, b)) in met)
    compared = []
    whole = near_stage.similar
    monkeypatch.setattr(near_stage, "similar", lambda pairs, *rest: compared.append({tuple(r) for r in pairs.collect()}) or whole(pairs, *rest))
    out = near_stage.drop_near_copies(docs)
    assert sorted(r["doc_id"] for r in out.collect()) == [g * 10 for g in range(8)] + [900 + k for k in range(5)]
    sets = {i: set(near_stage.shingle_set(t, 5).tolist()) for i, t in rows}
    assert {(a, b) for a, b in met if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])} <= compared[0]


@pytest.mark.parametrize("chunk", [1, 30, 1 << 15])
def test_anchor_runs_by_chunks(monkeypatch, chunk):
    """However many places are hashed at once: each start lies in one run, and equal strings have equal anchors."""
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    draw = random.Random(4)
    passage = bytes(draw.choices(b"abcdef", k=120))
    texts = [bytes(draw.choices(b"abcdef", k=draw.choice([0, 10, 49, 50, 200]))) + passage * (i % 3) for i in range(12)] + [b"x" * 700]
    raw, ends = b"".join(texts), np.cumsum(list(map(len, texts))).astype(np.int64)
    start, count, anchor = suffix_dedup.anchor_runs(raw, ends)
    assert count.max() <= suffix_dedup.RUN
    at = [(a + i, h) for a, n, h in zip(start.tolist(), count.tolist(), anchor.tolist()) for i in range(n)]
    begins = [0, *ends[:-1].tolist()]
    assert [a for a, _ in at] == [a for b, e in zip(begins, ends.tolist()) for a in range(b, e - 49)]
    assert len({(raw[a : a + 50], h) for a, h in at}) == len({raw[a : a + 50] for a, _ in at})


def test_groups_by_one_sort():
    for top in (3, 1 << 20):
        keys = np.random.default_rng(2).integers(0, top, 500)
        found = [(k, at.tolist()) for k, at in suffix_dedup._groups(keys)]
        assert found == [(int(k), np.flatnonzero(keys == k).tolist()) for k in np.unique(keys)]
    assert list(suffix_dedup._groups(np.empty(0, np.int64))) == []
