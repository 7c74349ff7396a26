import random
from itertools import combinations

import numpy as np
import xxhash

from scriptorium.llm import simhash as op
from scriptorium.llm.components import smallest_reachable
from tests.llm.fixtures import edge_docs, edge_rows, empty_docs, prose


def brute_fingerprint(text):
    w = (text or "").encode().translate(op._FOLD).split()
    sh = [b" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, radius=2):
    parent = {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    fps = [(i, f) for i, f in rows]
    parent = {f: f for _, f in fps}
    for a, b in combinations(list(parent), 2):
        if (a ^ b).bit_count() <= radius:
            parent[root(a)] = root(b)
    low = {}
    for i, f in fps:
        if i is not None:
            low[root(f)] = min(low.get(root(f), i), i)
    return sorted(((i, f"{f:016x}", low.get(root(f))) for i, f in fps), key=str)


def test_edge_rows(spark):
    want = brute_components([(i, brute_fingerprint(t)) for i, t, *_ in edge_rows()])
    assert sorted(map(tuple, op.op7(spark, edge_docs(spark)).collect()), key=str) == want
    assert op.op7(spark, empty_docs(spark)).count() == 0


def near_values(n, seed):
    r = random.Random(seed)
    out = [r.getrandbits(64) for _ in range(n)]
    for _ in range(4 * n):
        x = r.choice(out)
        for _ in range(r.randint(1, 3)):
            x ^= 1 << r.randrange(64)
        out.append(x)
    return sorted(set(out))


def test_links_are_complete(spark):
    values = near_values(120, 4)
    want = {}
    for i, f, root in brute_components(list(zip(values, values))):
        want[int(f, 16)] = root
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    for dense in (op.DENSE, 1):
        got = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in op.link_components(df, dense=dense).collect()}
        groups = {}
        for v in values:
            groups.setdefault(got.get(v, v), set()).add(v)
        expect = {}
        for v, root in want.items():
            expect.setdefault(root, set()).add(v)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))


def test_bit_sliced_pairs_equal_popcounts():
    r = np.random.default_rng(5)
    for radius in (0, 1, 2, 3):
        fp = np.sort(np.array(near_values(40, radius), np.uint64))
        group = np.sort(r.integers(0, 4, len(fp)))
        got = {(i, j) for a, b in op.near_pairs(fp, group, radius) for i, j in zip(a.tolist(), b.tolist())}
        want = {(i, j) for i, j in combinations(range(len(fp)), 2)
                if group[i] == group[j] and int(fp[i] ^ fp[j]).bit_count() <= radius}
        assert got == want


def test_block_masks_cover_the_radius():
    for a, b in combinations(range(64), 2):
        assert any(not m >> a & 1 and not m >> b & 1 for _, m in op.block_masks(2))


def test_components_of_long_paths(spark):
    r = random.Random(6)
    nodes = list(range(300))
    r.shuffle(nodes)
    edges = [(nodes[k], nodes[k + 1]) for k in range(298) if k != 150] + [(1, 1)]
    got = {x["node"]: x["root"] for x in smallest_reachable(spark.createDataFrame(edges, "a long, b long")).collect()}
    for part in (nodes[:151], nodes[151:299]):
        assert {got.get(v, v) for v in part} == {min(part)}


def test_keep_first(spark):
    rows = [(5, prose(60, 1), 1), (3, prose(60, 1), 2), (3, prose(60, 1), 2), (9, prose(60, 2), 3), (None, "x", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp long")
    assert sorted(map(tuple, op.keep_first(df).collect()), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)
    assert op.keep_first(empty_docs(spark)).count() == 0
    assert op.keep_first(edge_docs(spark)).columns == edge_docs(spark).columns


def test_keep_first_with_columns_named_like_its_own(spark):
    rows = [(1, "a b c d", 1, 2, 3), (2, "a b c d", 4, 5, 6), (3, "other words here", 7, 8, 9), (None, "a b c d", 1, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _n int, `first` int, N int")
    got = op.keep_first(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[0], rows[2], rows[3]], key=str)


def test_components_with_hubs_equal_a_union_find(spark, monkeypatch):
    import random

    from scriptorium.llm import components
    rnd = random.Random(3)
    links = [(0, k) for k in range(1, 300)] + [(1000 + k, 900) for k in range(200)] + [(2000 + k, 2001 + k) for k in range(60)] \
        + [(rnd.randrange(3000, 3200), rnd.randrange(3000, 3200)) for _ in range(120)] + [(5, 5), (299, 1000), (None, 1)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    expected = {x: find(x) for x in root if find(x) != x}
    frame = spark.createDataFrame(links, "a long, b long")
    for hubs in (4, 1024):  # only the hubs are broadcast, or every node
        monkeypatch.setattr(components, "HUBS", hubs)
        got = components.smallest_reachable(frame).collect()
        assert {r["node"]: r["root"] for r in got} == expected and len(got) == len(expected)
    assert components.smallest_reachable(frame.limit(0)).collect() == []


def test_a_bucket_larger_than_what_is_gathered(spark, monkeypatch):
    monkeypatch.setattr(op, "HELD", 7)
    base = 0x1234_5678_9ABC_DEF0
    fps = sorted({base ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(64)})
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = op.link_components(frame).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(fps) - 1 and len({r["root"] for r in got}) == 1
