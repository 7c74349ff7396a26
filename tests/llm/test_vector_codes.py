import hashlib
import math
import random
from collections import defaultdict

import numpy as np

from scriptorium.llm import vector_codes as op

SCHEMA = "vec_id long, embedding array<float>, label int, q string, r double, dim int"


def brute(rows, parts=8, entries=16, rounds=6):
    """Plain Lloyd rounds in Python integers, without pivots."""
    kept = []
    for i, e, label in rows:
        if e is not None and all(x is not None and math.isfinite(x) for x in e):
            v = [max(-op.BOUND, min(op.BOUND, math.floor(4096 * float(np.float32(x))))) for x in e]
            kept.append((i, v + [0] * (-len(v) % parts), label, len(v)))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i4").tobytes()))
    kept = [r for r in kept if r[3] == kept[0][3]]
    width = len(kept[0][1]) // parts if kept else 0
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for c in cut:
                members[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(col) // len(members[k]) for col in zip(*members[k])] if members[k] else e
                        for k, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = defaultdict(int)
    for (_, _, label, _), e in zip(kept, errors):
        by_label[label] += e
    return sorted(((r[0], "".join(f"{k:02x}" for _, k in f), e, by_label[r[2]], sha)
                   for r, f, e in zip(kept, found, errors)), key=str)


def got(spark, rows):
    df = spark.createDataFrame([(*r, "q", 1.5, 3) for r in rows], SCHEMA).repartition(4)
    return sorted((tuple(r) for r in op.op13(spark, df).collect()), key=str)


def vectors(n, dim, seed, spread=5):
    r = random.Random(seed)
    centres = [[r.uniform(-1, 1) for _ in range(dim)] for _ in range(spread)]
    return [(i, [x + r.gauss(0, 0.1) for x in r.choice(centres)], r.choice([None, 1, 2])) for i in range(n)]


def test_against_plain_search(spark):
    rows = vectors(200, 32, 1) + [(1000 + i, [0.25] * 32, 5) for i in range(100)]  # a third are copies
    assert got(spark, rows) == brute(rows)


def test_ties_go_to_the_lower_index(spark):
    rows = [(i, [float(x) / 4096 for x in ((i * 7) % 3, (i * 5) % 2) * 8], i % 2) for i in range(60)]
    assert got(spark, rows) == brute(rows)


def test_invalid_vectors_odd_lengths_and_large_components(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(12, 11, 2) + [(90, None, 1), (91, [1.0, None] + [0.0] * 9, 1), (92, [nan] * 11, 1), (93, [inf] * 11, None),
                                 (94, [0.0] * 10, 1), (None, [0.5] * 11, 2), (3, [0.5] * 11, None), (3, [0.5] * 11, None),
                                 (95, [3e38] * 11, 9), (96, [-3e38] + [0.0] * 10, 9), (97, [], 1)]
    assert got(spark, rows) == brute(rows)


def test_empty_tables_and_empty_vectors(spark):
    assert got(spark, [(1, None, 1)]) == []
    assert op.op13(spark, spark.createDataFrame([], SCHEMA)).count() == 0
    assert got(spark, [(1, [], 1), (2, [], None)]) == brute([(1, [], 1), (2, [], None)])


def test_pivots_prune_and_bounds_hold():
    r = np.random.default_rng(5)
    book = r.integers(-4096, 4096, (16, 8))
    part = (book[r.integers(0, 16, 5000)] + r.integers(-300, 300, (5000, 8))).astype(np.int64)
    pivots = op.choose_pivots(book)
    search = op.Search(book, pivots)
    index, best = search.nearest(part, op.floor_root(op.squared(part, pivots)))
    all_d = op.squared(part, book)
    assert (best == all_d.min(axis=1)).all() and (index == all_d.argmin(axis=1)).all()
    assert search.tried < 0.35 * search.asked
    x = np.array([0, 1, 2, 3, 4, (1 << 52) - 1, 1 << 52, (1 << 61) - 1], np.int64)
    assert op.floor_root(x).tolist() == [math.isqrt(v) for v in x.tolist()]
