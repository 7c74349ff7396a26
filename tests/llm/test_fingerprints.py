import hashlib

import numpy as np
import xxhash

from scriptorium.llm import fingerprints as op
from tests.llm.fixtures import edge_docs, edge_rows, empty_docs, prose


def brute_chunks(data):
    """One byte at a time."""
    strict, loose = op.masks()
    out, at = {}, 0
    while at < len(data):
        h, end = 0, at
        while end < len(data):
            h = 0
            for k in range(min(op.REACH, end + 1)):  # the hash reaches back over the chunk's start
                h = (h + (int(op.GEAR[data[end - k]]) << k)) & 0xFFFFFFFF
            end += 1
            size = end - at
            if size >= op.MIN_SIZE and h & (strict if size <= op.NORMAL_SIZE else loose) == 0 or size == op.MAX_SIZE:
                break
        out[xxhash.xxh64_intdigest(data[at:end], op.SEED)] = end - at
        at = end
    return out


def brute(rows):
    rows = sorted(((i is not None, i or 0, t is not None, t or "", i) for i, t in rows))
    texts = [r[3] for r in rows]
    prints = [brute_chunks(t.encode()) for t in texts]
    out = []
    for k, (t, p) in enumerate(zip(texts, prints)):
        after, q = texts[(k + 1) % len(rows)], prints[(k + 1) % len(rows)]
        n = len(t) // 4
        e = t[:len(t) - n] + after[:n]
        f = brute_chunks(e.encode())
        near = lambda a, b: (1.0 if not b else 0.0) if not a else sum(v for d, v in a.items() if d in b) / sum(a.values())  # noqa
        out.append((rows[k][4], len(t), hashlib.sha256(e.encode()).hexdigest(), op.fingerprint(p), op.fingerprint(f),
                    near(p, f), near(p, q)))
    return sorted(out, key=str)


def small_rows():
    return [(i, (t or "")[:3000] if t is not None else None) for i, t, *_ in edge_rows()]


def test_edge_rows(spark):
    df = spark.createDataFrame(small_rows(), "doc_id long, text string")
    want = brute(small_rows())
    for ranges in (1, 4, 40):
        got = op.compare_with_next(df.repartition(3), ranges=ranges)
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_one_row_and_empty_table(spark):
    one = spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")
    assert op.op4(spark, one).select("near_next", "n_chars").collect()[0] == (1.0, 8)
    assert op.op4(spark, empty_docs(spark)).count() == 0
    assert op.op4(spark, edge_docs(spark)).count() == len(edge_rows())


def test_boundaries_resist_shifts_and_keep_sizes():
    a = np.frombuffer(prose(3000, 1, 5000).encode(), np.uint8)
    ends = op.boundaries(a)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(a) and sizes[:-1].min() >= op.MIN_SIZE and sizes.max() <= op.MAX_SIZE
    whole, shifted = op.chunks(a.tobytes()), op.chunks(b"some new words " + a.tobytes())
    assert op.containment(whole, shifted) > 0.95
