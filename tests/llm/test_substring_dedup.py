import hashlib
import re

import pytest

from scriptorium.llm import substring_dedup as op
from scriptorium.llm.common import NULL_ID
from tests.llm.fixtures import edge_docs, edge_rows, empty_docs, prose


def brute(rows, window):
    docs = [(NULL_ID if i is None else i, i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for key, _, w in docs:
        for k in range(len(w) - window + 1):
            s = tuple(w[k:k + window])
            first[s] = min(first.get(s, NULL_ID), key)
    out = []
    for key, i, w in docs:
        gone = {p for k in range(len(w) - window + 1) if first[tuple(w[k:k + window])] < key
                for p in range(k, k + window)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("limit", [op.BUCKET_LIMIT, 1, 400])
@pytest.mark.parametrize("buckets", [None, 1, 50])
def test_edge_rows(spark, limit, buckets):
    got = op.dedup(edge_docs(spark), buckets=buckets, bucket_limit=limit)
    assert result(got) == brute([r[:2] for r in edge_rows()], op.WINDOW)


def test_many_partial_overlaps(spark, monkeypatch):
    rows = [(i, " ".join([prose(10, i, 1000), prose(20 + i % 9, i % 5, 40), prose(9, 77), prose(5, i, 3)]))
            for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for limit in (op.BUCKET_LIMIT, 500):
        assert result(op.dedup(df, window=6, gram=2, bucket_limit=limit)) == brute(rows, 6)


def test_equal_hashes_are_told_apart_by_bytes():
    class Same(op.SpanHash):
        def spans(self, start, end):
            return super().spans(start, end) % op.np.uint64(3)
    packed = [prose(9, 1).encode(), prose(9, 2).encode(), prose(9, 1).encode() + b" z"]
    count, first = op.first_docs(packed, op.np.array([5, 6, 2]), 9, Same())
    assert count.tolist() == [1, 1, 2] and first.tolist() == [2, 6, 2, 2]


def test_empty_table(spark):
    assert op.op2(spark, empty_docs(spark)).count() == 0
