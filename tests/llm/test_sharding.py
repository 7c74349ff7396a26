import zlib
from collections import Counter, defaultdict

from scriptorium.llm import sharding as op
from scriptorium.llm.common import table
from tests.llm.fixtures import edge_docs, edge_rows, empty_docs, prose


def check(rows, texts, shards, slack):
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(sizes.values()) / shards
    assert max(abs(sizes[k] - mean) for k in range(shards)) <= slack * mean
    return sizes


def test_documents(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    rows = op.op9(spark, docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert r["size"] == len(raw) + 8 and r["text_crc32"] == zlib.crc32(raw)
    check(rows, texts, 24, 0.01)
    where = defaultdict(set)
    for r in rows:
        where[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())  # no group exceeds a shard here


def test_hot_group_is_cut_and_other_groups_stay_whole(spark):
    rows = [(i, "hot text" if i % 3 == 0 else prose(20 + i % 5, i // 2)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = op.op9(spark, df).collect()
    check(out, dict(rows), 24, 0.05)
    counts = Counter(r["shard"] for r in out)
    assert max(counts.values()) < 1.6 * 3000 / 24


def test_edge_rows_and_empty_table(spark):
    got = op.op9(spark, edge_docs(spark)).collect()
    assert len(got) == len(edge_rows())
    check(got, None, 24, 30)
    by = {(r["doc_id"], r["text_crc32"]): r for r in got}
    assert by[3, 0]["size"] == 8 and by[4, 0]["size"] == 8
    assert op.op9(spark, empty_docs(spark)).count() == 0


def test_a_hot_group_with_one_id_or_none(spark):
    for hot_id in ("7", "CAST(NULL AS LONG)"):
        hot = spark.range(1500).selectExpr(f"{hot_id} AS doc_id", "'the same text of some length, again and again' AS text")
        rest = spark.range(3000).selectExpr("id + 10 AS doc_id", "concat('text ', id, ' of one row') AS text")
        out = op.op9(spark, hot.unionByName(rest).repartition(5)).collect()
        assert len(out) == 4500
        check(out, None, 24, 0.05)


def test_ties_are_placed_alike_in_every_run(spark):
    df = spark.range(600).selectExpr("id AS doc_id", "concat('w ', id % 50) AS text").repartition(3)
    first, second = (sorted(tuple(r)[:5] for r in op.op9(spark, df).select("doc_id", "size", "law", "shard", "text_crc32").collect())
                     for _ in range(2))
    assert first == second


def test_placing_against_a_plain_version():
    import numpy as np
    r = np.random.default_rng(2)
    v = r.integers(1, 50, (200, 3)).astype(float)
    share = v / v.sum(axis=0) * 6
    residual, want = [[1.0] * 3 for _ in range(6)], {}
    for i in sorted(range(200), key=lambda i: (-max(share[i]), i)):
        scores = [sum(a * b for a, b in zip(residual[s], share[i])) for s in range(6)]
        want[i] = max(range(6), key=lambda s: (round(scores[s], 9), -s))
        residual[want[i]] = [a - b for a, b in zip(residual[want[i]], share[i])]
    got = op.place(v, 6)
    loads = np.stack([share[got == s].sum(axis=0) for s in range(6)])
    assert (got == [want[i] for i in range(200)]).mean() > 0.98 and abs(loads - 1).max() < 0.15
