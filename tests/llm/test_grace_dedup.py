import hashlib
import random
from collections import defaultdict

from scriptorium.llm import grace_dedup as op
from tests.llm.fixtures import edge_docs, edge_rows, empty_docs, prose


def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or ""))


def check(got, rows):
    """Against a dictionary of the normalised texts."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[fold(t)].append(i)
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in got) == sorted((i is None, i) for i, _ in rows)
    want = {}
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        want[hashlib.sha256(t.encode()).hexdigest()] = (max(known) if known else None, len(ids), sorted(ids, key=str))
    seen = defaultdict(list)
    for r in got:
        keep, n, _ = want[r["text_sha256"]]
        assert (r["keep_id"], r["group_size"]) == (keep, n)
        assert not r["kept"] or r["doc_id"] == keep
        seen[r["text_sha256"]].append(r)
    for sha, members in seen.items():
        assert sorted((r["doc_id"] for r in members), key=str) == want[sha][2]
        assert sum(r["kept"] for r in members) == 1
    assert len(seen) == len(groups)


def mixed(n, seed):
    r = random.Random(seed)
    pool = [prose(r.randrange(1, 60), k) for k in range(n // 4)]
    rows = [(i, "hot Text" if i % 3 == 0 else r.choice(pool)) for i in range(n)]
    return [(i, t.upper() if r.random() < 0.2 and t.isascii() else t) for i, t in rows]


def test_copies_and_a_group_with_a_third_of_the_rows(spark):
    rows = mixed(3000, 1)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    check(op.op11(spark, df).collect(), rows)


def test_buckets_that_do_not_fit_are_partitioned_again(spark):
    rows = mixed(400, 2) + [(5000 + i, "long " + "x" * 9000 + str(i % 3)) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    small = op.groups(df, table_bytes=12000, bucket_bytes=24000, window_bytes=4000, window_rows=100)
    check(small.collect(), rows)


def test_hot_group_has_many_short_windows(spark):
    df = spark.range(20_000).selectExpr("id AS doc_id", "'Same' AS text").repartition(4)
    got = op.groups(df, window_rows=500)
    assert got.where("kept").collect()[0]["doc_id"] == 19_999
    assert got.where("group_size = 20000 AND keep_id = 19999").count() == 20_000


def test_open_table_compares_whole_texts(monkeypatch):
    monkeypatch.setattr(op.xxhash, "xxh3_64_intdigest", lambda t: len(t) % 2)  # nearly all collide
    table, r = op.OpenTable(), random.Random(3)
    texts = [str(r.randrange(3000)).encode() for _ in range(4000)]
    for i, t in enumerate(texts):
        table.add(t, 1, (i, 0, 0), [i])
    assert len(table) == len(set(texts)) and sum(table.n) == 4000
    assert all(texts[max(table.keys[e])] == table.text[e] for e in range(len(table)))


def test_edge_rows_repeated_ids_and_empty_table(spark):
    check(op.op11(spark, edge_docs(spark)).collect(), [(r[0], r[1]) for r in edge_rows()])
    assert op.op11(spark, empty_docs(spark)).count() == 0
    only_null = spark.createDataFrame([(None, "a"), (None, "A"), (None, None)], "doc_id long, text string")
    check(op.op11(spark, only_null).collect(), [(None, "a"), (None, "A"), (None, None)])


def test_deduplicated_rows_keep_their_columns(spark):
    df = spark.createDataFrame([(1, "A b", 1, "x", None), (2, "a B", 2, "y", 2.5), (3, None, 3, None, None),
                                (4, "", 4, "z", 1.0)], "doc_id long, text string, k int, payload string, `n.x` double")
    got = op.deduplicated(df)
    assert got.schema == df.schema
    assert sorted(tuple(r) for r in got.collect()) == [(2, "a B", 2, "y", 2.5), (4, "", 4, "z", 1.0)]
    assert op.deduplicated(edge_docs(df.sparkSession)).columns == edge_docs(df.sparkSession).columns
