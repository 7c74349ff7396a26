"""Operators: modes, keys, closure, delta, integrity — small inputs and properties."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_ORACLE


def test_mode_ties_pick_smallest(spark):
    from scriptorium.operators.mode import mode
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "3"), (2, "1"),
                                (2, "3"), (2, "1"), (3, None)], "g int, v string")
    got = {r.g: r.v for r in mode(df, ["g"], "v").collect()}
    assert got == {1: "a", 2: "1"}


def test_weighted_mode_equals_mode_of_repeats(spark):
    """Summing weights gives the same winner as repeating each value w times."""
    from scriptorium.operators.mode import weighted_mode
    rng = random.Random(7)
    rows = [(rng.randint(0, 20), rng.choice("abcdefg"), rng.choice([1, 10, 15, 30]))
            for _ in range(600)]
    df = spark.createDataFrame(rows, "g int, v string, w int")
    got = {r.g: r.v for r in weighted_mode(df, ["g"], "v", "w").collect()}
    expected = {}
    for g in {r[0] for r in rows}:
        counts = {}
        for gg, v, w in rows:
            if gg == g:
                counts[v] = counts.get(v, 0) + w
        best = max(counts.values())
        expected[g] = min(v for v, c in counts.items() if c == best)
    assert got == expected


def test_dense_keys_equal_global_row_number(spark):
    from scriptorium.operators.keys import dense_keys
    orders = spark.read.parquet(f"{SF_ORACLE}/orders.parquet").select(
        F.col("o_orderpriority").alias("p"), F.to_date("o_orderdate").alias("d"))
    keys = dense_keys(orders, ["p", "d"], "k", start_after=100, num_partitions=7)
    ref = orders.distinct().withColumn(
        "r", F.row_number().over(Window.orderBy("p", "d")) + 100)
    joined = keys.join(ref, ["p", "d"])
    assert joined.count() == ref.count() == keys.count()
    assert joined.filter(F.col("k") != F.col("r")).count() == 0


def test_dense_keys_plan_has_no_single_partition_exchange_on_data(spark):
    from scriptorium.operators.keys import dense_keys
    df = spark.range(1000).select((F.col("id") % 97).alias("x"))
    plan = dense_keys(df, ["x"], "k")._jdf.queryExecution().executedPlan().toString()
    # the only single-partition step is the window over per-partition counts
    assert plan.count("SinglePartition") <= 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_closure_of_one_path(spark):
    from scriptorium.operators.closure import closure
    df = spark.createDataFrame([("a/b/c",)], "p string")
    got = {(r.parent, r.child, r.depth_from_parent, r.highest_parent_flag, r.lowest_child_flag)
           for r in closure(df, "p").collect()}
    assert got == {("a", "a", 0, True, False), ("a", "b", 1, True, False),
                   ("a", "c", 2, True, True), ("b", "b", 0, False, False),
                   ("b", "c", 1, False, True), ("c", "c", 0, False, True)}


def test_closure_size_is_triangular(spark):
    from scriptorium.operators.closure import closure
    for n in (1, 2, 5, 8):
        df = spark.createDataFrame([("/".join(f"n{i}" for i in range(n)),)], "p string")
        assert closure(df, "p").count() == n * (n + 1) // 2


def test_delta_is_null_safe_and_idempotent(spark):
    from scriptorium.operators.delta import full_row_delta, rows_once, symmetric_difference
    src = spark.createDataFrame([("a", None), ("a", None), ("b", 1), ("c", 2)], "x string, y int")
    wh = spark.createDataFrame([("a", None), ("c", 2)], "x string, y int")
    assert {tuple(r) for r in full_row_delta(src, wh, ["x", "y"]).collect()} == {("b", 1)}
    assert full_row_delta(src, src, ["x", "y"]).count() == 0
    assert {tuple(r) for r in rows_once(src).collect()} == {("b", 1), ("c", 2)}
    assert {tuple(r) for r in symmetric_difference(src, wh).collect()} == {("b", 1)}


def test_fact_delta_reports_changed_counts(spark):
    from scriptorium.operators.delta import fact_delta
    src = spark.createDataFrame([(1, 1, 5), (1, 2, 3), (2, 2, 1)], "e long, s long, n long")
    wh = spark.createDataFrame([(1, 1, 5), (1, 2, 2)], "e long, s long, n long")
    new, changed = fact_delta(src, wh, ["e", "s"], "n")
    assert {tuple(r) for r in new.collect()} == {(2, 2, 1)}
    assert {tuple(r) for r in changed.collect()} == {(1, 2, 3, 2)}


def test_integrity_checks(spark):
    from scriptorium.operators.integrity import fk_orphans, null_profile, pk_violations
    child = spark.createDataFrame([(1, 10), (1, 11), (2, None), (3, 99)], "k int, fk int")
    parent = spark.createDataFrame([(10,), (11,)], "pk int")
    assert {tuple(r) for r in pk_violations(child, ["k"]).collect()} == {(1, 2)}
    assert {r.k for r in fk_orphans(child.filter("fk is not null"), ["fk"], parent, ["pk"]).collect()} == {3}
    assert {(r.column_name, r.null_count) for r in null_profile(child).collect()} == {("k", 0), ("fk", 1)}


def test_missing_tokens_through_csv(spark, tmp_path):
    from pyspark.sql import types as T
    from scriptorium.sources.files import read_csv
    p = tmp_path / "x.csv"
    p.write_text('a,b\nNA,"multi\nline"\n n/a ,null\n,value\n')
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    rows = [tuple(r) for r in read_csv(spark, str(p), schema, multiline=True).collect()]
    assert rows == [(None, "multi\nline"), (" n/a ", None), (None, "value")]


def test_lookup_missing_gets_default_and_no_fanout(spark):
    from scriptorium.operators.lookup import lookup_key
    df = spark.createDataFrame([("a",), ("z",), (None,)], "n string")
    dim = spark.createDataFrame([("a", 5), ("a", 3)], "n string, pk long")
    got = sorted((r.n or "", r.pk) for r in lookup_key(df, dim, ["n"], "pk").collect())
    assert got == [("", 0), ("a", 3), ("z", 0)]


def test_full_merge_null_keys_never_match_and_are_kept(spark):
    from scriptorium.operators.lookup import full_merge
    a = spark.createDataFrame([("k1", 1), (None, 2), (None, 3)], "k string, v int")
    b = spark.createDataFrame([("k1", 10), (None, 20), ("k2", 30)], "k string, v int")
    got = sorted((r.k or "", r.v_art or -1, r.v_ref or -1)
                 for r in full_merge(a, b, ["k"], null_safe=False).collect())
    assert got == [("", -1, 20), ("", 2, -1), ("", 3, -1), ("k1", 1, 10), ("k2", -1, 30)]


def test_weighted_mode_with_a_hot_group(spark):
    """One group holds a third of all rows: same answer as a plain count."""
    from scriptorium.operators.mode import weighted_mode
    rows = [(0, f"e{i % 50}", 1) for i in range(3000)] + [(0, "hot", 1)] * 70 + \
           [(g, f"e{(g + i) % 7}", 1) for g in range(1, 200) for i in range(30)]
    df = spark.createDataFrame(rows, "g int, v string, w int")
    got = {r.g: r.v for r in weighted_mode(df, ["g"], "v", "w").collect()}
    assert got[0] == "hot" and len(got) == 200


def test_dense_keys_with_adaptive_partitions(spark):
    """No explicit partition count: AQE may merge ranges; keys stay exact."""
    from scriptorium.operators.keys import dense_keys
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        df = spark.read.parquet(f"{SF_ORACLE}/lineitem.parquet").select(
            (F.col("l_partkey") % 997).alias("x"), F.col("l_returnflag").alias("y"))
        keys = dense_keys(df, ["x", "y"], "k")
        ref = df.distinct().withColumn("r", F.row_number().over(Window.orderBy("x", "y")))
        j = keys.join(ref, ["x", "y"])
        assert j.count() == ref.count() == keys.count()
        assert j.filter(F.col("k") != F.col("r")).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_lookup_with_heavy_hitters_equals_the_plain_one_and_spreads_them(spark):
    from pyspark.sql import functions as F
    from scriptorium.operators.lookup import lookup_key
    from scriptorium.operators.skew import hot_keys
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, F.lit(None)).when(
        F.col("id") % 10 == 2, "unknown").otherwise(F.concat(F.lit("k"), (F.col("id") % 2000).cast("string")))
    df = spark.range(30_000).select("id", key.alias("name"))
    dim = spark.range(2000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("n"), (F.col("id") + 1).alias("pk")) \
        .unionByName(spark.createDataFrame([("hot", 7000), ("hot", 8000)], "n string, pk long"))
    hot = hot_keys(df, ["name"])
    assert 1 <= len(hot) <= 400
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plain = lookup_key(df, dim, {"name": "n"}, "pk")
        spread = lookup_key(df, dim, {"name": "n"}, "pk", hot=hot)
        sizes = [[r["n"] for r in d.groupBy(F.spark_partition_id()).agg(F.count("id").alias("n"), F.sum("pk")).collect()]
                 for d in (plain, spread)]
        assert max(sizes[0]) > 10_000 and max(sizes[1]) < 0.2 * 30_000
        assert spread.exceptAll(plain).isEmpty() and spread.count() == 30_000
        excluded = lookup_key(df, dim, {"name": "n"}, "pk", missing_values=("hot",), hot=hot)
        assert excluded.filter("name = 'hot' AND pk <> 0").isEmpty()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_full_join_with_hot_keys_equals_the_plain_one(spark):
    from pyspark.sql import functions as F
    from scriptorium.operators.lookup import full_merge
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "both").when(F.col("id") % 5 == 1, "left only").when(
        F.col("id") % 50 == 2, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"), "id", (F.col("id") * 2).alias("x"))
    right = spark.range(900).select(F.when(F.col("id") % 50 == 0, "both").when(F.col("id") % 3 == 1, "right only").when(
        F.col("id") % 60 == 2, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"), (F.col("id") * 5).alias("x"), "id")
    plain = full_merge(left, right, ["k"], null_safe=False)
    spread = full_merge(left, right, ["k"], null_safe=False, spread_hot=True)
    assert spread.columns == plain.columns
    assert sorted(map(tuple, spread.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = full_merge(left, right, ["k"], null_safe=False, spread_hot=True)
        sizes = [r["count"] for r in again.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 0.3 * sum(sizes)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
