"""CSV records cut in parallel, whatever the splits are."""

import csv
import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("n", T.IntegerType())])


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "1",
             "spark.sql.files.minPartitionNum": "64"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k in names:
        spark.conf.unset(k)


def write(path, rows, **options):
    with open(path, "w", newline="") as f:
        csv.writer(f, **options).writerows([["n", "text", "id"], *rows])


def some_rows(seed, n=80):
    r = random.Random(seed)
    parts = ["a", "b,c", '"q"', "\n", "line two", "\n\n", "é😀", '"', " x "]
    rows = [[k, "t" + "".join(r.choice(parts) for _ in range(r.randrange(9))) + ".", k] for k in range(n)]
    rows[n // 2][1] = "long cell\n" + "over many splits, \"quoted\"\n" * 60 + "end"
    return rows


@pytest.mark.parametrize("terminator", ["\n", "\r\n"])
def test_splits_inside_quotes(spark, tmp_path, small_splits, terminator):
    from scriptorium.sources.files import read_csv
    from scriptorium.sources.records import physical_lines
    for k in range(3):
        write(tmp_path / f"part{k}.csv", some_rows(k), lineterminator=terminator)
    got = read_csv(spark, str(tmp_path), SCHEMA, multiline=True)
    want = sorted((k, text, k) for s in range(3) for k, text, _ in some_rows(s))
    assert sorted(map(tuple, got.collect())) == want
    assert physical_lines(spark, str(tmp_path)).select("block").distinct().count() > 10
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000000")  # now one task a file
    assert sorted(map(tuple, read_csv(spark, str(tmp_path), SCHEMA, multiline=True).collect())) == want


def test_rejected_records_and_cells_have_their_origin(spark, tmp_path, small_splits):
    from scriptorium.sources.files import read_csv, rejected_cells
    (tmp_path / "a.csv").write_text('id,text,n\n1,"x\ny",1\n2,short\n\n3,"z",many\n4,"w",4,extra\nfive,NA,NA\n6,ok,6')
    bad = rejected_cells(spark, str(tmp_path / "a.csv"), SCHEMA)
    assert sorted((r.record_no, r.column_name, r.cell) for r in bad.collect()) == [
        (3, None, "2,short"), (5, "n", "many"), (6, None, '4,"w",4,extra'), (7, "id", "five")]
    assert {(r.column_name, r.cell) for r in bad.collect()} == {
        (None, "2,short"), ("n", "many"), (None, '4,"w",4,extra'), ("id", "five")}
    assert all(r.file.endswith("a.csv") for r in bad.collect())
    assert read_csv(spark, str(tmp_path / "a.csv"), SCHEMA, multiline=True).count() == 6


def test_unpaired_quotes_and_odd_headers_are_refused(spark, tmp_path):
    from scriptorium.sources.files import read_csv
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10")
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text('id,text,n\n1,"open,1\n')
    with pytest.raises(ValueError, match="x.csv"):
        read_csv(spark, str(tmp_path / "a"), SCHEMA, multiline=True)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.csv").write_text('id,text,n\n1,"fine",1\n')
    (tmp_path / "b" / "y.csv").write_text('id,n,text\n1,1,"other order"\n')
    with pytest.raises(ValueError, match="y.csv"):
        read_csv(spark, str(tmp_path / "b"), SCHEMA, multiline=True)
    (tmp_path / "c.csv").write_text("")
    with pytest.raises(ValueError, match="missing columns"):
        read_csv(spark, str(tmp_path / "c.csv"), SCHEMA, multiline=True)
    (tmp_path / "d.csv").write_text("id,text,n\n")
    assert read_csv(spark, str(tmp_path / "d.csv"), SCHEMA, multiline=True).count() == 0
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_query_scan_leaves_a_users_view_alone(spark):
    from scriptorium.sources.files import read_query
    spark.range(3).createOrReplaceTempView("t")
    other = spark.range(10).withColumnRenamed("id", "k")
    got = read_query(spark, "SELECT k FROM {t} WHERE k BETWEEN :low AND :high", {"t": other}, {"low": 4, "high": 6})
    assert sorted(r.k for r in got.collect()) == [4, 5, 6]
    assert spark.table("t").count() == 3
    spark.catalog.dropTempView("t")


def test_records_of_a_folder_are_numbered_on_over_its_files(spark, tmp_path, small_splits):
    from scriptorium.sources.files import rejected_cells
    (tmp_path / "a.csv").write_text('id,text,n\n1,"x\ny",1\n2,short\n')
    (tmp_path / "b.csv").write_text("id,text,n\n")
    (tmp_path / "c.csv").write_text("id,text,n\n3,short\n4,z,many\n")
    bad = rejected_cells(spark, str(tmp_path), SCHEMA, onward=True)
    assert sorted((r.record_no, r.column_name, r.cell) for r in bad.collect()) == [
        (3, None, "2,short"), (4, None, "3,short"), (5, "n", "many")]


def test_csv_rejected_writes_no_input_in_one_task(spark, tmp_path, monkeypatch):
    import os

    import __spark_entry__ as E
    from scriptorium import session
    kept = session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda s, n: str(tmp_path / n) if n == "csv_rejected" else kept(s, n))
    spark.range(1, 2011).selectExpr("IF(id > 2000, NULL, id) AS o_orderkey", "id % 50 AS o_custkey", "'2-HIGH' AS o_orderpriority") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = E.queries()["csv_rejected"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    want = [(k + 1, None, str(k)) if k % 5 == 0 else (k + 1, "year", "2-HIGH") for k in range(1, 2001) if k % 5 == 0 or k % 7 == 0]
    assert sorted(map(tuple, got)) == want
    sizes = [os.path.getsize(tmp_path / "csv_rejected" / f) for f in os.listdir(tmp_path / "csv_rejected") if f.endswith(".txt")]
    assert len(sizes) > 4 and max(sizes) < sum(sizes) / 3


def test_a_split_is_sorted_without_its_path(spark, tmp_path, small_splits, monkeypatch):
    from scriptorium.sources import records
    write(tmp_path / "a.csv", some_rows(1))
    plans, store = [], records.materialize

    def kept(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return store(df, name)
    monkeypatch.setattr(records, "materialize", kept)
    records.records(spark, str(tmp_path / "a.csv"))
    windows = [line for name, p in plans if name == "records" for line in p.splitlines() if "Window [" in line and ", at#" in line]
    assert windows and not any("file#" in line for line in windows)
