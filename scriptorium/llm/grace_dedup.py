"""Exact dedup as a Grace hash deduplication (operator 11).

Texts are equal when they are identical after lower-casing A-Z. Records are
partitioned by a hash of the text into as many buckets as their bytes ask for;
Spark's shuffle files are the spill files. A bucket is read into an
open-addressing table (linear probing) whose entries hold the complete text: a
probe that meets the same hash compares all bytes. A bucket whose different
texts don't fit the table's byte limit is written out again and partitioned by
another hash, until every bucket fits.

Copies never pile up. The same table combines records in every scan task before
anything is shuffled, so a text travels once for each scan window (WINDOW_ROWS
rows or WINDOW_BYTES of different texts), whatever the number of its copies, and
a bucket's table holds it once. What comes back to the rows is keyed by the
window's entry, which has at most WINDOW_ROWS rows: a group of copies with a
third of the table is spread over as many keys as it has windows. Besides the
text, a bucket holds one number for each window that has it.

Lineage is cut with tables in the shared folder: the scan's output and each level
of partitioning. A lost executor costs its tasks.

Defined cases: a null text is the empty text; of rows that share a group's largest
id one stays (the first that was scanned in the entry with the smallest key), so every
group keeps exactly one row; null ids are smaller than any id, and a group that
has only null ids keeps one of its rows and has a null keep_id; a text longer
than the byte limit has a table of its own; empty tables give no rows; other
columns are carried inside one struct, so no name of theirs can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptorium.llm.common import batch, slices
from scriptorium.session import scratch_path

TABLE_BYTES = 48 << 20    # different texts that a bucket's table may hold
BUCKET_BYTES = 24 << 20   # the bytes that a bucket is planned for
WINDOW_BYTES, WINDOW_ROWS = 12 << 20, 1 << 16
ENTRY_BYTES = 200         # what an entry takes besides its text
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_NO_ID = -(1 << 63) - 1


class OpenTable:
    """Texts with their counts, in one array of slots with linear probing."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.slots = np.full(1 << 10, -1, np.int64)
        self.hash: list[int] = []
        self.text: list[bytes] = []
        self.n: list[int] = []
        self.best: list[tuple[int, int, int]] = []  # (id, -entry key, -row number) of the row that stays
        self.keys: list[list[int]] = []
        self.bytes = 0

    def __len__(self) -> int:
        return len(self.text)

    def entry(self, text: bytes) -> int:
        """The number of the text's entry, a new one if there is none."""
        if 2 * len(self.text) >= len(self.slots):
            self._grow()
        h = xxhash.xxh3_64_intdigest(text)
        mask, slots = len(self.slots) - 1, self.slots
        at = h & mask
        while (e := slots[at]) >= 0:
            if self.hash[e] == h and self.text[e] == text:
                return int(e)
            at = (at + 1) & mask
        slots[at] = len(self.text)
        self.hash.append(h)
        self.text.append(text)
        self.n.append(0)
        self.best.append((_NO_ID, -(1 << 63), 0))
        self.keys.append([])
        self.bytes += len(text) + ENTRY_BYTES
        return len(self.text) - 1

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for e, h in enumerate(self.hash):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = e

    def add(self, text: bytes, n: int, best: tuple[int, int, int], keys: list[int]) -> int:
        e = self.entry(text)
        self.n[e] += n
        self.best[e] = max(self.best[e], best)
        self.keys[e].extend(keys)
        self.bytes += 8 * len(keys)
        return e


def folded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)


_RECORD = [("text", pa.binary()), ("n", pa.int64()), ("best_id", pa.int64()), ("best_key", pa.int64()),
           ("best_row", pa.int64()), ("keys", pa.list_(pa.int64()))]
_RECORD_DDL = "text binary, n long, best_id long, best_key long, best_row long, keys array<long>"


def _records(table: OpenTable, which: list[int] | None = None) -> dict:
    best = table.best
    return {"text": table.text, "n": table.n, "best_id": [None if b[0] == _NO_ID else b[0] for b in best],
            "best_key": [-b[1] for b in best], "best_row": [-b[2] for b in best], "keys": table.keys}


def _scan(window_bytes: int, window_rows: int):
    """Rows (k, row, doc_id, payload) as they come, and after each window its table's records."""

    def rows_of(b: pa.RecordBatch, k: list[int], first: int, schema: pa.Schema) -> pa.RecordBatch:
        n = b.num_rows
        have = {"k": pa.array(k, pa.int64()), "row": pa.array(range(first, first + n), pa.int64()),
                "doc_id": b.column("doc_id"), "payload": b.column("payload")}
        return pa.RecordBatch.from_arrays([have.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

    def flush(table: OpenTable, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        have = _records(table)
        n = len(table)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(have[f.name], f.type) if f.name in have else pa.nulls(n, f.type)
                                              for f in schema], schema=schema)
        table.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 32  # entry keys of this task
        table, row, held, opened = OpenTable(), 0, 0, key
        schema = None
        for b in slices(batches, "text", 2 << 20):
            schema = pa.schema([("k", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()),
                                ("payload", b.schema.field("payload").type), *_RECORD])
            k = []
            for text, i in zip(b.column("text").to_pylist(), b.column("doc_id").to_pylist()):
                t = folded(text)
                e = table.entry(t)
                mine = opened + e
                table.n[e] += 1
                table.best[e] = max(table.best[e], (_NO_ID if i is None else i, -mine, -(row + len(k))))
                table.keys[e] = table.keys[e] or [mine]
                k.append(mine)
            yield rows_of(b, k, row, schema)
            row += b.num_rows
            held += b.num_rows
            if table.bytes > window_bytes or held >= window_rows:
                opened += len(table)
                yield from flush(table, schema)
                held = 0
        yield from flush(table, schema)

    return run


def _resolve(limit: int):
    """One bucket a task. Its records, combined: with their digest if the table held them all,
    else as they are, for the next level."""
    schema = pa.schema([("sha256", pa.string()), *_RECORD])

    def out(table: OpenTable, whole: bool) -> Iterator[pa.RecordBatch]:
        if len(table):
            have = _records(table)
            have["sha256"] = [hashlib.sha256(t).hexdigest() if whole else None for t in table.text]
            if whole:
                have["text"] = [None] * len(table)
            yield batch(schema, have)
        table.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, whole = OpenTable(), True
        for b in slices(batches, "text"):
            rows = [b.column(name).to_pylist() for name, _ in _RECORD]
            for text, n, best_id, best_key, best_row, keys in zip(*rows):
                if table.bytes > limit and len(table) > 1:  # the bucket doesn't fit
                    whole = False
                    yield from out(table, False)
                table.add(text, n, (_NO_ID if best_id is None else best_id, -best_key, -best_row), keys)
        yield from out(table, whole)

    return run


def _stored(df: DataFrame, name: str) -> DataFrame:
    """The table in the shared folder; zstd, as it holds texts."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False,
           table_bytes: int = TABLE_BYTES, bucket_bytes: int = BUCKET_BYTES, window_bytes: int = WINDOW_BYTES,
           window_rows: int = WINDOW_ROWS) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id (the id of the group's row that stays),
    group_size, kept, text_sha256 (of the lower-cased text); with carry also ``payload``, a
    struct of all columns of docs."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if carry else F.lit(None).cast("boolean")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         row.alias("payload"))
    ddl = T.StructType([T.StructField("k", T.LongType()), T.StructField("row", T.LongType()),
                        T.StructField("doc_id", T.LongType()), T.StructField("payload", source.schema["payload"].dataType),
                        *T.StructType.fromDDL(_RECORD_DDL).fields])
    scanned = _stored(source.mapInArrow(_scan(window_bytes, window_rows), ddl), "scan")
    todo = scanned.where("n IS NOT NULL").select("text", "n", "best_id", "best_key", "best_row", "keys")
    found, level = None, 0
    while True:
        size = todo.agg(F.sum(F.octet_length("text") + ENTRY_BYTES)).first()[0]
        if size is None:
            break
        # finer from level to level and by another hash, so that texts which met in a bucket part
        buckets = (1 + size // bucket_bytes) << 2 * level
        spilled = todo.withColumn("b", F.pmod(F.xxhash64(F.lit(level), "text"), F.lit(buckets))) \
            .repartition(buckets, "b").drop("b")
        done = _stored(spilled.mapInArrow(_resolve(table_bytes), f"sha256 string, {_RECORD_DDL}"), f"level{level}")
        part = done.where("sha256 IS NOT NULL").drop("text")
        found = part if found is None else found.unionByName(part)
        todo = done.where("sha256 IS NULL").drop("sha256")
        level += 1
    members = scanned.where("k IS NOT NULL").select("k", "row", "doc_id", *(["payload"] if carry else []))
    if found is None:
        return members.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                              F.lit(True).alias("kept"), F.lit("").alias("text_sha256"), *(["payload"] if carry else []))
    answers = found.select(F.explode("keys").alias("k"), "best_id", "best_key", "best_row", "n", "sha256")
    kept = (F.col("k") == F.col("best_key")) & (F.col("row") == F.col("best_row"))
    return members.join(answers, "k").select(
        "doc_id", F.col("best_id").alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"),
        F.col("sha256").alias("text_sha256"), *(["payload"] if carry else []))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, unchanged, with all their columns."""
    return groups(docs, id_col, text_col, carry=True).where("kept").select("payload.*")


def op11(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return groups(docs)


ORACLE = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size, sha256(t) AS text_sha256 FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (t)
"""
