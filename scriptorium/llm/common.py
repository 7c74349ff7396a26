"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.session import ensure_checkpoint_dir

WORD_GAP = b" \t\n\x0b\x0c\r"  # what bytes.split() splits on
NULL_ID = (1 << 63) - 1        # a null id sorts after every other id


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only, so other columns of the input can't clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.col(text_col).cast("string").alias("text"))


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Rows of whole texts go to Python in batches of this many, not 10,000: a batch is held by the
    JVM and by the worker at once. A setting that the session's owner has chosen is left alone."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, "10000") == "10000":
        spark.conf.set(name, str(rows))


_kept: dict[object, object] = {}


def kept(key: object, build: Callable[[], object]) -> object:
    """A worker process keeps one compiled thing from task to task; the next stage's replaces it."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = build()
    return _kept[key]


def release() -> None:
    """Called by stages that compile nothing, so that what an earlier stage compiled goes."""
    _kept.clear()


def unused(df: DataFrame, *names: str) -> list[str]:
    """For each name a column name that df doesn't have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage: a reliable checkpoint in the session's shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def held_out(id_col: Column) -> Column:
    """The fixed fold: crc32 of the id as text, modulo 5, is 0 (null id: as the empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, field.type)
         for field, c in ((f, columns[f.name]) for f in schema)], schema=schema)


def replaced(source: pa.RecordBatch, columns: dict) -> pa.RecordBatch:
    """The batch with some columns' values replaced (same names and types)."""
    out = [pa.array(columns[f.name], f.type) if f.name in columns else source.column(i)
           for i, f in enumerate(source.schema)]
    return pa.RecordBatch.from_arrays(out, schema=source.schema)


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into pieces of about max_bytes of text (one row at least)."""
    for b in batches:
        if b.num_rows == 0:
            continue
        sizes = np.nan_to_num(pc.binary_length(b.column(text)).to_numpy(zero_copy_only=False)
                              .astype("float64"))
        ends = np.flatnonzero(np.diff((np.cumsum(sizes) // max_bytes))) + 1
        at = 0
        for end in [*ends.tolist(), b.num_rows]:
            if end > at:
                yield b.slice(at, end - at)
                at = end


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all its bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SpanHash:
    """Polynomial prefix sums over a byte buffer: the 64-bit hash of any span in O(1)."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self) -> None:
        self._pow = self._inv = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self._pow) <= n:
            size = max(n + 1, 1 << 16)
            for name, base in (("_pow", self.BASE), ("_inv", pow(self.BASE, -1, 1 << 64))):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=np.uint64))

    def load(self, buf: np.ndarray) -> None:
        self._powers(len(buf))
        self._sum = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * self._pow[:len(buf)], out=self._sum[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self._sum[end] - self._sum[start]) * self._inv[start])
