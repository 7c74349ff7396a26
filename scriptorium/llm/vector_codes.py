"""Vector code compression with LAESA pivots (operator 13).

Vectors become integers, floor(4096 * x), and are cut into PARTS consecutive parts.
Each part position has a codebook of ENTRIES entries, refined in ROUNDS rounds of
assignment to the nearest entry and componentwise floored means; a vector's code is
the list of its parts' entries.

The assignment is exact and done in integers. PIVOTS fixed pivots per part
position (first entries, each the farthest from those before it) stay the same
for the whole run. The distance of every part to them is computed
once and stored with the part. In a round only the entries' distances to the
pivots are new. By the triangle inequality |d(part, pivot) - d(entry, pivot)| is
a lower bound of the distance of part and entry. A part's entries are tried in
the order of their bounds, and the search of a part ends at the first bound that exceeds the best
distance found; only tried entries cost an evaluation. Stored distances are
integer roots rounded down, and the bound is lessened by one, so it holds exactly; an
entry whose bound equals the best distance is still tried, so ties go to the lower index.

Codebooks are all that the driver holds: PARTS * ENTRIES rows, whatever the
number of vectors. A task adds up its parts by entry before anything is shuffled. The
integer vectors and their pivot distances are a table in the shared folder, read once
a round; nothing else is kept, so a lost executor costs its tasks.

Defined cases: a row whose vector is null or holds a null, NaN or infinite component is
dropped; so is one whose length differs from that of the smallest kept vec_id. A
length that PARTS doesn't divide is filled up with zeros. Components beyond 8,192
in magnitude are set to that bound, so that distances of up to 2,048 components fit a long.
Null vec_ids count as the largest; repeated vec_ids are entries and rows of
their own (the smaller vector first). With fewer vectors than ENTRIES the codebooks are
shorter. A label_error beyond a long is null. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import batch
from scriptorium.session import materialize

SCALE, PARTS, ENTRIES, ROUNDS, PIVOTS = 4096, 8, 16, 6, 4
BOUND = 1 << 25
BLOCK = 4096  # vectors that are compared at once


def _matrix(b: pa.RecordBatch, name: str, kind: str) -> np.ndarray:
    """A binary column of equally long values as a matrix."""
    rows = b.column(name).to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label", parts: int = PARTS) -> DataFrame:
    """(vec_id, label, dim, q): valid vectors as packed 32-bit integers, filled up to a multiple of parts."""
    v = F.col(vector_col).cast("array<double>")
    valid = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(valid).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), v.alias("v"))
    label = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q, dims = [], []
            for x in b.column("v").to_pylist():
                with np.errstate(over="ignore"):
                    a = np.clip(np.floor(np.asarray(x, np.float64) * SCALE), -BOUND, BOUND).astype("<i4")
                q.append(np.concatenate([a, np.zeros(-len(a) % parts, "<i4")]).tobytes())
                dims.append(len(a))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(dims, pa.int64()), pa.array(q, pa.binary())],
                names=["vec_id", "label", "dim", "q"])

    return rows.mapInArrow(run, f"vec_id long, label {label}, dim long, q binary")


def floor_root(x: np.ndarray) -> np.ndarray:
    """The integer square root of non-negative 64-bit integers, rounded down."""
    r = np.sqrt(x.astype(np.float64)).astype(np.int64)
    r -= r * r > x
    return r + ((r + 1) * (r + 1) <= x)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of a to all rows of b."""
    return np.stack([((a - e) ** 2).sum(axis=1) for e in b], axis=1)


def choose_pivots(book: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Farthest-first choice among the entries of a first codebook (entries x width)."""
    chosen = [0]
    least = squared(book, book[:1])[:, 0]
    while len(chosen) < min(count, len(book)):
        chosen.append(int(least.argmax()))
        least = np.minimum(least, squared(book, book[chosen[-1:]])[:, 0])
    return book[chosen]


class Search:
    """Nearest entries of the parts at one position, with pruning by pivots."""

    def __init__(self, book: np.ndarray, pivots: np.ndarray) -> None:
        self.book, self.to_pivots = book, floor_root(squared(book, pivots))
        self.tried = self.asked = 0  # evaluations done, and what a plain search would do

    def nearest(self, part: np.ndarray, part_to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each part's nearest entry."""
        n, k = len(part), len(self.book)
        bound = np.zeros((n, k), np.int64)
        for p in range(self.to_pivots.shape[1]):
            np.maximum(bound, np.abs(part_to_pivots[:, p, None] - self.to_pivots[None, :, p]) - 1, out=bound)
        order = np.argsort(bound, axis=1, kind="stable")
        floor = np.take_along_axis(bound, order, axis=1)
        floor *= floor
        index = np.full(n, k, np.int64)
        best = np.full(n, np.iinfo(np.int64).max)
        alive = np.arange(n)
        for turn in range(k):
            alive = alive[floor[alive, turn] <= best[alive]]
            if not len(alive):
                break
            entry = order[alive, turn]
            d = ((part[alive] - self.book[entry]) ** 2).sum(axis=1)
            self.tried += len(alive)
            better = (d < best[alive]) | ((d == best[alive]) & (entry < index[alive]))
            best[alive[better]], index[alive[better]] = d[better], entry[better]
        self.asked += n * k
        return index, best


def _blocks(batches: Iterator[pa.RecordBatch], parts: int, pivots: int):
    """(batch, vectors as n x parts x width, their pivot distances as n x parts x pivots)."""
    for b in batches:
        for at in range(0, b.num_rows, BLOCK):
            piece = b.slice(at, BLOCK)
            n = piece.num_rows
            q = _matrix(piece, "q", "<i4").astype(np.int64).reshape(n, parts, -1)
            yield piece, q, _matrix(piece, "r", "<i4").astype(np.int64).reshape(n, parts, pivots)


def with_pivots(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """rows with r, the packed distances (rounded down) of each part to its pivots (parts x pivots x width)."""
    parts = len(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            q = _matrix(b, "q", "<i4").astype(np.int64).reshape(b.num_rows, parts, -1)
            r = np.stack([floor_root(squared(q[:, p], pivots[p])) for p in range(parts)], axis=1).astype("<i4")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x.tobytes() for x in r], pa.binary())],
                                             names=[*b.schema.names, "r"])

    from pyspark.sql import types as T
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("r", T.BinaryType())]))


def refined(rows: DataFrame, books: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The codebooks (parts x entries x width) after one round."""
    parts, entries, width = books.shape
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()),
                        ("total", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Search(books[p], pivots[p]) for p in range(parts)]
        total, n = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for _, q, r in _blocks(batches, parts, pivots.shape[1]):
            for p in range(parts):
                index, _ = search[p].nearest(q[:, p], r[:, p])
                np.add.at(total[p], index, q[:, p])
                n[p] += np.bincount(index, minlength=entries)
        part, entry = np.nonzero(n)
        yield batch(schema, {"part": np.repeat(part, width), "entry": np.repeat(entry, width),
                             "place": np.tile(np.arange(width), len(part)), "total": total[part, entry].ravel(),
                             "n": np.repeat(n[part, entry], width)})

    sums = rows.select("q", "r").mapInArrow(run, "part int, entry int, place int, total long, n long") \
        .groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    out = books.copy()
    for x in sums.collect():  # parts * entries * width rows at most
        out[x["part"], x["entry"], x["place"]] = x["total"] // x["n"]
    return out


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS) -> DataFrame:
    """vec_id, label, code (array of entry indexes, in part order), error, codebooks_sha256 of every kept vector."""
    rows = materialize(integers(vectors, id_col, vector_col, label_col, parts), "integers")
    smallest = [F.col("vec_id").asc_nulls_last(), F.col("q")]
    first = rows.orderBy(*smallest).first()
    label = rows.schema["label"].dataType.simpleString()
    ddl = f"vec_id long, label {label}, code array<int>, error long"
    if first is None:
        return rows.sparkSession.createDataFrame([], ddl).withColumn("codebooks_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    rows = rows.where(F.col("dim") == first["dim"])
    seeds = [np.frombuffer(x["q"], "<i4").astype(np.int64).reshape(parts, -1)
             for x in rows.orderBy(*smallest).limit(entries).collect()]
    books = np.stack(seeds, axis=1)  # parts x entries x width
    fixed = np.stack([choose_pivots(b, pivots) for b in books])
    rows = materialize(with_pivots(rows, fixed), "pivots")
    for _ in range(rounds):
        books = refined(rows, books, fixed)
    schema = [("code", pa.list_(pa.int32())), ("error", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Search(books[p], fixed[p]) for p in range(parts)]
        for b, q, r in _blocks(batches, parts, fixed.shape[1]):
            found = [search[p].nearest(q[:, p], r[:, p]) for p in range(parts)]
            code = np.stack([f[0] for f in found], axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(code.tolist(), schema[0][1]),
                 pa.array(sum(f[1] for f in found), schema[1][1])], names=["vec_id", "label", "code", "error"])

    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = rows.select("vec_id", "label", "q", "r").mapInArrow(run, ddl)
    return materialize(coded, "codes").withColumn("codebooks_sha256", F.lit(digest))


def op13(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    coded = compress(vectors)
    by_label = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error")) \
        .withColumnRenamed("label", "l")
    code = F.array_join(F.transform("code", lambda x: F.lower(F.lpad(F.hex(x), 2, "0"))), "")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("l")), "left").select(
        "vec_id", code.alias("code"), "error", "label_error", "codebooks_sha256")


def oracle(rounds: int = ROUNDS) -> str:
    """DuckDB SQL of op13: every assignment as a plain search over all entries."""
    def nearest(book: str) -> str:
        return (f"SELECT vec_id, p, arg_min(k, (d, k)) AS k, min(d) AS d FROM (SELECT x.vec_id, x.p, b.k, "
                f"sum((x.v - b.v) * (x.v - b.v)) AS d FROM parts x JOIN {book} b ON b.p = x.p AND b.i = x.i "
                f"GROUP BY ALL) GROUP BY ALL")
    steps = []
    for n in range(rounds):
        steps.append(f"a{n} AS MATERIALIZED ({nearest(f'b{n}')})")
        steps.append(f"""b{n + 1} AS MATERIALIZED (SELECT o.p, o.k, o.i, coalesce(m.v, o.v) AS v FROM b{n} o LEFT JOIN
    (SELECT x.p, a.k, x.i, CAST(((sum(x.v) - ((sum(x.v) % count(*)) + count(*)) % count(*)) // count(*)) AS BIGINT) AS v
     FROM parts x JOIN a{n} a ON a.vec_id = x.vec_id AND a.p = x.p GROUP BY ALL) m ON m.p = o.p AND m.k = o.k AND m.i = o.i)""")
    return f"""
WITH kept AS (SELECT vec_id, label, embedding AS e FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, (j - 1) // (len(e) // 8) AS p, (j - 1) % (len(e) // 8) AS i,
    CAST(floor(4096 * CAST(e[j] AS DOUBLE)) AS BIGINT) AS v
    FROM (SELECT vec_id, e, unnest(generate_series(1, len(e))) AS j FROM kept)),
b0 AS MATERIALIZED (SELECT p, k, i, v FROM parts JOIN
    (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM kept QUALIFY k < 16) USING (vec_id)),
{", ".join(steps)},
last AS MATERIALIZED ({nearest(f'b{rounds}')}),
coded AS (SELECT vec_id, label, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM last JOIN kept USING (vec_id) GROUP BY vec_id, label),
books AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, k, i)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, books
"""


ORACLE = oracle()
