"""Language identification by nearest centroids (operator 6).

A text's vector holds the TF-IDF weights of its hashed byte n-grams (letters
lower-cased, everything else a gap), scaled to length 1. Document frequencies
are counted over all training documents. Each language, however many there are,
gets up to CENTROIDS centroids (fewer when all would be more than MAX_CENTROIDS,
one at least) by spherical k-means in a task of its own, over a bounded sample
(the same number of rows from each language: its part of SAMPLE, LEAST at least;
chosen by a hash of the id). A text takes the language of
the centroid with the highest cosine. It is rejected when that cosine is below
REJECT times the first percentile of the centroid's own training cosines; for a
text of fewer than ENOUGH different grams, which can't come near a centroid, the
bound falls with the square root of their number. Random letters come nearer to a
centroid the same way, the more different grams they have, so the bound stays
above them; REJECT lies between planted foreign texts and held-out ones (README).

Defined cases: a text that is null or has no letter is ``und``, score 0,
rejected; equal cosines go to the language that comes first alphabetically;
with no labelled training row every text is ``und``. Very long texts are read
whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptorium.llm.common import batch, held_out, release, slices

BITS = 12
SAMPLE, LEAST, CENTROIDS, MAX_CENTROIDS, ROUNDS = 2400, 40, 4, 800, 8
REJECT, ENOUGH = 0.5, 1250
UNKNOWN = "und"
_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed 2- and 3-byte grams of the letters of a text."""
    raw = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    two = b[:-1] | b[1:] << np.uint32(8)
    three = two[:-1] | b[2:] << np.uint32(16)
    spread = lambda x: ((x * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)
    return np.bincount(np.concatenate([spread(two + np.uint32(1 << 24)), spread(three)]), minlength=1 << BITS)


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    x = np.empty((len(texts), len(idf)), np.float32)
    for i, t in enumerate(texts):
        x[i] = gram_counts(t or "")
    np.log1p(x, out=x)
    x *= idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    return x


@dataclass
class Model:
    langs: list[str]        # the language of each centroid
    centroids: np.ndarray
    floors: np.ndarray      # first percentile of the cosines of each centroid's members
    idf: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, cosine, rejected) of each text."""
        readable = np.array([has_letter(t) for t in texts], bool)
        lang, score, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        if not self.langs:
            return lang, score, rejected
        for start in range(0, len(texts), 256):
            x = vectors(texts[start:start + 256], self.idf)
            cos = x @ self.centroids.T
            best = cos.argmax(axis=1)
            bound = REJECT * np.sqrt(np.minimum(1, np.count_nonzero(x, axis=1) / ENOUGH))
            for i, k in enumerate(best.tolist()):
                if readable[start + i]:
                    lang[start + i] = self.langs[k]
                    score[start + i] = min(1.0, max(0.0, float(cos[i, k])))
                    rejected[start + i] = cos[i, k] < bound[i] * self.floors[k]
        return lang, score, rejected


def spherical_kmeans(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, label of each row); starts from rows that are far apart, so it is deterministic."""
    start = [0]
    near = x @ x[0]
    while len(start) < min(k, len(x)):
        start.append(int(near.argmin()))
        near = np.maximum(near, x @ x[start[-1]])
    c = x[start]
    for _ in range(ROUNDS):
        label = (x @ c.T).argmax(axis=1)
        c = np.stack([x[label == j].sum(axis=0) if (label == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c, (x @ c.T).argmax(axis=1)


def _document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """Over all training documents: in how many each hashed gram occurs, and their number."""
    schema = pa.schema([("gram", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs = np.zeros(1 << BITS, np.int64), 0
        for b in batches:
            for t in b.column("text").to_pylist():
                df += gram_counts(t or "") > 0
                docs += 1
        yield batch(schema, {"gram": np.arange(-1, len(df), dtype=np.int32), "n": np.concatenate([[docs], df])})

    out, total = np.zeros(1 << BITS, np.int64), 0
    for row in train.select("text").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        if row["gram"] < 0:
            total = row["n"]
        else:
            out[row["gram"]] = row["n"]
    return out, total


def fit(docs: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model:
    """docs has doc_id, text, lang; learns from rows outside the held-out fold with a language."""
    train = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    df, total = _document_frequencies(train)
    idf = np.log((1 + total) / (1 + df)).astype(np.float32) + np.float32(0.1)
    counts = train.groupBy("lang").count().collect()  # one narrow row for each language
    if not counts:
        return Model([], np.empty((0, len(idf)), np.float32), np.empty(0), idf)
    each = max(LEAST, sample // len(counts))
    most = max(1, min(centroids, MAX_CENTROIDS // len(counts)))
    # A share of each language by a hash of the id, about four times what is needed, so that no
    # language's rows meet in one task; then the first ones by another hash.
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, 4.0 * each / r["count"])) for r in counts],
                                               "lang string, share double")
    place = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = train.join(F.broadcast(shares), "lang") \
        .where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) < F.col("share") * (1 << 30)) \
        .select("doc_id", "lang").withColumn("n", F.row_number().over(place)).where(F.col("n") <= each).drop("n")
    # `chosen` has at most `each` narrow rows a language; a repeated doc_id counts once.
    rows = train.join(F.broadcast(chosen.distinct()), ["doc_id", "lang"], "left_semi") \
        .groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("v", pa.binary())])
        for b in batches:
            t = b.column("text").to_pylist()
            for i in range(0, len(t), 256):
                yield batch(schema, {"lang": b.column("lang").slice(i, 256),
                                     "v": [v.tobytes() for v in vectors(t[i:i + 256], idf).astype(np.float16)]})

    def learn(rows: pa.Table) -> pa.Table:
        x = np.stack(sorted((np.frombuffer(v, np.float16) for v in rows.column("v").to_pylist()), key=bytes)).astype(np.float32)
        c, label = spherical_kmeans(x, most)
        cos = (x @ c.T).max(axis=1)
        floors = [float(np.percentile(cos[label == j], 1)) if (label == j).any() else float(cos.min()) for j in range(len(c))]
        return pa.table([rows.column("lang").slice(0, 1).to_pylist() * len(c), list(range(len(c))), [v.tobytes() for v in c], floors],
                        schema=pa.schema([("lang", pa.string()), ("place", pa.int32()), ("centroid", pa.binary()), ("floor", pa.float64())]))

    found = rows.select("text", "lang").mapInArrow(run, "lang string, v binary").groupBy("lang") \
        .applyInArrow(learn, "lang string, place int, centroid binary, floor double").collect()
    found.sort(key=lambda r: (r["lang"], r["place"]))
    return Model([r["lang"] for r in found], np.stack([np.frombuffer(r["centroid"], np.float32) for r in found]),
                 np.array([r["floor"] for r in found]), idf)


def predictions(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of docs, then lang_pred, score, rejected (columns of those names are replaced)."""
    docs = docs.drop("lang_pred", "score", "rejected")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MAX_CENTROIDS vectors, or one a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col, 2 << 20):
            lang, score, rejected = shared.value.predict(b.column(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                names=[*b.schema.names, "lang_pred", "score", "rejected"])

    return docs.mapInArrow(run, T.StructType([
        *docs.schema.fields, T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]))


def training_columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of docs (unchanged) whose language isn't rejected; the model is learned from docs."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(training_columns(docs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in slices(batches, "text", 2 << 20):
            yield b.filter(pa.array(~shared.value.predict(b.column("text").to_pylist())[2]))

    return docs.mapInArrow(run, docs.schema)


def op6(spark: SparkSession, docs: DataFrame) -> DataFrame:
    narrow = training_columns(docs)
    return predictions(narrow.drop("lang"), fit(narrow)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
