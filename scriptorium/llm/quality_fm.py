"""Quality classifier: a factorisation machine (operator 8).

Features of a text: structure statistics, metadata (the length column) and
hashed words, scaled. The machine scores w0 + w.x + sum over pairs of
<v_i, v_j> x_i x_j, where the pairwise sum is taken in linear time as
0.5 * sum_f ((x V_f)^2 - x^2 V_f^2). It is trained with logistic loss on a
bounded sample (SAMPLE labelled rows outside the held-out fold, chosen by a hash
of the id) and every document is scored whole.

Defined cases: null and empty texts have all statistics zero and get a score
like any other; rows without a label don't train; a document with several label
rows takes the largest quality; without labels of both kinds every score is the
share of label 1 (0.5 if there is none). Repeated documents get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import SpanHash, batch, held_out, slices

WORDS, RANK, SAMPLE, EPOCHS = 2048, 8, 6000, 30
THRESHOLD = 0.3
STATS = 22


def _statistics(text: str, raw: bytes, words: list[bytes], hashes: np.ndarray, n_chars: float) -> list[float]:
    n, m = max(1, len(raw)), max(1, len(words))
    c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower, digit = c[65:91].sum(), c[97:123].sum(), c[48:58].sum()
    symbols = c[33:48].sum() + c[58:65].sum() + c[91:97].sum() + c[123:127].sum()
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    same = np.bincount(np.unique(hashes, return_inverse=True)[1]) if len(hashes) else np.ones(1)
    lines = [x for x in text.split("\n") if x.strip()] or [""]
    tails = sum(w[-1] in b"#$%&*!|" for w in words)
    return [
        np.log1p(len(raw)), np.log1p(n_chars), np.log1p(len(words)), np.log1p(len(lines)),
        lengths.mean(), lengths.std(), lengths.max() / n, upper / n, lower / n, digit / n, symbols / n,
        c[128:].sum() / n, c[10] / n, c[124] / n, (c[35] + c[36] + c[37] + c[38] + c[42]) / n, c[33] / n,
        (c[44] + c[46]) / n, upper / max(1, upper + lower), len(same) / m, same.max() / m,
        len(set(lines)) / len(lines), tails / m]


def features(texts: list[str | None], n_chars: list[int | None], hasher: SpanHash) -> tuple[np.ndarray, np.ndarray]:
    """(statistics, hashed word weights of length 1) of each text."""
    split = [(t or "").encode("utf-8", "replace").split() for t in texts]
    buf = b" ".join(b" ".join(w) for w in split if w)
    raw = np.frombuffer(buf, np.uint8)
    h = np.zeros(0, np.uint64)
    if len(raw):
        gaps = np.flatnonzero(raw == 32)
        hasher.load(raw)
        h = hasher.spans(np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(raw)]]))
    ends = np.cumsum([len(w) for w in split])
    stats = np.zeros((len(texts), STATS), np.float32)
    hashed = np.zeros((len(texts), WORDS), np.float32)
    for i, (t, w, end) in enumerate(zip(texts, split, ends.tolist())):
        own = h[end - len(w):end]
        t = t or ""
        stats[i] = _statistics(t, t.encode("utf-8", "replace"), w, own, float(n_chars[i] or 0)) if t else 0.0
        hashed[i] = np.bincount((own % np.uint64(WORDS)).astype(np.int64), minlength=WORDS)
    np.log1p(hashed, out=hashed)
    hashed /= np.maximum(np.linalg.norm(hashed, axis=1, keepdims=True), 1e-9)
    return stats, hashed


@dataclass
class Machine:
    mean: np.ndarray
    scale: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def scaled(self, stats: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        return np.concatenate([np.clip((stats - self.mean) / self.scale, -4, 4), hashed], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        pairs = 0.5 * ((x @ self.factors) ** 2 - (x * x) @ (self.factors ** 2)).sum(axis=1)
        return self.bias + x @ self.linear + pairs

    def score(self, stats: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(self.scaled(stats, hashed)), -30, 30)))


def train(stats: np.ndarray, hashed: np.ndarray, label: np.ndarray, rank: int = RANK, epochs: int = EPOCHS) -> Machine:
    """Adam on the logistic loss, from a fixed seed."""
    share = float(label.mean()) if len(label) else 0.5
    width = STATS + WORDS
    if share in (0.0, 1.0) or not len(label):
        share = min(0.999, max(0.001, share)) if len(label) else 0.5
        return Machine(np.zeros(STATS, np.float32), np.ones(STATS, np.float32), float(np.log(share / (1 - share))),
                       np.zeros(width, np.float32), np.zeros((width, rank), np.float32))
    rng = np.random.default_rng(8)
    m = Machine(stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-6), float(np.log(share / (1 - share))),
                np.zeros(width, np.float32), rng.normal(0, 0.02, (width, rank)).astype(np.float32))
    x = m.scaled(stats, hashed).astype(np.float32)
    state = {k: [0.0, 0.0] for k in ("bias", "linear", "factors")}
    step = 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            step += 1
            xb, sums = x[rows], x[rows] @ m.factors
            g = (1 / (1 + np.exp(-np.clip(m.raw(xb), -30, 30))) - label[rows]).astype(np.float32) / len(rows)
            grads = {"bias": float(g.sum()), "linear": xb.T @ g + 1e-5 * m.linear,
                     "factors": xb.T @ (g[:, None] * sums) - ((xb * xb).T @ g)[:, None] * m.factors
                     + 1e-4 * m.factors}
            for k, grad in grads.items():
                s = state[k]
                s[0] = 0.9 * s[0] + 0.1 * grad
                s[1] = 0.999 * s[1] + 0.001 * grad * grad
                move = 0.01 * (s[0] / (1 - 0.9 ** step)) / (np.sqrt(s[1] / (1 - 0.999 ** step)) + 1e-8)
                setattr(m, k, getattr(m, k) - move)
    return m


def narrow(docs: DataFrame) -> DataFrame:
    size = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.length("text").cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       size.alias("n_chars"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")) \
        .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # `chosen` has at most `sample` narrow rows; a repeated doc_id counts once.
    rows = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality") \
        .agg(F.min(F.struct("text", "n_chars")).alias("d")).select("doc_id", "quality", "d.*")
    schema = pa.schema([("quality", pa.int32()), ("doc_id", pa.int64()), ("s", pa.binary()), ("w", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHash()
        for b in slices(batches, "text", 1 << 20):
            for i in range(0, b.num_rows, 128):
                p = b.slice(i, 128)
                stats, hashed = features(p.column("text").to_pylist(), p.column("n_chars").to_pylist(), hasher)
                yield batch(schema, {"quality": p.column("quality"), "doc_id": p.column("doc_id"),
                                     "s": [v.tobytes() for v in stats],
                                     "w": [v.tobytes() for v in hashed.astype(np.float16)]})

    found = rows.mapInArrow(run, "quality int, doc_id long, s binary, w binary").collect()
    found.sort(key=lambda r: (r["doc_id"], r["s"]))
    stack = lambda k, kind, width: np.stack([np.frombuffer(r[k], kind) for r in found]).astype(np.float32) \
        if found else np.zeros((0, width), np.float32)
    return train(stack("s", np.float32, STATS), stack("w", np.float16, WORDS),
                 np.array([float(r["quality"] == 1) for r in found], np.float32))


def scores(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score of every row of docs (doc_id, text, n_chars)."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHash()
        for b in slices(batches, "text", 1 << 20):
            for i in range(0, b.num_rows, 128):
                p = b.slice(i, 128)
                x = features(p.column("text").to_pylist(), p.column("n_chars").to_pylist(), hasher)
                yield batch(schema, {"doc_id": p.column("doc_id"), "score": shared.value.score(*x).astype(np.float64)})

    return docs.mapInArrow(run, "doc_id long, score double")


def op8(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = narrow(docs)
    return scores(docs, fit(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
