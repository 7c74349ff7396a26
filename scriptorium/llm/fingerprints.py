"""Document fingerprints by content-defined chunking (operator 4).

A gear hash rolls over the UTF-8 bytes; its value depends on the last 32 bytes
only, so it is computed for all positions at once by doubling. A chunk ends
where the hash has certain bits zero: a strict mask before the normal length
and a loose one after it (normalised chunking), between a minimum and a
maximum length. An edit moves the boundaries next to it, and those further on
fall at the same content again. A fingerprint is the set of chunk digests
(XXH64), each with its chunk's length; the likeness of A to B is the length of
the chunks of A that B has too over the length of A's chunks (containment).

The next document by ascending doc_id is found without a global sort in one
task: quantiles of the ids (a bounded list) cut them into ranges, each range is
sorted in its own task, and the first row of each range is sent a second time
to the range before it. So the text is shuffled once.

Defined cases: a null text is the empty text; an empty text has the empty
fingerprint, is fully contained in another empty one (1.0) and has nothing in
common with a text that isn't empty (0.0); rows are ordered by doc_id (null
first) and then by text, so repeated ids have a fixed next row; the only row
is its own next one. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import batch, mix64, texts

MIN_SIZE, NORMAL_SIZE, MAX_SIZE = 32, 64, 256
REACH = 32               # bytes that the gear hash depends on
SEED = 4
MAX_RANGES = 4096
GEAR = (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def gear_hash(raw: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[raw[i - k]] << k for k below 32, modulo 2^32."""
    h = GEAR[raw]
    by = 1
    while by < REACH and by < len(h):
        shifted = h[:-by] << np.uint32(by)
        h = h.copy()
        h[by:] += shifted
        by *= 2
    return h


def masks(normal: int = NORMAL_SIZE) -> tuple[int, int]:
    """High bits, which depend on all 32 bytes: two more and two fewer than the normal length asks for."""
    bits = max(3, normal.bit_length() - 1)
    top = lambda n: ((1 << n) - 1) << (32 - n)
    return top(bits + 2), top(bits - 2)


def boundaries(raw: np.ndarray, minimum: int = MIN_SIZE, normal: int = NORMAL_SIZE, maximum: int = MAX_SIZE
               ) -> list[int]:
    """Chunk ends (exclusive), the last one the length of raw."""
    n = len(raw)
    if not n:
        return []
    strict, loose = masks(normal)
    h = gear_hash(raw)
    loose_at = np.flatnonzero((h & np.uint32(loose)) == 0)
    strict_at = loose_at[(h[loose_at] & np.uint32(strict)) == 0].tolist()
    loose_at = loose_at.tolist()
    out, at, i, j, ni, nj = [], 0, 0, 0, len(strict_at), len(loose_at)
    while at < n:
        low, mid, high = at + minimum - 1, at + normal, min(at + maximum, n)
        while i < ni and strict_at[i] < low:
            i += 1
        if i < ni and strict_at[i] < min(mid, high):
            at = strict_at[i] + 1
        else:
            while j < nj and loose_at[j] < mid:
                j += 1
            at = loose_at[j] + 1 if j < nj and loose_at[j] < high else high
        out.append(at)
    return out


def chunks(data: bytes, minimum: int = MIN_SIZE, normal: int = NORMAL_SIZE, maximum: int = MAX_SIZE) -> dict[int, int]:
    """Digest -> length of the different chunks."""
    out, at, digest = {}, 0, xxhash.xxh64_intdigest
    for end in boundaries(np.frombuffer(data, np.uint8), minimum, normal, maximum):
        out[digest(data[at:end], SEED)] = end - at
        at = end
    return out


def fingerprint(print_: dict[int, int]) -> str:
    """Digests in ascending order, each with its chunk's length: ``digest:length`` in hex, comma-joined."""
    return ",".join(f"{d:016x}:{print_[d]:x}" for d in sorted(print_))


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    if not a:
        return 0.0 if b else 1.0
    return sum(size for d, size in a.items() if d in b) / sum(a.values())


def edited(text: str, following: str) -> str:
    """The last quarter (floor) of text replaced by the start of following."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def with_next(docs: DataFrame, ranges: int) -> DataFrame:
    """(part, ahead, doc_id, text): rows in ranges of doc_id; ahead rows belong to the next range
    and are only there to be looked at."""
    ids = docs.where("doc_id IS NOT NULL").select("doc_id")
    cuts = np.unique(ids.agg(F.percentile_approx("doc_id", [k / ranges for k in range(1, ranges)], 10 * ranges))
                     .first()[0] or []).astype(np.int64) if ranges > 1 else np.zeros(0, np.int64)

    def lowest_of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low: dict[int, int] = {}
        for b in batches:
            x = np.sort(b.column("doc_id").to_numpy())
            part, at = np.unique(np.searchsorted(cuts, x, side="right"), return_index=True)
            for p, v in zip(part.tolist(), x[at].tolist()):
                low[p] = min(low.get(p, v), v)
        yield pa.RecordBatch.from_pydict({"part": pa.array(low.keys(), pa.int32()), "low": pa.array(low.values(), pa.int64())})

    # Quantiles are rounded; the ranges start at the lowest id that each really has.
    starts = sorted(r["low"] for r in ids.mapInArrow(lowest_of_range, "part int, low long")
                    .groupBy("part").agg(F.min("low").alias("low")).collect())
    nameless = not docs.where("doc_id IS NULL").isEmpty()
    lowest = None if nameless or not starts else starts[0]
    starts = starts if nameless else starts[1:]
    schema = pa.schema([("part", pa.int32()), ("ahead", pa.int32()), ("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array(starts, np.int64)
        for b in batches:
            known = b.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            ids = b.column("doc_id").fill_null(0).to_numpy()
            part = np.where(known, np.searchsorted(edges, ids, side="right"), 0).astype(np.int32)
            yield batch(schema, {"part": part, "ahead": np.zeros(len(ids), np.int32), "doc_id": b.column("doc_id"),
                                 "text": b.column("text")})
            opens = np.isin(ids, edges) & known
            is_first = ~known if lowest is None else known & (ids == lowest)
            for rows, to in ((np.flatnonzero(opens), part[opens] - 1),
                             (np.flatnonzero(is_first), np.full(int(is_first.sum()), len(edges)))):
                if len(rows):
                    take = pa.array(rows)
                    yield batch(schema, {"part": to.astype(np.int32), "ahead": np.ones(len(rows), np.int32),
                                         "doc_id": b.column("doc_id").take(take), "text": b.column("text").take(take)})

    return docs.mapInArrow(run, "part int, ahead int, doc_id long, text string")


def _compare(minimum: int, normal: int, maximum: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                        ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def judge(doc_id, text: str, own: dict, after: str, after_print: dict) -> tuple:
        change = edited(text, after)
        data = change.encode("utf-8", "replace")
        if change == text:
            new = own
        else:
            new = chunks(data, minimum, normal, maximum)
        return (doc_id, len(text), hashlib.sha256(data).hexdigest(), fingerprint(own), fingerprint(new),
                containment(own, new), containment(own, after_print))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held, part, done = None, None, False
        for b in batches:
            for p, ahead, doc_id, text in zip(*(b.column(c).to_pylist() for c in schema_in)):
                if p != part:
                    part, held, done = p, None, False
                if done:
                    continue
                text = text or ""
                own = chunks(text.encode("utf-8", "replace"), minimum, normal, maximum)
                if held is not None:
                    out.append(judge(*held, text, own))
                held = (doc_id, text, own)
                done = bool(ahead)
                if len(out) >= 500:
                    yield batch(schema, dict(zip(schema.names, zip(*out))))
                    out = []
        if out:
            yield batch(schema, dict(zip(schema.names, zip(*out))))

    schema_in = ("part", "ahead", "doc_id", "text")
    return run


def compare_with_next(docs: DataFrame, ranges: int | None = None, minimum: int = MIN_SIZE,
                      normal: int = NORMAL_SIZE, maximum: int = MAX_SIZE) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    docs = texts(docs)
    spark = docs.sparkSession
    if ranges is None:
        ranges = min(MAX_RANGES, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = with_next(docs, ranges)
    return rows.repartition("part").sortWithinPartitions("part", "ahead", "doc_id", "text") \
        .mapInArrow(_compare(minimum, normal, maximum),
                    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                    "edited_fingerprint string, near_edited double, near_next double")


def op4(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return compare_with_next(docs)
