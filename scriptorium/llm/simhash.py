"""SimHash near-dedup with bit-sliced comparison (operator 7).

A text's fingerprint has bit k set when more than half of its word-shingle
hashes (XXH64, seed 42) have it set. Equal fingerprints are put together first
(one row for each, whatever the number of copies), so only different ones are
compared.

Candidates: the 64 bits are cut into radius + 3 blocks. Two fingerprints within
the radius agree on at least three whole blocks, so each one is sent, for every
choice of three blocks, to the bucket of those blocks' bits: complete for the
radius, and a bucket's key has at least 36 bits. Inside a task the fingerprints
lie sorted by bucket, and their bits are stored as vertical planes, 64
fingerprints to a machine word. The fingerprints at distance s in that order
are compared all at once: plane by plane the difference is added into carry-save
counters of two bits, and words in which every lane has passed the radius, or
joins two buckets, are abandoned. A bucket larger than DENSE is not compared
pair by pair: there the neighbours of a fingerprint are enumerated over the
bits that the bucket leaves free, and looked up, which is exact and linear.
With radius 2 a bucket has at most 2^26 different fingerprints.

Links go out as (fingerprint, smallest linked fingerprint seen), and components
are found by distributed rounds (components.py).

Defined cases: a null, empty or blank text has fingerprint zero; fewer words
than the shingle make one shingle; a bit set in exactly half of the hashes is 0;
very long texts are read whole, their hashes counted in pieces; a null doc_id is
returned with its fingerprint and a component that it doesn't name (null if it is
alone); repeated rows are returned as often as they come; an empty table gives no
rows; extra columns, whatever their names, aren't read by op7 and pass keep_first
unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.llm.common import batch, release, slices, texts, unused
from scriptorium.llm.components import smallest_reachable
from scriptorium.session import materialize

SHINGLE, RADIUS, SEED = 3, 2, 42
DENSE = 1024
HELD = 1 << 18  # fingerprints that a task gathers before it judges the complete buckets among them
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "replace").translate(_FOLD).split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined, at, starts, ends = b" ".join(words), 0, [], []
        for w in words:
            starts.append(at)
            at += len(w) + 1
            ends.append(at - 1)
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:])]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        h = np.array(hashes[i:i + (1 << 16)], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in slices(batches, "text", 2 << 20):
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64)
            yield batch(schema, {"doc_id": b.column("doc_id"), "fp": fp.view(np.int64)})

    return docs.mapInArrow(run, "doc_id long, fp long")


def block_masks(radius: int) -> list[tuple[int, int]]:
    """(table number, mask of its fixed bits) for every choice of three of radius + 3 blocks."""
    edges = np.linspace(0, 64, radius + 4).astype(int).tolist()  # as even as can be
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [(n, sum(x)) for n, x in enumerate(combinations(blocks, 3))]


def bit_planes(fp: np.ndarray) -> np.ndarray:
    """planes[k] has bit k of every fingerprint, 64 of them to a word (lane 0 lowest)."""
    pad = -len(fp) % 64
    raw = np.concatenate([fp, np.zeros(pad, np.uint64)]).astype("<u8").view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view("<u8")


def _shifted(planes: np.ndarray, words: np.ndarray, by: int) -> np.ndarray:
    """Lanes of `words` as they stand `by` places further on."""
    n = planes.shape[-1]
    skip, rest = divmod(by, 64)
    low = planes[..., np.minimum(words + skip, n - 1)] >> np.uint64(rest)
    if rest:
        low = low | (planes[..., np.minimum(words + skip + 1, n - 1)] << np.uint64(64 - rest))
    return low


def near_pairs(fp: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) index arrays of fingerprints within the radius whose group numbers are equal;
    group ascends. Needs radius <= 3 (two counter bits and an overflow)."""
    n = len(fp)
    if n < 2:
        return
    sizes = np.diff(np.concatenate([np.flatnonzero(np.diff(group, prepend=group[0] - 1)), [n]]))
    left = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # place in the group
    room = np.repeat(sizes, sizes) - left                             # how far the group goes on
    planes = bit_planes(fp)
    lanes = np.arange(planes.shape[1])
    padded = np.concatenate([room, np.zeros(-n % 64, room.dtype)]).reshape(-1, 64)
    reach = padded.max(axis=1)
    for by in range(1, int(sizes.max())):
        words = lanes[reach > by]
        alive = np.packbits(padded[words] > by, axis=1, bitorder="little").view("<u8")[:, 0]
        one = np.zeros(len(words), np.uint64)
        two = np.zeros(len(words), np.uint64)
        over = ~alive
        for k in range(64):
            diff = planes[k][words] ^ _shifted(planes[k], words, by)
            carry = one & diff
            one = one ^ diff
            over = over | (two & carry)
            two = two ^ carry
            if k % 8 == 7:  # abandon the words whose lanes are all beyond the radius
                dead = over | (one & two if radius < 3 else np.uint64(0)) | (two if radius < 2 else np.uint64(0)) \
                    | (one if radius < 1 else np.uint64(0))
                go = dead != ~np.uint64(0)
                if not go.all():
                    words, one, two, over, dead = words[go], one[go], two[go], over[go], dead[go]
                if not len(words):
                    break
                over = dead
        if len(words):
            lanes_ok = np.unpackbits((~over).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            w, lane = np.nonzero(lanes_ok)
            i = words[w] * 64 + lane
            if len(i):
                yield i, i + by


def _dense_pairs(fp: np.ndarray, mask: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Neighbours in one large bucket, by enumeration over the bits that mask leaves free."""
    order = np.argsort(fp, kind="stable")
    ordered = fp[order]
    free = [k for k in range(64) if not mask >> k & 1]
    for r in range(1, radius + 1):
        for bits in combinations(free, r):
            other = fp ^ np.uint64(sum(1 << k for k in bits))
            at = np.minimum(np.searchsorted(ordered, other), len(fp) - 1)
            i = np.flatnonzero(ordered[at] == other)
            if len(i):
                yield i, order[at[i]]


def _lowest(n: int, value: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n, the smallest value of its local component."""
    parent = np.arange(n)

    def root(x: np.ndarray) -> np.ndarray:
        while True:
            up = parent[x]
            if np.array_equal(up, x):
                return x
            x = up

    rank = np.argsort(np.argsort(value, kind="stable"), kind="stable")
    by_rank = np.argsort(rank, kind="stable")
    for i, j in pairs:
        a, b = rank[i], rank[j]
        while len(a):
            ra, rb = root(a), root(b)
            differ = ra != rb
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            if len(a):
                np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
    return value[by_rank[root(rank)]]


def _compare(radius: int, dense: int):
    masks = dict(block_masks(radius))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(table: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        mask = np.array([masks[t] for t in range(len(masks))], np.uint64)[table]
        key = fp & mask
        new = np.ones(len(fp), bool)
        new[1:] = (key[1:] != key[:-1]) | (table[1:] != table[:-1])
        group = np.cumsum(new)
        size = np.bincount(group)[group]
        plain = size <= dense
        for rows, pairs in [(np.flatnonzero(plain & (size > 1)), None)] + \
                [(np.flatnonzero(group == g), masks[int(table[group == g][0])]) for g in np.unique(group[~plain])]:
            f = fp[rows]
            found = near_pairs(f, group[rows], radius) if pairs is None else _dense_pairs(f, pairs, radius)
            low = _lowest(len(f), f, found)
            differ = low != f
            if differ.any():
                yield batch(schema, {"a": f[differ].view(np.int64), "b": low[differ].view(np.int64)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_t, held_f, held, limit = [], [], 0, HELD
        for b in batches:
            t, f = b.column("t").to_numpy(), b.column("fp").to_numpy().view(np.uint64)
            if held and held + len(f) > limit:
                # Judge all complete buckets; the last one may go on in this batch.
                tt, ff = np.concatenate(held_t), np.concatenate(held_f)
                mask = np.array([masks[k] for k in range(len(masks))], np.uint64)[tt]
                same = (tt == tt[-1]) & (ff & mask == ff[-1] & mask[-1])
                cut = int(len(same) - np.argmin(same[::-1])) if not same.all() else 0
                if cut:
                    yield from links(tt[:cut], ff[:cut])
                held_t, held_f = [tt[cut:]], [ff[cut:]]
                held = len(tt) - cut
                limit = max(HELD, 2 * held)  # a bucket that goes on is copied a few times, not for every batch
            held_t.append(t)
            held_f.append(f)
            held += len(f)
        if held:
            yield from links(np.concatenate(held_t), np.concatenate(held_f))

    return run


def link_components(distinct: DataFrame, radius: int = RADIUS, dense: int = DENSE) -> DataFrame:
    """(fp, root fp) of every fingerprint that links to another one; distinct has a column fp."""
    if radius > 3:
        raise ValueError("the carry-save counters have two bits: radius 3 at most")
    tables = F.array(*[F.struct(F.lit(n).alias("t"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m))
                                .alias("key")) for n, m in block_masks(radius)])
    sent = distinct.select("fp", F.inline(tables)).select("t", "key", "fp")
    links = sent.repartition("t", "key").sortWithinPartitions("t", "key", "fp") \
        .mapInArrow(_compare(radius, dense), "a long, b long")
    return smallest_reachable(links)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) for each row of docs; component_id is the smallest doc_id reachable."""
    rows = materialize(fingerprints(docs, shingle), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    root = link_components(classes.select("fp"), radius).withColumnsRenamed({"node": "fp"})
    labelled = classes.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(labelled.join(first, "root").select("fp", "component_id"), "fp") \
        .select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               radius: int = RADIUS) -> DataFrame:
    """The rows of docs that stay when each group keeps its smallest doc_id; of rows that repeat
    that doc_id, the one with the smallest text hash. Rows without a doc_id stay: no id names them."""
    found = near_duplicates(texts(docs, id_col, text_col).where("doc_id IS NOT NULL"), shingle, radius)
    first, n = unused(docs, "first", "n")
    firsts = found.select(F.col("component_id").alias(first)).distinct()
    place = Window.partitionBy(docs[id_col]).orderBy(F.xxhash64(docs[text_col]))
    kept = docs.join(firsts, docs[id_col].cast("long") == firsts[first], "left_semi") \
        .withColumn(n, F.row_number().over(place)).where(F.col(n) == 1).drop(n)
    return kept.unionByName(docs.where(docs[id_col].isNull()))


def op7(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return near_duplicates(texts(docs)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
