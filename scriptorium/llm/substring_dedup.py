"""Substring dedup by super-k-mer partitioning (operator 2).

A window is ``window`` consecutive words. The minimiser of a window is the
smallest hash among its ``gram``-word phrases; equal windows have equal
minimisers. Consecutive windows that share one travel together, as one packed
string of words (a super-k-mer), to the bucket of that minimiser (a bucket is cut into parts by the minimiser again). There the
windows of all super-k-mers are sorted by hash, equal hashes are compared as
bytes, and the smallest doc_id of each window is read off exactly.

Scale. A map task groups its super-k-mers by bucket and by text before the
shuffle: equal super-k-mers of one task become one entry with a list of the
places it came from, so a group of copies holding a third of the rows shrinks
to 16 bytes a place. Entries for one bucket are packed and compressed into one
row. The number of buckets grows with the corpus (BUCKET_BYTES each). A bucket
that still exceeds ``bucket_limit`` (a very frequent phrase) is not held:
its windows go one by one to a second exchange by the window's own hash, where
they are read as a sorted stream. All places of a hot window pass through one
task there, but never through memory at once.

Only the words that go are sent back (ranges of word offsets for each
document), and the text is shuffled once to meet them.

Defined cases: null and empty texts have no words; a text shorter than the
window has no windows and is kept whole; a null doc_id sorts after all others.
Rows that repeat a doc_id are one document and so no earlier than each other:
each is judged by its own text. Words keep their bytes; separators are dropped.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import NULL_ID, SpanHash, batch, mix64, slices, texts

WINDOW, GRAM = 13, 3
BUCKET_BYTES = 4 << 20     # text for each bucket, about
PARTS = 4                  # parts of a bucket that are sorted one after the other
BUCKET_LIMIT = 32 << 20    # packed bytes of a bucket that are held at once
RUN = 64                   # windows in one super-k-mer at most
SEGMENT = 1 << 18          # packed bytes that are hashed at once
PLACES = 4096              # bytes of places in one entry
FLUSH_BYTES = 5 << 20      # text that a map task gathers before it sends rows
_PLACE = np.dtype([("doc", "<i8"), ("crc", "<u4"), ("at", "<u4")])


def split_words(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ as UTF-8."""
    return (text or "").encode("utf-8", "replace").split()


def _word_edges(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a buffer in which single spaces part them."""
    gaps = np.flatnonzero(buf == 32)
    return np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(buf)]])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:len(x) - size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


def super_kmers(docs: list[list[bytes]], window: int, gram: int, hasher: SpanHash
                ) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, doc number, first word, first byte, last byte, minimiser) of each super-k-mer."""
    buf = b" ".join(b" ".join(w) for w in docs)
    raw = np.frombuffer(buf, np.uint8)
    start, end = _word_edges(raw)
    hasher.load(raw)
    h = hasher.spans(start, end)
    n = len(h)
    phrase = h[:n - gram + 1].copy()
    for k in range(1, gram):
        phrase = mix64(phrase + h[k:n - gram + 1 + k] * np.uint64(2 * k + 1))
    low = _sliding_min(phrase, window - gram + 1)  # the minimiser of the window at each word
    sizes = np.array([len(w) for w in docs], np.int64)
    first = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(docs)), sizes)[:len(low)]
    at = np.arange(len(low))
    valid = at + window <= (first + sizes)[doc]
    opens = np.empty(len(low), bool)
    opens[0] = True
    opens[1:] = (low[1:] != low[:-1]) | ~valid[:-1]
    opens &= valid
    run = np.flatnonzero(opens)
    valid_before = np.concatenate([[0], np.cumsum(valid)])
    count = np.diff(np.concatenate([valid_before[run], [valid_before[-1]]]))
    if len(count) and count.max() > RUN:  # cut long runs; each piece keeps the minimiser
        parts = -(-count // RUN)
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        run, count = np.repeat(run, parts) + step * RUN, np.minimum(np.repeat(count, parts) - step * RUN, RUN)
    return buf, doc[run], run - first[doc[run]], start[run], end[run + count + window - 2], low[run]


def _cut(window: int, gram: int, buckets: int):
    schema = pa.schema([("key", pa.int64()), ("body", pa.binary())])

    def flush(held: dict[int, dict[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        while held:
            part = [held.popitem() for _ in range(min(64, len(held)))]
            yield batch(schema, {"key": [k // PARTS for k, _ in part], "body": [pack(k % PARTS, x) for k, x in part]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, size = SpanHash(), 0
        held: dict[int, dict[bytes, bytes]] = {}  # bucket and part -> packed words -> places
        for b in slices(batches, "text", 1 << 19):
            rows = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                w = split_words(text)
                if len(w) >= window:
                    rows.append((NULL_ID if doc is None else doc, zlib.crc32(text.encode("utf-8", "replace")), w))
            if not rows:
                continue
            buf, number, at, s, e, low = super_kmers([w for _, _, w in rows], window, gram, hasher)
            place = np.empty(len(at), _PLACE)
            place["doc"] = np.array([r[0] for r in rows], np.int64)[number]
            place["crc"] = np.array([r[1] for r in rows], np.uint32)[number]
            place["at"] = at
            raw, key = place.tobytes(), (low % np.uint64(buckets * PARTS)).tolist()
            for i, (x, y, k) in enumerate(zip(s.tolist(), e.tolist(), key)):
                entries, words, one = held.setdefault(k, {}), buf[x:y], raw[16 * i:16 * i + 16]
                known = entries.get(words, b"")
                if len(known) >= PLACES:  # a long list goes out, and a new one starts
                    yield batch(schema, {"key": [k // PARTS], "body": [pack(k % PARTS, {words: known})]})
                    known = b""
                entries[words] = known + one
            size += len(buf)
            if size >= FLUSH_BYTES:
                yield from flush(held)
                size = 0
        yield from flush(held)

    return run


def pack(part: int, entries: dict[bytes, bytes]) -> bytes:
    """Entries (packed words -> places) of one part of a bucket as one compressed body."""
    words = sorted(entries)
    places = np.frombuffer(b"".join(map(entries.__getitem__, words)), _PLACE)
    counts = np.fromiter((len(entries[w]) // 16 for w in words), "<u4", len(words))
    text = b"\n".join(words)
    raw = text + b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes()  # byte planes
                          for c in (counts, places["doc"], places["crc"], places["at"]))
    return struct.pack("<BIII", part, len(words), len(text), len(places)) + pa.Codec("zstd", 9).compress(raw, asbytes=True)


def raw_size(body: bytes) -> int:
    _, n, text, places = struct.unpack_from("<BIII", body)
    return text + 4 * n + 16 * places


def unpack(body: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(packed words, number of places, places) of a body."""
    _, n, text, n_places = struct.unpack_from("<BIII", body)
    raw = pa.Codec("zstd").decompress(memoryview(body)[13:], raw_size(body), asbytes=True)
    at, out = text, []
    for size, kind in ((n, "<u4"), (n_places, "<i8"), (n_places, "<u4"), (n_places, "<u4")):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, size * width, at).reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(size))
        at += size * width
    places = np.empty(n_places, _PLACE)
    places["doc"], places["crc"], places["at"] = out[1:]
    return raw[:text].split(b"\n"), out[0].astype(np.int64), places


def first_docs(packed: list[bytes], first: np.ndarray, window: int, hasher: SpanHash
               ) -> tuple[np.ndarray, np.ndarray]:
    """For distinct packed strings with their smallest doc each: the number of windows of each,
    and for each window, in order, the smallest doc that holds it."""
    buf, lengths = b" ".join(packed), np.fromiter(map(len, packed), np.int64, len(packed))
    begins = np.cumsum(lengths + 1) - lengths - 1
    counts, starts, ends, hashes = [], [], [], []
    for some in np.split(np.arange(len(packed)), np.flatnonzero(np.diff(begins // SEGMENT)) + 1):
        base = int(begins[some[0]])
        raw = np.frombuffer(buf, np.uint8, int(begins[some[-1]] + lengths[some[-1]]) - base, base)
        start, end = _word_edges(raw)
        word_of = np.searchsorted(start, begins[some] - base)
        n = np.diff(np.concatenate([word_of, [len(start)]])) - window + 1
        at = np.repeat(word_of, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        hasher.load(raw)
        s, e = start[at], end[at + window - 1]
        for held, x in ((counts, n), (starts, s + base), (ends, e + base), (hashes, hasher.spans(s, e))):
            held.append(x)
    count, s, e, h = map(np.concatenate, (counts, starts, ends, hashes))
    doc = np.repeat(first, count)
    order = np.lexsort((doc, h))
    sorted_h = h[order]
    head = np.empty(len(order), bool)
    head[0] = True
    head[1:] = sorted_h[1:] != sorted_h[:-1]
    lead = order[np.flatnonzero(head)[np.cumsum(head) - 1]]  # the first member of each hash class
    out = np.empty(len(order), np.int64)
    out[order] = doc[lead]
    again = np.flatnonzero(~head)
    odd: set[int] = set()
    for i, j in zip(order[again].tolist(), lead[again].tolist()):
        if buf[s[i]:e[i]] != buf[s[j]:e[j]]:
            odd.add(int(h[i]))
    if odd:  # different windows with one hash: tell them apart by their bytes
        exact: dict[bytes, int] = {}
        same = np.flatnonzero(np.isin(h, np.array(list(odd), np.uint64)))
        for i in same.tolist():
            w = buf[s[i]:e[i]]
            exact[w] = min(exact.get(w, NULL_ID), int(doc[i]))
        for i in same.tolist():
            out[i] = exact[buf[s[i]:e[i]]]
    return count, out


_RANGE = pa.schema([("key", pa.int64()), ("kind", pa.int32()), ("doc", pa.int64()), ("crc", pa.int64()),
                    ("s", pa.int32()), ("e", pa.int32()), ("body", pa.binary())])
_RANGE_SQL = "key long, kind int, doc long, crc long, s int, e int, body binary"


def _ranges(doc, crc, s, e) -> pa.RecordBatch:
    doc = np.asarray(doc, np.int64)
    n = len(doc)
    return batch(_RANGE, {"key": doc, "kind": np.zeros(n, np.int32), "doc": doc,
                          "crc": np.asarray(crc, np.int64), "s": np.asarray(s, np.int32),
                          "e": np.asarray(e, np.int32), "body": pa.nulls(n, pa.binary())})


def _judge(window: int, limit: int):
    def windows_alone(bodies: list[bytes]) -> Iterator[pa.RecordBatch]:
        """The windows of an oversized bucket, each as a row of its own."""
        for body in bodies:
            words, n, places = unpack(body)
            ends, rows = np.cumsum(n), ([], [], [], [], [])
            for packed, a, b in zip(words, (ends - n).tolist(), ends.tolist()):
                w = packed.split(b" ")
                for k in range(len(w) - window + 1):
                    one = b" ".join(w[k:k + window])
                    key = int.from_bytes(hashlib.blake2b(one, digest_size=8).digest(), "little", signed=True)
                    for p in places[a:b]:
                        for col, v in zip(rows, (key, int(p["doc"]), int(p["crc"]), int(p["at"]) + k, one)):
                            col.append(v)
                if len(rows[0]) >= 10_000 or b == ends[-1]:
                    key, doc, crc, s, one = rows
                    yield batch(_RANGE, {"key": key, "kind": [1] * len(key), "doc": doc, "crc": crc, "s": s,
                                         "e": [x + window for x in s], "body": one})
                    rows = ([], [], [], [], [])

    def parts(bodies: list[bytes], hasher: SpanHash) -> Iterator[pa.RecordBatch]:
        for part in range(PARTS):
            if own := [b for b in bodies if b[0] == part]:
                yield from judge(own, hasher)

    def judge(bodies: list[bytes], hasher: SpanHash) -> Iterator[pa.RecordBatch]:
        opened = [unpack(b) for b in bodies]
        number: dict[bytes, int] = {}
        of = np.array([number.setdefault(w, len(number)) for ws, _, _ in opened for w in ws], np.int64)
        place = np.concatenate([p for _, _, p in opened])
        of = np.repeat(of, np.concatenate([n for _, n, _ in opened]))
        first = np.full(len(number), NULL_ID, np.int64)
        np.minimum.at(first, of, place["doc"])
        count, earliest = first_docs(list(number), first, window, hasher)
        ends = np.cumsum(count)
        begins = ends - count
        low = np.minimum.reduceat(earliest, begins)
        high = np.maximum.reduceat(earliest, begins)
        doc = place["doc"]
        whole = np.flatnonzero(high[of] < doc)  # all windows are in an earlier document
        if len(whole):
            p = place[whole]
            at = p["at"].astype(np.int64)
            yield _ranges(p["doc"], p["crc"], at, at + count[of[whole]] + window - 1)
        some = np.flatnonzero((low[of] < doc) & (high[of] >= doc))
        out: tuple[list, list, list, list] = ([], [], [], [])
        for i in some.tolist():
            k = of[i]
            gone = earliest[begins[k]:ends[k]] < doc[i]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
            for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist()):
                for col, v in zip(out, (doc[i], place["crc"][i], int(place["at"][i]) + a,
                                        int(place["at"][i]) + b + window - 1)):
                    col.append(v)
        if out[0]:
            yield _ranges(*out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, bucket, bodies, held, over = SpanHash(), None, [], 0, False
        for b in batches:
            for key, body in zip(b.column("key").to_pylist(), b.column("body").to_pylist()):
                if key != bucket:
                    yield from parts(bodies, hasher)
                    bucket, bodies, held, over = key, [], 0, False
                bodies.append(body)
                held += raw_size(body)
                if over or held > limit:
                    yield from windows_alone(bodies)
                    bodies, over = [], True
        yield from parts(bodies, hasher)

    return run


def _judge_alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges pass; single windows come sorted by (key, body, doc), so the first row of a
    window names its smallest doc."""
    window, first = None, 0
    for b in batches:
        kind = b.column("kind").to_numpy()
        if not kind.any():
            yield b
            continue
        keep = kind == 0
        bodies, docs = b.column("body").to_pylist(), b.column("doc").to_numpy()
        for i in np.flatnonzero(kind).tolist():
            if bodies[i] != window:
                window, first = bodies[i], docs[i]
            keep[i] = docs[i] > first
        yield b.filter(pa.array(keep))


def removed_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, buckets: int | None = None,
                   bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """(doc, crc, s, e): word ranges of each document that go. docs has doc_id, text."""
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(64, size // BUCKET_BYTES)
    cut = docs.mapInArrow(_cut(window, gram, int(buckets)), "key long, body binary")
    judged = cut.repartition("key").sortWithinPartitions("key").mapInArrow(_judge(window, bucket_limit), _RANGE_SQL)
    return judged.repartition("key").sortWithinPartitions("key", "kind", "body", "doc") \
        .mapInArrow(_judge_alone, _RANGE_SQL).select("doc", "crc", "s", "e")


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts are compressed for their one shuffle; words and separators stay as they are."""
    schema = pa.schema([("doc_id", pa.int64()), ("doc", pa.int64()), ("crc", pa.int64()), ("size", pa.int64()),
                        ("text", pa.binary())])
    codec = pa.Codec("zstd", 3)
    for b in slices(batches, "text", 4 << 20):
        raw = [(t or "").encode("utf-8", "replace") for t in b.column("text").to_pylist()]
        yield batch(schema, {"doc_id": b.column("doc_id"), "doc": b.column("doc_id").fill_null(NULL_ID),
                             "crc": [zlib.crc32(r) for r in raw], "size": [len(r) for r in raw],
                             "text": [codec.compress(r, asbytes=True) if r else b"" for r in raw]})


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, buckets: int | None = None,
          bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept words for each row of docs."""
    docs = texts(docs)
    ranges = removed_ranges(docs, window, gram, buckets, bucket_limit).groupBy("doc", "crc").agg(
        F.collect_set(F.struct("s", "e")).alias("gone"))
    packed = docs.mapInArrow(_packed_texts, "doc_id long, doc long, crc long, size long, text binary")
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("kept_sha256", pa.string()), ("kept", pa.string())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for b in slices(batches, "text", 1 << 20):
            total, removed, digest, kept = [], [], [], []
            gone = b.column("gone")
            for i, (text, size) in enumerate(zip(b.column("text").to_pylist(), b.column("size").to_pylist())):
                w = codec.decompress(text, size, asbytes=True).split() if size else []
                total.append(len(w))
                if gone[i].is_valid:
                    cover = np.zeros(len(w) + 1, np.int32)
                    pairs = gone[i].values.flatten()
                    np.add.at(cover, pairs[0].to_numpy(), 1)
                    np.add.at(cover, pairs[1].to_numpy(), -1)
                    w = [x for x, c in zip(w, np.cumsum(cover).tolist()) if not c]
                removed.append(total[-1] - len(w))
                out = b" ".join(w)
                digest.append(hashlib.sha256(out).hexdigest())
                kept.append(out.decode("utf-8", "replace"))
            yield batch(schema, {"doc_id": b.column("doc_id"), "n_words": total, "n_removed": removed,
                                 "kept_sha256": digest, "kept": kept})

    return packed.join(ranges, ["doc", "crc"], "left").select("doc_id", "size", "text", "gone") \
        .mapInArrow(apply, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def op2(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return dedup(docs).drop("kept")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
firsts AS (SELECT s, min(doc_id) AS first_doc FROM win GROUP BY s HAVING count(DISTINCT doc_id) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS p
    FROM win JOIN firsts USING (s) WHERE first_doc < doc_id),
lists AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
    sha256(coalesce(array_to_string([w[k] FOR k IN generate_series(1, len(w))
        IF ps IS NULL OR NOT list_contains(ps, k)], ' '), '')) AS kept_sha256
FROM d LEFT JOIN lists USING (doc_id)
"""
