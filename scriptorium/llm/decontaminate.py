"""Benchmark decontamination with a generalised suffix automaton (operator 3).

The normalised words of the test items are compiled into one suffix automaton
(states are classes of word sequences with the same ends in the items). Each
training text is streamed through it once: the automaton's state and matched
length after a word give the longest item passage that ends there. Where the
length reaches the window, the last ``window`` words are hit; the state's
ancestor on the suffix-link path that holds the window itself names the items.
Items of fewer words than the window count as one window of their own length.

Items are cut into pieces of at most PIECE_WORDS words that overlap by a window, and
a running sum over the pieces deals them into blocks of at most BLOCK_WORDS +
PIECE_WORDS words, on Spark. The words of one block are all that the driver or a broadcast ever holds;
the automaton is built in the workers, once for each block. A benchmark of one block takes one pass over
the documents and no shuffle. With more blocks, the documents are stored once under a row key, each block is a pass of its own that
stores what it hit (row key, spans, items), and the findings are put together by row key at the end.

Spans and texts are judged in the pass that finds them, so a task runs one Python worker.

Defined cases: a null or empty text has no words and is clean; very long texts are read whole, a
slice of rows at a time; null or empty items are ignored; a repeated item_id names one
item; repeated documents, and documents with equal or null ids, are judged each on their own;
an item that is found twice counts once; an empty benchmark leaves all documents clean, empty documents give no
rows; other columns, whatever their names, are returned as they came.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptorium.llm.common import batch, kept, replaced, slices, texts, unused
from scriptorium.session import materialize

WINDOW = 10
BLOCK_WORDS, PIECE_WORDS = 200_000, 4096
MAX_COVERAGE = 0.5

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32
              for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) maximal runs of ASCII letters, digits and all other code points."""
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


class SuffixAutomaton:
    """Generalised suffix automaton over word ids, with the items of every window."""

    def __init__(self, items: dict[str, list[list[bytes]]], window: int) -> None:
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        ends: list[tuple[int, int, int]] = []  # (state, window length, item)
        self.items = sorted(items)
        for number, item in enumerate(self.items):
            for seq in items[item]:
                coded = [self.vocab.setdefault(w, len(self.vocab)) for w in seq]
                short = min(window, len(coded))
                last = 0
                for i, c in enumerate(coded):
                    last = self._extend(last, c)
                    if i + 1 >= short:
                        ends.append((last, short, number))
        # A state that holds a window: the shallowest one on the suffix path that is long enough.
        self.found: dict[int, dict[int, set[int]]] = {}
        for state, length, number in ends:
            while self.len[self.link[state]] >= length:
                state = self.link[state]
            self.found.setdefault(state, {}).setdefault(length, set()).add(number)
        self._above()

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # the path is there already, from an earlier item
            return q if self.len[q] == self.len[last] + 1 else self._clone(last, c, q)
        cur = self._state(self.len[last] + 1, {})
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._clone(p, c, q)
        return cur

    def _state(self, length: int, arcs: dict[int, int]) -> int:
        self.next.append(arcs)
        self.link.append(0)
        self.len.append(length)
        return len(self.len) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        clone = self._state(self.len[p] + 1, dict(self.next[q]))
        self.link[clone], self.link[q] = self.link[q], clone
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _above(self) -> None:
        """For each state, the windows on its suffix path: (state, lengths, nearest such ancestor)."""
        order = np.argsort(np.asarray(self.len), kind="stable").tolist()
        self.near = [-1] * len(order)
        for s in order:
            if s:
                self.near[s] = s if s in self.found else self.near[self.link[s]]
        self.above = {s: self.near[self.link[s]] if self.link[s] >= 0 else -1 for s in self.found}
        self.lengths = {s: sorted(x) for s, x in self.found.items()}

    def scan(self, text_words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit spans (start, end), merged and ascending, and the items found."""
        coded = map(self.vocab.get, text_words)
        arcs, link, length, near = self.next, self.link, self.len, self.near
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        seen: set[tuple[int, int]] = set()
        state = n = 0
        for i, c in enumerate(coded):
            if c is None:
                state = n = 0
                continue
            to = arcs[state].get(c)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = arcs[state].get(c)
            if to is None:
                continue
            state, n = to, n + 1
            at = near[state]
            while at >= 0:
                for size in self.lengths[at]:
                    if size <= n:
                        if (at, size) not in seen:
                            seen.add((at, size))
                            items |= self.found[at][size]
                        start = i + 1 - size
                        while spans and spans[-1][1] >= start:
                            start = min(start, spans.pop()[0])
                        spans.append((start, i + 1))
                at = self.above[at]
        return spans, items


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW,
           block_words: int = BLOCK_WORDS, piece_words: int = PIECE_WORDS) -> DataFrame:
    """(block, item_id, piece array<binary>): the words of all items, in pieces dealt into blocks."""
    step = max(1, piece_words - window + 1)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            out = {"item_id": [], "piece": []}
            for item, text in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist()):
                w = words(text)
                for at in range(0, max(1, len(w) - window + 1), step) if w else ():
                    out["item_id"].append(item)
                    out["piece"].append(w[at:at + piece_words])
            yield pa.RecordBatch.from_arrays([pa.array(out["item_id"], pa.string()),
                                              pa.array(out["piece"], pa.list_(pa.binary()))], names=["item_id", "piece"])

    items = benchmark.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text")) \
        .where("item_id IS NOT NULL AND text IS NOT NULL")
    place = F.spark_partition_id()
    stored = materialize(items.mapInArrow(cut, "item_id string, piece array<binary>").withColumns(
        {"part": place, "pos": F.monotonically_increasing_id(), "n": F.size("piece").cast("long")}), "pieces")
    sums = stored.groupBy("part").agg(F.sum("n").alias("words"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = sums.select("part", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("start") + F.coalesce(F.sum("n").over(within), F.lit(0))
    return stored.join(F.broadcast(starts), "part").select(F.floor(at / block_words).cast("long").alias("block"), "item_id", "piece")


def automaton(shared) -> SuffixAutomaton:
    """The automaton of a broadcast block (name, window, items)."""
    name, window, items = shared.value
    return kept(("automaton", name), lambda: SuffixAutomaton(items, window))


def _block_items(rows: list) -> dict[str, list[list[bytes]]]:
    items: dict[str, list[list[bytes]]] = {}
    for r in rows:
        items.setdefault(r["item_id"], []).append([bytes(w) for w in r["piece"]])
    return items


def _share(spark: SparkSession, items: dict, window: int):
    name = hashlib.sha256(repr((window, sorted(items.items()))).encode()).digest()
    return spark.sparkContext.broadcast((name, window, items))


Finish = Callable[[pa.RecordBatch, list, list], pa.RecordBatch]


def judged(docs: DataFrame, benchmark: DataFrame, finish: Finish, schema: T.StructType | str, window: int = WINDOW,
           block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs (with a ``text`` column) through ``finish(batch, spans, items)``: for each row its merged hit
    spans [start, end, start, end, ...] in words, and the ids of the items found."""
    spark = docs.sparkSession
    dealt = blocks(benchmark, window=window, block_words=block_words)
    numbers = dealt.agg(F.max("block")).first()[0]

    def scanned(b: pa.RecordBatch, fst: SuffixAutomaton) -> tuple[list, list]:
        spans, items = [], []
        for text in b.column("text").to_pylist():
            s, found = fst.scan(words(text))
            spans.append([x for pair in s for x in pair])
            items.append([fst.items[k] for k in found])
        return spans, items

    if not numbers:  # one block, or an empty benchmark
        shared = _share(spark, _block_items(dealt.collect()), window)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fst = automaton(shared)
            for b in slices(batches, "text"):
                yield finish(b, *scanned(b, fst))
        return docs.mapInArrow(run, schema)

    key, spans, items = unused(docs, "row_key", "spans", "items")
    stored = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "documents")
    hits = None
    for number in range(numbers + 1):  # one block's words at a time
        shared = _share(spark, _block_items(dealt.where(F.col("block") == number).collect()), window)
        found = materialize(stored.select(F.col(key).alias("row_key"), "text").mapInArrow(
            _hits(shared, scanned), "row_key long, spans array<int>, items array<string>"), "hits")
        shared.destroy()
        hits = found if hits is None else hits.unionByName(found)
    merged = hits.groupBy("row_key").agg(F.flatten(F.collect_list("spans")).alias(spans),
                                         F.array_distinct(F.flatten(F.collect_list("items"))).alias(items)) \
        .withColumnRenamed("row_key", key)

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            found = [[x or [] for x in b.column(c).to_pylist()] for c in (spans, items)]
            yield finish(b.drop_columns([key, spans, items]), *found)
    return stored.join(merged, key, "left").mapInArrow(put_together, schema)


def _hits(shared, scanned):
    schema = pa.schema([("row_key", pa.int64()), ("spans", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = automaton(shared)
        for b in slices(batches, "text"):
            spans, items = scanned(b, fst)
            hit = [i for i, s in enumerate(spans) if s]
            yield batch(schema, {"row_key": b.column("row_key").take(pa.array(hit, pa.int64())),
                                 "spans": [spans[i] for i in hit], "items": [items[i] for i in hit]})
    return run


def hit_mask(n: int, spans: list[int]) -> np.ndarray:
    hit = np.zeros(n + 1, np.int32)
    s = np.asarray(spans, np.int64)
    np.add.at(hit, s[0::2], 1)
    np.add.at(hit, s[1::2], -1)
    return np.cumsum(hit[:n]) > 0


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
           block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each document."""
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
              ("items_sha256", pa.string()), ("contaminated", pa.bool_())]
    out_schema = pa.schema(fields)

    def finish(b: pa.RecordBatch, spans: list, found: list) -> pa.RecordBatch:
        n_words = [len(words(t)) for t in b.column("text").to_pylist()]
        n_hit = [int(hit_mask(n, s).sum()) if s else 0 for n, s in zip(n_words, spans)]
        items = [sorted(set(i)) for i in found]
        return batch(out_schema, {
            "doc_id": b.column("doc_id"), "n_words": n_words, "n_hit": n_hit, "n_items": [len(i) for i in items],
            "items_sha256": [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items],
            "contaminated": [h > 0 for h in n_hit]})

    return judged(texts(docs), benchmark, finish, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
                                                  "contaminated boolean", window, block_words)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE,
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs without benchmark passages: a hit span is cut out of the text, with the separators
    inside it; a document of whose words more than max_coverage are hit goes as a whole.
    Clean documents are returned unchanged. A column n_chars follows the new text."""

    def finish(b: pa.RecordBatch, spans: list, found: list) -> pa.RecordBatch:
        kept, new = [], []
        for i, (text, s) in enumerate(zip(b.column("text").to_pylist(), spans)):
            cut = without(text, s, max_coverage) if s else text
            if cut is not None or text is None:
                kept.append(i)
                new.append(cut)
        rows = b.take(pa.array(kept, pa.int64()))
        values = {"text": new}
        if "n_chars" in rows.schema.names:
            values["n_chars"] = [w if t is None or t == o else len(t) for w, t, o in
                                 zip(rows.column("n_chars").to_pylist(), new, rows.column("text").to_pylist())]
        return replaced(rows, values)

    return judged(docs, benchmark, finish, docs.schema, window, block_words)


def without(text: str, spans: list[int], max_coverage: float) -> str | None:
    """The text without its hit spans; None if they cover more than max_coverage of its words."""
    raw = text.encode("utf-8", "replace")
    at = [m.span() for m in WORD.finditer(raw.translate(_LOWER))]
    hit = hit_mask(len(at), spans)
    if hit.sum() > max_coverage * len(at):
        return None
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    out, done = [], 0
    for s, e in zip(edges[0::2].tolist(), edges[1::2].tolist()):
        out.append(raw[done:at[s][0]])
        done = at[e - 1][1]
    out.append(raw[done:])
    return b"".join(out).decode()


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def op3(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return report(docs, benchmark)


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT dw.doc_id, dw.i, dw.n, iw.item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits))
    GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
