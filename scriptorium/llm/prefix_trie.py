"""Conversation prefix trie by truncation peeling (operator 12).

A conversation's path holds, for each of its turns, a chained digest of all turns
up to it and the length of its text: 20 bytes a turn, no texts. Two conversations
share a depth-d node when their digests at depth d are equal.

The trie is peeled from its maximum depth up. At a depth, the nodes that came up
from below are merged with the conversations that end there; each merged node is
written out with its aggregates, loses its last turn and joins its parent's group one
level higher. Every figure of a node is a sum over its children and its own
end, so nodes are found and aggregated in the same pass, and nothing is ever
expanded to (conversation, depth) rows.

Levels are peeled in blocks whose floors double (0, 1, 2, 4, 8, ...), so a
conversation of n turns costs about log2(n) shuffles and not n. In a block, the items
(ended conversations, surviving nodes) that share the floor's prefix meet in
one task, which peels that subtree down to the floor. A prefix with more than GROUP_ITEMS items
isn't put into one task: its block is halved, first the deeper half, whose longer prefixes
split the group, then the upper half over the survivors. A block of one level is a plain
aggregation with partial results before its shuffle, so a first turn (or any other prefix)
that a third of all conversations share is combined in the scan tasks. Equal
conversations are one item with a count from the start.

The digest of a node's ended conversations is a digest over one ascending list, which
can't be computed in parts. The ids are sorted in ranges spread over tasks, packed into strings of up to
CHUNK_IDS ids there, and only the strings of one node are streamed through its digest; no task holds a list.

Every level's rows are tables in the shared folder.

Defined cases: turns are ordered by turn, null first; turns that tie are ordered by
their role, then by a digest of their text. A null role or text is the empty
one. A row without conv_id belongs to no conversation and is left out. Repeated rows are turns of their own.
An empty table has no conversations, hence no nodes. A conversation's packed path has to fit one row (100 million turns).
Ids below zero truncate towards zero in ``c - c % 100``. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import batch
from scriptorium.session import materialize

STEP, KEY = 20, 16        # bytes of a turn in a path; the first KEY are the chained digest
GROUP_ITEMS = 512
CHUNK_IDS = 1 << 14
BASE, HEADS = 100, 6
NO_END = hashlib.sha256(b"").hexdigest()

_ITEM = [("path", pa.binary()), ("depth", pa.int64()), ("first", pa.int64()), ("n", pa.int64()),
         ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string())]
_ITEM_DDL = "path binary, depth long, first long, n long, children long, leaves long, saved long, ends string"
_NODE = [("own", pa.binary()), ("up", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
         ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
         ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())]
_NODE_DDL = ("own binary, up binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
             "n_leaves long, saved_tokens long, ends_sha256 string")


# --- paths -------------------------------------------------------------------

def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, own): the packed turns of each conversation in their order, 16 bytes of the
    digest of role and text and 4 bytes of the text's length in code points."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    packed = F.unhex(F.concat(F.substring(digest, 1, 2 * KEY), F.lpad(F.hex(F.char_length(text)), 8, "0")))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                role.alias("role"), packed.alias("packed")).where("conv_id IS NOT NULL")
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "packed")))
    hexed = F.array_join(F.transform("t", lambda x: F.hex(x["packed"])), "")
    return rows.groupBy("conv_id").agg(ordered.alias("t")).select("conv_id", F.unhex(hexed).alias("own"))


def rebuilt(own: DataFrame, base: int = BASE, heads: int = HEADS) -> DataFrame:
    """(conv_id, packed): the first h turns of conversation c - c % base, then c's own turns after
    its first h, where h is crc32(c) % heads."""
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % heads).cast("int") * STEP
    firsts = own.where(c % base == 0).select(c.alias("base_id"), F.substring("own", 1, (heads - 1) * STEP).alias("firsts"))
    both = own.withColumns({"h": h, "base_id": c - c % base}).join(firsts, "base_id", "left")
    head = F.coalesce(F.substring(F.col("firsts"), F.lit(1), F.col("h")), F.lit(b""))
    rest = F.substring(F.col("own"), F.col("h") + 1, F.greatest(F.octet_length("own") - F.col("h"), F.lit(0)))
    return both.select("conv_id", F.concat(head, rest).alias("packed"))


def chained(sequences: DataFrame) -> DataFrame:
    """(conv_id, path, depth): each turn's digest replaced by the one of all turns up to it."""
    schema = pa.schema([("conv_id", pa.int64()), ("path", pa.binary()), ("depth", pa.int64())])

    def chain(packed: bytes) -> bytes:
        out, state = bytearray(), hashlib.sha256()
        for at in range(0, len(packed), STEP):
            turn = packed[at:at + STEP]
            state.update(turn)
            out += state.digest()[:KEY]  # digest() leaves the running state as it is
            out += turn[KEY:]
        return bytes(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = [chain(p) for p in b.column("packed").to_pylist()]
            yield batch(schema, {"conv_id": b.column("conv_id"), "path": paths, "depth": [len(p) // STEP for p in paths]})

    return sequences.mapInArrow(run, "conv_id long, path binary, depth long")


def node_key(path: Column, depth: Column | int) -> Column:
    """The digest of the node at a depth of a path (depth 0: empty)."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.when(depth > 0, F.substring(path, ((depth - 1) * STEP + 1).cast("int"), F.lit(KEY))).otherwise(F.lit(b""))


def ended(paths: DataFrame) -> DataFrame:
    """One item for each different sequence, with the digest of the ids of its conversations."""
    chunk_schema = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])
    end_schema = pa.schema([("first", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def out() -> pa.RecordBatch:
            return batch(chunk_schema, {"key": [key], "first": [ids[0]], "n": [len(ids)], "ids": [",".join(map(str, ids))]})

        for b in batches:
            for k, i in zip(b.column("key").to_pylist(), b.column("conv_id").to_pylist()):
                if ids and (k != key or len(ids) >= CHUNK_IDS):
                    yield out()
                    ids = []
                key = k
                ids.append(i)
        if ids:
            yield out()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, first, n = None, None, 0, 0
        for b in batches:
            done = {"first": [], "n": [], "ends": []}
            for k, f, m, ids in zip(*[b.column(c).to_pylist() for c in ("key", "first", "n", "ids")]):
                if k != key:
                    if state is not None:
                        for name, v in (("first", first), ("n", n), ("ends", state.hexdigest())):
                            done[name].append(v)
                    key, state, first, n = k, hashlib.sha256(ids.encode()), f, m
                else:
                    state.update(b"," + ids.encode())
                    n += m
            yield batch(end_schema, done)
        if state is not None:
            yield batch(end_schema, {"first": [first], "n": [n], "ends": [state.hexdigest()]})

    ids = paths.select(node_key(F.col("path"), F.col("depth")).alias("key"), "conv_id")
    packed = ids.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id") \
        .mapInArrow(chunks, "key binary, first long, n long, ids string")
    ends = packed.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digests, "first long, n long, ends string")
    zero = F.lit(0).cast("long")
    return paths.withColumnRenamed("conv_id", "first").join(ends, "first").select(
        "path", "depth", "first", "n", zero.alias("children"), zero.alias("leaves"), zero.alias("saved"), "ends")


# --- peeling -----------------------------------------------------------------

class Node:
    __slots__ = ("path", "first", "n", "children", "leaves", "saved", "ends", "orphans")

    def __init__(self, path: bytes) -> None:
        self.path, self.first, self.n, self.children, self.leaves, self.saved = path, None, 0, 0, 0, 0
        self.ends = NO_END
        self.orphans: list[int] = []  # places, in the output, of children that wait for this node's first


def peel_group(items: list[tuple], floor: int, nodes: list[list], survivors: list[tuple]) -> None:
    """Peels the items under one prefix of ``floor`` turns, from the deepest up to floor + 1."""
    by_depth: dict[int, list[tuple]] = {}
    for it in items:
        by_depth.setdefault(it[1], []).append(it)
    alive: dict[bytes, Node] = {}
    for depth in range(max(by_depth), floor, -1):
        at = STEP * (depth - 1)
        for path, _, first, n, children, leaves, saved, ends in by_depth.get(depth, ()):
            node = alive.setdefault(path[at:at + KEY], Node(path))
            node.first = first if node.first is None else min(node.first, first)
            node.n += n
            node.children += children
            node.leaves += leaves
            node.saved += saved
            if ends != NO_END:
                node.ends = ends
        above: dict[bytes, Node] = {}
        for key, node in alive.items():
            leaves = node.leaves if node.children else 1
            saved = node.saved + (node.n - 1) * int.from_bytes(node.path[at + KEY:at + STEP])
            for place in node.orphans:
                nodes[place][4] = node.first
            up = node.path[at - STEP:at - STEP + KEY] if depth > 1 else b""
            nodes.append([key, up if depth == floor + 1 else None, depth, node.first, None, node.n, node.children,
                          leaves, saved, node.ends])
            if depth > floor + 1:
                parent = above.setdefault(up, Node(node.path))
                parent.first = node.first if parent.first is None else min(parent.first, node.first)
                parent.n += node.n
                parent.children += 1
                parent.leaves += leaves
                parent.saved += saved
                parent.orphans.append(len(nodes) - 1)
            else:
                survivors.append((node.path[:STEP * floor], floor, node.first, node.n, 1, leaves, saved, NO_END))
        alive = above


def _peel_tasks(floor: int):
    """Items sorted by the floor's prefix -> rows of nodes (tag 0) and of survivors (tag 1)."""
    schema = pa.schema([("tag", pa.int32()), *_NODE, *[(f"s_{n}", t) for n, t in _ITEM]])

    def out(nodes: list[list], survivors: list[tuple]) -> pa.RecordBatch:
        n, m = len(nodes), len(survivors)
        columns = {"tag": [0] * n + [1] * m}
        for i, (name, _) in enumerate(_NODE):
            columns[name] = [x[i] for x in nodes] + [None] * m
        for i, (name, _) in enumerate(_ITEM):
            columns[f"s_{name}"] = [None] * n + [x[i] for x in survivors]
        return batch(schema, columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for b in batches:
            nodes, survivors = [], []
            for g, *item in zip(b.column("g").to_pylist(), *[b.column(n).to_pylist() for n, _ in _ITEM]):
                if held and g != group:
                    peel_group(held, floor, nodes, survivors)
                    held = []
                group = g
                held.append(tuple(item))
            yield out(nodes, survivors)
        if held:
            nodes, survivors = [], []
            peel_group(held, floor, nodes, survivors)
            yield out(nodes, survivors)

    return run


_OUT_DDL = "tag int, " + _NODE_DDL + ", " + ", ".join(f"s_{x}" for x in _ITEM_DDL.split(", "))


def _one_level(items: DataFrame, depth: int) -> DataFrame:
    """The nodes at one depth by a plain aggregation (combined before the shuffle), as item rows."""
    return items.groupBy(node_key(F.col("path"), depth).alias("key")).agg(
        F.min("path").alias("path"), F.min("first").alias("first"), F.sum("n").alias("n"),
        F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
        F.coalesce(F.max(F.when(F.col("ends") != NO_END, F.col("ends"))), F.lit(NO_END)).alias("ends")) \
        .withColumn("leaves", F.when(F.col("children") > 0, F.col("leaves")).otherwise(F.lit(1)))


def _as_nodes(level: DataFrame, depth: int) -> DataFrame:
    up = node_key(F.col("path"), depth - 1) if depth else F.lit(None).cast("binary")
    return level.select(F.col("key").alias("own"), up.alias("up"), F.lit(depth).cast("long").alias("depth"),
                        F.col("first").alias("conv_id"), F.lit(None).cast("long").alias("parent_conv_id"),
                        F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
                        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                        F.col("ends").alias("ends_sha256"))


class _Peeling:
    """The node tables found so far; ``peel`` turns the items of a block into nodes and survivors."""

    def __init__(self, limit: int) -> None:
        self.limit, self.nodes = limit, []

    def peel(self, items: DataFrame, floor: int, top: int) -> DataFrame:
        """Items with floor < depth <= top; returns the survivors, items at the floor's depth."""
        if top == floor + 1:
            level = _one_level(items, top)
            code = F.conv(F.hex(F.substring(F.col("path"), STEP * floor + KEY + 1, STEP - KEY)), 16, 10).cast("long")
            level = materialize(level.withColumn("saved", F.col("saved") + (F.col("n") - 1) * code), "trie-level")
            self.nodes.append(_as_nodes(level, top))
            return level.select(F.substring("path", 1, STEP * floor).alias("path"), F.lit(floor).cast("long").alias("depth"),
                                "first", "n", F.lit(1).cast("long").alias("children"), "leaves", "saved",
                                F.lit(NO_END).alias("ends"))
        tagged = items.withColumn("g", node_key(F.col("path"), floor))
        hot = materialize(tagged.groupBy("g").count().where(F.col("count") > self.limit).select("g"), "trie-hot")
        some_hot = not hot.isEmpty()
        light = tagged.join(hot, "g", "left_anti") if some_hot else tagged
        done = materialize(light.repartition("g").sortWithinPartitions("g").mapInArrow(_peel_tasks(floor), _OUT_DDL), "trie-block")
        names = [n for n, _ in _ITEM]
        self.nodes.append(done.where("tag = 0").select(*[n for n, _ in _NODE]))
        out = done.where("tag = 1").select(*[F.col(f"s_{n}").alias(n) for n in names])
        if some_hot:
            mid = (floor + top) // 2
            heavy = materialize(tagged.join(hot, "g", "left_semi").select(*names), "trie-heavy")
            risen = self.peel(heavy.where(F.col("depth") > mid), mid, top)
            out = out.unionByName(self.peel(heavy.where(F.col("depth") <= mid).unionByName(risen), floor, mid))
        return out


def trie(conversations: DataFrame, base: int = BASE, heads: int = HEADS, group_items: int = GROUP_ITEMS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths = materialize(chained(rebuilt(turns(conversations), base, heads)), "trie-paths")
    deepest = paths.agg(F.max("depth")).first()[0]
    items = materialize(ended(paths), "trie-ended")
    if deepest is None:
        return _shaped(items.limit(0).select(F.lit(None).cast("binary").alias("key"), *[n for n, _ in _ITEM])
                       .transform(lambda d: _as_nodes(d, 0)))
    floors = [0]
    while floors[-1] < deepest:
        floors.append(max(1, 2 * floors[-1]))
    state, risen = _Peeling(group_items), None
    for floor, top in reversed(list(zip(floors, floors[1:]))):
        block = items.where((F.col("depth") > floor) & (F.col("depth") <= top))
        risen = state.peel(block if risen is None else block.unionByName(risen), floor, top)
    roots = items.where("depth = 0") if risen is None else items.where("depth = 0").unionByName(risen)
    nodes = _as_nodes(_one_level(roots, 0), 0)
    for part in state.nodes:
        nodes = nodes.unionByName(part)
    nodes = materialize(nodes, "trie-nodes")
    # nodes whose parent was found in another block take its first member from there; the root's is one value
    first_of = nodes.where("depth > 0 AND n_children > 0").select(F.col("own").alias("up"), F.col("conv_id").alias("parent_first"))
    root = nodes.where("depth = 0").first()["conv_id"]
    return _shaped(nodes.where("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(root).cast("long")))
                   .unionByName(nodes.where("depth > 1 AND up IS NULL"))
                   .unionByName(nodes.where("depth > 1 AND up IS NOT NULL").join(first_of, "up")
                                .withColumn("parent_conv_id", F.col("parent_first")).select(*nodes.columns)))


def _shaped(nodes: DataFrame) -> DataFrame:
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    return trie(conversations)


ORACLE = """
WITH crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i::UBIGINT] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END)) AS t),
ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
hs AS (SELECT conv_id, CAST(xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda ch: ascii(ch)::UBIGINT), lambda a, b: xor(a >> 8, t[CAST((xor(a, b) & 255::UBIGINT) + 1 AS BIGINT)])), 4294967295::UBIGINT) % 6 AS BIGINT) AS h
    FROM ids, crc_table),
tt AS (SELECT conv_id, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS e, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p FROM conversations WHERE conv_id IS NOT NULL),
seqs AS (SELECT conv_id, list(e ORDER BY p) AS s FROM tt GROUP BY conv_id),
re AS (SELECT o.conv_id, list_concat(coalesce(b.s[1:h], []), o.s[h + 1:len(o.s)]) AS s
    FROM seqs o JOIN hs USING (conv_id) LEFT JOIN seqs b ON b.conv_id = o.conv_id - o.conv_id % 100),
nodes AS (SELECT s[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(s) = d), '')) AS ends_sha256
    FROM (SELECT conv_id, s, unnest(generate_series(0, len(s))) AS d FROM re) GROUP BY 1, 2),
linked AS (SELECT n.*, q.conv_id AS parent_conv_id,
    (SELECT count(*) FROM nodes c WHERE c.d = n.d + 1 AND c.p[1:n.d] = n.p) AS n_children
    FROM nodes n LEFT JOIN nodes q ON q.d = n.d - 1 AND q.p = n.p[1:n.d - 1]),
sums AS (SELECT p, d, count(*) FILTER (below = 0) AS n_leaves, sum(cost) AS saved FROM (
    SELECT p[1:k] AS p, k AS d, n_children AS below, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(p[d].t) END AS cost
    FROM (SELECT *, unnest(generate_series(0, d)) AS k FROM linked)) GROUP BY 1, 2)
SELECT conv_id, CAST(l.d AS BIGINT) AS depth, parent_conv_id, n_convs, CAST(n_children AS BIGINT) AS n_children,
    CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM linked l JOIN sums s ON s.d = l.d AND s.p = l.p
"""
