"""Sharding by vector bin packing (operator 9), under the law ``bytes``.

A group is all rows with equal texts. Its vector (bytes, tokens, rows), each in
shares of the table's total, is placed in the shard where the dot product with
the residual capacity is highest; the heaviest groups come first. That balances
the three measures jointly.

Placing runs over a bounded list. A group above 1/(shards * FINE) of any total
is an item of its own (there can be at most 3 * shards * FINE of them); all
lighter groups are dealt by the hash of their text into shards * FINE bundles,
and a bundle is placed as one item. So the driver sees a number of items that
depends on the shard count alone, whatever the table's size, and a bundle is
too light to unbalance a shard. A group stays in one shard unless it exceeds
the capacity of a shard in some measure (a hot group): then it is cut by a hash
of the stored row's number (not of doc_id, which may repeat or be null) into pieces of
about 1/(shards * FINE) that are placed one by one.

Slots are numbered without sorting a shard in one task: each item's rows are
numbered by themselves (heavy groups in pieces), and an item's slots start
where those of the items before it in its shard end.

Defined cases: a null text has size 8 and no token, and null texts are one
group, as empty texts are another; a very long text is one row that may exceed a shard's share;
equal dot products go to the lowest shard; repeated rows, and rows with equal or null ids, get
slots of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.llm.common import texts
from scriptorium.session import materialize

SHARDS, FINE, ROW_BYTES = 24, 256, 8
SPACES = " \t\n\x0b\x0c\r"


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size, tokens, text_crc32 and the group key (two hashes of the text) of each row."""
    text = F.coalesce("text", F.lit(""))
    gaps = F.length(text) - F.length(F.translate(text, SPACES, ""))
    return docs.select(
        "doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.when(F.length(text) > 0, gaps + 1).otherwise(0).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64("text")).alias("g1"),
        F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64("text", F.lit(1))).alias("g2"))


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item: heaviest first, to the highest dot product with the residual capacity.
    Capacities are equal shares of the total; a residual below zero counts as such."""
    total = np.maximum(vectors.sum(axis=0), 1e-12)
    v = vectors / total * shards
    residual = np.ones((shards, v.shape[1]))
    out = np.zeros(len(v), np.int64)
    for i in np.lexsort((np.arange(len(v)), -v.max(axis=1))).tolist():
        out[i] = int((residual @ v[i]).argmax())
        residual[out[i]] -= v[i]
    return out


def shard(docs: DataFrame, shards: int = SHARDS, fine: int = FINE) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law is ``bytes``)."""
    spark = docs.sparkSession
    rows = materialize(measured(texts(docs)).withColumn("rid", F.monotonically_increasing_id()), "rows")
    total = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("size", "tokens")], F.count("*")).first()
    if not total[2]:
        return _result(rows.withColumns({"shard": F.lit(0), "slot": F.lit(0)}))
    bundles = shards * fine
    limit = [max(1.0, t / bundles) for t in total]
    heavy = materialize(
        rows.groupBy("g1", "g2").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
                                     F.count("*").alias("n"))
        .where((F.col("bytes") > limit[0]) | (F.col("tokens") > limit[1]) | (F.col("n") > limit[2]))
        .withColumn("pieces", F.greatest(F.ceil(F.col("bytes") / limit[0]), F.ceil(F.col("tokens") / limit[1]),
                                         F.ceil(F.col("n") / limit[2])).cast("long")), "heavy")
    # Items: bundle numbers for light groups; for heavy ones the group and a piece.
    light = F.pmod(F.col("g1"), F.lit(bundles)).cast("long")
    tagged = rows.join(F.broadcast(heavy.select("g1", "g2", "pieces")), ["g1", "g2"], "left").select(
        "doc_id", "size", "tokens", "text_crc32", "g1", "g2", "rid",
        F.when(F.col("pieces").isNull(), light).otherwise(F.col("g1")).alias("k1"),
        F.when(F.col("pieces").isNull(), F.lit(0).cast("long")).otherwise(F.col("g2")).alias("k2"),
        F.when(F.col("pieces").isNull(), F.lit(-1).cast("long"))
        .otherwise(F.pmod(F.xxhash64("rid"), F.col("pieces"))).alias("piece"))
    items = tagged.groupBy("k1", "k2", "piece").agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("n")) \
        .orderBy("k1", "k2", "piece").collect()  # at most (1 + 3 + 3) * shards * fine narrow rows
    placed = _place_items(items, shards)
    starts = spark.createDataFrame(placed, "k1 long, k2 long, piece long, shard int, start long")
    slot = Window.partitionBy("k1", "k2", "piece").orderBy("g1", "g2", "doc_id", "rid")
    numbered = tagged.join(F.broadcast(starts), ["k1", "k2", "piece"]) \
        .withColumn("slot", F.col("start") + F.row_number().over(slot) - 1)
    return _result(numbered)


def _place_items(items: list, shards: int) -> list[tuple]:
    """(k1, k2, piece, shard, first slot) of each item. Pieces of a group go together if it fits a shard."""
    vec = np.array([(r["bytes"], r["tokens"], r["n"]) for r in items], float)
    capacity = np.maximum(vec.sum(axis=0), 1) / shards
    whole: dict[tuple, list[int]] = {}
    for i, r in enumerate(items):
        whole.setdefault((r["k1"], r["k2"], r["piece"] >= 0), []).append(i)
    units = []
    for members in whole.values():
        if (vec[members].sum(axis=0) > capacity).any():
            units += [[i] for i in members]
        else:
            units.append(members)
    where = place(np.array([vec[u].sum(axis=0) for u in units]), shards)
    target = {i: int(s) for u, s in zip(units, where) for i in u}
    out, next_slot = [], [0] * shards
    for i, r in enumerate(items):
        s = target[i]
        out.append((r["k1"], r["k2"], r["piece"], s, next_slot[s]))
        next_slot[s] += r["n"]
    return out


def _result(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
                       F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))


def op9(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return shard(docs)
