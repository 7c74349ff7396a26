"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import cut


HUBS = 1024  # a node with more than one in HUBS of all links is a hub: fewer than 2 * HUBS nodes, whatever the input


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable over edges (a, b), for every node that
    has an edge. Alternates two steps: every node's larger neighbours are tied to its smallest
    one, then its smaller ones are. Each step keeps the components, and the tree depths fall
    geometrically. A node's minimum is a sum with partial results; it meets the node's links in
    a join by node, but the links of a hub stay where they are and the hubs' minima are
    broadcast (_with_least). Every step is checkpointed in the shared folder: a lost executor
    costs one step. Ends when all links are stars: no node has two parents, and no parent has
    one. Null ends and links to oneself are left out; no links give no rows."""
    pairs = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where("a <> b").distinct())
    while True:
        total, stars = _links(pairs)
        if stars:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
        large = cut(_with_least(both.where("b > a"), low, total).select(F.col("b").alias("a"), F.col("m").alias("b")))
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        tied = _with_least(large, low, total)
        # (a, m) for each a, and (b, m) for its other parents b
        small = tied.select(F.inline(F.array(F.struct("a", F.col("m").alias("b")),
                                             F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))).where("a <> b")
        pairs = cut(small.distinct())


def _with_least(links: DataFrame, least: DataFrame, total: int) -> DataFrame:
    """links (a, b) with m of least (a, m, n), n being the links that a has among at most 2 * total."""
    is_hub = F.col("n") * HUBS > total
    hubs = F.broadcast(least.where(is_hub).select("a", "m"))
    rest = links.join(F.broadcast(least.where(is_hub).select("a")), "a", "left_anti")
    return links.join(hubs, "a").unionByName(rest.join(least.where(~is_hub).select("a", "m"), "a")).select("a", "b", "m")


def _links(pairs: DataFrame) -> tuple[int, bool]:
    """(number of links, whether all are stars), from one sum by node: how often it is a child, and
    whether it is a parent."""
    roles = pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("parent"))))) \
        .groupBy("node").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    total, other = roles.agg(F.sum("child"), F.count_if(F.expr("child > 1 OR (child = 1 AND parent = 1)"))).first()
    return total or 0, not other
