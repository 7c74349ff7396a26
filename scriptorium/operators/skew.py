"""Heavy hitters: keys that hold a large share of the rows, found with a sketch and spread over tasks.

Adaptive execution splits a hot partition only above its size threshold and never in a full
outer join. Here the hot keys of a table are found by ``approx_top_k`` over a hash of the key (one narrow pass with partial
results). A key counts as hot above ``share`` of the rows, so there are at most 1 / share
of them, whatever the table's size: a list that may be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE = 1 / 200
SALTS = 64


def hot_keys(df: DataFrame, cols: list[str], share: float = SHARE) -> list[int]:
    """The hashes of the keys (without nulls) that hold at least ``share`` of the rows, about; a sketch may
    name a few that hold a little less, at most 2 / share in all."""
    keys = int(1 / share)
    hashes = df.select(*cols).na.drop().select(F.xxhash64(*cols).alias("h"))
    row = hashes.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {keys}, {keys * 50})").alias("top")).first()
    return sorted(x["item"] for x in row["top"] or [] if x["count"] >= max(2, share * row["n"]))


def row_salt(df: DataFrame, salts: int = SALTS) -> Column:
    """A salt that depends on the whole row, so it is the same when a task runs again."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts))


PART_ROWS = 8_000_000
PARTS = 16


def part_filters(df: DataFrame, key: str, rows: int | None = None) -> list[Column]:
    """Conditions that deal ``df``, and any table with the same whole-number ``key``, into parts by a hash of it: one for each ``rows``
    rows of ``df``, ``PARTS`` at most. A step that runs part by part needs disk for the shuffle of one part."""
    n = max(1, min(PARTS, -(-df.count() // (rows or PART_ROWS))))
    return [F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(n)) == i for i in range(n)] if n > 1 else [F.lit(True)]
