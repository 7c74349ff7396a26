"""Surrogate and group keys (inventory W1, W2, W3, A7).

``row_number() over (order by k)`` without a partition moves every row into one
task. ``number_rows`` gives the same numbers with all work distributed:

1. rows are range-partitioned by the natural key and sorted inside each
   partition; each row records its partition id and its position in it;
2. partition id and position are written as a table into the shared
   checkpoint folder, so they stay valid even if an executor is lost and a
   stage re-runs (range bounds are sampled and could differ on recomputation);
3. per-partition row counts (one number per partition) become offsets through
   a window over those few rows, which is broadcast back.

Keys are ordered by the natural key, so they are deterministic; the reference
numbers in file order, and only density, uniqueness and "above the current
maximum" are part of its contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize


def max_key(df: DataFrame | None, key: str) -> int:
    """The highest key in use, 0 for an empty or missing table (one scalar)."""
    if df is None:
        return 0
    row = df.agg(F.max(F.col(key)).alias("m")).first()
    return int(row["m"]) if row is not None and row["m"] is not None else 0


def number_rows(df: DataFrame, order_cols: list[str], key_name: str,
                start_after: int = 0, num_partitions: int | None = None) -> DataFrame:
    """Every row of ``df`` with a key of its own, ``start_after + 1, ...`` in
    the order of ``order_cols`` (nulls first). The other columns travel with the
    row, so nothing is joined back. Rows that tie on ``order_cols`` get
    different keys in either order."""
    ensure_checkpoint_dir(df.sparkSession)
    pid = F.spark_partition_id().cast("long")
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    # without an explicit count AQE may merge adjacent ranges of a small input
    # (merged partitions stay contiguous in key order, so positions hold)
    ranged_in = (df.repartitionByRange(num_partitions, *order) if num_partitions
                 else df.repartitionByRange(*order))
    ranged = (
        ranged_in
        .sortWithinPartitions(*order)
        .withColumn("_pid", pid)
        # position inside the partition: the id's low 33 bits count rows
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(pid, 33))
    )
    ranged = materialize(ranged, "keys")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a bounded, broadcastable table
    offsets = counts.select(
        "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return ranged.join(F.broadcast(offsets), "_pid").select(
        *df.columns,
        (F.lit(start_after).cast("long") + F.col("_off") + F.col("_pos") + 1)
        .alias(key_name),
    )


def dense_keys(df: DataFrame, key_cols: list[str], key_name: str,
               start_after: int = 0, num_partitions: int | None = None) -> DataFrame:
    """Give each distinct ``key_cols`` tuple of ``df`` a consecutive key
    ``start_after + 1, start_after + 2, ...`` in ascending key order (nulls
    first). Returns ``key_cols + [key_name]``, one row per distinct tuple.
    """
    return number_rows(df.select(*key_cols).distinct(), key_cols, key_name, start_after, num_partitions)


def group_numbers(df: DataFrame, key_cols: list[str], name: str,
                  offset: int = 0, num_partitions: int | None = None) -> DataFrame:
    """W1 + W3: pandas ``groupby(k).ngroup()`` (0-based rank of the sorted
    distinct key) plus ``offset`` for every row; null keys are not grouped.
    The rows are stored first, as the numbers and the result both read them."""
    valid = df
    for c in key_cols:
        valid = valid.filter(F.col(c).isNotNull())
    valid = materialize(valid, "owners")  # else the delta with all its joins runs twice
    keys = dense_keys(valid, key_cols, name, offset - 1, num_partitions)
    return valid.join(keys, key_cols, "inner")
