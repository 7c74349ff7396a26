"""Change data capture and set operators (inventory C1-C7, D4, U1-U3, J5, J6).

Every delta is an anti join on the hash of the natural key, which a stored table
carries and is bucketed by, instead of the reference's "concatenate and drop all duplicates" (Q1,
Q4) or per-row list membership.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .keys import max_key, number_rows


MATCH = "_match"  # the hash of a stored row's natural key; stored tables are bucketed by it (sources.warehouse)


def match_hash(types: dict[str, T.DataType]) -> Column:
    """One hash over a natural key; equal keys of these types hash alike."""
    return F.xxhash64(*[F.col(c).cast(t) for c, t in types.items()])


def _matched(source: DataFrame, target: DataFrame, on: list[str], null_safe: bool,
             carry: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides with the hash of ``on`` (the target's columns as ``_t_...``, and those of ``carry`` by their new
    names), and their join condition. The hash is the only equality that the planner sees, so each side moves
    once, wide attributes are no sort keys, and a target that is stored in buckets of that hash doesn't
    move at all; the attributes are compared on the rows that meet."""
    # equal values must hash alike, so both sides hash the common (wider) type
    common = {f.name: f.dataType for f in source.select(*on).limit(0).unionByName(target.select(*on).limit(0)).schema.fields}
    stored = MATCH in target.columns and all(target.schema[c].dataType == t for c, t in common.items())
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in on], *[F.col(c).alias(new) for c, new in (carry or {}).items()],
                      (F.col(MATCH) if stored else match_hash(common)).alias("_t_match"))
    s = source.withColumn(MATCH, match_hash(common))

    def same(c: str) -> Column:  # not written as an equality, which would become a join key
        a, b = F.col(c), F.col(f"_t_{c}")
        equal = (a >= b) & (a <= b)
        return F.coalesce(equal, F.lit(False)) | (a.isNull() & b.isNull()) if null_safe else equal
    return s, t, reduce(lambda a, b: a & b, [same(c) for c in on], F.col(MATCH) == F.col("_t_match"))


def new_rows(source: DataFrame, target: DataFrame | None, on: list[str],
             null_safe: bool = True) -> DataFrame:
    """Rows of ``source`` whose ``on`` key is not in ``target``.
    ``null_safe`` matches null with null (pandas merge semantics, J7)."""
    if target is None:
        return source
    s, t, cond = _matched(source, target, on, null_safe)
    return s.join(t, cond, "left_anti").drop(MATCH)


def known_rows(source: DataFrame, target: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``source`` whose ``on`` key (without nulls) is in ``target``."""
    s, t, cond = _matched(source, target, on, False)
    return s.join(t, cond, "left_semi").drop(MATCH)


def full_row_delta(source: DataFrame, target: DataFrame | None,
                   cols: list[str]) -> DataFrame:
    """Distinct source rows (over ``cols``) that are not already in
    ``target`` with all the same attribute values (null-safe)."""
    return new_rows(source.select(*cols).distinct(), target, cols, null_safe=True)


def append_keys(delta: DataFrame, target: DataFrame | None, key_name: str,
                order_cols: list[str], num_partitions: int | None = None) -> DataFrame:
    """W2 + A7: give each delta row a key above the target's highest key, in the
    order of ``order_cols``."""
    return number_rows(delta, order_cols, key_name, max_key(target, key_name), num_partitions)


def rows_once(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Keep only the rows that occur exactly once (every copy of a repeated
    row is removed; pandas ``drop_duplicates(keep=False)``)."""
    cols = cols or df.columns
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") == 1).drop("_n"))


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that are in exactly one of two sets (distinct on all columns);
    ``b`` may lack columns of ``a`` (filled with null, U2)."""
    da = a.distinct()
    db = b.distinct()
    both = da.unionByName(db, allowMissingColumns=True)
    return rows_once(both, da.columns if len(da.columns) >= len(db.columns) else db.columns)


def fact_delta(source: DataFrame, target: DataFrame | None, pk: list[str],
               measure: str) -> tuple[DataFrame, DataFrame]:
    """C6 with decision Q9: (new facts, changed facts).

    New facts have a primary key absent from the target and are appended;
    facts whose key exists with another measure are returned apart (the
    reference would re-insert the key and lose the whole batch)."""
    if target is None:
        return source, source.filter(F.lit(False))
    s, t, cond = _matched(source, target, pk, False, {measure: f"previous_{measure}"})
    new = s.join(t, cond, "left_anti").drop(MATCH)
    changed = (s.join(t, cond, "inner").filter(~F.col(measure).eqNullSafe(F.col(f"previous_{measure}")))
               .select(*source.columns, f"previous_{measure}"))
    return new, changed


def stored_fact_delta(source: DataFrame, target: DataFrame | None, pk: list[str],
                      measure: str) -> tuple[DataFrame, DataFrame]:
    """``fact_delta`` for a costly source: it meets the target once, and the new and changed facts are stored."""
    if target is None:
        return source, source.filter(F.lit(False))
    previous = f"previous_{measure}"
    s, t, cond = _matched(source, target, pk, False, {measure: previous})
    met = s.join(t.withColumn("_known", F.lit(True)), cond, "left").select(
        *source.columns, previous, F.col("_known").isNotNull().alias("_known"))
    met = materialize(met.filter(~F.col("_known") | ~F.col(measure).eqNullSafe(F.col(previous))), "fact_rows")
    return met.filter("NOT _known").select(*source.columns), met.filter("_known").drop("_known")
