"""Foreign-key lookups and join shapes (inventory J1-J5, J7, J10).

Join strategy is left to Catalyst and AQE: a dimension is broadcast only when
its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (checked at
plan time from statistics and again at run time from shuffle sizes);
otherwise it is a sort-merge join, and AQE splits skewed partitions. No
dimension is broadcast on faith, because dimensions grow with the data.

The unknown member (key 0 / ``'MISSING'``) is the typical hot key; values that denote it never match. Heavy
hitters below the size at which adaptive execution splits a partition, and those of full
outer joins, which it never splits, are spread on demand (``skew``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .skew import hot_keys, row_salt


def lookup_key(df: DataFrame, dim: DataFrame, on: dict[str, str] | list[str],
               key_col: str, out: str | None = None, default: int | None = 0,
               null_safe: bool = False, missing_values: tuple = (), hot: list[int] | None = None) -> DataFrame:
    """J1 / J2 + P5: left-join ``dim`` on the natural key ``on`` (list of shared
    names or mapping ``{df column: dim column}``) and add ``out`` = the dim's
    key, ``default`` when there is no match.

    ``null_safe`` matches nulls with nulls (pandas merge, J7). Values listed
    in ``missing_values`` never match (they denote the unknown member).

    ``hot`` (from ``skew.hot_keys`` over the key columns of ``df``) names heavy hitters: their few dimension
    rows are broadcast and looked up where the rows are, and the rows then pass the shuffled join spread by a
    salt, so no task gets more than its share. Null keys are spread the same way.
    """
    mapping = dict(zip(on, on)) if isinstance(on, list) else dict(on)
    out = out or key_col
    nat = [F.col(v).alias(f"_k{i}") for i, v in enumerate(mapping.values())]
    # one key per natural key (the smallest), so a lookup never multiplies rows
    d = (dim.select(*nat, F.col(key_col).alias("_key"))
         .groupBy(*[f"_k{i}" for i in range(len(mapping))])
         .agg(F.min("_key").alias("_key")))
    conds, allowed = [], F.lit(True)
    for i, left in enumerate(mapping):
        lc, rc = df[left], d[f"_k{i}"]
        conds.append(lc.eqNullSafe(rc) if null_safe else lc == rc)
        if missing_values:
            allowed &= ~F.coalesce(lc.isin(*missing_values), F.lit(False))
    cond = reduce(lambda a, b: a & b, [*conds, allowed] if missing_values else conds)
    if hot and not null_safe:
        joined = _hot_lookup(df, d, mapping, cond, allowed, hot)
    else:
        joined = df.join(d, cond, "left")
    key = F.col("_key").cast("bigint")
    if default is not None:
        key = F.coalesce(key, F.lit(default).cast("bigint"))
    return joined.select(df["*"], key.alias(out))


def _hot_lookup(df: DataFrame, d: DataFrame, mapping: dict[str, str], cond: Column, allowed: Column, hot: list[int]) -> DataFrame:
    """``df`` left-joined to ``d`` (key columns _k0, ..., and _key), the hot keys by broadcast where ``allowed``."""
    left = F.xxhash64(*[df[c].cast(d.schema[f"_k{i}"].dataType) for i, c in enumerate(mapping)])
    few = d.filter(F.xxhash64(*[F.col(f"_k{i}") for i in range(len(mapping))]).isin(hot)).withColumnsRenamed(
        {"_key": "_hot_key", **{f"_k{i}": f"_h{i}" for i in range(len(mapping))}})  # at most one row for each of ``hot``
    here = df.join(F.broadcast(few), reduce(lambda a, b: a & b, [df[c] == few[f"_h{i}"] for i, c in enumerate(mapping)], allowed), "left")
    null_key = reduce(lambda a, b: a | b, [df[c].isNull() for c in mapping])
    spread = F.when(null_key | left.isin(hot), row_salt(df) + 1).otherwise(F.lit(0))
    salted = here.withColumn("_spread", spread)
    rest = d.withColumn("_zero", F.pmod(F.col("_key"), F.lit(1)).cast("bigint"))  # a literal would be no join key
    joined = salted.join(rest, cond & (salted["_spread"] == rest["_zero"]), "left")
    return joined.withColumn("_key", F.coalesce("_hot_key", "_key"))


def _full_merge_hot(l2: DataFrame, r2: DataFrame, on: list[str], hot: list[int], salts: int) -> DataFrame:
    """Full outer join on non-null keys of which ``hot`` are heavy on either side. Each row of a hot key
    has a salt of its own side and is copied for all salts of the other side, so that every pair of rows meets once, in one of
    salts * salts tasks; rows without a partner are added once, by anti joins."""
    def keys(df: DataFrame, prefix: str) -> list[Column]:
        return [df[f"{prefix}{c}"] for c in on]

    def salted(df: DataFrame, prefix: str, mine: str, other: str) -> DataFrame:
        is_hot = F.xxhash64(*keys(df, prefix)).isin(hot)
        zero = F.lit(0).cast("bigint")
        return df.filter(reduce(lambda a, b: a & b, [k.isNotNull() for k in keys(df, prefix)])).withColumns({
            mine: F.when(is_hot, row_salt(df, salts)).otherwise(zero)}).withColumn(
            other, F.explode(F.when(is_hot, F.sequence(zero, F.lit(salts - 1).cast("bigint"))).otherwise(F.array(zero))))
    left, right = salted(l2, "_l_", "_l_mine", "_l_other"), salted(r2, "_r_", "_r_mine", "_r_other")
    cond = reduce(lambda a, b: a & b, [a == b for a, b in zip(keys(left, "_l_"), keys(right, "_r_"))])
    pairs = left.join(right, cond & (left["_l_mine"] == right["_r_other"]) & (left["_l_other"] == right["_r_mine"])) \
        .drop("_l_mine", "_l_other", "_r_mine", "_r_other")

    def alone(df: DataFrame, prefix: str, other: DataFrame, other_prefix: str) -> DataFrame:
        """Rows whose key the other side doesn't have; its distinct keys are few where a key is hot. Rows of a hot
        key, and rows without one, are spread by a salt, over which the other side's hot keys are copied."""
        zero = F.lit(0).cast("bigint")
        k = keys(df, prefix)
        null_key = reduce(lambda a, b: a | b, [x.isNull() for x in k])
        mine = df.withColumn("_s", F.when(null_key | F.xxhash64(*k).isin(hot), row_salt(df, salts)).otherwise(zero))
        there = other.select(*[x.alias(f"_o_{c}") for c, x in zip(on, keys(other, other_prefix))]).distinct()
        there = there.withColumn("_t", F.explode(F.when(F.xxhash64(*[F.col(f"_o_{c}") for c in on]).isin(hot), F.sequence(
            zero, F.lit(salts - 1).cast("bigint"))).otherwise(F.array(zero))))
        match = reduce(lambda a, b: a & b, [mine[f"{prefix}{c}"] == there[f"_o_{c}"] for c in on], mine["_s"] == there["_t"])
        return mine.join(there, match, "left_anti").drop("_s")
    return pairs.unionByName(alone(l2, "_l_", r2, "_r_"), allowMissingColumns=True) \
        .unionByName(alone(r2, "_r_", l2, "_l_"), allowMissingColumns=True)


def full_merge(left: DataFrame, right: DataFrame, on: list[str],
               suffixes: tuple[str, str] = ("_art", "_ref"),
               null_safe: bool = True, spread_hot: bool = False, salts: int = 8) -> DataFrame:
    """Full outer join on ``on``; the key columns are coalesced, every
    other shared column gets a suffix per side (pandas ``merge(how='outer')``).

    ``spread_hot`` (without ``null_safe``) looks for heavy hitters on both sides first; adaptive execution can't split
    them in a full outer join. Both sides are stored for that, as they are read more than once."""
    shared = [c for c in left.columns if c in right.columns and c not in on]
    lsuf, rsuf = suffixes
    l2 = left.select(*[F.col(c).alias(f"_l_{c}") if c in on else
                       F.col(c).alias(c + lsuf if c in shared else c) for c in left.columns])
    r2 = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else
                        F.col(c).alias(c + rsuf if c in shared else c) for c in right.columns])
    if spread_hot and not null_safe:
        l2, r2 = materialize(l2, "full_left"), materialize(r2, "full_right")
        hot = sorted({*hot_keys(l2, [f"_l_{c}" for c in on]), *hot_keys(r2, [f"_r_{c}" for c in on])})
        if hot:
            return _merged(_full_merge_hot(l2, r2, on, hot, salts), on)
    cond = reduce(lambda a, b: a & b, [
        (l2[f"_l_{c}"].eqNullSafe(r2[f"_r_{c}"]) if null_safe
         else l2[f"_l_{c}"] == r2[f"_r_{c}"]) for c in on])
    if not null_safe:
        # A null key never matches, yet every null-key row would hash to the
        # same shuffle partition, and AQE does not split skew in a full outer
        # join. A per-row salt (a hash of the row, deterministic on retry)
        # joins the equi-keys: null-key rows spread out, matching rows keep
        # salt 0 on both sides.
        def salted(df, prefix):
            is_null = reduce(lambda a, b: a | b, [F.col(f"{prefix}{c}").isNull() for c in on])
            return df.withColumn(f"{prefix}salt", F.when(is_null, F.xxhash64(*df.columns))
                                 .otherwise(F.lit(0).cast("bigint")))
        l2, r2 = salted(l2, "_l_"), salted(r2, "_r_")
        cond = reduce(lambda a, b: a & b, [
            l2[f"_l_{c}"] == r2[f"_r_{c}"] for c in on]) & (l2["_l_salt"] == r2["_r_salt"])
    return _merged(l2.join(r2, cond, "full"), on)


def _merged(j: DataFrame, on: list[str]) -> DataFrame:
    keys = [F.coalesce(F.col(f"_l_{c}"), F.col(f"_r_{c}")).alias(c) for c in on]
    rest = [c for c in j.columns if not c.startswith("_l_") and not c.startswith("_r_")]
    return j.select(*keys, *rest)
