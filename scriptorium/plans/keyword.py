"""PL1 — keyword dimension: lower, distinct, anti join, key, append."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators.delta import append_keys, new_rows
from ..operators.impute import with_unknown_member
from ..schemas import TABLES


def is_first_load(existing: DataFrame | None, key: str) -> bool:
    """A table gets its key-0 row on its first load, i.e. while it is
    empty (the reference tests ``max(key) == 0``; a table holding only the
    key-0 row is not empty and does not get a second one)."""
    return existing is None or existing.select(key).isEmpty()


def keyword_delta(keywords: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Rows to append to ``dim_keyword``.

    ``keywords`` has a ``keyword`` column (source ``keywords.csv``). Keywords
    are lower-cased and de-duplicated; null keywords are dropped (Q3); keys
    follow the current maximum in keyword order (Q2: key by value, not by
    position)."""
    src = (keywords.select(tx.lower("keyword").alias("keyword_string"))
           .filter(F.col("keyword_string").isNotNull()).distinct())
    delta = new_rows(src, existing, ["keyword_string"], null_safe=False)
    keyed = append_keys(delta, existing, "keyword_pk", ["keyword_string"])
    return with_unknown_member(keyed, TABLES["dim_keyword"], is_first_load(existing, "keyword_pk"))
