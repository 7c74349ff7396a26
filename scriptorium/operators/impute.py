"""Null handling and default members (inventory P2-P6, P12, P14, P15).

``'MISSING'`` for strings, ``0`` for numbers and 1 January 1678 for dates are
the warehouse defaults; key 0 of each dimension is the unknown member.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: warehouse defaults
MISSING = "MISSING"
DEFAULT_DATE = dt.date(1678, 1, 1)


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop rows where every column is null."""
    return df.na.drop(how="all")


def fill(df: DataFrame, values: dict) -> DataFrame:
    """P5: per-column defaults; date defaults go through ``coalesce`` because
    ``na.fill`` does not take dates."""
    plain = {k: v for k, v in values.items() if not isinstance(v, dt.date)}
    dates = {k: v for k, v in values.items() if isinstance(v, dt.date)}
    out = df.na.fill(plain) if plain else df
    if dates:
        out = out.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in dates.items()})
    return out


def default_row(schema: T.StructType, overrides: dict | None = None) -> dict:
    """The unknown-member row of a table: key 0 and defaults by type."""
    row = {}
    for f in schema.fields:
        t = f.dataType
        if isinstance(t, T.StringType):
            row[f.name] = MISSING
        elif isinstance(t, T.DateType):
            row[f.name] = DEFAULT_DATE
        elif isinstance(t, T.BooleanType):
            row[f.name] = False
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            row[f.name] = 0.0
        else:
            row[f.name] = 0
    row.update(overrides or {})
    return row


def unknown_member(spark, schema: T.StructType, overrides: dict | None = None) -> DataFrame:
    """The one-row unknown member as a DataFrame."""
    row = default_row(schema, overrides)
    return spark.createDataFrame([tuple(row[f.name] for f in schema.fields)], schema)


def with_unknown_member(df: DataFrame, schema: T.StructType, first_load: bool,
                        overrides: dict | None = None) -> DataFrame:
    """On the first load of a table, add the key-0 row."""
    out = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    if not first_load:
        return out
    return out.unionByName(unknown_member(df.sparkSession, schema, overrides))


def replace_unknown_member(df: DataFrame, key: str, schema: T.StructType,
                           overrides: dict | None = None) -> DataFrame:
    """Drop whatever row was computed for key 0 and add the all-default one."""
    out = df.filter(F.col(key) != 0).select(
        *[F.col(f.name).cast(f.dataType) for f in schema.fields])
    return out.unionByName(unknown_member(df.sparkSession, schema, overrides))
