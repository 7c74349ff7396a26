"""Every registered query against its DuckDB SQL on the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from scriptorium import bindings as B
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


def _norm(v):
    import numpy as np
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, np.generic):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(df):
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(B.ORACLE))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_every_query_has_an_oracle_or_is_listed():
    no_sql = set(B.QUERIES) - set(B.ORACLE)
    assert no_sql == {"full_load"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 1
    assert "participants" in df.columns
