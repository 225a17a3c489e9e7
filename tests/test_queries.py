"""Every registered record query against its SQL on the smallest tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from recordloom.plans import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


def plain(v):
    v = v.item() if isinstance(v, np.generic) else v
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, pd.Timestamp):
        return str(v)
    return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def rows(df, columns):
    return sorted((tuple(map(plain, r)) for r in df[columns].itertuples(index=False)), key=repr)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{FOLDER}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    got, want = QUERIES[name](spark, FOLDER).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, sorted(got.columns)) == rows(want, sorted(got.columns))


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
