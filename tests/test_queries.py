"""Every graph query against its SQL twin on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from weftgraph.plans.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


def plain(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    return sorted(tuple("" if v is None or v is pd.NA or v != v else str(v if isinstance(v, str) else int(v)) for v in row) for row in df.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, duck, name):
    got, want = QUERIES[name](spark, DATA).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)
