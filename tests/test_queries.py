"""Every query that has SQL against that SQL, on the smallest tables."""

import os

import pandas as pd
import pytest

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def sql(data):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{data}/{f}'")
    return con


def one(v):
    if hasattr(v, "__len__") and not isinstance(v, str):
        return repr([str(x) for x in v])
    if pd.isna(v):
        return None
    return (str(int(v)) if v == int(v) else f"{v:.9g}") if isinstance(v, float) else str(v)


def table(df):
    df = df[sorted(df.columns)].astype(object)
    for c in df.columns:
        df[c] = [one(v) for v in df[c]]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, data, sql, name):
    got, want = table(entry.queries()[name](spark, data).toPandas()), table(sql.sql(entry.oracle_sql()[name]).df())
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_entry(spark, data):
    assert entry.entry(spark).columns == ["hash", "n", "first_id", "last_id"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
