"""Every registered query with SQL against DuckDB at the smallest scale."""

import os

import duckdb
import pandas as pd
import pytest

from sievework.plans.queries import ORACLE_SQL, QUERIES

from .conftest import SF


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in os.listdir(SF):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{SF}/{name}'")
    return con


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    return v.item() if hasattr(v, "item") else v


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(plain(x) for x in r) for r in df[cols].astype(object).values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(duck.execute(ORACLE_SQL[name]).df())


def test_entry_registers_all(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
