"""Every registered query against its SQL on a second engine."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from tests.conftest import SMALL

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{name}'")
    return con


def text(value):
    if value is None or value is pd.NaT or value is pd.NA or value != value:
        return None
    return repr(float(value)) if isinstance(value, (int, float)) else str(value)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    cells = frame.astype(object).map(text)
    return list(frame.columns), sorted(cells.itertuples(index=False, name=None), key=str)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, SMALL).toPandas()
    assert len(got.columns) > 0
    if name in ORACLES:
        assert rows(got) == rows(duck.execute(ORACLES[name]).fetchdf())
    else:
        assert len(got) > 0


def test_no_oracle_without_query():
    assert set(ORACLES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 16
