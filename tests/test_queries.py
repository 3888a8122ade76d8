"""Every registered query against plain SQL in DuckDB on the same tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from fixtures import oracle, runs

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
         "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


def comparable(df, dates):
    df = df[sorted(df.columns)].copy()
    for column in df:
        if column in dates:
            df[column] = pd.to_datetime(df[column]).dt.date
        elif str(df[column].dtype).startswith("datetime"):
            df[column] = df[column].astype("datetime64[us]")
        df[column] = df[column].map(
            lambda v: "-" if pd.isna(v) else repr(float(v)) if isinstance(v, float) else str(v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def test_every_query_has_an_oracle():
    assert set(runs.queries()) == set(oracle.oracle_sql())
    assert set(runs.queries()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", list(runs.queries()))
def test_query(spark, duck, name):
    got = entry_module.queries()[name](spark, SF_DIR)
    wanted = duck.execute(entry_module.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in wanted.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in got.schema} == types
    dates = {column for column, kind in types.items() if kind == "DATE"}
    assert comparable(got.toPandas(), dates).equals(comparable(wanted.df(), dates))


def test_entry(spark):
    assert entry_module.entry(spark).count() == 5
