"""Every registered query against its SQL in DuckDB, on whole tables."""

import glob
import os
from collections import Counter

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from tidemark.plans import change_checks, checks

DUCK_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def bag(pdf):
    def plain(value):
        if pd.isna(value):
            return None
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            return float(value)
        return str(value)

    return Counter(tuple(map(plain, row)) for row in pdf.astype(object).itertuples(index=False))


def test_every_query_has_sql():
    assert checks.QUERIES is change_checks.QUERIES and checks.QUERIES.keys() == checks.ORACLES.keys()
    assert checks.QUERIES.keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", checks.QUERIES)
def test_query(spark, duck, sf_dir, name):
    df = checks.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    expected = duck.sql(checks.ORACLES[name])
    assert sorted(expected.columns) == columns
    assert {c: DUCK_TYPES[k] for c, k in df.dtypes} == dict(zip(expected.columns, map(str, expected.types)))
    found = df.select(*[f"`{c}`" for c in columns]).toPandas()
    assert len(found) > 0
    assert bag(found) == bag(expected.df()[columns])


def test_entry(spark):
    assert contract.entry(spark).count() > 0
