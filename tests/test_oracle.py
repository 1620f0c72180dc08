"""Every registered query against its SQL in DuckDB, on whole tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from telemetra.plans import catalog

SF_DIR = "/root/testdata/sf0.01"
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def normal(rows):
    return sorted(tuple(repr(v) for v in row) for row in rows)


def test_every_query_has_sql():
    assert catalog.QUERIES.keys() == catalog.SQL.keys()
    assert catalog.QUERIES.keys() <= entry.queries().keys()


def test_entry(spark):
    scored = entry.entry(spark)
    assert scored.count() > 0
    assert {"ml_anomaly", "ml_confidence", "ml_prediction"} <= set(scored.columns)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    found = entry.queries()[name](spark, SF_DIR)
    expected = duck.sql(entry.oracle_sql()[name])
    types = {c: TYPES[str(t)] for c, t in zip(expected.columns, expected.types)}
    assert {f.name: f.dataType.simpleString() for f in found.schema} == types
    columns = sorted(found.columns)
    rows = found.select(*[f"`{c}`" for c in columns]).collect()
    assert normal(rows) == normal(expected.select(*[f'"{c}"' for c in columns]).fetchall())
