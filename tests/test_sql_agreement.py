"""Every query beside its SQL statement: same columns, types, rows and values."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tailwake.plans import catalog

TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
    "float": "FLOAT", "boolean": "BOOLEAN", "date": "DATE",
}
# The text queries have tests of their own, in a folder that can be taken out with them.
QUERIES = {name: entry.queries()[name] for name in catalog.QUERIES}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}
WITHOUT_SQL = {
    "kafka_payload", "event_emission", "gold_json",
    "ml_delay_predict", "prediction_sample", "spatial_clusters", "stream_predict",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def in_order(rows):
    return sorted(rows, key=lambda row: [(v is None, str(type(v)), 0 if v is None else v) for v in row])


def test_registry():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_agreement(spark, duck, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    relation = duck.sql(SQL[name])
    columns = sorted(frame.columns)
    assert columns == sorted(relation.columns)
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: TYPES[frame.schema[c].dataType.simpleString()] for c in columns} == types
    ours = in_order(tuple(row[c] for c in columns) for row in frame.collect())
    theirs = in_order(relation.select(*[f'"{c}"' for c in columns]).fetchall())
    assert ours == theirs


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0
    assert frame.columns[:2] == ["report_date", "airline_icao"]
