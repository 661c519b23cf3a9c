"""Registered queries against their SQL, on the smallest given tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from workload import TABLES, registry

# One or two of each kind; tools/check.py runs them all.
CHECKED = [
    "profile_top_values",
    "table_profile_events",
    "table_profile_documents",
    "detect_by_values",
    "mask_table",
    "document_schema",
    "schema_changes",
    "sync_columns",
    "search_first_50",
    "export_result",
    "postgres_columns",
    "lake_datasets",
    "lake_json",
]


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as from read_parquet('{sf}/{name}.parquet')")
    return connection


def in_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_its_sql(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert in_order(df.columns, map(tuple, df.collect())) == in_order(columns, result.fetchall())


def test_every_query_has_its_sql():
    assert set(registry.queries) == set(registry.sql)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() == 11
