import duckdb
import pytest

import __spark_entry__ as entry
from sondar.llm.queries import SQL


def test_one_query_for_each_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, sf, name):
    duck = duckdb.connect()
    for table in ("pages", "embeddings", "conversations"):
        duck.execute(f"create view {table} as from read_parquet('{sf}/{table}.parquet')")
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    df = entry.queries()[name](spark, sf)
    assert sorted(df.columns) == sorted(columns)
    rows = sorted((tuple(r[c] for c in sorted(columns)) for r in df.collect()), key=repr)
    want = sorted((tuple(v for _, v in sorted(zip(columns, r))) for r in result.fetchall()), key=repr)
    assert rows == want
