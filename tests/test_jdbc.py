import pytest

from sondar.sources import jdbc, opening
from sondar.sources.jdbc import slice_options


def test_slices():
    assert slice_options("id", 1, 100, 4) == {
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "100",
        "numPartitions": "4",
    }
    with pytest.raises(ValueError):
        slice_options("id", 1, 2, 0)


def whole(rows, spark, predicates):
    """Every row meets exactly one of the conditions."""
    spark.createDataFrame([(r,) for r in rows], "k string").createOrReplaceTempView("sliced")
    parts = [spark.sql(f"select k from sliced where {p}").collect() for p in predicates]
    assert sorted((r.k for part in parts for r in part), key=str) == sorted(rows, key=str)
    return [len(part) for part in parts]


def test_predicates_are_disjoint_and_complete(spark):
    rows = [None, "", "a", "it's", "m", "mm", "z", "Ö"]
    assert whole(rows, spark, jdbc.range_predicates("k", ["b", "it's", "n"])) == [3, 0, 3, 2]
    assert whole(rows, spark, jdbc.range_predicates("k", [])) == [8]
    assert len(whole(rows, spark, jdbc.hash_predicates("hash(k)", 3))) == 3
    assert whole([None, None], spark, jdbc.hash_predicates("cast(k as int)", 2)) == [2, 0]
    with pytest.raises(ValueError):
        jdbc.range_predicates("k", [1, 1])
    assert jdbc.range_predicates("n", [1, 2.5]) == ["n < 1 or n is null", "n >= 1 and n < 2.5", "n >= 2.5"]


def test_names_of_a_listing_are_quoted(monkeypatch, spark):
    asked = []
    monkeypatch.setattr(jdbc, "read_table", lambda _spark, url, name, **options: asked.append((name, options)))
    opened = opening.jdbc_tables(spark, "jdbc:x", slices=4)
    opened("dbo", 'dbo.odd"name')
    opening.jdbc_tables(spark, "jdbc:x", quote="[")("", "odd]name")
    assert asked == [('"dbo"."odd""name"', {"slices": 4}), ("[odd]]name]", {})]
    assert opening.by_schema({"dbo": opened})("other", "t") is None
