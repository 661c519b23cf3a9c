import datetime as dt

import pytest
from pyspark.sql import functions as F

from sondar.model import UnknownColumn
from sondar.operators import profile as p

USERS = [(1, "ada"), (2, "bob"), (3, "ada"), (4, "cid"), (None, "ada")]


@pytest.fixture
def users(spark):
    return spark.createDataFrame(USERS, "id bigint, name string")


def row(df, **want):
    (found,) = df.collect()
    for name, value in want.items():
        assert found[name] == value, name
    return found


def tops(found):
    return [(v.value, v["count"]) for v in found.top_values]


def test_null_ratio(users):
    row(p.profile_column(users, "id", "null_ratio"), null_ratio=0.2)


def test_distinct_leaves_null_out(users):
    row(p.profile_column(users, "id", "distinct_count"), distinct_count=4)


def test_min_max_on_the_native_type(spark, users):
    row(p.profile_column(users, "id", "min_max"), min_value="1", max_value="4")
    numbers = spark.createDataFrame([(9,), (10,)], "n int")
    row(p.profile_column(numbers, "n", "min_max"), min_value="9", max_value="10")


def test_top_values_break_ties_by_value(users):
    found = row(p.profile_column(users, "name", "top_values"))
    assert tops(found) == [("ada", 3), ("bob", 1), ("cid", 1)]


def test_null_is_a_top_value_shown_empty(users):
    found = row(p.profile_column(users, "id", "top_values"))
    assert tops(found) == [("1", 1), ("2", 1), ("3", 1), ("4", 1), ("", 1)]
    assert found.top_values[-1].is_null


def test_twenty_top_values_at_most(spark):
    wide = spark.range(50).select(F.col("id").cast("string").alias("v"))
    assert len(row(p.profile_column(wide, "v", "top_values")).top_values) == 20


def test_empty_table(spark):
    blank = spark.createDataFrame([], "id bigint, name string")
    by_name = {r.column_name: r for r in p.table_profile(blank, list(p.ALL_MODES)).collect()}
    for found in by_name.values():
        assert found.null_ratio is None
        assert found.min_value is None and found.max_value is None
        assert found.distinct_count == 0
        assert found.top_values == []


def test_modes_follow_the_type(spark):
    df = spark.createDataFrame(
        [("a", 1, dt.datetime(2024, 1, 2), True, bytearray(b"x"), [1])],
        "s string, n int, t timestamp_ntz, b boolean, y binary, a array<int>",
    )
    found = {r.column_name: r for r in p.table_profile(df).collect()}
    assert found["s"].top_values and found["s"].distinct_count == 1
    assert found["s"].min_value is None
    assert found["n"].min_value == "1" and found["n"].distinct_count is None
    assert found["t"].min_value == "2024-01-02T00:00:00"
    assert found["b"].top_values[0].value == "True"
    for name in "ya":
        assert found[name].null_ratio == 0.0
        assert found[name].min_value is None and found[name].top_values is None


@pytest.mark.parametrize("rows", [200, 201])
def test_gate_on_distinct_values(spark, rows):
    df = spark.range(rows).select(F.col("id").cast("string").alias("v"))
    found = row(p.table_profile(df, max_distinct=200), distinct_count=rows)
    assert (found.top_values is None) == (rows > 200)
    assert len(row(p.table_profile(df), distinct_count=rows).top_values) == 20
    named = row(p.table_profile(df, ["top_values"]))
    assert len(named.top_values) == 20


def test_gate_holds_when_the_first_rows_are_alike(spark):
    """Many values that the probe of the first rows cannot see."""
    df = spark.range(0, 6000, 1, 1).select(
        F.when(F.col("id") < 5000, F.lit("same")).otherwise(F.col("id").cast("string")).alias("v")
    )
    found = row(p.table_profile(df, max_distinct=200), distinct_count=1001)
    assert found.top_values is None


def test_long_values_are_told_apart_exactly(spark):
    df = spark.range(3000).select(
        F.concat(F.repeat(F.lit("x"), 254), (F.col("id") % 1500).cast("string")).alias("v")
    )
    row(p.table_profile(df, max_distinct=200), distinct_count=1500, null_ratio=0.0, top_values=None)


def test_nulls_of_a_wide_column(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 4 != 0, F.col("id").cast("string")).alias("v")
    )
    row(p.table_profile(df), distinct_count=750, null_ratio=0.25)


def test_empty_mode_list_gathers_nothing(users):
    for found in p.table_profile(users, []).collect():
        assert found.null_ratio is None and found.distinct_count is None


def test_approximate_is_flagged(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("v"))
    found = row(p.table_profile(df, approximate=True), approximate=True)
    assert abs(found.distinct_count - 20000) < 0.15 * 20000
    assert found.null_ratio == 0.0


def test_zero_and_minus_zero_are_one_value(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,)], "v double")
    row(p.profile_column(df, "v", "distinct_count"), distinct_count=1)


def test_every_type_takes_every_mode(spark):
    df = spark.sql(
        "select date '2024-01-02' as d, timestamp_ntz '2024-01-02 03:04:05.5' as t, "
        "timestamp '2024-01-02 03:04:05' as z, 1.20bd as n, cast(1.5 as float) as f, "
        "true as b, x'726177' as y, array(1, 2) as a, map('k', 1) as m, "
        "named_struct('k', map('x', 1)) as s, parse_json('[1]') as v, interval '1' day as i, "
        "null as u, 'x' as c, 7 as l"
    )
    df = df.unionAll(df.selectExpr(*[f"null as {c}" for c in df.columns]))
    found = {r.column_name: r for r in p.table_profile(df, list(p.ALL_MODES)).collect()}
    shown = {name: r.top_values[0].value or r.top_values[1].value for name, r in found.items() if name != "u"}
    assert {k: shown[k] for k in "dtznfbyamsvcl"} == {
        "d": "2024-01-02", "t": "2024-01-02T03:04:05.500000", "z": "2024-01-02T03:04:05+00:00",
        "n": "1.20", "f": "1.5", "b": "True", "y": "cmF3", "a": "[1,2]", "m": '{"k":1}',
        "s": '{"k":{"x":1}}', "v": "[1]", "c": "x", "l": "7",
    }
    for name, r in found.items():
        assert r.null_ratio == (1.0 if name == "u" else 0.5), name
        assert r.distinct_count == (0 if name == "u" else 1), name
        assert (r.min_value is None) == (name in "ymsvu"), name
    exact = {r.column_name: r.distinct_count for r in p.distinct_counts(df, df.columns).collect()}
    assert exact == {name: r.distinct_count for name, r in found.items()}


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "x")], "`a.b` int, `it's `` \\\\ odd` string")
    names = [r.column_name for r in p.table_profile(df).orderBy("ordinal").collect()]
    assert names == df.columns


def test_unknown_column_and_mode(users):
    with pytest.raises(UnknownColumn):
        p.profile_column(users, "nope", "null_ratio")
    with pytest.raises(ValueError):
        p.table_profile(users, ["median"])


def test_mode_map(users):
    found = {r.column_name: r.profile for r in p.as_mode_map(p.table_profile(users)).collect()}
    assert set(found["id"]) == {"null_ratio", "min_max"}
    assert set(found["name"]) == {"null_ratio", "distinct_count", "top_values"}
    assert found["name"]["distinct_count"].distinct_count == 3


def test_plan_shape(spark, sf):
    """Map-side counts, one shuffle of the values, no row multiplied, no Python."""
    lineitem = spark.read.parquet(f"{sf}/lineitem.parquet")
    plan = p.table_profile(lineitem)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
    assert "Expand" not in plan
    assert "WindowGroupLimit" in plan
    light = p.light_profile(lineitem, lineitem.columns[:2], [])
    scan = light._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in scan.split("ReadSchema")[1]


def test_bitmaps_count_exactly(spark):
    low, high = -(2**63), 2**63 - 1
    values = [None, None, 0, 1, -1, 32768, -32768, 32769, -32769, 65536, low, high, low + 1, high - 1, 1, 0, *range(-40_000, 40_000, 7)]
    df = spark.createDataFrame([(v, dt.date(2000, 1, 1) + dt.timedelta(days=(v or 0) % 300)) for v in values], "n bigint, d date").repartition(3)
    by_name = {r.column_name: r for r in p.bitmap_counts(df, ["n", "d"]).collect()}
    assert by_name["n"].distinct_count == len({v for v in values if v is not None})
    assert (by_name["n"].rows, by_name["n"].nulls) == (len(values), 2)
    assert by_name["d"].distinct_count == len({(v or 0) % 300 for v in values})
    with pytest.raises(TypeError):
        p.bitmap_counts(df.selectExpr("cast(n as string) as n"), ["n"])
    assert p.bitmap_counts(df.limit(0), ["n"]).count() == 0


def test_bitmaps_only_where_values_lie_close(spark):
    df = spark.range(200_000).selectExpr(
        "id as close", "id * 1000003 as apart", "cast(id as string) as text", "date_add(date'2000-01-01', cast(id % 3000 as int)) as day",
        "cast(null as int) as none")
    assert set(p.dense_columns(df, df.columns)) == {"close", "day", "none"}
    found = {r.column_name: r.distinct_count for r in p.table_profile(df, ["distinct_count"]).collect()}
    assert found == {"close": 200_000, "apart": 200_000, "text": 200_000, "day": 3000, "none": 0}


def test_wide_tables_are_profiled_in_blocks(spark, monkeypatch):
    wide = spark.range(30).selectExpr(*[f"id % {i + 1} as n{i}" for i in range(20)], *[f"cast(id % {i + 1} as string) as s{i}" for i in range(20)])
    want = p.table_profile(wide).orderBy("ordinal").collect()
    monkeypatch.setattr(p, "BLOCK", 7)
    assert p.table_profile(wide).orderBy("ordinal").collect() == want and len(want) == 40


def test_three_thousand_columns(spark):
    wide = spark.range(20).selectExpr(*[f"id + {i} as c{i}" if i % 2 else f"cast(id % {i + 1} as string) as c{i}" for i in range(3000)])
    plan = p.table_profile(wide, ["null_ratio", "min_max"])
    found = {r.column_name: r for r in plan.collect()}
    assert len(found) == 3000 and found["c2999"].min_value == "2999" and found["c2999"].ordinal == 3000
