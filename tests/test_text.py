import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondar.functions import text


def shown(spark, value, kind):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(text.value_text("v", df.schema["v"].dataType)).first()[0]


DOUBLES = [
    1e7, 1.5e7, 123456789.125, 1e16, 1.2345e16, 1e-3, 1.5e-4, 1e-5, 0.1, 100.0,
    float("nan"), float("inf"), float("-inf"), -0.0, -1.25e8, 1.7976931348623157e308,
    9007199254740993.0, -3.25e-4, -1e-7, 12345678.9, 1.5e15, 1e100, 104999.91,
]


def test_doubles_read_like_python_floats(spark):
    df = spark.createDataFrame([(v,) for v in DOUBLES], "v double")
    rows = df.select("v", text.value_text("v", T.DoubleType()).alias("t")).collect()
    assert [r.t for r in rows] == [str(r.v) for r in rows]


def test_each_value_is_written_once(spark):
    """No branch of the text writes its number, time or date a second time."""
    number = text.value_sql("v", T.DoubleType()).replace(" else ", " when ")
    assert max(branch.count("cast(v as string)") for branch in number.split(" when ")) == 1
    moment = text.value_sql("v", T.TimestampNTZType())
    assert moment.startswith("if(cast(v as string) >= '0001', rpad(")
    rows = spark.sql(
        "select explode(array(timestamp_ntz'0001-01-01 00:00:00.5', timestamp_ntz'9999-12-31 23:59:59')) as v"
    )
    assert [r[0] for r in rows.select(text.value_text("v", T.TimestampNTZType())).collect()] == [
        "0001-01-01T00:00:00.500000", "9999-12-31T23:59:59",
    ]


@pytest.mark.parametrize(
    ("value", "kind", "expected"),
    [
        (dt.datetime(2024, 1, 2, 3, 4, 5), "timestamp_ntz", "2024-01-02T03:04:05"),
        (dt.datetime(2024, 1, 2, 3, 4, 5, 60), "timestamp_ntz", "2024-01-02T03:04:05.000060"),
        (dt.date(2024, 1, 2), "date", "2024-01-02"),
        (decimal.Decimal("1.20"), "decimal(5,2)", "1.20"),
        (bytearray(b"raw"), "binary", "cmF3"),
        (True, "boolean", "True"),
        (False, "boolean", "False"),
        (7, "int", "7"),
        ("x", "string", "x"),
        (None, "double", None),
        (None, "boolean", None),
        (None, "timestamp_ntz", None),
        ([dt.date(2024, 1, 2)], "array<date>", '["2024-01-02"]'),
        ({1: bytearray(b"raw")}, "map<int,binary>", '{"1":"cmF3"}'),
        ((dt.date(2024, 1, 2), None), "struct<a:date,b:int>", '{"a":"2024-01-02","b":null}'),
    ],
)
def test_value_text(spark, value, kind, expected):
    assert shown(spark, value, kind) == expected


def test_zoned_time_carries_its_offset(spark):
    value = spark.sql("select timestamp '2024-01-02 03:04:05' as v")
    assert value.select(text.value_text("v", T.TimestampType())).first()[0] == (
        "2024-01-02T03:04:05+00:00"
    )


def test_json_ready_keeps_numbers(spark):
    df = spark.createDataFrame(
        [(1, 2.5, True, dt.date(2024, 1, 2), bytearray(b"raw"))],
        "a int, b double, c boolean, d date, e binary",
    )
    assert tuple(text.json_ready(df).first()) == (1, 2.5, True, "2024-01-02", "cmF3")


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("value", "expected"),
    [("  a \n", "a"), (" \t\n ", None), ("", None), (None, None), (" x ", "x")],
)
def test_blank_to_null(spark, value, expected):
    assert one(spark, value, text.blank_to_null) == expected


def test_shortened(spark):
    assert one(spark, "x" * 120, text.shortened) == "x" * 120
    assert one(spark, "x" * 119 + "  yy", text.shortened) == "x" * 119 + "…"
    assert one(spark, None, text.shortened) is None


def test_yaml_scalar_and_cell(spark):
    assert one(spark, 'a "b": c\nd', text.yaml_scalar) == '"a \\"b\\": c\\nd"'
    assert one(spark, " a|b\nc ", text.table_cell) == "a\\|b c"
