import pytest
from pyspark.sql import functions as F

from sondar.functions.types import document_type
from sondar.operators import documents as d


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "n int, doc string")


def schema(frame, **options):
    rows = d.infer_schema(frame, "doc", order_by=["n"], **options).orderBy("ordinal").collect()
    return [(r.column_name, r.ordinal, r.native_type, r.nullable, r.is_pk) for r in rows]


def test_union_of_fields(spark):
    frame = docs(
        spark,
        '{"_id":1,"email":"a","age":30}',
        '{"_id":2,"email":"b"}',
        '{"_id":3,"email":null,"age":41}',
    )
    for sample in (100, None):
        assert schema(frame, sample_documents=sample) == [
            ("_id", 1, "int", False, True),
            ("email", 2, "string", True, False),
            ("age", 3, "int", True, False),
        ]


def test_mixed_null_and_nested(spark):
    assert schema(docs(spark, '{"v":"a"}', '{"v":1}', '{"v":null}')) == [
        ("v", 1, "int|string", True, False)
    ]
    assert schema(docs(spark, '{"v":null}')) == [("v", 1, "", True, False)]
    assert schema(docs(spark, '{"p":{"c":1},"t":["a"]}')) == [
        ("p", 1, "object", False, False),
        ("t", 2, "array", False, False),
    ]


def test_written_order_and_empty_documents(spark):
    assert schema(docs(spark, "{}", '{"z":1,"a":2}')) == [
        ("z", 1, "int", True, False),
        ("a", 2, "int", True, False),
    ]


def test_sample_bounds_what_is_seen(spark):
    frame = docs(spark, '{"a":1}', '{"a":2,"b":1}')
    assert [r[0] for r in schema(frame, sample_documents=1)] == ["a"]
    rows = d.infer_schema(frame.coalesce(1), "doc", sample_documents=1).collect()
    assert len(rows) >= 1


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("true", "bool"),
        ("1", "int"),
        ("2147483647", "int"),
        ("2147483648", "long"),
        ("-2147483649", "long"),
        ("1.5", "double"),
        ("1e3", "double"),
        ('"x"', "string"),
        ("[]", "array"),
        ("{}", "object"),
        ('{"a":1,"b":2}', "object"),
        ("null", None),
        ('{"$oid":"65f0"}', "objectId"),
        ('{"$date":"2024-01-01T00:00:00Z"}', "date"),
        ('{"$numberDecimal":"1.2"}', "decimal"),
        ('{"$binary":{"base64":"AA==","subType":"00"}}', "binData"),
    ],
)
def test_types(spark, text, kind):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(document_type(F.parse_json("t"))).first()[0] == kind


def test_profile(spark):
    frame = docs(
        spark,
        '{"_id":1,"s":"a","n":5,"m":1}',
        '{"_id":2,"s":"a","n":null,"m":"x"}',
        '{"_id":3,"s":"b","n":7.5}',
        '{"_id":4,"n":-2,"o":{"k":1}}',
    )
    inferred = d.infer_schema(frame, "doc", order_by=["n"])
    found = {r.column_name: r for r in d.document_profile(frame, "doc", inferred).collect()}
    assert found["_id"].min_value == "1" and found["_id"].max_value == "4"
    assert found["s"].null_ratio == 0.25 and found["s"].distinct_count == 2
    tops = [(v.value, v["count"]) for v in found["s"].top_values]
    assert tops == [("a", 2), ("", 1), ("b", 1)]
    assert found["n"].native_type == "double|int" and found["n"].min_value is None
    assert found["n"].null_ratio == 0.25
    assert found["m"].null_ratio == 0.5 and found["m"].top_values is None
    assert found["o"].null_ratio == 0.75


def test_typed_values(spark):
    frame = docs(
        spark,
        '{"d":{"$date":"2024-01-02T03:04:05Z"},"t":{"$timestamp":{"t":1704164645,"i":1}},'
        '"n":{"$numberDecimal":"10.5"},"l":{"$numberLong":"5"},"b":true}',
        '{"d":{"$date":{"$numberLong":"1704164646500"}},"t":{"$timestamp":{"t":1704164646,"i":1}},'
        '"n":{"$numberDecimal":"9.25"},"l":{"$numberLong":"40"},"b":null}',
    )
    inferred = d.infer_schema(frame, "doc", order_by=["n"])
    found = {r.column_name: r for r in d.document_profile(frame, "doc", inferred).collect()}
    assert {n: r.native_type for n, r in found.items()} == {
        "d": "date", "t": "timestamp", "n": "decimal", "l": "long", "b": "bool",
    }
    ranges = {n: (r.min_value, r.max_value) for n, r in found.items()}
    assert ranges["d"] == ("2024-01-02T03:04:05+00:00", "2024-01-02T03:04:06.500000+00:00")
    assert ranges["t"] == ("2024-01-02T03:04:05+00:00", "2024-01-02T03:04:06+00:00")
    assert ranges["l"] == ("5", "40")
    assert ranges["n"] == ("9.25", "10.5")
    assert found["b"].null_ratio == 0.5 and found["b"].distinct_count == 1


def test_malformed_documents_fail(spark):
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        schema(docs(spark, "not json"))


def test_values_that_do_not_fit_are_no_missing_ones(spark):
    frame = docs(
        spark,
        '{"v":1,"n":{"$numberDecimal":"123456789012345678901234567890"}}',
        '{"v":"x","n":{"$numberDecimal":"-0.50"}}',
        '{"v":"y","n":{"$numberDecimal":"1E+3"}}',
        '{"v":null,"n":{"$numberDecimal":"99999999999999999999.125"}}',
    )
    early = spark.createDataFrame(
        [("v", "int", 1), ("n", "decimal", 2)], "column_name string, native_type string, ordinal int"
    )
    found = {r.column_name: r for r in d.document_profile(frame, "doc", early).collect()}
    assert (found["v"].null_ratio, found["v"].unfit_ratio) == (0.25, 0.5)
    assert (found["v"].min_value, found["v"].max_value) == ("1", "1")
    assert (found["n"].null_ratio, found["n"].unfit_ratio) == (0.0, 0.0)
    assert found["n"].min_value == "-0.5"
    assert found["n"].max_value == "123456789012345678901234567890"


def test_too_many_fields_are_refused(spark):
    frame = docs(spark, '{"a":1,"b":2,"c":3}')
    with pytest.raises(ValueError, match="more than 2 fields"):
        d.document_profile(frame, "doc", d.infer_schema(frame, "doc"), max_fields=2)


def test_many_names_are_numbered_part_by_part(spark):
    from sondar.operators.documents import infer_schema, require_fields
    from sondar.plans.scan import Collection

    df = spark.range(2000).selectExpr(
        "id", "concat('{', array_join(transform(sequence(0, 99), i -> concat('\"k', id * 100 + i, '\":1')), ','), '}') as d")
    schema = infer_schema(df, "d", order_by=["id"])
    # Each part numbers its own rows; the one exchange left brings a count of documents a task.
    assert "Window" not in schema._jdf.queryExecution().toString()
    rows = schema.selectExpr("count(1) as n", "max(ordinal) as last", "count_if(column_name <> concat('k', ordinal - 1)) as wrong").first()
    assert tuple(rows) == (200_000, 200_000, 0)
    with pytest.raises(ValueError, match="are its keys data"):
        require_fields(schema, "d")
    with pytest.raises(ValueError, match="are its keys data"):
        Collection(df, "d", ["id"], max_fields=100).fields
