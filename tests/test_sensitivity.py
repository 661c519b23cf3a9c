import pytest
from pyspark.sql import functions as F

from sondar.functions import masking
from sondar.functions.fixed import VALUE_NEEDS
from sondar.functions.sql import literal
from sondar.operators import sensitivity as s


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "column_name string")


def test_flatten(spark):
    rows = names(spark, "user_email", "userEmail", "USER-EMAIL", "e_mail").select(
        masking.flatten_name(F.col("column_name"))
    )
    assert [r[0] for r in rows.collect()] == ["useremail"] * 3 + ["email"]


@pytest.mark.parametrize(
    ("level", "columns"),
    [
        ("pii", ["email", "user_email", "phone", "mobile_no", "ssn", "passport_no", "iban",
                 "card_number", "postcode", "home_address", "birth_date", "dob", "first_name",
                 "lastName", "latitude"]),
        ("secret", ["password", "api_key", "access_token", "secret"]),
        (None, ["id", "total", "created_at", "status", "quantity", "description"]),
    ],
)
def test_by_name(spark, level, columns):
    assert {r.sensitivity for r in s.by_name(names(spark, *columns)).collect()} == {level}


def test_patterns_are_tried_on_texts_that_can_match(spark):
    """No pattern is run over a text too short for it, and none is missed for that."""
    texts = ["a@b.cc", " a@b.cc ", "012345678", "\t012345678\n", "+012345678", "000-11-2222", "0000000000000",
             "0 1 2 3 4 5 6 7 8 9 0 1 2", "01234567", "38291.12", "", "quay", None]
    df = spark.createDataFrame([(v,) for v in texts], "v string")
    tried = df.selectExpr(*[f"v rlike {literal(p)} and not ({n.format('v')}) as x{i}"
                            for i, (n, p) in enumerate(zip(VALUE_NEEDS, masking.value_regexes(), strict=True))])
    assert not any(any(row) for row in tried.collect())
    plan = s.by_values(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("length(v#") >= 3 and "Contains(v#" in plan


def judge(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return s.by_values(df).first().sensitivity


@pytest.mark.parametrize(
    ("values", "level"),
    [
        (["mill@weir.nl", "pump.7@sluice.dk", "gate+1@dyke.example"], "pii"),
        (["+31 20 555 01 99", "030.555.0142", "5550 1234 77", "quay"], "pii"),
        (["\t0455-501-773", "0455501774  ", "0455 501 775"], "pii"),
        (["900-11-2233", "900-11-2234", "900-11-2235", "900-11-2236"], "pii"),
        (["6011 0000 0000 0004", "6011-0000-0000-0012", "6011000000000020"], "pii"),
        (["mill@weir.nl", "barge", "buoy", "tide", "rope", "sail"], None),
        (["mill@weir.nl", "gate@dyke.dk"], None),
        (["", "mill@weir.nl", None, "gate@dyke.dk", None, "lock@canal.se", ""], "pii"),
        (["mill@weir.nl", "gate@dyke.dk", "lock@canal.se", "ebb", "flow", "slack"], None),
        ([], None),
    ],
)
def test_by_values(spark, values, level):
    assert judge(spark, values) == level


@pytest.mark.parametrize(
    ("value", "level", "expected"),
    [
        ("keeper@lighthouse.se", "pii", "k***@***.se"),
        ("q@north.pier.org.nz", "pii", "q***@***.nz"),
        ("bosun@deck", "pii", "b***@***"),
        ("mate@.se", "pii", "m***@***"),
        ("@pier.nz", "pii", "***@***.nz"),
        ("z@pier.", "pii", "z***@***."),
        ("two@ats@pier.nz", "pii", "t***@***.nz"),
        ("tide-table", "secret", "***"),
        ("buoy", "pii", "***"),
        ("buoys", "pii", "bu***ys"),
        ("+4655501773", "pii", "+4***73"),
        (None, "pii", None),
        (None, "secret", None),
        ("", "pii", "***"),
    ],
)
def test_mask(spark, value, level, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert s.mask_table(df, {"v": level}).first()[0] == expected


def test_mask_leaves_other_columns_and_turns_numbers_to_text(spark):
    df = spark.createDataFrame([(1, 455501773)], "id int, phone bigint")
    masked = s.mask_table(df, {"phone": "pii", "id": "none"})
    assert tuple(masked.first()) == (1, "45***73")
    assert s.mask_table(df, {}).columns == df.columns


CONTACTS = [(i, f"berth{i}@quay{i}.se", "moored", f"04555017{i:02d}") for i in range(40)]


@pytest.fixture
def contacts(spark):
    return spark.createDataFrame(CONTACTS, "id int, email string, remark string, reach string")


@pytest.mark.parametrize("full", [False, True])
def test_detect(contacts, full):
    found = {r.column_name: r.sensitivity for r in s.detect(contacts, full=full).collect()}
    assert found == {"email": "pii", "reach": "pii"}


def test_detect_reads_no_values_when_names_settle_it(spark):
    broken = spark.range(5).select(F.raise_error(F.lit("read")).cast("string").alias("email"))
    assert [r.sensitivity for r in s.detect(broken).collect()] == ["pii"]


def test_recorded_verdict_wins(contacts):
    levels = s.sensitive_columns(contacts, {"email": "none", "remark": "secret"})
    assert levels == {"remark": "secret", "reach": "pii"}


def test_masked_sample(contacts):
    rows, hidden = s.masked_sample(contacts, 2, order_by=["id"])
    assert hidden == ["email", "reach"]
    assert [tuple(r) for r in rows.collect()] == [
        (0, "b***@***.se", "moored", "04***00"),
        (1, "b***@***.se", "moored", "04***01"),
    ]


def test_sample_is_clamped(contacts):
    assert s.sample(contacts, -1).count() == 0
    assert s.sample(contacts, 1000, max_rows=5).count() == 5
    assert s.sample(contacts).count() == 3


def test_record_detected(spark):
    columns = spark.createDataFrame(
        [("a", None, None), ("b", "none", "human"), ("c", "pii", "detected"), ("d", "pii", "detected")],
        "column_name string, sensitivity string, sensitivity_source string",
    )
    new = spark.createDataFrame(
        [("a", "pii"), ("b", "pii"), ("c", "secret"), ("zz", "pii")],
        "column_name string, sensitivity string",
    )
    found = {r.column_name: (r.sensitivity, r.sensitivity_source) for r in s.record_detected(columns, new).collect()}
    assert found == {
        "a": ("pii", "detected"),
        "b": ("none", "human"),
        "c": ("secret", "detected"),
        "d": ("pii", "detected"),
    }


def test_with_recorded(spark):
    det = spark.createDataFrame([("a", "pii"), ("b", "pii")], "column_name string, sensitivity string")
    rec = spark.createDataFrame([("a", "none"), ("c", "secret")], "column_name string, sensitivity string")
    found = {r.column_name: r.sensitivity for r in s.with_recorded(det, rec).collect()}
    assert found == {"b": "pii", "c": "secret"}


def test_raw_rows_need_the_grant(contacts):
    from sondar.model import NotPermitted
    from sondar.operators.browse import Access

    with pytest.raises(NotPermitted):
        s.sample_for(contacts, Access.from_claims({}), masked=False)
    with pytest.raises(NotPermitted):
        s.sample_for(contacts, Access.from_claims({"allow_raw_sample": "yes"}), masked=False)
    granted = Access.from_claims({"allow_raw_sample": True})
    assert s.sample_for(contacts, granted, 2, masked=False).count() == 2
    assert s.sample_for(contacts, Access(), 2).count() == 2


def test_many_columns_are_judged_in_blocks(spark, monkeypatch):
    from sondar.operators import sensitivity

    df = spark.range(6).selectExpr(*[
        f"concat('u', id, '@x.org') as a{i}" if i % 3 == 0 else f"concat('word ', id) as a{i}" for i in range(20)])
    want = sorted(sensitivity.by_values(df).collect())
    monkeypatch.setattr(sensitivity, "BLOCK", 6)
    assert sorted(sensitivity.by_values(df).collect()) == want
    assert sum(r.sensitivity == "pii" for r in want) == 7
