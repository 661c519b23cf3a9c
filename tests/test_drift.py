import datetime as dt

import pytest
from pyspark.sql import functions as F

from sondar.model import COLUMNS, CONTAINERS, LISTED_COLUMNS, LISTED_CONTAINERS, UnknownContainer, ddl
from sondar.operators import drift, inventory


def now():
    return F.lit(dt.datetime(2024, 6, 1))



def listed(spark, shape, errors=(), comments=None):
    """(containers, columns) from {container: [(column, type), ...]}."""
    comments = comments or {}
    containers = spark.createDataFrame(
        [("shop", "", n, "table", None, comments.get(n), None, "OSError: gone" if n in errors else None) for n in shape],
        ddl({**LISTED_CONTAINERS, "error": "string"}),
    )
    columns = spark.createDataFrame(
        [
            ("shop", "", n, c, i, kind, True, False, False, None, None, None)
            for n, fields in shape.items()
            for i, (c, kind) in enumerate(fields, 1)
        ],
        ddl(LISTED_COLUMNS),
    )
    return containers, columns


class Inventory:
    """Two frames and the scan step over them."""

    def __init__(self, spark):
        self.spark = spark
        self.containers = spark.createDataFrame([], ddl(CONTAINERS))
        self.columns = spark.createDataFrame([], ddl(COLUMNS))

    def scan(self, shape, errors=(), covered=True, force=False, comments=None):
        containers, columns = listed(self.spark, shape, errors, comments)
        compared = drift.compare(drift.fingerprint(containers, columns), self.containers, force=force)
        changes = drift.changes(
            compared, columns, self.containers, self.columns, job_id="j", detected_at=now(), covered=covered
        )
        found = sorted(
            (r.container_name, r.change_type, r.detail.asDict() if r.detail else None) for r in changes.collect()
        )
        outcomes = {r.container_name: r.outcome for r in compared.collect()}
        new = inventory.upsert_containers(self.containers, compared, now())
        new_columns = inventory.sync_columns(self.columns, columns, compared, now())
        if covered:
            gone = drift.removed(compared, self.containers)
            new, new_columns = inventory.forget(new, gone), inventory.forget(new_columns, gone)
        self.containers = self.spark.createDataFrame(new.collect(), ddl(CONTAINERS))
        self.columns = self.spark.createDataFrame(new_columns.collect(), ddl(COLUMNS))
        return found, outcomes

    def annotate(self, **notes):
        out = inventory.annotate(self.containers, self.columns, written_at=now(), **notes)
        self.containers = self.spark.createDataFrame(out.containers.collect(), ddl(CONTAINERS))
        self.columns = self.spark.createDataFrame(out.columns.collect(), ddl(COLUMNS))
        return out

    def column(self, container, name):
        return self.columns.where(
            (F.col("container_name") == container) & (F.col("column_name") == name)
        ).first()


FIRST = {"orders": [("id", "INTEGER"), ("total", "REAL")], "users": [("id", "INTEGER"), ("email", "TEXT")]}


@pytest.fixture(scope="module")
def first(spark):
    out = Inventory(spark)
    return out, *out.scan(FIRST)


@pytest.fixture
def inv(spark, first):
    out = Inventory(spark)
    out.containers, out.columns = first[0].containers, first[0].columns
    return out


def test_first_scan_adds(first):
    _, found, outcomes = first
    assert found == [("orders", "container_added", None), ("users", "container_added", None)]
    assert set(outcomes.values()) == {"done"}


def test_columns_added_and_removed(inv):
    found, outcomes = inv.scan({**FIRST, "users": [("id", "INTEGER"), ("created_at", "TEXT")]})
    assert found == [
        ("users", "schema_changed", {"added": ["created_at"], "removed": ["email"], "retyped": None})
    ]
    assert outcomes == {"orders": "skipped", "users": "done"}


def test_retyped(inv):
    found, _ = inv.scan({**FIRST, "users": [("id", "TEXT"), ("email", "TEXT")]})
    assert found == [
        ("users", "schema_changed", {"added": None, "removed": None, "retyped": ["id: INTEGER → TEXT"]})
    ]


def test_comment_alone_is_a_change_without_detail(inv):
    found, _ = inv.scan(FIRST, comments={"users": "people"})
    assert found == [("users", "schema_changed", None)]


def test_removed_only_when_all_was_covered(inv):
    rest = {"users": FIRST["users"]}
    assert inv.scan(rest, covered=False)[0] == []
    assert inv.containers.count() == 2
    assert inv.scan(rest)[0] == [("orders", "container_removed", None)]
    assert inv.containers.count() == 1 and inv.columns.count() == 2


def test_force_rescans_without_a_change(inv):
    found, outcomes = inv.scan(FIRST, force=True)
    assert found == [] and set(outcomes.values()) == {"done"}


def test_failure_is_recorded_and_retried(inv):
    found, outcomes = inv.scan({**FIRST, "users": []}, errors=["users"])
    assert found == [] and outcomes["users"] == "failed"
    users = inv.containers.where("container_name = 'users'").first()
    assert users.error == "OSError: gone" and users.schema_hash
    assert inv.columns.where("container_name = 'users'").count() == 2
    found, outcomes = inv.scan(FIRST)
    assert found == [] and outcomes == {"orders": "skipped", "users": "done"}
    assert inv.containers.where("error is not null").count() == 0


def test_new_container_that_fails(inv):
    found, outcomes = inv.scan({**FIRST, "bad": []}, errors=["bad"])
    assert found == [] and outcomes["bad"] == "failed"
    assert inv.containers.where("container_name = 'bad'").first().schema_hash == ""
    found, _ = inv.scan({**FIRST, "bad": [("x", "INT")]})
    assert found == [("bad", "container_added", None)]


@pytest.mark.parametrize(
    ("field", "value"),
    [
        ("column_name", "'other'"),
        ("ordinal", "ordinal + 10"),
        ("native_type", "'X'"),
        ("nullable", "false"),
        ("is_pk", "true"),
        ("is_fk", "true"),
        ("native_description", "'note'"),
        ("references_container", "'t'"),
        ("references_column", "'c'"),
    ],
)
def test_every_field_counts_in_the_fingerprint(spark, field, value):
    containers, columns = listed(spark, {"t": [("id", "INT")]})

    def digest(cols, cont=containers):
        return drift.fingerprint(cont, cols).first().schema_hash

    assert digest(columns.withColumn(field, F.expr(value))) != digest(columns)


def test_fingerprint_is_stable_and_framed(spark):
    a = drift.fingerprint(*listed(spark, {"t": [("id", "INT"), ("b", "X")]})).first().schema_hash
    again = drift.fingerprint(*listed(spark, {"t": [("id", "INT"), ("b", "X")]})).first().schema_hash
    described = drift.fingerprint(
        *listed(spark, {"t": [("id", "INT"), ("b", "X")]}, comments={"t": "c"})
    ).first().schema_hash
    assert a == again != described


def notes(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "database string, schema_name string, container_name string, column_name string, description string, sensitivity string",
    )


def test_annotation_survives_a_rescan(spark, inv):
    out = inv.annotate(
        container_notes=spark.createDataFrame(
            [("shop", "", "users", "people")], "database string, schema_name string, container_name string, description string"
        ),
        column_notes=notes(
            spark,
            ("shop", "", "users", "email", " where we write ", "none"),
            ("shop", "", "users", "id", None, None),
            ("shop", "", "users", "typo", "x", None),
        ),
        source="human",
    )
    assert out.containers_updated.count() == 1
    assert [r.column_name for r in out.columns_updated.collect()] == ["email"]
    assert [r.column_name for r in out.unknown_columns.collect()] == ["typo"]
    inv.scan({**FIRST, "users": [("email", "VARCHAR"), ("new", "TEXT")]})
    email = inv.column("users", "email")
    assert (email.description, email.description_source, email.sensitivity) == ("where we write", "human", "none")
    assert email.native_type == "VARCHAR"
    assert inv.column("users", "id") is None
    assert inv.column("users", "new").description is None
    users = inv.containers.where("container_name = 'users'").first()
    assert users.description == "people" and users.description_updated_at == dt.datetime(2024, 6, 1)


def test_blank_clears_and_null_leaves(spark, inv):
    inv.annotate(column_notes=notes(spark, ("shop", "", "users", "email", "x", "pii")))
    inv.annotate(column_notes=notes(spark, ("shop", "", "users", "email", None, "secret")))
    email = inv.column("users", "email")
    assert (email.description, email.sensitivity, email.sensitivity_source) == ("x", "secret", "ai")
    inv.annotate(column_notes=notes(spark, ("shop", "", "users", "email", "  ", None)))
    assert inv.column("users", "email").description is None


def test_unknown_container_or_level_is_an_error(spark, inv):
    with pytest.raises(UnknownContainer):
        inv.annotate(column_notes=notes(spark, ("shop", "", "nope", "email", "x", None)))
    with pytest.raises(ValueError):
        inv.annotate(column_notes=notes(spark, ("shop", "", "users", "email", None, "odd")))


def test_profiles_merge_by_mode(spark, inv):
    from sondar.operators.profile import as_mode_map, table_profile

    def record(values, modes):
        data = spark.createDataFrame([(v,) for v in values], "email string")
        found = as_mode_map(table_profile(data, modes)).select(
            F.lit("shop").alias("database"), F.lit("").alias("schema_name"),
            F.lit("users").alias("container_name"), "*",
        )
        stranger = found.withColumn("column_name", F.lit("gone"))
        merged = inventory.merge_profiles(inv.columns, found.unionByName(stranger))
        inv.columns = spark.createDataFrame(merged.collect(), ddl(COLUMNS))

    record(["a", None], ["null_ratio", "distinct_count"])
    record(["a", "b"], ["distinct_count"])
    profile = inv.column("users", "email").profile
    assert set(profile) == {"null_ratio", "distinct_count"}
    assert profile["null_ratio"].null_ratio == 0.5
    assert profile["distinct_count"].distinct_count == 2
    assert inv.column("users", "id").profile is None
    assert inv.columns.count() == 4


def test_outcomes(spark, inv):
    containers, columns = listed(spark, {**FIRST, "new": [("a", "INT")], "bad": []}, errors=["bad"])
    compared = drift.compare(drift.fingerprint(containers, columns), inv.containers)
    assert tuple(inventory.scan_outcomes(compared).first()) == ("shop", 1, 1, 2)


def test_one_inventory(spark, inv):
    other = inv.containers.withColumn("database", F.lit("crm"))
    assert inventory.one_inventory([inv.containers, other]).count() == 4
    with pytest.raises(ValueError):
        inventory.one_inventory([])


def test_the_later_note_wins(spark):
    from sondar.operators.inventory import _last_notes

    rows = [("t", 1, "zebra", "secret"), ("t", 2, "apple", None), ("u", 1, None, None)]
    frame = spark.createDataFrame(rows, "k string, sequence int, description string, sensitivity string")
    fields = {"description": "a", "sensitivity": "b"}
    found = {r.k: (r.a, r.b) for r in _last_notes(frame, ["k"], fields).collect()}
    assert found == {"t": ("apple", "secret"), "u": (None, None)}
    with pytest.raises(Exception, match="several notes on the description of t"):
        _last_notes(frame.drop("sequence"), ["k"], fields).collect()
    same = frame.withColumn("description", F.lit("x")).drop("sequence")
    assert {r.a for r in _last_notes(same, ["k"], fields).collect()} == {"x"}


@pytest.mark.parametrize("name", ["schema_changes", "schema_changes_partial_scan", "change_feed", "sync_columns", "annotate_result"])
def test_no_use_of_a_look_derives_it_again(spark, sf, name):
    from workload import inventories

    read = getattr(inventories, name)(spark, sf).inputFiles()
    assert read and not any("lineitem" in path for path in read)


def test_containers_without_a_whole_key_are_added_or_removed(spark):
    """NULL parts of a key are equal when something recorded is looked for."""
    containers, columns = listed(spark, {"t": [("a", "int")]})
    containers = containers.withColumn("database", F.lit(None).cast("string"))
    previous = containers.withColumn("schema_hash", F.lit("x"))
    gone = previous.withColumn("container_name", F.lit("u"))
    compared = drift.compare(drift.fingerprint(containers, columns), previous)
    found = drift.changes(compared, columns, previous.unionByName(gone), columns, job_id="j", detected_at=now())
    assert {r.container_name: r.change_type for r in found.collect()} == {"t": "container_added", "u": "container_removed"}
