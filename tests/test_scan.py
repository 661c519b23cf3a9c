import datetime as dt

import pytest
from pyspark.sql import functions as F

from sondar.operators.browse import recent_changes, summary
from sondar.operators.drift import fingerprint
from sondar.operators.sensitivity import sensitive_columns
from sondar.plans.scan import scan_tables
from sondar.plans.store import CatalogStore
from sondar.session import scratch_dir
from sondar.sources import audit


def tables(spark):
    users = spark.createDataFrame(
        [(i, f"u{i}@x.com", f"0912-345-6{i:02d}", "note") for i in range(9)],
        "id int, email string, reach string, remark string",
    )
    orders = spark.createDataFrame([(1, 9.5), (2, None)], "id int, amount double")

    def broken():
        raise OSError("gone")

    return {"users": users, "orders": orders, "broken": broken}


def test_scan_twice(spark, tmp_path):
    store = CatalogStore(spark, f"{tmp_path}/inventory")
    assert store.latest() == 0 and store.state("columns").count() == 0
    data = tables(spark)
    keys = spark.createDataFrame(
        [("users", "id", True, None, None)],
        "container_name string, column_name string, is_pk boolean, references_container string, references_column string",
    )
    assert scan_tables(store, "shop", data, keys=keys, counted=["users"]) == 1
    containers = {r.container_name: r for r in store.state("containers").collect()}
    assert containers["users"].estimated_count == 9 and containers["orders"].estimated_count is None
    assert containers["broken"].error.startswith("OSError")
    columns = {(r.container_name, r.column_name): r for r in store.state("columns").collect()}
    assert columns["users", "email"].sensitivity == "pii"
    assert columns["users", "reach"].sensitivity_source == "detected"
    assert columns["users", "remark"].sensitivity is None
    assert columns["users", "id"].is_pk
    assert columns["orders", "amount"].profile["null_ratio"].null_ratio == 0.5
    assert columns["orders", "amount"].profile["min_max"].max_value == "9.5"
    assert columns["users", "remark"].profile["top_values"].top_values[0].value == "note"
    assert tuple(summary(store.state("containers"), store.state("columns")).first()) == (3, 1, 9, 6, 6)

    data["orders"] = data["orders"].withColumn("note", F.lit("x"))
    del data["users"]
    assert scan_tables(store, "shop", data) == 2
    feed = recent_changes(store.log("changes")).collect()
    newest = max(r.detected_at for r in feed)
    assert {(r.container_name, r.change_type) for r in feed if r.detected_at == newest} == {
        ("orders", "schema_changed"), ("users", "container_removed"),
    }
    assert len({r.id for r in feed}) == 4
    assert [r.detail.added for r in feed if r.container_name == "orders" and r.detail] == [["note"]]
    assert store.state("columns", 1).count() == 6 and store.state("columns").count() == 3
    runs = {(r.containers_done, r.containers_failed, r.containers_skipped) for r in store.log("scan_runs").collect()}
    assert runs == {(2, 1, 0), (1, 1, 0)}

    assert scan_tables(store, "shop", data) == 3
    assert store.log("changes").count() == 4
    assert {(r.containers_done, r.containers_skipped) for r in store.log("scan_runs").collect()} >= {(0, 1)}


def test_one_bad_column_does_not_cost_the_table(spark, tmp_path):
    store = CatalogStore(spark, f"{tmp_path}/inventory")
    bad = spark.range(5).select(
        "id", F.raise_error(F.lit("unreadable")).cast("string").alias("password")
    )
    scan_tables(store, "shop", {"t": bad})
    columns = {r.column_name: r for r in store.state("columns").collect()}
    assert columns["id"].profile["min_max"].max_value == "4"
    assert columns["password"].profile is None and columns["password"].sensitivity == "secret"


def test_other_databases_are_left_alone(spark, tmp_path):
    store = CatalogStore(spark, f"{tmp_path}/inventory")
    one = {"t": spark.range(3).toDF("id")}
    scan_tables(store, "a", one, modes=[])
    scan_tables(store, "b", one, modes=[], now=dt.datetime(2030, 1, 1))
    assert {r.database for r in store.state("containers").collect()} == {"a", "b"}
    assert store.log("changes").count() == 2
    assert store.state("columns").where("profile is not null").count() == 0


def test_dead_run_leaves_the_last_version(spark, tmp_path):
    store = CatalogStore(spark, f"{tmp_path}/inventory")
    scan_tables(store, "a", {"t": spark.range(3).toDF("id")}, modes=[])
    store.log("changes").write.parquet(store.path("changes", 2))
    assert store.latest() == 1 and store.log("changes").count() == 1
    assert scan_tables(store, "a", {"t": spark.range(3).toDF("key")}, modes=[]) == 2
    assert store.log("changes").count() == 2


def test_recorded_levels_drive_masking(spark, tmp_path):
    store = CatalogStore(spark, f"{tmp_path}/inventory")
    data = tables(spark)
    scan_tables(store, "shop", {"users": data["users"]}, modes=[])
    known = {r.column_name: r.sensitivity for r in store.state("columns").where("sensitivity is not null").collect()}
    assert sensitive_columns(data["users"], known) == {"email": "pii", "reach": "pii"}


class Settings(dict):
    """As much of a session as names its folders."""

    master = "yarn"
    conf = sparkContext = property(lambda self: self)

    def getConf(self):
        return self


def test_scratch_follows_the_cluster_setting():
    shared = Settings({"spark.checkpoint.dir": "hdfs://shared/"})
    first, second = scratch_dir(shared, "x"), scratch_dir(shared, "x")
    assert first.startswith("hdfs://shared/sondar/x-") and first != second
    with pytest.raises(RuntimeError):
        scratch_dir(Settings(), "x")


def test_audit(spark, tmp_path):
    lines = [
        '{"ts":"2024-01-01T00:00:00.123+00:00","key_id":"k1","tool":"get_sample","params":{"container":"users","limit":3,"mask":false},"outcome":"ok","duration_ms":1.5,"rendered_sql":"SELECT","rows_returned":3,"unmasked":true}',
        '{"ts":"2024-01-02T00:00:00.123+00:00","key_id":"k1","tool":"get_sample","params":{"container":"users"},"outcome":"ToolError","duration_ms":1.5,"rendered_sql":null,"rows_returned":null,"error":"no"}',
    ]
    (tmp_path / "audit.jsonl").write_text(lines[1] + "\n")
    (tmp_path / "audit.jsonl.1").write_text(lines[0] + "\n")
    trail = audit.read_trail(spark, f"{tmp_path}/audit.jsonl*")
    assert trail.count() == 2
    assert tuple(audit.reads_by_caller(trail).first()) == ("k1", "get_sample", "users", 2, 1, 3)
    seen = audit.unmasked_reads(trail).first()
    assert (seen.key_id, seen.container, seen.reads, seen.rows_returned) == ("k1", "users", 1, 3)
    parsed = audit.parse_trail(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted(parsed.collect()) == sorted(trail.collect())


def test_a_scan_leaves_other_schemas_alone(spark, tmp_path):
    store = CatalogStore(spark, f"{tmp_path}/inventory")
    one = spark.createDataFrame([(1, "a")], "id int, note string")
    scan_tables(store, "shop", {"first": one, "second": one}, schema_name="x")
    scan_tables(store, "shop", {"other": one}, schema_name="y")
    named = lambda: {(r.schema_name, r.container_name) for r in store.state("containers").collect()}
    assert named() == {("x", "first"), ("x", "second"), ("y", "other")}
    scan_tables(store, "shop", {"first": one}, schema_name="x")
    assert named() == {("x", "first"), ("y", "other")}
    removed = store.log("changes").where("change_type = 'container_removed'").collect()
    assert [(r.schema_name, r.container_name) for r in removed] == [("x", "second")]


def test_values_are_judged_on_every_row(spark):
    rows = [(f"word {i}",) for i in range(30)] + [(f"u{i}@x.com",) for i in range(70)]
    mixed = spark.createDataFrame(rows, "v string").coalesce(1)
    assert sensitive_columns(mixed) == {"v": "pii"}


def test_statistics_do_not_outlive_their_values(spark, tmp_path):
    store = CatalogStore(spark, f"{tmp_path}/inventory")
    full = spark.range(5).select("id", F.col("id").cast("string").alias("word"))
    scan_tables(store, "shop", {"t": full})
    scan_tables(store, "shop", {"t": full.where("false")}, force=True)
    found = {r.column_name: r.profile for r in store.state("columns").collect()}
    assert found["id"]["null_ratio"].null_ratio is None
    assert found["id"]["min_max"].min_value is None and found["id"]["min_max"].max_value is None
    assert found["word"]["distinct_count"].distinct_count == 0
    assert found["word"]["top_values"].top_values == []


def test_a_part_that_failed_is_read_again(spark, tmp_path):
    store = CatalogStore(spark, f"{tmp_path}/inventory")
    broken = spark.range(5).select("id", F.raise_error(F.lit("x")).cast("string").alias("note"))
    good = spark.range(5).select("id", F.when(F.col("id") >= 0, F.lit("n")).alias("note"))
    assert broken.schema == good.schema
    scan_tables(store, "shop", {"t": broken}, modes=["null_ratio"])
    assert "profile of note" in store.state("containers").first().error
    scan_tables(store, "shop", {"t": good}, modes=["null_ratio"])
    assert store.state("containers").first().error is None
    notes = store.state("columns").where("column_name = 'note'").first()
    assert notes.profile["null_ratio"].null_ratio == 0.0
    assert store.log("changes").count() == 1


def test_descriptions_survive_scans_of_other_schemas(spark, tmp_path):
    store = CatalogStore(spark, f"{tmp_path}/inventory")
    one = spark.range(2).toDF("id")
    scan_tables(store, "shop", {"a": one}, schema_name="x", modes=[])
    written = store.state("containers").withColumn("description", F.lit("by hand"))
    store.commit(containers=written)
    scan_tables(store, "shop", {"b": one}, schema_name="y", modes=[])
    found = {r.container_name: r.description for r in store.state("containers").collect()}
    assert found == {"a": "by hand", "b": None}


def test_a_listing_with_one_table_to_read(spark, tmp_path):
    from sondar.model import LISTED_COLUMNS, LISTED_CONTAINERS, ddl

    store = CatalogStore(spark, f"{tmp_path}/inventory")
    containers = spark.createDataFrame(
        [
            ("shop", "x", "read", "table", 7, "kept", "2024-01-01T00:00:00"),
            ("shop", "x", "seen", "view", None, None, None),
            ("shop", "x", "lost", "table", 3, None, None),
            ("shop", "y", "other", "table", 3, None, None),
        ],
        ddl(LISTED_CONTAINERS),
    )
    columns = spark.createDataFrame(
        [("shop", "x", n, "id", 1, "int4", False, True, False, None, None, None) for n in ("read", "seen", "lost")],
        ddl(LISTED_COLUMNS),
    )

    def gone():
        raise OSError("gone")

    scan_tables(
        store, "shop", {"read": spark.range(2).toDF("id"), "lost": gone}, schema_name="x",
        containers=containers, columns=columns, counted=["read"],
    )
    found = {r.container_name: r for r in store.state("containers").collect()}
    assert set(found) == {"read", "seen", "lost"}
    assert found["read"].estimated_count == 2 and found["read"].native_description == "kept"
    assert found["seen"].container_type == "view" and found["lost"].error == "OSError: gone"
    profiled = {r.container_name: r.profile is not None for r in store.state("columns").collect()}
    assert profiled == {"read": True, "seen": False}


def test_a_listing_is_read_once(spark, tmp_path):
    """A source that answers differently each time is recorded as it was compared."""
    store = CatalogStore(spark, f"{tmp_path}/inventory")
    containers = spark.sql(
        "select 'shop' as database, 'x' as schema_name, 't' as container_name, 'table' as container_type, "
        "cast(null as bigint) as estimated_count, uuid() as native_description, null as last_modified_at"
    )
    columns = spark.sql(
        "select 'shop' as database, 'x' as schema_name, 't' as container_name, 'c' as column_name, 1 as ordinal, "
        "uuid() as native_type, true as nullable, false as is_pk, false as is_fk, null as native_description, "
        "null as references_container, null as references_column"
    )
    scan_tables(store, "shop", {}, schema_name="x", containers=containers, columns=columns)
    recorded = store.state("containers")
    again = fingerprint(recorded.drop("schema_hash"), store.state("columns")).first().schema_hash
    assert recorded.first().schema_hash == again


def test_a_listing_that_repeats_a_name_is_refused(spark, tmp_path):
    from sondar.model import LISTED_COLUMNS, LISTED_CONTAINERS, RepeatedKey, ddl

    store = CatalogStore(spark, f"{tmp_path}/inventory")
    one = ("shop", "x", "harbours", "table", 7, None, None)
    column = ("shop", "x", "harbours", "depth", 1, "int4", False, True, False, None, None, None)
    containers = spark.createDataFrame([one, one], ddl(LISTED_CONTAINERS))
    columns = spark.createDataFrame([column], ddl(LISTED_COLUMNS))
    with pytest.raises(RepeatedKey, match="1 in all.*shop.x.harbours"):
        scan_tables(store, "shop", {}, schema_name="x", containers=containers, columns=columns)
    with pytest.raises(RepeatedKey, match="depth"):
        scan_tables(store, "shop", {}, schema_name="x", containers=containers.distinct(), columns=columns.unionAll(columns))
    assert store.latest() == 0


def test_a_catalog_scan_opens_what_changed_and_records_what_it_could_not(spark, tmp_path):
    from sondar.model import LISTED_COLUMNS, LISTED_CONTAINERS, ddl
    from sondar.plans.scan import scan_catalog

    store = CatalogStore(spark, f"{tmp_path}/inventory")
    names = [("north", "buoys"), ("north", "gone"), ("south", "piers"), ("south", "view")]

    def listing(kinds):
        return (
            spark.createDataFrame([("shop", s, n, "table", None, None, None) for s, n in kinds], ddl(LISTED_CONTAINERS)),
            spark.createDataFrame(
                [("shop", s, n, "id", 1, kind, True, False, False, None, None, None) for (s, n), kind in kinds.items()], ddl(LISTED_COLUMNS)))

    asked = []

    def open_table(schema, name):
        asked.append((schema, name))
        if name == "gone":
            raise OSError("no such table")
        return None if name == "view" else spark.range(5).toDF("id")

    scan_catalog(store, "shop", *listing(dict.fromkeys(names, "bigint")), open_table=open_table, counted=[("north", "buoys")])
    found = {r.container_name: r for r in store.state("containers").collect()}
    assert found["buoys"].estimated_count == 5 and found["view"].error is None and "no such table" in found["gone"].error
    assert sorted(asked) == sorted(names)
    asked.clear()
    # Next time only what changed or failed is opened, and a schema that is not listed is gone.
    scan_catalog(store, "shop", *listing({names[0]: "bigint", names[1]: "bigint"}), open_table=open_table)
    assert asked == [("north", "gone")]
    assert {r.container_name for r in store.state("containers").collect()} == {"buoys", "gone"}
    removed = store.log("changes").where("change_type = 'container_removed'").collect()
    assert {(r.schema_name, r.container_name) for r in removed} == {("south", "piers"), ("south", "view")}


def test_pages_skip_files_before_the_cursor(spark, tmp_path):
    from sondar.model import CONTAINERS
    from sondar.operators.browse import containers_after

    store = CatalogStore(spark, f"{tmp_path}/inventory")
    names = spark.range(4000).select(F.lit("shop").alias("database"), F.lit("x").alias("schema_name"), F.format_string("c%05d", (F.col("id") * 7919) % 4000).alias("container_name"))
    frame = names.select(*[F.col(c) if c in names.columns else F.lit(None).cast(t).alias(c) for c, t in CONTAINERS.items()])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.commit(containers=frame)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    kept = store.state("containers")
    files = kept.groupBy(F.col("_metadata.file_path")).agg(F.min("container_name").alias("low"), F.max("container_name").alias("high")).orderBy("low").collect()
    assert len(files) > 1 and all(a.high < b.low for a, b in zip(files, files[1:]))
    page = containers_after(kept, cursor=("c02998", "shop", "x"), limit=3)
    assert [r.container_name for r in page.collect()] == ["c02999", "c03000", "c03001", "c03002"]
    assert "PushedFilters: [Or(GreaterThan(container_name,c02998)" in page._jdf.queryExecution().toString()


def test_tables_are_read_in_pools_of_their_own(spark, tmp_path, monkeypatch):
    from sondar.plans import scan

    seen = []
    monkeypatch.setattr(scan, "_inspect", lambda table, key, *rest: seen.append(
        spark.sparkContext.getLocalProperty("spark.scheduler.pool")) or [])
    store = CatalogStore(spark, f"{tmp_path}/inventory")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_tables(store, "shop", {n: spark.range(2).toDF("id") for n in "abc"}, parallel=2)
    assert len(seen) == 3 and set(seen) <= {f"{scan.POOLS}-0", f"{scan.POOLS}-1"}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
