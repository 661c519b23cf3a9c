import datetime as dt

from pyspark.sql import functions as F

from sondar.functions.types import modes_for_document_type, modes_for_type_text, sqlserver_type
from sondar.sources import documents, mysql, postgres, sqlserver


# A lending library: books, their copies on shelves, and loans.
def pg(spark):
    return {
        "pg_namespace": spark.createDataFrame(
            [(31, "stacks"), (32, "desk"), (33, "pg_toast"), (34, "pg_catalog"), (35, "information_schema")],
            "oid bigint, nspname string",
        ),
        "pg_class": spark.createDataFrame(
            [
                (501, "book", 31, "r", 88000.0, False),
                (502, "copy", 31, "p", 121000.0, False),
                (503, "copy_2020", 31, "r", 9000.0, True),
                (504, "overdue", 32, "v", 0.0, False),
                (505, "loan", 32, "r", -1.0, False),
                (506, "copy", 32, "f", 77.0, False),
                (507, "popular", 32, "m", 40.0, False),
                (508, "book_isbn", 31, "i", 88000.0, False),
                (509, "pg_shelf", 34, "r", 12.0, False),
                (510, "book_seq", 31, "S", 1.0, False),
            ],
            "oid bigint, relname string, relnamespace bigint, relkind string, reltuples double, relispartition boolean",
        ),
        "pg_description": spark.createDataFrame(
            [
                (501, 1259, 0, "titles, not volumes"),
                (501, 1259, 1, "thirteen digits"),
                (502, 2615, 0, "about another catalog"),
                (505, 1259, 4, "day it is due back"),
            ],
            "objoid bigint, classoid bigint, objsubid int, description string",
        ),
        "pg_attribute": spark.createDataFrame(
            [
                (501, "isbn", 1, "character(13)", True, False),
                (501, "title", 2, "text", True, False),
                (501, "printed", 5, "smallint", False, False),
                (501, "........pg.dropped.3........", 3, "-", False, True),
                (501, "xmin", -2, "xid", True, False),
                (502, "isbn", 1, "character(13)", True, False),
                (502, "volume", 2, "integer", True, False),
                (505, "isbn", 2, "character(13)", True, False),
                (505, "volume", 3, "integer", True, False),
                (505, "due", 4, "date", False, False),
            ],
            "attrelid bigint, attname string, attnum int, native_type string, attnotnull boolean, attisdropped boolean",
        ),
        "pg_constraint": spark.createDataFrame(
            [
                (900, 501, "p", [1], None, None),
                (901, 502, "p", [1, 2], None, None),
                (902, 502, "f", [1], 501, [1]),
                (903, 505, "f", [2, 3], 502, [1, 2]),
                (904, 501, "u", [2], None, None),
            ],
            "oid bigint, conrelid bigint, contype string, conkey array<int>, confrelid bigint, confkey array<int>",
        ),
    }


def test_postgres_containers(spark):
    f = pg(spark)
    rows = postgres.containers(f["pg_class"], f["pg_namespace"], f["pg_description"], "library").collect()
    assert {(r.container_name, r.container_type, r.estimated_count, r.native_description) for r in rows} == {
        ("stacks.book", "table", 88000, "titles, not volumes"),
        ("stacks.copy", "table", 121000, None),
        ("desk.overdue", "view", None, None),
        ("desk.loan", "table", None, None),
        ("desk.copy", "table", None, None),
        ("desk.popular", "view", 40, None),
    }


def test_postgres_columns(spark):
    f = pg(spark)
    frames = [f[n] for n in ("pg_class", "pg_namespace", "pg_attribute", "pg_description", "pg_constraint")]
    rows = postgres.columns(*frames, "library").collect()
    assert {(r.container_name, r.column_name, r.ordinal, r.nullable, r.is_pk, r.native_description) for r in rows} == {
        ("stacks.book", "isbn", 1, False, True, "thirteen digits"),
        ("stacks.book", "title", 2, False, False, None),
        ("stacks.book", "printed", 3, True, False, None),
        ("stacks.copy", "isbn", 1, False, True, None),
        ("stacks.copy", "volume", 2, False, True, None),
        ("desk.loan", "isbn", 1, False, False, None),
        ("desk.loan", "volume", 2, False, False, None),
        ("desk.loan", "due", 3, True, False, "day it is due back"),
    }
    assert {
        (r.container_name, r.column_name): (r.references_container, r.references_column) for r in rows if r.is_fk
    } == {
        ("stacks.copy", "isbn"): ("stacks.book", "isbn"),
        ("desk.loan", "isbn"): ("stacks.copy", "isbn"),
        ("desk.loan", "volume"): ("stacks.copy", "volume"),
    }


def test_postgres_databases(spark):
    df = spark.createDataFrame(
        [("shop", True, False), ("template1", True, True), ("closed", False, False), ("app", True, False)],
        "datname string, datallowconn boolean, datistemplate boolean",
    )
    assert [r.database for r in postgres.databases(df).collect()] == ["app", "shop"]


def test_mysql(spark):
    tables = spark.createDataFrame(
        [
            ("library", "book", "BASE TABLE", 88000, "titles, not volumes", dt.datetime(1999, 12, 31, 23, 59, 59)),
            ("library", "loan", "BASE TABLE", 0, "", None),
            ("library", "overdue", "VIEW", None, "VIEW", None),
            ("performance_schema", "threads", "BASE TABLE", 9, "", None),
        ],
        "TABLE_SCHEMA string, TABLE_NAME string, TABLE_TYPE string, TABLE_ROWS bigint, TABLE_COMMENT string, UPDATE_TIME timestamp_ntz",
    )
    rows = mysql.containers(tables).collect()
    assert {(r.container_name, r.container_type, r.native_description, r.last_modified_at) for r in rows} == {
        ("book", "table", "titles, not volumes", "1999-12-31T23:59:59"),
        ("loan", "table", None, None),
        ("overdue", "view", None, None),
    }
    columns = spark.createDataFrame(
        [
            ("library", "loan", "isbn", 2, "char(13)", "NO", "PRI", "of the title"),
            ("library", "loan", "reader", 4, "bigint", "YES", "MUL", ""),
            ("library", "loan", "due", 9, "date", "YES", "", ""),
        ],
        "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, ORDINAL_POSITION int, COLUMN_TYPE string, IS_NULLABLE string, COLUMN_KEY string, COLUMN_COMMENT string",
    )
    usage = spark.createDataFrame(
        [
            ("library", "loan", "isbn", 1, "PRIMARY", None, None, None),
            ("library", "loan", "isbn", 1, "loan_of", "library", "book", "isbn"),
            ("library", "loan", "reader", 1, "lent_to", "town", "citizen", "nr"),
        ],
        "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, ORDINAL_POSITION int, CONSTRAINT_NAME string, REFERENCED_TABLE_SCHEMA string, REFERENCED_TABLE_NAME string, REFERENCED_COLUMN_NAME string",
    )
    rows = mysql.columns(columns, usage, "library").collect()
    assert {
        (r.column_name, r.ordinal, r.nullable, r.is_pk, r.references_container, r.native_description) for r in rows
    } == {
        ("isbn", 1, False, True, "book", "of the title"),
        ("reader", 2, True, False, "town.citizen", None),
        ("due", 3, True, False, None, None),
    }
    names = spark.createDataFrame([("library",), ("sys",), ("mysql",), ("town",)], "SCHEMA_NAME string")
    assert [r.database for r in mysql.databases(names).collect()] == ["library", "town"]


def test_sqlserver(spark):
    mk = spark.createDataFrame
    objects = mk(
        [
            (71, "book", 6, "U ", dt.datetime(1999, 12, 31, 23, 59, 59, 250000), 0),
            (72, "loan", 6, "U ", dt.datetime(2000, 1, 1), 0),
            (73, "overdue", 7, "V ", None, 0),
            (74, "spt_values", 6, "U ", None, 1),
            (75, "lend", 6, "P ", None, 0),
        ],
        "object_id int, name string, schema_id int, type string, modify_date timestamp_ntz, is_ms_shipped int",
    )
    schemas = mk([(6, "stacks"), (7, "desk")], "schema_id int, name string")
    props = mk(
        [
            (1, 71, 0, "MS_Description", "titles"),
            (1, 72, 3, "MS_Description", "when it is due"),
            (1, 72, 0, "Caption", "not a description"),
            (7, 73, 0, "MS_Description", "of an index"),
        ],
        "class int, major_id int, minor_id int, name string, value string",
    )
    stats = mk(
        [(71, 1, 60), (71, 1, 28), (71, 5, 88), (72, 0, 14)], "object_id int, index_id int, row_count bigint"
    )
    rows = sqlserver.containers(objects, schemas, props, stats, "library").collect()
    assert {
        (r.container_name, r.container_type, r.estimated_count, r.native_description, r.last_modified_at) for r in rows
    } == {
        ("stacks.book", "table", 88, "titles", "1999-12-31T23:59:59.250000"),
        ("stacks.loan", "table", 14, None, "2000-01-01T00:00:00"),
        ("desk.overdue", "view", None, None, None),
    }
    columns = mk(
        [
            (71, "isbn", 1, 82, 26, 0, 0, 0),
            (72, "volume", 2, 81, 4, 10, 0, 0),
            (72, "due", 3, 83, 3, 10, 0, 1),
            (72, "isbn", 7, 82, 26, 0, 0, 0),
            (72, "fine", 8, 84, 5, 7, 3, 1),
        ],
        "object_id int, name string, column_id int, user_type_id int, max_length int, precision int, scale int, is_nullable int",
    )
    types = mk([(81, "int"), (82, "nchar"), (83, "date"), (84, "decimal")], "user_type_id int, name string")
    indexes = mk([(71, 3, 1), (72, 1, 0)], "object_id int, index_id int, is_primary_key int")
    index_columns = mk([(71, 3, 1), (72, 1, 2)], "object_id int, index_id int, column_id int")
    keys = mk([(990,)], "object_id int")
    key_columns = mk(
        [(990, 72, 7, 71, 1)],
        "constraint_object_id int, parent_object_id int, parent_column_id int, referenced_object_id int, referenced_column_id int",
    )
    rows = sqlserver.columns(
        objects, schemas, columns, types, props, indexes, index_columns, keys, key_columns, "library"
    ).collect()
    assert {
        (r.container_name, r.column_name, r.ordinal, r.native_type, r.is_pk, r.references_container, r.native_description)
        for r in rows
    } == {
        ("stacks.book", "isbn", 1, "nchar(13)", True, None, None),
        ("stacks.loan", "volume", 1, "int", False, None, None),
        ("stacks.loan", "due", 2, "date", False, None, "when it is due"),
        ("stacks.loan", "isbn", 3, "nchar(13)", False, "stacks.book", None),
        ("stacks.loan", "fine", 4, "decimal(7,3)", False, None, None),
    }
    servers = mk(
        [(2, "tempdb", "ONLINE", 1), (8, "town", "ONLINE", 1), (9, "library", "ONLINE", 1),
         (10, "attic", "RESTORING", 1), (11, "vault", "ONLINE", 0)],
        "database_id int, name string, state_desc string, has_access int",
    )
    assert [r.database for r in sqlserver.databases(servers).collect()] == ["library", "town"]


def test_declared_types(spark):
    df = spark.createDataFrame(
        [("varchar", -1, 0, 0), ("nvarchar", -1, 0, 0), ("nchar", 20, 0, 0), ("varbinary", 16, 0, 0), ("numeric", 9, 5, 0), ("xml", -1, 0, 0)],
        "n string, l int, p int, s int",
    )
    got = [r[0] for r in df.select(sqlserver_type(F.col("n"), F.col("l"), F.col("p"), F.col("s"))).collect()]
    assert got == ["varchar(max)", "nvarchar(max)", "nchar(10)", "varbinary(16)", "numeric(5,0)", "xml"]


def test_modes_for_foreign_types(spark):
    expect = {
        "integer": ["null_ratio", "min_max"],
        "INTERVAL day": ["null_ratio", "min_max"],
        "point": ["null_ratio"],
        "varbinary(10)": ["null_ratio"],
        "enum('a')": ["null_ratio", "min_max"],
        "character varying(10)": ["null_ratio", "distinct_count", "top_values"],
        "boolean": ["null_ratio", "distinct_count", "top_values"],
        "jsonb": ["null_ratio"],
        "": ["null_ratio"],
    }
    df = spark.createDataFrame([(t,) for t in expect], "t string")
    rows = df.select("t", modes_for_type_text(F.col("t")).alias("m")).collect()
    assert {r.t: r.m for r in rows} == expect
    kinds = {"int": 2, "date": 2, "string": 3, "bool": 3, "int|string": 1, "objectId": 1, "": 1}
    df = spark.createDataFrame([(t,) for t in kinds], "t string")
    rows = df.select("t", modes_for_document_type(F.col("t")).alias("m")).collect()
    assert {r.t: len(r.m) for r in rows} == kinds


def test_document_databases(spark):
    df = spark.createDataFrame([("shop",), ("admin",), ("app",), ("local",)], "name string")
    assert [r.database for r in documents.databases(df).collect()] == ["app", "shop"]
