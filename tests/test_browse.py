import fnmatch

import pytest
from pyspark.sql import functions as F

from sondar.functions.globs import matches_any
from sondar.model import CHANGES, COLUMNS, CONTAINERS, AmbiguousContainer, InvalidCursor, UnknownContainer, ddl
from sondar.operators import browse as b


def frame(spark, fields, rows):
    names = list(fields)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl(fields))


def container(name, database="shop", schema="", **more):
    return {"database": database, "schema_name": schema, "container_name": name, "container_type": "table", **more}


def column(name, container_name, ordinal, database="shop", **more):
    return {
        "database": database, "schema_name": "", "container_name": container_name, "column_name": name,
        "ordinal": ordinal, "native_type": "text", "nullable": True, "is_pk": False, "is_fk": False, **more,
    }


@pytest.fixture
def shop(spark):
    containers = frame(spark, CONTAINERS, [
        container("users", estimated_count=3, native_description="people; 100% of them"),
        container("orders", estimated_count=120, description="what was bought", error=None),
        container("broken", error="OSError: gone"),
    ])
    columns = frame(spark, COLUMNS, [
        column("id", "users", 1),
        column("email_address", "users", 2, description="x" * 200),
        column("user_id", "users", 3),
        column("userXid", "users", 4),
        column("id", "orders", 1, profile={}),
        column("total", "orders", 2, native_description="Email receipt total"),
        column("user_ref", "orders", 3, is_fk=True, references_container="users", references_column="id"),
    ])
    return containers, columns


def hits(df):
    return [(r.container_name, r.column_name, r.match_in) for r in df.collect()]


def test_search_ranks_names_first(shop):
    assert hits(b.search(*shop, "EMAIL")) == [
        ("users", "email_address", "name"),
        ("orders", "total", "description"),
    ]
    assert hits(b.search(*shop, "user"))[0] == ("users", None, "name")


def test_search_takes_characters_literally(shop):
    assert hits(b.search(*shop, "user_id")) == [("users", "user_id", "name")]
    assert hits(b.search(*shop, "%")) == [("users", None, "description")]
    assert hits(b.search(*shop, "  ")) == []


def test_search_kind_limit_and_scope(shop):
    assert hits(b.search(*shop, "orders", kind="column")) == []
    assert len(hits(b.search(*shop, "user", limit=1))) == 1
    assert hits(b.search(*shop, "user", database="other")) == []
    found = b.search(*shop, "email_address").first()
    assert found.description == "x" * 120 + "…"
    with pytest.raises(ValueError):
        b.search(*shop, "x", kind="row")


PATTERNS = ["dim_*", "*_pii", "users", "u?ers", "[ab]*", "[!ab]*", "a.b", "x[", "*", "a[]]b", "[a-c]x", "a\\b", "[^a]x"]
NAMES = ["dim_product", "users_pii", "users", "uzers", "apple", "cherry", "a.b", "axb", "x[", "", "a]b", "bx", "a\\b", "^x", "Users", "a\nb"]


def test_globs_like_fnmatch(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    for pattern in PATTERNS:
        got = {r.n for r in df.where(matches_any(F.col("n"), [pattern])).collect()}
        assert got == {n for n in NAMES if fnmatch.fnmatchcase(n, pattern)}, pattern


@pytest.mark.parametrize(
    ("claims", "visible"),
    [
        ({}, {"users", "orders", "broken"}),
        ({"containers": {"deny": ["u*"]}}, {"orders", "broken"}),
        ({"containers": {"allow": ["*s"], "deny": ["users"]}}, {"orders"}),
        ({"containers": "users"}, set()),
        ({"databases": ["other"]}, set()),
        ({"databases": "shop"}, {"users", "orders", "broken"}),
    ],
)
def test_access(shop, claims, visible):
    containers, _ = shop
    got = {r.container_name for r in b.permitted(containers, b.Access.from_claims(claims)).collect()}
    assert got == visible


def test_container_pages(spark):
    rows = [container(n, d) for d in ("a", "b") for n in ("x", "y", "Z")]
    containers = frame(spark, CONTAINERS, rows)
    seen, cursor = [], None
    while True:
        page, cursor = b.container_page(containers, limit=2, cursor=cursor)
        seen += [(r.container_name, r.database) for r in page.collect()]
        if cursor is None:
            break
    assert seen == sorted((r["container_name"], r["database"]) for r in rows)


def test_column_pages(shop):
    _, columns = shop
    page, cursor = b.column_page(columns, "shop", "users", limit=3, include_profile=False)
    assert [r.ordinal for r in page.collect()] == [1, 2, 3] and cursor == "3"
    assert "profile" not in page.columns
    page, cursor = b.column_page(columns, "shop", "users", limit=3, cursor=cursor)
    assert [r.ordinal for r in page.collect()] == [4] and cursor is None
    with pytest.raises(InvalidCursor):
        b.column_page(columns, "shop", "users", cursor="x")


def test_names(spark):
    containers = spark.createDataFrame(
        [("public.orders",), ("public.users",), ("sales.users",), ("flat",)], "container_name string"
    )
    assert b.require_container(containers, "orders") == "public.orders"
    assert b.require_container(containers, "public.users") == "public.users"
    assert b.require_container(containers, "flat") == "flat"
    with pytest.raises(AmbiguousContainer, match="public.users, sales.users"):
        b.require_container(containers, "users")
    for name in ("nope", "x.orders"):
        with pytest.raises(UnknownContainer):
            b.require_container(containers, name)
    wanted = spark.createDataFrame([("flat",), ("nope",)], "container_name string")
    assert [r[0] for r in b.known_only(wanted, containers).collect()] == ["flat"]


def test_relationships_and_summary(spark, shop):
    containers, columns = shop
    assert [tuple(r) for r in b.relationships(columns).collect()] == [
        ("shop", "", "orders", "user_ref", "users", "id")
    ]
    assert tuple(b.summary(containers, columns).first()) == (3, 1, 123, 7, 1)
    assert tuple(b.summary(containers, columns, "none").first()) == (0, 0, None, 0, 0)


def test_changes_newest_first(spark):
    import datetime as dt

    rows = [
        {"id": i, "database": "shop", "schema_name": "", "container_name": f"t{i}", "change_type": "container_added",
         "detected_at": dt.datetime(2024, 1, 1 + i // 2)}
        for i in range(5)
    ]
    changes = frame(spark, CHANGES, rows)
    assert [r.id for r in b.recent_changes(changes).collect()] == [4, 3, 2, 1, 0]
    assert [r.id for r in b.recent_changes(changes, since="2024-01-02", limit=2).collect()] == [4, 3]
