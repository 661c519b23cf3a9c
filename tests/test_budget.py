"""What a reader of a 500 x 30 catalog gets back stays small."""

import pytest
from pyspark.sql import functions as F

from sondar.model import COLUMNS, CONTAINERS, PROFILE
from sondar.operators import browse as b


@pytest.fixture(scope="module")
def catalog(spark):
    def fill(df, fields):
        return df.select(
            *[
                (F.col(n) if n in df.columns else F.lit(None)).cast(kind).alias(n)
                for n, kind in fields.items()
            ]
        )

    names = spark.range(500).selectExpr(
        "'main' as database", "'' as schema_name",
        "format_string('table_%04d', id) as container_name",
        "'table' as container_type", "1000000 + id as estimated_count", "sha2(string(id), 256) as schema_hash",
        "repeat('One row per order placed by a customer. ', 4) as native_description",
        "timestamp '2024-01-01' as scanned_at",
    )
    value = "named_struct('value', concat('value-', v), 'count', 100 - v, 'is_null', false)"
    profile = (
        f"cast(map('top_values', named_struct('distinct_count', null, 'null_ratio', null, 'top_values', "
        f"transform(sequence(1L, 20L), v -> {value}), 'min_value', null, 'max_value', null, 'approximate', false)) "
        f"as {PROFILE})"
    )
    columns = names.selectExpr("*", "explode(sequence(1, 30)) as id").selectExpr(
        "database", "schema_name", "container_name", "format_string('customer_email_%02d', id) as column_name",
        "id as ordinal", "'varchar(255)' as native_type", "true as nullable", "false as is_pk", "false as is_fk",
        "repeat('The address the customer gave us. ', 2) as native_description",
        f"{profile} as profile", "timestamp '2024-01-01' as scanned_at",
    )
    return fill(names, CONTAINERS).cache(), fill(columns, COLUMNS).cache()


def size(df):
    return df.select(F.octet_length(F.to_json(F.struct("*"))).alias("n")).agg(F.sum("n")).first()[0]


def test_summary_is_under_a_kilobyte_and_a_page_is_not(catalog):
    summary = size(b.summary(*catalog))
    assert summary < 1024
    page, _ = b.container_page(catalog[0], limit=100)
    assert size(page) > 10 * summary


def test_fifty_hits_of_fifteen_thousand(catalog):
    hits = b.search(*catalog, "email")
    assert hits.count() == 50
    assert size(hits) < 16 * 1024


def test_column_page(catalog):
    def page(**options):
        found, _ = b.column_page(
            catalog[1], "main", "table_0001", **options
        )
        return size(found)

    assert page() < 40 * 1024
    assert 2 * page(include_profile=False) < page()
