"""Inference and profiling of JSON documents derived from the events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondar.operators import documents as d
from sondar.model import SCHEMA_SAMPLE_DOCUMENTS
from workload import plain, registry, run_sql
from workload.profiles import union

# Documents of differing shape: a field of mixed type, one that may be null,
# one that may be missing, a nested one and a large whole number.
DOCS = """
select event_id, concat(
  '{{"_id":', event_id, ',"kind":"', event_type, '"',
  case event_type when 'click' then ',"v":"a"' when 'view' then ',"v":1'
                  when 'error' then ',"v":null' else '' end,
  case when value >= 20 then concat(',"big":', cast(event_id as bigint) + 2147483600) else '' end,
  ',"at":{{"user":', user_id, '}},"tags":["x"],"ok":',
  case when event_type = 'error' then 'false' else 'true' end,
  '}}') as document
from {events}
"""


def _docs_sql() -> str:
    return plain(DOCS.replace("{{", "<<").replace("}}", ">>")).replace("<<", "{").replace(
        ">>", "}"
    )


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, DOCS)


def _schema_sql(source: str) -> str:
    return f"""
with d as ({source}),
f as (select event_id, k.field, k.position, json_type(document, '$."' || k.field || '"') as t,
             json_extract_string(document, '$."' || k.field || '"') as raw
      from d, lateral (select unnest(json_keys(document)) as field,
                              generate_subscripts(json_keys(document), 1) as position) k),
n as (select field, event_id, position,
             case t when 'NULL' then null when 'VARCHAR' then 'string' when 'BOOLEAN' then 'bool'
                    when 'OBJECT' then 'object' when 'ARRAY' then 'array' when 'DOUBLE' then 'double'
                    else case when raw::bigint between -2147483648 and 2147483647
                              then 'int' else 'long' end end as kind
      from f),
g as (select field, min((event_id, position)) as first_seen,
             string_agg(distinct kind, '|' order by kind) as kinds, count(kind) as present
      from n group by field)
select field as column_name, row_number() over (order by first_seen)::int as ordinal,
       coalesce(kinds, '') as native_type, present < (select count(*) from d) as nullable,
       field = '_id' as is_pk, false as is_fk
from g
"""


@registry.add("document_schema", _schema_sql(_docs_sql()))
def document_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.infer_schema(
        docs(spark, sf_dir), "document", order_by=["event_id"], sample_documents=None
    )


@registry.add(
    "document_schema_first_100",
    _schema_sql(f"select * from ({_docs_sql()}) order by event_id limit 100"),
)
def document_schema_first_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reading a catalog takes by default: the first hundred documents."""
    return d.infer_schema(
        docs(spark, sf_dir), "document", order_by=["event_id"], sample_documents=SCHEMA_SAMPLE_DOCUMENTS
    )


@registry.add(
    "document_schema_props",
    _schema_sql("select event_id, props as document from events"),
)
def document_schema_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.infer_schema(
        run_sql(spark, sf_dir, "select event_id, props from {events}"),
        "props",
        order_by=["event_id"],
        sample_documents=None,
    )


def _field(name: str, kind: str, present: str, distinct: str, low: str, high: str) -> str:
    return (
        f"select '{name}' as column_name, '{kind}' as native_type, "
        f"(count(*) - count({present}))::double / count(*) as null_ratio, "
        f"{distinct} as distinct_count, {low} as min_value, {high} as max_value from e"
    )


_NO_COUNT, _NO_TEXT = "null::bigint", "null::varchar"


@registry.add(
    "document_profile",
    "with e as (select *, case when event_type in ('click', 'view') then 1 end as v, "
    "case when value >= 20 then event_id + 2147483600 end as big from events)\n"
    + union(
        [
            _field("_id", "int", "event_id", _NO_COUNT, "min(event_id)::varchar", "max(event_id)::varchar"),
            _field("kind", "string", "event_type", "count(distinct event_type)", _NO_TEXT, _NO_TEXT),
            _field("v", "int|string", "v", _NO_COUNT, _NO_TEXT, _NO_TEXT),
            # Whole numbers fall on both sides of 32 bits, so no range.
            _field("big", "int|long", "big", _NO_COUNT, _NO_TEXT, _NO_TEXT),
            _field("at", "object", "1", _NO_COUNT, _NO_TEXT, _NO_TEXT),
            _field("tags", "array", "1", _NO_COUNT, _NO_TEXT, _NO_TEXT),
            _field("ok", "bool", "1", "count(distinct event_type = 'error')", _NO_TEXT, _NO_TEXT),
        ]
    ),
)
def document_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = docs(spark, sf_dir)
    schema = d.infer_schema(
        frame, "document", order_by=["event_id"], sample_documents=None
    )
    return d.document_profile(frame, "document", schema).select(
        "column_name", "native_type", "null_ratio", "distinct_count", "min_value", "max_value"
    )


@registry.add(
    "document_top_values",
    """
select 'kind' as column_name, row_number() over (order by n desc, v)::int as rank, v as value, n as count
from (select event_type as v, count(*) as n from events group by 1)
""",
)
def document_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = docs(spark, sf_dir)
    schema = spark.sql(
        "select 'kind' as column_name, 'string' as native_type, 1 as ordinal"
    )
    return (
        d.document_profile(frame, "document", schema)
        .select("column_name", F.posexplode("top_values").alias("rank", "item"))
        .select(
            "column_name",
            (F.col("rank") + 1).alias("rank"),
            "item.value",
            "item.count",
        )
    )
