"""Reading the derived catalog: access, pages, search, names, export, audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sondar.model import CONTAINER_KEY, CONTAINERS, PROFILE
from sondar.operators import browse, export
from sondar.operators.search_index import SearchIndex, write_index
from sondar.plans.store import CatalogStore
from sondar.session import scratch_dir
from sondar.sources import audit
from workload import derived as d
from workload import plain, registry, run_sql


def columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored columns; those of the first four ordinals count as profiled."""
    return d.frame(spark, sf_dir, d.COLUMNS_STORED).withColumn(
        "profile", F.when(F.col("ordinal") <= 4, F.create_map().cast(PROFILE))
    )


# What an inventory holds, without the fingerprints nothing here reads.
_CONTAINERS = f"""
select c.*, case when estimated_count >= 400000 then 'a big | one' end as description,
       case when estimated_count >= 400000 then 'ai' end as description_source
from ({d.CONTAINERS_NOW}) c
"""
_C = f"({plain(_CONTAINERS)})"
_K = f"({plain(d.COLUMNS_STORED)})"


def containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.frame(spark, sf_dir, _CONTAINERS)


@registry.add(
    "access_filter",
    f"""
select {d.KEY} from {_C}
where not regexp_full_match(container_name, 'order_1.*') and not regexp_full_match(container_name, '.*_[89][0-9]?')
  and regexp_full_match(container_name, '.*[^5]')
  and database in ('1-URGENT', '5-LOW')
""",
)
def access_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deny before allow, and two databases of five."""
    access = browse.Access.from_claims(
        {
            "containers": {"allow": ["*[!5]"], "deny": ["order_1*", "*_[89]", "*_[89][0-9]"]},
            "databases": ["1-URGENT", "5-LOW"],
        }
    )
    return browse.permitted(containers(spark, sf_dir), access).select(*CONTAINER_KEY)


@registry.add(
    "container_page",
    f"""
select {d.KEY}, container_type, estimated_count from {_C}
where container_name > 'order_5' order by container_name, database, schema_name limit 101
""",
)
def container_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.containers_after(
        containers(spark, sf_dir), cursor=("order_5", "￿", "")
    ).select(*CONTAINER_KEY, "container_type", "estimated_count")


@registry.add(
    "column_page",
    f"""
select column_name, ordinal, native_type from {_K}
where container_name = (select min(container_name) from {_K}
                        where database = '5-LOW' and schema_name = 'o' and ordinal > 5)
  and database = '5-LOW' and schema_name = 'o' and ordinal > 2 order by ordinal limit 4
""",
)
def column_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = columns(spark, sf_dir)
    name = (
        frame.where("database = '5-LOW' and schema_name = 'o' and ordinal > 5")
        .agg(F.min("container_name"))
        .first()[0]
    )
    return browse.columns_after(
        frame, "5-LOW", name, "o", limit=3, cursor="2", include_profile=False
    ).select("column_name", "ordinal", "native_type")


def _search_sql(word: str, limit: int | None = None) -> str:
    text = "coalesce(nullif(description, ''), native_description)"
    cut = (
        f"case when length({text}) > 120 then rtrim(left({text}, 120)) || '…' else {text} end"
    )
    hit = (
        "contains(lower({n}), '{w}') or coalesce(contains(lower(description), '{w}'), false) "
        "or coalesce(contains(lower(native_description), '{w}'), false)"
    )
    return f"""
select * from (
  select {d.KEY}, null::varchar as column_name, null::varchar as native_type, {cut} as description,
         case when contains(lower(container_name), '{word}') then 'name' else 'description' end as match_in
  from {_C} where {hit.format(n='container_name', w=word)}
  union all
  select {d.KEY}, column_name, native_type, {cut},
         case when contains(lower(column_name), '{word}') then 'name' else 'description' end
  from {_K} where {hit.format(n='column_name', w=word)})
order by match_in <> 'name', column_name is not null, container_name, coalesce(column_name, ''),
         database, schema_name {"" if limit is None else f"limit {limit}"}
"""


@registry.add("search_names_and_descriptions", _search_sql("email"))
def search_names_and_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hit: a name for most, a description for some."""
    return browse.search(
        containers(spark, sf_dir), columns(spark, sf_dir), " EMAIL ", limit=None
    )


@registry.add(
    "pages_from_store",
    f"""
with c as (select container_name, database, schema_name from {_C} c),
cut as (select container_name as at from c order by container_name, database, schema_name limit 1 offset 4999)
select container_name, database, schema_name, row_number() over (order by container_name, database, schema_name) as place
from c, cut where container_name > cut.at order by container_name, database, schema_name limit 101
""",
)
def pages_from_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page far into a committed inventory, whose files lie in the order of the pages."""
    store = CatalogStore(spark, scratch_dir(spark, "pages"))
    found = containers(spark, sf_dir)
    lacking = {c: F.lit(None).cast(t) for c, t in CONTAINERS.items() if c not in found.columns}
    store.commit(containers=found.withColumns(lacking))
    order = ["container_name", "database", "schema_name"]
    kept = store.state("containers")
    cursor = kept.select(*order).orderBy(*order).offset(4999).first()
    page = browse.containers_after(kept, cursor=(cursor[0], "~", "~"), limit=100).select(*order)
    return page.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


@registry.add("search_indexed", _search_sql("email"))
def search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same hits from an index of trigrams, whose postings are read instead of
    all names and descriptions."""
    path = scratch_dir(spark, "search")
    write_index(containers(spark, sf_dir), columns(spark, sf_dir), path)
    return SearchIndex(spark, path).search(" EMAIL ", limit=None)


_LONG = (
    "case when estimated_count % 3 = 0 then 'big' else concat('A table of big orders, described at such length that a hit of a search ', "
    "'has to cut it ', repeat('and ', cast(estimated_count % 40 as int)), '  so that it ends, ', container_name) end"
)


@registry.add(
    "search_long_descriptions",
    f"""
with c as (select {d.KEY}, {_LONG.replace(' as int)', ' as bigint)')} as t from {_C} where estimated_count is not null)
select {d.KEY}, case when length(t) > 120 then rtrim(left(t, 120)) || '…' else t end as description
from c where contains(lower(t), 'big')
""",
)
def search_long_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits whose descriptions are cut to 120 characters, trailing blanks left out."""
    found = containers(spark, sf_dir).where("estimated_count is not null").withColumn(
        "description", F.expr(_LONG)
    )
    hits = browse.search(found, columns(spark, sf_dir), "BIG", kind="container", limit=None)
    return hits.select(*CONTAINER_KEY, "description")


@registry.add("search_first_50", _search_sql("order_1", 50))
def search_first_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``_`` is an ordinary character; the ranking decides what is kept."""
    return browse.search(containers(spark, sf_dir), columns(spark, sf_dir), "order_1")


# Requested names: bare, qualified, unknown and held by several schemas.
_QUALIFIED = "select concat('s', c_nationkey, '.', c_mktsegment) as container_name from {customer}"
_REQUESTED = """
select distinct c_mktsegment as container from {customer}
union all select distinct concat('s', c_nationkey, '.', c_mktsegment) from {customer}
union all select p_type from {part}
union all select concat('s1.', r_name) from {region}
"""


@registry.add(
    "resolve_names",
    f"""
with k as (select distinct container_name from ({plain(_QUALIFIED)}
       union all select concat('only.', p_type) as container_name from part)),
r as (select distinct container from ({plain(_REQUESTED)})),
m as (select container, container_name as candidate from r join k on container = container_name
      union all
      select container, container_name from r join k on container = split_part(container_name, '.', -1)
      where not contains(container, '.') and container not in (select container_name from k))
select container, case when count(candidate) = 1 then min(candidate) end as resolved,
       count(candidate) as matches
from r left join m using (container) group by container
""",
)
def resolve_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = run_sql(
        spark,
        sf_dir,
        f"{_QUALIFIED} union all select concat('only.', p_type) as container_name from {{part}}",
    )
    return browse.resolve_names(run_sql(spark, sf_dir, _REQUESTED), known)


@registry.add(
    "known_names",
    f"select container_name from ({plain(_REQUESTED.replace('as container ', 'as container_name '))}) "
    f"semi join ({plain(_QUALIFIED)}) using (container_name)",
)
def known_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = run_sql(spark, sf_dir, _REQUESTED).withColumnRenamed("container", "container_name")
    return browse.known_only(asked, run_sql(spark, sf_dir, _QUALIFIED))


@registry.add(
    "relationships",
    f"""
select database, schema_name, container_name as from_container, column_name as from_column,
       references_container as to_container, references_column as to_column
from {_K} where references_container is not null
""",
)
def relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.relationships(columns(spark, sf_dir))


@registry.add(
    "inventory_summary",
    f"""
select (select count(*) from {_C})::bigint as containers,
       (select count(error) from {_C})::bigint as containers_failed,
       (select sum(estimated_count) from {_C})::bigint as estimated_rows,
       (select count(*) from {_K})::bigint as columns,
       (select count(*) from {_K} where ordinal <= 4)::bigint as columns_profiled
""",
)
def inventory_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.summary(containers(spark, sf_dir), columns(spark, sf_dir))


# ---- export

_DESCRIBED = "coalesce(nullif(description, ''), nullif(native_description, ''), '')"
_TARGET = "references_container || coalesce('.' || references_column, '')"


@registry.add(
    "export_csv_rows",
    f"""
select database, schema_name as schema, container_name as container, column_name as "column",
       ordinal, native_type, nullable::int as nullable, is_pk::int as is_pk, is_fk::int as is_fk,
       coalesce({_TARGET}, '') as "references", {_DESCRIBED} as description,
       coalesce(description_source, '') as description_source,
       coalesce(sensitivity, '') as sensitivity
from {_K}
""",
)
def export_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.csv_rows(columns(spark, sf_dir))


_MARKDOWN_LINES = f"""
select {d.KEY}, string_agg('| `' || column_name || '` | ' || native_type || ' | ' ||
         case when nullable then 'yes' else 'no' end || ' | ' ||
         trim(case when is_pk then 'PK' else '' end || case when is_fk then ' FK → ' || {_TARGET} else '' end)
         || ' | ' || trim(replace({_DESCRIBED} || case when description <> '' then ' *(written)*' else '' end, '|', '\\|'))
         || ' |', chr(10) order by ordinal) as body, count(*) as n
from {_K} group by all
"""
_MARKDOWN = f"""
select {d.KEY}, chr(10) || '## ' || container_name || chr(10) || chr(10) || container_type ||
       coalesce(' · ~' || format('{{:,}}', estimated_count) || ' rows', '') ||
       case when {_DESCRIBED} <> '' then chr(10) || chr(10) || {_DESCRIBED} else '' end ||
       case when error is not null then chr(10) || chr(10) || '> Not readable at the last scan: ' || error
            else chr(10) || chr(10) || '| column | type | null | key | description |' || chr(10) ||
                 '|---|---|---|---|---|' || coalesce(chr(10) || body, '') end as block,
       case when error is not null then 0 else coalesce(n, 0) end as columns
from {_C} left join ({_MARKDOWN_LINES}) using ({d.KEY})
"""


@registry.add("export_markdown_blocks", _MARKDOWN)
def export_markdown_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.markdown_blocks(containers(spark, sf_dir), columns(spark, sf_dir))


def _quoted(x: str) -> str:
    return f"to_json({x})::varchar"


_DBT_LINES = f"""
select {d.KEY}, string_agg('      - name: ' || {_quoted('column_name')} ||
         case when {_DESCRIBED} <> '' then chr(10) || '        description: ' || {_quoted(_DESCRIBED)} else '' end,
         chr(10) order by ordinal) as body, count(*) as columns
from {_K} group by all
"""


@registry.add(
    "export_dbt_blocks",
    f"""
select {d.KEY}, '  - name: ' || {_quoted('container_name')} ||
       case when {_DESCRIBED} <> '' then chr(10) || '    description: ' || {_quoted(_DESCRIBED)} else '' end ||
       chr(10) || '    columns:' || chr(10) || body as block, columns
from {_C} join ({_DBT_LINES}) using ({d.KEY})
""",
)
def export_dbt_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.dbt_blocks(containers(spark, sf_dir), columns(spark, sf_dir))


@registry.add(
    "export_result",
    f"""
select sum(octet_length(encode(block)) + 1)::bigint
         + octet_length(encode('# Data dictionary — every database' || chr(10) || chr(10) ||
           'From the inventory. Descriptions marked *written* were added to the inventory; '
           || 'the rest are the source''s own comments.')) + 1 as bytes_written,
       count(*) as containers, sum(columns)::bigint as columns
from ({_MARKDOWN}) where not starts_with(container_name, 'order_1')
""",
)
def export_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary written out, without what the caller may not read."""
    return export.export(
        containers(spark, sf_dir),
        columns(spark, sf_dir),
        f"{scratch_dir(spark, 'export')}/dictionary",
        access=browse.Access(deny=("order_1*",)),
    ).select("bytes_written", "containers", "columns")


# ---- audit

# Events as lines of a call trail.
_TRAIL = """
select concat('{{"ts":"', replace(cast(date_trunc('second', ts) as varchar(19)), ' ', 'T'), 'Z","key_id":"key', user_id,
  '","tool":"', case event_type when 'view' then 'get_sample' else 'profile_column' end,
  '","params":{{"container":"t', cast(floor(value / 10) as int), '","limit":3}},"outcome":"',
  case event_type when 'error' then 'ToolError' else 'ok' end,
  '","duration_ms":1.5,"rendered_sql":null,"rows_returned":',
  case event_type when 'error' then 'null' else cast(cast(floor(value) as int) as varchar(10)) end,
  case when event_type = 'view' and value >= 5 then ',"unmasked":true' else '' end, '}}') as value
from {events}
"""
_CALLS = """
select 'key' || user_id as key_id, case event_type when 'view' then 'get_sample' else 'profile_column' end as tool,
       't' || floor(value / 10)::int as container, event_type, floor(value)::bigint as rows_returned, value, ts
from events
"""


def _trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.parse_trail(run_sql(spark, sf_dir, _TRAIL))


@registry.add(
    "audit_reads_by_caller",
    f"""
select key_id, tool, container, count(*) as calls, count(*) filter (event_type = 'error') as failed,
       coalesce(sum(rows_returned) filter (event_type <> 'error'), 0)::bigint as rows_returned
from ({_CALLS}) group by all
""",
)
def audit_reads_by_caller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.reads_by_caller(_trail(spark, sf_dir))


@registry.add(
    "audit_unmasked_reads",
    f"""
select key_id, container, count(*) as reads, sum(rows_returned)::bigint as rows_returned,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last_read
from ({_CALLS}) where event_type = 'view' and value >= 5 group by all
""",
)
def audit_unmasked_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.unmasked_reads(_trail(spark, sf_dir)).withColumn(
        "last_read", F.date_format("last_read", "yyyy-MM-dd HH:mm:ss")
    )
