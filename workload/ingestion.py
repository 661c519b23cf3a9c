"""System catalogs derived from the given tables, taken in as inventory rows.

Orders play the relations, line numbers their columns, nations the schemas and
parts the targets of references, in the shape each server keeps them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sondar.model import LISTED_COLUMNS, LISTED_CONTAINERS
from sondar.sources import mysql, postgres, sqlserver
from workload import plain, registry, run_sql

_LISTED = ", ".join(LISTED_CONTAINERS)
_COLUMNS = ", ".join(LISTED_COLUMNS)

# One row per (order, line number), as a column of that order's relation.
_LINES = """
select l_orderkey, l_linenumber,
       min(case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end) as flag,
       min(case l_linestatus when 'F' then 1 else 2 end) as status,
       max(l_partkey) as part, max(l_suppkey) as supplier, count(*) as n
from {lineitem} group by l_orderkey, l_linenumber
"""

# ---- PostgreSQL

_NAMESPACE = """
select n_nationkey as oid, case n_nationkey when 3 then 'pg_catalog' when 4 then 'pg_toast_9'
  when 5 then 'information_schema' else lower(n_name) end as nspname from {nation}
"""
_PG_CLASS = """
select o_orderkey as oid, concat('rel_', o_orderkey) as relname, c_nationkey as relnamespace,
       case o_orderpriority when '1-URGENT' then 'r' when '2-HIGH' then 'v' when '3-MEDIUM' then 'p'
            when '5-LOW' then 'm' else case o_orderstatus when 'F' then 'f' when 'O' then 'i' else 'r' end
            end as relkind,
       case when o_totalprice < 100000 then -1.0 else floor(o_totalprice) end as reltuples,
       o_totalprice >= 450000 as relispartition
from {orders} join {customer} on c_custkey = o_custkey
"""
_PG_ATTRIBUTE = f"""
select l_orderkey as attrelid, concat('col_', l_linenumber) as attname, l_linenumber - 1 as attnum,
       case flag when 1 then 'integer' when 2 then 'character varying(20)' else 'timestamp with time zone' end
         as native_type,
       status = 1 as attnotnull, l_linenumber = 3 and flag = 1 as attisdropped
from ({_LINES}) l
"""
_PG_DESCRIPTION = f"""
select o_orderkey as objoid, 1259 as classoid, 0 as objsubid, concat('placed by ', o_custkey) as description
from {{orders}} where o_totalprice >= 300000
union all
select l_orderkey, 1259, l_linenumber - 1, concat('line ', l_linenumber) from ({_LINES}) l
where flag = 3 and l_linenumber > 1
union all
select o_orderkey, 2615, 0, 'of something else' from {{orders}}
"""
_PG_CONSTRAINT = """
select o_orderkey as oid, o_orderkey as conrelid, 'p' as contype, @ARRAY(1, 2) as conkey,
       cast(null as bigint) as confrelid, cast(null as @INTS) as confkey
from {orders} where o_orderstatus <> 'P'
union all
select o_orderkey + 100000000, o_orderkey, 'f', @ARRAY(3, 4), o_custkey, @ARRAY(1, 2) from {orders}
union all
select o_orderkey + 200000000, o_orderkey, 'f', @ARRAY(4), o_orderkey, @ARRAY(5) from {orders}
where o_orderstatus = 'O'
"""


def _pg(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    constraint = _PG_CONSTRAINT.replace("@ARRAY", "array").replace("@INTS", "array<int>")
    texts = {
        "pg_class": _PG_CLASS,
        "pg_namespace": _NAMESPACE,
        "pg_attribute": _PG_ATTRIBUTE,
        "pg_description": _PG_DESCRIPTION,
        "pg_constraint": constraint,
    }
    return {name: run_sql(spark, sf_dir, text) for name, text in texts.items()}


_PG_WITH = f"""
with pg_namespace as ({plain(_NAMESPACE)}), pg_class as ({plain(_PG_CLASS)}),
pg_attribute as ({plain(_PG_ATTRIBUTE)}), pg_description as ({plain(_PG_DESCRIPTION)}),
pg_constraint as ({plain(_PG_CONSTRAINT).replace('@ARRAY', 'list_value').replace('@INTS', 'int[]')}),
rel as (select c.*, n.nspname, n.nspname || '.' || c.relname as container_name
        from pg_class c join pg_namespace n on n.oid = c.relnamespace
        where c.relkind in ('r','p','v','m','f') and not c.relispartition
          and n.nspname not in ('pg_catalog', 'information_schema') and left(n.nspname, 3) <> 'pg_')
"""


@registry.add(
    "postgres_containers",
    f"""{_PG_WITH}
select 'shop' as database, nspname as schema_name, container_name,
       case when relkind in ('v', 'm') then 'view' else 'table' end as container_type,
       case when relkind in ('r', 'p', 'm') and reltuples >= 0 then reltuples::bigint end as estimated_count,
       description as native_description, null::varchar as last_modified_at
from rel left join pg_description d on d.objoid = rel.oid and d.objsubid = 0 and d.classoid = 1259
""",
)
def postgres_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _pg(spark, sf_dir)
    return postgres.containers(
        f["pg_class"], f["pg_namespace"], f["pg_description"], "shop"
    )


@registry.add(
    "postgres_columns",
    f"""{_PG_WITH},
pk as (select conrelid, unnest(conkey) as attnum from pg_constraint where contype = 'p'),
fk as (select oid, conrelid, unnest(conkey) as attnum, confrelid, unnest(confkey) as to_attnum
       from pg_constraint where contype = 'f'),
edge as (select fk.conrelid, fk.attnum, max_by((tn.nspname || '.' || t.relname, ta.attname), fk.oid) as target
         from fk join pg_class t on t.oid = fk.confrelid join pg_namespace tn on tn.oid = t.relnamespace
         join pg_attribute ta on ta.attrelid = fk.confrelid and ta.attnum = fk.to_attnum
         group by 1, 2)
select 'shop' as database, nspname as schema_name, container_name, attname as column_name,
       row_number() over (partition by a.attrelid order by a.attnum)::int as ordinal, native_type,
       not attnotnull as nullable, pk.attnum is not null as is_pk, target is not null as is_fk,
       description as native_description, target[1] as references_container, target[2] as references_column
from pg_attribute a join rel on rel.oid = a.attrelid
left join pg_description d on d.objoid = a.attrelid and d.objsubid = a.attnum and d.classoid = 1259
left join pk on pk.conrelid = a.attrelid and pk.attnum = a.attnum
left join edge on edge.conrelid = a.attrelid and edge.attnum = a.attnum
where a.attnum > 0 and not a.attisdropped
""",
)
def postgres_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _pg(spark, sf_dir)
    return postgres.columns(
        f["pg_class"],
        f["pg_namespace"],
        f["pg_attribute"],
        f["pg_description"],
        f["pg_constraint"],
        "shop",
    )


# ---- databases

_PG_DATABASE = """
select concat('db_', c_custkey) as datname, c_mktsegment <> 'MACHINERY' as datallowconn,
       c_nationkey = 7 as datistemplate from {customer}
"""
_SCHEMATA = """
select case n_nationkey when 1 then 'mysql' when 2 then 'sys' when 3 then 'information_schema'
       when 4 then 'performance_schema' else n_name end as SCHEMA_NAME from {nation}
union all select c_name from {customer}
"""
_SYS_DATABASES = """
select c_custkey as database_id, c_name as name,
       case c_mktsegment when 'FURNITURE' then 'OFFLINE' else 'ONLINE' end as state_desc,
       case when c_nationkey < 20 then 1 else 0 end as has_access from {customer}
"""


@registry.add(
    "list_databases",
    f"""
select 'postgres' as source, datname as database from ({plain(_PG_DATABASE)}) where datallowconn and not datistemplate
union all
select 'mysql', SCHEMA_NAME from ({plain(_SCHEMATA)})
where SCHEMA_NAME not in ('information_schema', 'mysql', 'performance_schema', 'sys')
union all
select 'sqlserver', name from ({plain(_SYS_DATABASES)})
where database_id > 4 and state_desc = 'ONLINE' and has_access = 1
""",
)
def list_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {
        "postgres": postgres.databases(run_sql(spark, sf_dir, _PG_DATABASE)),
        "mysql": mysql.databases(run_sql(spark, sf_dir, _SCHEMATA)),
        "sqlserver": sqlserver.databases(run_sql(spark, sf_dir, _SYS_DATABASES)),
    }
    out = None
    for source, frame in parts.items():
        rows = frame.selectExpr(f"'{source}' as source", "database")
        out = rows if out is None else out.unionAll(rows)
    return out


# ---- MySQL

_SCHEMA_OF = "case o_orderstatus when 'F' then 'mysql' when 'O' then 'shop' else 'crm' end"
_MY_TABLES = f"""
select {_SCHEMA_OF} as TABLE_SCHEMA, concat('t_', o_orderkey) as TABLE_NAME,
       case o_orderpriority when '1-URGENT' then 'VIEW' when '2-HIGH' then 'SYSTEM VIEW' else 'BASE TABLE' end
         as TABLE_TYPE,
       case when o_orderpriority <> '1-URGENT' then cast(floor(o_totalprice) as bigint) end as TABLE_ROWS,
       case o_orderpriority when '1-URGENT' then 'VIEW' when '5-LOW' then '' else concat('for ', o_custkey) end
         as TABLE_COMMENT,
       case when o_totalprice >= 100000 then o_orderdate end as UPDATE_TIME
from {{orders}}
"""
_MY_COLUMNS = f"""
select {_SCHEMA_OF} as TABLE_SCHEMA, concat('t_', l_orderkey) as TABLE_NAME,
       concat('c_', l_linenumber) as COLUMN_NAME, l_linenumber as ORDINAL_POSITION,
       case flag when 1 then 'int unsigned' when 2 then 'varchar(50)' else 'enum(''a'')' end as COLUMN_TYPE,
       case status when 2 then 'YES' else 'NO' end as IS_NULLABLE,
       case l_linenumber when 1 then 'PRI' when 2 then 'MUL' else '' end as COLUMN_KEY,
       case when part > 500 then concat('part ', part) else '' end as COLUMN_COMMENT
from ({_LINES}) l join {{orders}} on o_orderkey = l_orderkey
"""
_MY_KEYS = f"""
select {_SCHEMA_OF} as TABLE_SCHEMA, concat('t_', l_orderkey) as TABLE_NAME,
       concat('c_', l_linenumber) as COLUMN_NAME, l_linenumber as ORDINAL_POSITION, 'fk_one' as CONSTRAINT_NAME,
       case when supplier < 50 then 'stock' else {_SCHEMA_OF} end as REFERENCED_TABLE_SCHEMA,
       concat('t_', part) as REFERENCED_TABLE_NAME, 'c_1' as REFERENCED_COLUMN_NAME
from ({_LINES}) l join {{orders}} on o_orderkey = l_orderkey where l_linenumber >= 5
union all
select {_SCHEMA_OF}, concat('t_', l_orderkey), concat('c_', l_linenumber), 9, 'fk_two',
       cast(null as varchar(1)), concat('t_', supplier), 'c_2'
from ({_LINES}) l join {{orders}} on o_orderkey = l_orderkey where l_linenumber = 6
union all
select {_SCHEMA_OF}, concat('t_', o_orderkey), 'c_1', 1, 'PRIMARY', cast(null as varchar(1)),
       cast(null as varchar(1)), cast(null as varchar(1)) from {{orders}}
"""


@registry.add(
    "mysql_containers",
    f"""
select TABLE_SCHEMA as database, '' as schema_name, TABLE_NAME as container_name,
       case when TABLE_TYPE = 'BASE TABLE' then 'table' else 'view' end as container_type,
       TABLE_ROWS as estimated_count,
       case when TABLE_COMMENT not in ('', 'VIEW') then TABLE_COMMENT end as native_description,
       strftime(UPDATE_TIME, '%Y-%m-%dT%H:%M:%S') as last_modified_at
from ({plain(_MY_TABLES)}) where TABLE_SCHEMA <> 'mysql'
""",
)
def mysql_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mysql.containers(run_sql(spark, sf_dir, _MY_TABLES))


@registry.add(
    "mysql_columns",
    f"""
with k as (select TABLE_SCHEMA, TABLE_NAME, COLUMN_NAME,
                  max_by((case when coalesce(REFERENCED_TABLE_SCHEMA, '') not in ('', TABLE_SCHEMA)
                               then REFERENCED_TABLE_SCHEMA || '.' || REFERENCED_TABLE_NAME
                               else REFERENCED_TABLE_NAME end, REFERENCED_COLUMN_NAME),
                         (ORDINAL_POSITION, CONSTRAINT_NAME)) as target
           from ({plain(_MY_KEYS)}) where REFERENCED_TABLE_NAME is not null group by all)
select c.TABLE_SCHEMA as database, '' as schema_name, c.TABLE_NAME as container_name,
       c.COLUMN_NAME as column_name,
       row_number() over (partition by c.TABLE_SCHEMA, c.TABLE_NAME order by ORDINAL_POSITION)::int as ordinal,
       COLUMN_TYPE as native_type, IS_NULLABLE = 'YES' as nullable, COLUMN_KEY = 'PRI' as is_pk,
       target is not null as is_fk, nullif(COLUMN_COMMENT, '') as native_description,
       target[1] as references_container, target[2] as references_column
from ({plain(_MY_COLUMNS)}) c left join k using (TABLE_SCHEMA, TABLE_NAME, COLUMN_NAME)
where c.TABLE_SCHEMA <> 'mysql'
""",
)
def mysql_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mysql.columns(
        run_sql(spark, sf_dir, _MY_COLUMNS), run_sql(spark, sf_dir, _MY_KEYS)
    )


# ---- SQL Server

_SS = {
    "sys_objects": """
select o_orderkey as object_id, concat('obj_', o_orderkey) as name, c_nationkey as schema_id,
       case o_orderpriority when '1-URGENT' then 'V ' when '2-HIGH' then 'P ' else 'U ' end as type,
       case when o_totalprice >= 50000 then o_orderdate + case when o_totalprice >= 100000
            then interval '1500' microsecond else interval '0' microsecond end end as modify_date,
       case when o_totalprice >= 470000 then 1 else 0 end as is_ms_shipped
from {orders} join {customer} on c_custkey = o_custkey
""",
    "sys_schemas": "select n_nationkey as schema_id, lower(n_name) as name from {nation}",
    "sys_columns": f"""
select l_orderkey as object_id, concat('col_', l_linenumber) as name, l_linenumber as column_id,
       case flag when 1 then 1 when 2 then case status when 2 then 2 else 3 end
            else case status when 2 then 4 else 5 end end as user_type_id,
       case when supplier < 20 then -1 else 2 * supplier end as max_length,
       l_linenumber + 10 as precision, l_linenumber as scale,
       case status when 2 then 1 else 0 end as is_nullable
from ({_LINES}) l
""",
    "sys_types": """
select r_regionkey + 1 as user_type_id, case r_regionkey when 0 then 'int' when 1 then 'nvarchar'
  when 2 then 'varbinary' when 3 then 'decimal' else 'datetime2' end as name from {region}
""",
    "extended_properties": f"""
select 1 as class, o_orderkey as major_id, 0 as minor_id, 'MS_Description' as name,
       case when o_totalprice < 200000 then '' else concat('sold to ', o_custkey) end as value
from {{orders}} where o_orderstatus <> 'P'
union all
select 1, l_orderkey, l_linenumber, case flag when 3 then 'MS_Description' else 'Other' end,
       concat('line ', l_linenumber) from ({_LINES}) l
""",
    "partition_stats": """
select l_orderkey as object_id, case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as index_id,
       cast(l_quantity as bigint) as row_count
from {lineitem} join {orders} on o_orderkey = l_orderkey where o_orderpriority <> '1-URGENT'
""",
    "sys_indexes": """
select o_orderkey as object_id, 1 as index_id, case o_orderstatus when 'P' then 0 else 1 end as is_primary_key
from {orders}
""",
    "sys_index_columns": """
select distinct l_orderkey as object_id, 1 as index_id, l_linenumber as column_id from {lineitem}
where l_linenumber <= 2
""",
    "sys_foreign_keys": "select o_orderkey as object_id from {orders} where o_orderstatus <> 'F'",
    "sys_foreign_key_columns": f"""
select l_orderkey as constraint_object_id, l_orderkey as parent_object_id,
       l_linenumber as parent_column_id, part as referenced_object_id, 1 as referenced_column_id
from ({_LINES}) l where l_linenumber >= 6
""",
}


def _ss(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [run_sql(spark, sf_dir, _SS[name]) for name in names]


_SS_WITH = "with " + ",\n".join(f"{n} as ({plain(t)})" for n, t in _SS.items()) + f""",
obj as (select o.*, s.name as schema_name, s.name || '.' || o.name as container_name
        from sys_objects o join sys_schemas s using (schema_id)
        where trim(o.type) in ('U', 'V') and o.is_ms_shipped = 0),
props as (select major_id, minor_id, nullif(value, '') as description from extended_properties
          where class = 1 and name = 'MS_Description')
"""


@registry.add(
    "sqlserver_containers",
    f"""{_SS_WITH}
select 'shop' as database, schema_name, container_name,
       case trim(type) when 'U' then 'table' else 'view' end as container_type,
       (select sum(row_count) from partition_stats p where p.object_id = obj.object_id
          and index_id in (0, 1))::bigint as estimated_count,
       description as native_description, strftime(modify_date, '%Y-%m-%dT%H:%M:%S')
         || case when microsecond(modify_date) % 1000000 = 0 then '' else strftime(modify_date, '.%f') end
         as last_modified_at
from obj left join props on major_id = object_id and minor_id = 0
""",
)
def sqlserver_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = _ss(
        spark, sf_dir, "sys_objects", "sys_schemas", "extended_properties", "partition_stats"
    )
    return sqlserver.containers(*frames, "shop")


@registry.add(
    "sqlserver_columns",
    f"""{_SS_WITH},
pk as (select ic.object_id, ic.column_id from sys_indexes i join sys_index_columns ic
       on ic.object_id = i.object_id and ic.index_id = i.index_id where i.is_primary_key = 1),
fk as (select c.parent_object_id as object_id, c.parent_column_id as column_id,
              s.name || '.' || t.name as target, rc.name as target_column
       from sys_foreign_keys f join sys_foreign_key_columns c on c.constraint_object_id = f.object_id
       join sys_objects t on t.object_id = c.referenced_object_id and trim(t.type) = 'U'
       join sys_schemas s on s.schema_id = t.schema_id
       join sys_columns rc on rc.object_id = c.referenced_object_id and rc.column_id = c.referenced_column_id)
select 'shop' as database, schema_name, container_name, c.name as column_name,
       row_number() over (partition by c.object_id order by c.column_id)::int as ordinal,
       case when t.name = 'decimal' then t.name || '(' || c.precision || ',' || c.scale || ')'
            when t.name in ('nvarchar', 'varbinary') and c.max_length = -1 then t.name || '(max)'
            when t.name = 'nvarchar' then t.name || '(' || c.max_length // 2 || ')'
            when t.name = 'varbinary' then t.name || '(' || c.max_length || ')' else t.name end as native_type,
       c.is_nullable = 1 as nullable, pk.object_id is not null as is_pk, target is not null as is_fk,
       description as native_description, target as references_container, target_column as references_column
from sys_columns c join obj using (object_id) join sys_types t using (user_type_id)
left join props on major_id = c.object_id and minor_id = c.column_id
left join pk on pk.object_id = c.object_id and pk.column_id = c.column_id
left join fk on fk.object_id = c.object_id and fk.column_id = c.column_id
""",
)
def sqlserver_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = _ss(
        spark,
        sf_dir,
        "sys_objects",
        "sys_schemas",
        "sys_columns",
        "sys_types",
        "extended_properties",
        "sys_indexes",
        "sys_index_columns",
        "sys_foreign_keys",
        "sys_foreign_key_columns",
    )
    return sqlserver.columns(*frames, "shop")
