"""A catalog derived from the given tables, as SQL both engines read.

Every order is a container and its line numbers are the columns, so the
catalog grows with the tables. ``THEN`` and ``NOW`` are two looks at it:
orders below 20 000 are gone by the second, those from 480 000 up are new, and
columns come, go and change type with their tax, discount and quantity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from workload import plain, run_sql, table

KEY = "database, schema_name, container_name"

_CONTAINERS = """
select o_orderpriority as database, lower(o_orderstatus) as schema_name,
       concat('order_', o_orderkey) as container_name,
       case when o_orderdate < timestamp '1996-01-01 00:00:00' then 'view' else 'table' end
         as container_type,
       case when o_orderdate >= timestamp '1996-01-01 00:00:00'
            then cast(floor(o_totalprice) as bigint) end as estimated_count,
       case when o_totalprice >= 300000 then concat('@NOTE ', o_custkey) end
         as native_description,
       cast(null as varchar(1)) as last_modified_at,
       @ERROR as error
from {orders} where @WHERE
"""

CONTAINERS_THEN = (
    _CONTAINERS.replace("@NOTE", "order of customer")
    .replace("@ERROR", "cast(null as varchar(1))")
    .replace("@WHERE", "o_totalprice < 480000")
)
CONTAINERS_NOW = (
    _CONTAINERS.replace(
        "concat('@NOTE ', o_custkey)",
        "concat(case when o_totalprice < 310000 then 'Email of ' else 'order of customer ' end, o_custkey)",
    )
    .replace(
        "@ERROR",
        "case when o_totalprice >= 200000 and o_totalprice < 205000 then 'OSError: gone' end",
    )
    .replace("@WHERE", "o_totalprice >= 20000")
)

_SHAPE = """
select o_orderpriority as database, lower(o_orderstatus) as schema_name,
       concat('order_', l_orderkey) as container_name,
       case l_linenumber when 1 then 'id' when 2 then 'user_email' when 3 then 'createdAt'
            when 4 then 'API-key' when 5 then 'unit_price' when 6 then 'phoneNumber'
            else 'note' end as column_name,
       l_linenumber as ordinal,
       @TYPE as native_type,
       status = 2 as nullable, l_linenumber = 1 as is_pk, l_linenumber = 5 as is_fk,
       case when flag = 3 then concat('line ', l_linenumber, ' | returned') end
         as native_description,
       case when l_linenumber = 5 then concat('part_', part) end as references_container,
       case when l_linenumber = 5 and part > 100 then 'id' end as references_column
"""
_LINES = """select l_orderkey, l_linenumber,
             min(case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end) as flag,
             min(case l_linestatus when 'F' then 1 else 2 end) as status,
             max(l_partkey) as part, sum(l_quantity) as quantity,
             max(l_discount) as discount, max(l_tax) as tax
      from {lineitem} group by l_orderkey, l_linenumber"""
_COLUMNS = (
    f"{_SHAPE}from ({_LINES}) l\n"
    "join (select * from {orders} where @ORDERS) o on o_orderkey = l_orderkey\nwhere @WHERE\n"
)
# The same from lines that have met their orders.
SEEN = f"select * from ({_LINES}) l join {{orders}} o on o_orderkey = l_orderkey"
_COLUMNS_SEEN = f"{_SHAPE}from (select * from {{seen}} where @ORDERS) s where @WHERE"
_TYPE = "case flag when 1 then 'bigint' when 2 then 'varchar(20)' else 'timestamp' end"


def _then(columns: str) -> str:
    return (
        columns.replace("@TYPE", _TYPE)
        .replace("@ORDERS", "o_totalprice < 480000")
        .replace("@WHERE", "tax < 0.075")
    )


def _now(columns: str) -> str:
    # What could not be read has no columns to list.
    return (
        columns.replace("@TYPE", f"case when quantity > 48 then 'text' else {_TYPE} end")
        .replace(
            "@ORDERS",
            "o_totalprice >= 20000 and not (o_totalprice >= 200000 and o_totalprice < 205000)",
        )
        .replace("@WHERE", "discount < 0.095")
    )


COLUMNS_THEN, COLUMNS_NOW = _then(_COLUMNS), _now(_COLUMNS)
COLUMNS_THEN_SEEN, COLUMNS_NOW_SEEN = _then(_COLUMNS_SEEN), _now(_COLUMNS_SEEN)

# What people and earlier scans left on the first look's columns.
WRITTEN = """
select c.*,
       case when ordinal = 2 and nullable then 'where we | write' end as description,
       case when ordinal = 2 and nullable then 'human' end as description_source,
       cast(null as timestamp) as description_updated_at,
       case when ordinal = 2 then case when nullable then 'none' else 'pii' end
            when ordinal = 6 then 'pii' end as sensitivity,
       case when ordinal = 2 then case when nullable then 'human' else 'detected' end
            when ordinal = 6 then 'detected' end as sensitivity_source,
       timestamp '2024-01-01 00:00:00' as scanned_at
from (@COLUMNS) c
"""
COLUMNS_STORED = WRITTEN.replace("@COLUMNS", COLUMNS_THEN)

_STORED = """
select {key}, container_type, estimated_count, schema_hash, native_description,
       case when estimated_count >= 400000 then 'a big | one' end as description,
       case when estimated_count >= 400000 then 'ai' end as description_source,
       cast(null as timestamp) as description_updated_at, last_modified_at, error,
       timestamp '2024-01-01 00:00:00' as scanned_at
from {hashed} h
"""


def frame(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A look's rows; line items meet their order where they are grouped, in one shuffle."""
    if "{lineitem}" not in text:
        return run_sql(spark, sf_dir, text)
    lines = table(spark, sf_dir, "lineitem").repartition("l_orderkey")
    return run_sql(spark, sf_dir, text, lineitem=lines)


def written(columns: DataFrame) -> DataFrame:
    """A look's columns with what people and earlier scans left on them."""
    return columns.sparkSession.sql(WRITTEN.replace("(@COLUMNS)", "{columns}"), columns=columns)


def stored_containers(hashed: DataFrame) -> DataFrame:
    """Fingerprinted containers as an inventory would hold them."""
    return hashed.sparkSession.sql(
        _STORED.replace("{key}", KEY), hashed=hashed
    )


# ---- the same in DuckDB


def _framed(x: str) -> str:
    return f"coalesce(length({x}::varchar) || ':' || {x}::varchar, '-')"


def hashed_sql(containers: str, columns: str) -> str:
    """DuckDB: containers with their fingerprint."""
    fields = [
        "column_name", "ordinal", "native_type", "nullable", "is_pk", "is_fk",
        "native_description", "references_container", "references_column",
    ]
    digest = "sha256(" + " || ".join(_framed(f) for f in fields) + ")"
    return f"""
select c.*, sha256({_framed('native_description')} || coalesce(digests, '')) as schema_hash
from ({plain(containers)}) c left join (
  select {KEY}, string_agg({digest}, '' order by ordinal, column_name) as digests
  from ({plain(columns)}) group by all) d using ({KEY})
"""


HASHED_THEN = hashed_sql(CONTAINERS_THEN, COLUMNS_THEN)
HASHED_NOW = hashed_sql(CONTAINERS_NOW, COLUMNS_NOW)

STORED_CONTAINERS = _STORED.replace("{key}", KEY).replace("{hashed}", f"({HASHED_THEN})")

# Old and new containers side by side, with what a scan does about each.
COMPARED = f"""
select n.*, nullif(o.schema_hash, '') as old_hash,
       case when n.error is not null then 'failed'
            when o.schema_hash = n.schema_hash then 'skipped' else 'done' end as outcome
from ({HASHED_NOW}) n left join ({HASHED_THEN}) o using ({KEY})
"""
