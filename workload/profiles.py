"""Column statistics over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondar.functions.text import json_ready, value_text
from sondar.model import TOP_VALUES_MAX_DISTINCT, UnknownColumn
from sondar.operators.profile import (
    bitmap_counts,
    light_profile,
    profile_column,
    table_profile,
)
from sondar.plans.folders import FolderStatistics
from sondar.session import scratch_dir
from sondar.sources import footers
from workload import TABLES, plain, registry, run_sql, table

# Columns of the given tables by the statistics their type gets.
NUMBERS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey", "n_regionkey"],
    "customer": ["c_custkey", "c_nationkey", "c_acctbal"],
    "supplier": ["s_suppkey", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_totalprice"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax",
    ],
    "events": ["event_id", "user_id", "value"],
    "documents": ["doc_id", "n_chars"],
    "embeddings": ["vec_id", "label"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn"],
}
TIMES = {"orders": ["o_orderdate"], "lineitem": ["l_shipdate"], "events": ["ts"]}
TEXTS = {
    "region": ["r_name"],
    "nation": ["n_name"],
    "customer": ["c_name", "c_mktsegment"],
    "supplier": ["s_name"],
    "part": ["p_name", "p_brand", "p_type"],
    "orders": ["o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_linestatus"],
    "events": ["event_type", "props"],
    "documents": ["text", "lang", "source"],
    "embeddings": [],
    "pages": ["url", "html"],
    "benchmark": ["text"],
    "labels": [],
    "conversations": ["role", "text"],
}
OTHERS = {"embeddings": ["embedding"]}


def clock(x: str) -> str:
    """DuckDB text of a time as the library writes it."""
    return (
        f"strftime({x}, '%Y-%m-%dT%H:%M:%S') || "
        f"case when extract('microsecond' from {x}) % 1000000 = 0 then '' "
        f"else '.' || lpad(cast(extract('microsecond' from {x}) % 1000000 as varchar), 6, '0') end"
    )


def bounds(c: str) -> tuple[str, str]:
    """DuckDB text of a column's range; a zero has no sign."""
    return tuple(
        f"case {f}({c})::varchar when '-0.0' then '0.0' else {f}({c})::varchar end"
        for f in ("min", "max")
    )


def distinct_sql(x: str, source: str) -> str:
    return f"(select count(distinct {x}) from {source})"


def union(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


# Events with holes: the given tables have no nulls.
GAPS = """
select event_id, ts, user_id, nullif(event_type, 'error') as event_type,
       case when value >= 1.0 then value end as value, props
from {events}
"""


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, GAPS)


GAP_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@registry.add(
    "profile_null_ratio",
    f"with g as ({plain(GAPS)})\n"
    + union(
        [
            f"select '{c}' as column_name, "
            f"(count(*) - count({c}))::double / count(*) as null_ratio from g"
            for c in GAP_COLUMNS
        ]
    ),
)
def profile_null_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = gaps(spark, sf_dir)
    return light_profile(df, [], df.columns).select("column_name", "null_ratio")


@registry.add(
    "profile_min_max",
    union(
        [
            f"select '{c}' as column_name, {low} as min_value, {high} as max_value "
            "from lineitem"
            for c in [*NUMBERS["lineitem"], *TEXTS["lineitem"]]
            for low, high in [bounds(c)]
        ]
        + [
            f"select 'l_shipdate' as column_name, {clock('min(l_shipdate)')} as "
            f"min_value, {clock('max(l_shipdate)')} as max_value from lineitem"
        ]
    ),
)
def profile_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem")
    return table_profile(df, ["min_max"]).select("column_name", "min_value", "max_value")


_ALL_LINEITEM = [*NUMBERS["lineitem"], *TEXTS["lineitem"], "l_shipdate"]


@registry.add(
    "profile_distinct",
    union(
        [
            f"select '{c}' as column_name, count(distinct {c}) as distinct_count "
            "from lineitem"
            for c in _ALL_LINEITEM
        ]
    ),
)
def profile_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem")
    return table_profile(df, ["distinct_count"]).select("column_name", "distinct_count")


_BITMAPS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "shipped", "tested"]


@registry.add(
    "profile_distinct_bitmaps",
    "with t as (select *, l_shipdate::date as shipped, "
    "case when l_orderkey % 2 = 0 then -l_orderkey end as tested from lineitem)\n"
    + union(
        [
            f"select '{c}' as column_name, count(distinct {c}) as distinct_count, "
            f"count(*) as rows, count(*) - count({c}) as nulls from t"
            for c in _BITMAPS
        ]
    ),
)
def profile_distinct_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers, negative and missing ones too, and dates, by bitmaps."""
    df = table(spark, sf_dir, "lineitem").selectExpr(
        "*", "cast(l_shipdate as date) as shipped", "if(l_orderkey % 2 = 0, -l_orderkey, null) as tested"
    )
    return bitmap_counts(df, _BITMAPS).select("column_name", "distinct_count", "rows", "nulls")


def _ranked(name: str, source: str, column: str) -> str:
    return (
        f"select '{name}' as column_name, "
        "row_number() over (order by n desc, coalesce(v, 'None'), v is null)::int as rank, "
        "coalesce(v, '') as value, n as count, v is null as is_null "
        f"from (select {column}::varchar as v, count(*) as n from {source} group by 1)"
        " qualify rank <= 20"
    )


def _exploded(profile: DataFrame) -> DataFrame:
    return profile.where(F.col("top_values").isNotNull()).select(
        "column_name", F.posexplode("top_values").alias("rank", "item")
    ).select(
        "column_name",
        (F.col("rank") + 1).alias("rank"),
        "item.value",
        "item.count",
        "item.is_null",
    )


@registry.add(
    "profile_top_values",
    f"with g as ({plain(GAPS)})\n"
    + union(
        [
            _ranked("event_type", "g", "event_type"),
            _ranked("props", "g", "props"),
            _ranked("user_id", "g", "user_id"),
            _ranked("value", "g", "value"),
        ]
    ),
)
def profile_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {c: ["top_values"] for c in ("event_type", "props", "user_id", "value")}
    return _exploded(table_profile(gaps(spark, sf_dir), wanted))


def profile_row_sql(source: str, name: str, kinds: dict[str, list[str]]) -> str:
    """One row per column of a table: what its type gets."""
    parts = []
    for c in kinds.get("numbers", []):
        low, high = bounds(c)
        parts.append((c, "null::bigint", low, high))
    for c in kinds.get("times", []):
        parts.append((c, "null::bigint", clock(f"min({c})"), clock(f"max({c})")))
    for c in kinds.get("texts", []):
        parts.append((c, f"count(distinct {c})", "null::varchar", "null::varchar"))
    for c in kinds.get("others", []):
        parts.append((c, "null::bigint", "null::varchar", "null::varchar"))
    return union(
        [
            f"select '{name}' as container_name, '{c}' as column_name, "
            f"(count(*) - count({c}))::double / count(*) as null_ratio, "
            f"{distinct} as distinct_count, {low} as min_value, {high} as max_value "
            f"from {source}"
            for c, distinct, low, high in parts
        ]
    )


def _kinds(name: str) -> dict[str, list[str]]:
    return {
        "numbers": NUMBERS[name],
        "times": TIMES.get(name, []),
        "texts": TEXTS[name],
        "others": OTHERS.get(name, []),
    }


def _flat(profile: DataFrame, name: str) -> DataFrame:
    return profile.select(
        F.lit(name).alias("container_name"),
        "column_name",
        "null_ratio",
        "distinct_count",
        "min_value",
        "max_value",
    )


def _register_table(name: str) -> None:
    @registry.add(f"table_profile_{name}", profile_row_sql(name, name, _kinds(name)))
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _flat(table_profile(table(spark, sf_dir, name)), name)


for _name in TABLES:
    _register_table(_name)


def _gated(source: str, column: str) -> str:
    return (
        f"select * from ({_ranked(column, source, column)}) "
        f"where {distinct_sql(column, source)} <= 200"
    )


@registry.add(
    "table_profile_top_values",
    union([_gated("documents", c) for c in TEXTS["documents"]]),
)
def table_profile_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commonest values where a column has few; text has too many."""
    return _exploded(
        table_profile(
            table(spark, sf_dir, "documents"), max_distinct=TOP_VALUES_MAX_DISTINCT
        )
    )


@registry.add(
    "profile_column",
    "select 'lang' as column_name, count(distinct lang) as distinct_count from documents",
)
def one_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents")
    return profile_column(df, "lang", "distinct_count").select(
        "column_name", "distinct_count"
    )


@registry.add(
    "profile_unknown_column",
    "select 'lang' as column_name, count(distinct lang) as distinct_count, null::varchar as refused from documents "
    "union all select 'Lang', null, 'UnknownColumn: Lang' union all select 'no such', null, 'UnknownColumn: no such'",
)
def unknown_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that is there is profiled, others are refused by their exact names."""
    df, out = table(spark, sf_dir, "documents"), None
    for name in ("lang", "Lang", "no such"):
        try:
            found = profile_column(df, name, "distinct_count").select(
                "column_name", "distinct_count", F.lit(None).cast("string").alias("refused")
            )
        except UnknownColumn as error:
            found = spark.createDataFrame(
                [(name, None, f"{type(error).__name__}: {error}")],
                "column_name string, distinct_count bigint, refused string",
            )
        out = found if out is None else out.unionAll(found)
    return out


@registry.add(
    "profile_approx_distinct",
    union(
        [
            f"select '{c}' as column_name, count(distinct {c}) as distinct_count, "
            "true as approximate from lineitem"
            for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"]
        ]
    ),
)
def profile_approx_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact counts where the approximate ones are within four deviations of
    them; an approximate count that is further off is shown itself."""
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"]
    df = table(spark, sf_dir, "lineitem").select(*columns)
    rough = table_profile(df, ["distinct_count"], approximate=True, rsd=0.02)
    exact = table_profile(df, ["distinct_count"]).select(
        "column_name", F.col("distinct_count").alias("exact")
    )
    off = F.abs(F.col("distinct_count") - F.col("exact"))
    return rough.join(exact, "column_name").select(
        "column_name",
        F.when(off <= 0.08 * F.col("exact"), F.col("exact"))
        .otherwise(F.col("distinct_count"))
        .alias("distinct_count"),
        "approximate",
    )


_DAILY = {"o_orderkey": "n", "o_totalprice": "n", "o_orderdate": "t", "o_orderpriority": "c", "status": "c"}


def _daily_sql() -> str:
    def row(name: str, kind: str) -> str:
        x = "o_orderstatus" if name == "status" else name
        low, high = (clock(f"min({x})"), clock(f"max({x})")) if kind == "t" else bounds(x)
        distinct = f"count(distinct {x})" if kind == "c" else "null::bigint"
        return (
            f"select '{name}' as column_name, (count(*) - count({x}))::double / count(*) as null_ratio, "
            f"{low} as min_value, {high} as max_value, {distinct} as distinct_count, "
            "[3, 1, 0] as folders_read from orders"
        )

    return union([row(name, kind) for name, kind in _DAILY.items()])


@registry.add("profile_of_folders", _daily_sql())
def profile_of_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in folders: the first look reads three of them, the second the one that
    came since, the third none; what is merged is what a look at everything says."""
    lake = scratch_dir(spark, "daily")
    folders = {name: f"{lake}/orders/status={name}" for name in ("F", "O", "P")}
    orders = table(spark, sf_dir, "orders").select(*[c for c in _DAILY if c != "status"], "o_orderstatus")
    late = F.col("o_orderkey") % 7 == 0
    for name, folder in folders.items():
        mine = orders.where((F.col("o_orderstatus") == name) & ~late)
        mine.drop("o_orderstatus").write.parquet(f"{folder}/part=0")
    store = FolderStatistics(spark, f"{lake}/kept")
    read = [store.refresh(f"{lake}/orders").read]
    orders.where(late).drop("o_orderstatus").write.parquet(f"{folders['F']}/part=1")
    read.append(store.refresh(f"{lake}/orders").read)
    last = store.refresh(f"{lake}/orders")
    read.append(last.read)
    listed = F.col("column_name").isin([c for c, kind in _DAILY.items() if kind == "c"])
    return last.profile.where(F.col("column_name") != "part").select(
        "column_name", "null_ratio", "min_value", "max_value",
        F.when(listed, F.col("distinct_count")).alias("distinct_count"),
        F.array(*map(F.lit, read)).alias("folders_read"),
    )


@registry.add(
    "container_counts",
    union(
        [
            f"select '{t}' as container_name, count(*) as estimated_count from {t}"
            for t in TABLES
        ]
    ),
)
def container_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return footers.footer_counts(spark, {t: f"{sf_dir}/{t}.parquet" for t in TABLES})


_FOOTERS = ["orders", "lineitem", "labels", "events"]


def _footer_sql(name: str) -> str:
    parts = []
    for c in [*NUMBERS[name], *TIMES.get(name, []), *TEXTS[name]]:
        low, high = (clock(f"min({c})"), clock(f"max({c})")) if c in TIMES.get(name, []) else bounds(c)
        parts.append(
            f"select '{name}' as container_name, '{c}' as column_name, "
            f"(count(*) - count({c}))::double / count(*) as null_ratio, "
            f"{low} as min_value, {high} as max_value, "
            f"(select count(*) from {name}) as estimated_count from {name}"
        )
    return union(parts)


@registry.add("profile_from_footers", union([_footer_sql(name) for name in _FOOTERS]))
def profile_from_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null ratios, ranges and row counts as the files' footers have them."""
    folders = {name: f"{sf_dir}/{name}.parquet" for name in _FOOTERS}
    found = None
    for name, folder in folders.items():
        one = footers.footer_profile(spark, folder).withColumn("container_name", F.lit(name))
        found = one if found is None else found.unionByName(one)
    return found.join(footers.footer_counts(spark, folders), "container_name").select(
        "container_name", "column_name", "null_ratio", "min_value", "max_value", "estimated_count"
    )


@registry.add(
    "value_texts",
    "select "
    + ", ".join(
        [
            f"{c}::varchar as {c}"
            for c in [*NUMBERS["lineitem"], *TEXTS["lineitem"]]
        ]
    )
    + f", {clock('l_shipdate')} as l_shipdate, "
    "case when l_discount > 0.05 then 'True' else 'False' end as discounted, "
    "strftime(l_shipdate, '%Y-%m-%d') as shipped, "
    "(l_extendedprice * 100000000)::varchar as scaled_up, "
    "(l_tax / 10000000)::varchar as scaled_down "
    "from lineitem",
)
def value_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of a table as text."""
    df = table(spark, sf_dir, "lineitem").selectExpr(
        "*",
        "l_discount > 0.05 as discounted",
        "cast(l_shipdate as date) as shipped",
        "l_extendedprice * 100000000 as scaled_up",
        "l_tax / 10000000 as scaled_down",
    )
    return df.select(
        *[value_text(f.name, f.dataType).alias(f.name) for f in df.schema.fields]
    )


@registry.add(
    "json_ready",
    f"""
select event_id, user_id, event_type, value, {clock('ts')} as ts, strftime(ts, '%Y-%m-%d') as day,
       to_base64(encode(props)) as raw, (value::decimal(12,2))::varchar as amount,
       '{{"at":"' || {clock('ts')} || '","days":["' || strftime(ts, '%Y-%m-%d') || '"]}}' as nested
from events
""",
)
def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row in a shape JSON can carry; the nested value is shown as text."""
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "ts",
        "cast(ts as date) as day",
        "cast(props as binary) as raw",
        "cast(value as decimal(12,2)) as amount",
        "named_struct('at', ts, 'days', array(cast(ts as date))) as nested",
    )
    return json_ready(rows).withColumn("nested", F.to_json("nested"))
