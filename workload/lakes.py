"""Lake folders written from the given tables, found and read back; and a
whole scan of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondar.model import TOP_VALUES_MAX_DISTINCT
from sondar.operators.profile import row_counts
from sondar.plans.scan import scan_tables
from sondar.plans.store import CatalogStore
from sondar.session import scratch_dir
from sondar.sources import lake
from workload import TABLES, plain, registry, run_sql, table
from workload.profiles import NUMBERS, OTHERS, TEXTS, TIMES, bounds, clock, union

# A listing of files: one per document, spread over datasets and depths.
_FILES = """
select concat('/lake/', case when n_chars < 200 then '' else concat(lang, '_', source, '/') end,
  case when n_chars >= 1000 then 'dt=2024-01-01/' else '' end,
  case when n_chars >= 3000 then 'h=1/' else '' end,
  case when n_chars >= 6000 then 'm=2/' else '' end,
  case when n_chars >= 9000 then 's=3/' else '' end,
  'part-', lpad(cast(doc_id as varchar(10)), 8, '0'),
  case when n_chars < 1500 then '.txt' when source = 'src1' then '.csv' when lang = 'fr' then '.ndjson'
       when lang = 'de' then '.json' else '.parquet' end) as path
from {documents}
"""


@registry.add(
    "lake_datasets",
    f"""
with f as (select path, string_split(substr(path, 7), '/') as parts from ({plain(_FILES)})),
k as (select *, list_transform(range(2, len(parts) + 1), lambda i:
        case when i = len(parts) then '0' else '1' end || parts[i]) as ordering,
        regexp_extract(path, '\\.([a-z]+)$', 1) as ext from f)
select parts[1] as container_name,
       case arg_min(ext, ordering) when 'parquet' then 'parquet' when 'csv' then 'csv' else 'json' end as format,
       arg_min(path, ordering) as first_file
from k where ext in ('parquet', 'csv', 'json', 'jsonl', 'ndjson') and len(parts) >= 2
group by 1
""",
)
def lake_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.datasets(run_sql(spark, sf_dir, _FILES), "/lake")


_LEVELS = {"customer": "", "supplier": "/a", "part": "/a/b=1", "orders": "/a/b=1/c", "nation": "/a/b=1/c/d/e"}


@registry.add(
    "lake_discovered",
    union(
        [
            f"select distinct '{t}' as container_name, '{'csv' if t == 'nation' else 'parquet'}' as format, "
            f"{below.count('/') + 1} as depth from {t}"
            for t, below in _LEVELS.items()
        ]
    ),
)
def lake_discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake of folders up to five levels deep, each search ending with its first file."""
    root = scratch_dir(spark, "levels")
    for name, below in _LEVELS.items():
        writer = table(spark, sf_dir, name).write.format("csv" if name == "nation" else "parquet")
        writer.save(f"{root}/{name}{below}")
    found = lake.discover(spark, root)
    inside = F.expr("substring_index(first_file, concat('/', container_name, '/'), -1)")
    return found.select("container_name", "format", F.size(F.split(inside, "/")).alias("depth"))


@registry.add(
    "lake_files",
    union(
        [
            f"select '{t}' as container_name, count(*) as estimated_count from {t}"
            for t in TABLES
        ]
    ),
)
def lake_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every data file of the given folder is a dataset; found, then counted."""
    found = lake.discover_flat(spark, sf_dir).collect()
    return row_counts(
        {
            row.container_name: spark.read.format(row.format).load(row.first_file)
            for row in found
        }
    )


_KEPT = "event_id, user_id, value, event_type"


def _written(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    root = scratch_dir(spark, f"lake-{kind}")
    rows = run_sql(spark, sf_dir, f"select {_KEPT} from {{events}}")
    rows.write.partitionBy("event_type").option("header", "true").format(kind).save(
        f"{root}/events"
    )
    return lake.read_dataset(spark, root, "events").select(
        F.col("event_id").cast("bigint"), F.col("user_id").cast("bigint"), "value", "event_type"
    )


@registry.add("lake_parquet", f"select {_KEPT} from events")
def lake_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "parquet")


@registry.add("lake_csv", f"select {_KEPT} from events")
def lake_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "csv")


@registry.add("lake_json", f"select {_KEPT} from events")
def lake_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, "json")


# ---- a whole scan

_PRIMARY = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey",
    "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
    "documents": "doc_id",
}
_FOREIGN = {
    ("nation", "n_regionkey"): ("region", "r_regionkey"),
    ("customer", "c_nationkey"): ("nation", "n_nationkey"),
    ("supplier", "s_nationkey"): ("nation", "n_nationkey"),
    ("orders", "o_custkey"): ("customer", "c_custkey"),
    ("lineitem", "l_orderkey"): ("orders", "o_orderkey"),
    ("lineitem", "l_partkey"): ("part", "p_partkey"),
    ("lineitem", "l_suppkey"): ("supplier", "s_suppkey"),
    ("labels", "doc_id"): ("documents", "doc_id"),
}


def _scanned_sql() -> str:
    parts = []
    for t in TABLES:
        columns = [
            *[(c, "number") for c in NUMBERS[t]],
            *[(c, "time") for c in TIMES.get(t, [])],
            *[(c, "text") for c in TEXTS[t]],
            *[(c, "other") for c in OTHERS.get(t, [])],
        ]
        for c, kind in columns:
            low = high = top = "null::varchar"
            distinct = "null::bigint"
            if kind == "number":
                low, high = bounds(c)
            elif kind == "time":
                low, high = clock(f"min({c})"), clock(f"max({c})")
            elif kind == "text":
                distinct = f"count(distinct {c})"
                top = (
                    f"case when count(distinct {c}) <= {TOP_VALUES_MAX_DISTINCT} then "
                    f"(select v from (select {c} as v, count(*) as n from {t} group by 1) "
                    "order by n desc, v limit 1) end"
                )
            to = _FOREIGN.get((t, c), (None, None))
            quoted = [f"'{x}'" if x else "null::varchar" for x in to]
            parts.append(
                f"select '{t}' as container_name, '{c}' as column_name, "
                f"{str(_PRIMARY.get(t) == c).lower()} as is_pk, {quoted[0]} as references_container, "
                f"{quoted[1]} as references_column, count(*) as estimated_count, "
                f"(count(*) - count({c}))::double / count(*) as null_ratio, "
                f"{distinct} as distinct_count, {low} as min_value, {high} as max_value, "
                f"{top} as commonest from {t}"
            )
    return union(parts)


@registry.add("scan", _scanned_sql())
def scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas, declared keys, row counts and profiles of all given tables,
    committed to a new inventory and read back from it."""
    store = CatalogStore(spark, f"{scratch_dir(spark, 'scan')}/inventory")
    values = ", ".join(
        [f"('{t}', '{c}', true, null, null)" for t, c in _PRIMARY.items()]
        + [f"('{t}', '{c}', false, '{rt}', '{rc}')" for (t, c), (rt, rc) in _FOREIGN.items()]
    )
    keys = spark.sql(
        f"select * from values {values} as k(container_name, column_name, is_pk, "
        "references_container, references_column)"
    )
    tables = {t: (lambda t=t: table(spark, sf_dir, t)) for t in TABLES}
    scan_tables(
        store, "given", tables, keys=keys, counted=TABLES,
        max_distinct=TOP_VALUES_MAX_DISTINCT,
    )
    counts = store.state("containers").select("container_name", "estimated_count")
    return store.state("columns").join(counts, "container_name").select(
        "container_name",
        "column_name",
        "is_pk",
        "references_container",
        "references_column",
        "estimated_count",
        F.expr("profile['null_ratio'].null_ratio").alias("null_ratio"),
        F.expr("profile['distinct_count'].distinct_count").alias("distinct_count"),
        F.expr("profile['min_max'].min_value").alias("min_value"),
        F.expr("profile['min_max'].max_value").alias("max_value"),
        F.expr("get(profile['top_values'].top_values, 0).value").alias("commonest"),
    )
