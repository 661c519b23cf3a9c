"""Scans of the given tables that meet what real ones meet: several schemas,
emptied tables, parts that fail, listings of a source, document collections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondar.model import COLUMN_KEY, CONTAINER_KEY, LISTED_CONTAINERS, ddl
from sondar.operators import documents, inventory
from sondar.operators.browse import containers_after
from sondar.operators.profile import row_counts
from sondar.plans.scan import Collection, scan_catalog, scan_tables
from sondar.plans.store import CatalogStore
from sondar.session import scratch_dir
from sondar.sources import lake, opening
from sondar.sources.documents import read_collection
from workload import browsing, registry, run_sql, table
from workload import documents as docs
from workload import ingestion as listed
from workload import sensitive
from workload.profiles import bounds, union

_NO_TEXT, _NO_COUNT = "null::varchar", "null::bigint"


def _store(spark: SparkSession, label: str) -> CatalogStore:
    return CatalogStore(spark, f"{scratch_dir(spark, label)}/inventory")


def _two_schemas_sql() -> str:
    def row(part: str, schema: str, name: str, change: str, count: str) -> str:
        return (
            f"select '{part}' as part, '{schema}' as schema_name, '{name}' as container_name, "
            f"{change} as change_type, {count} as estimated_count"
        )

    return union(
        [
            row("container", "x", "orders", _NO_TEXT, "(select count(*) from orders)"),
            row("container", "y", "customer", _NO_TEXT, "(select count(*) from customer)"),
            row("change", "x", "orders", "'container_added'", _NO_COUNT),
            row("change", "x", "events", "'container_added'", _NO_COUNT),
            row("change", "y", "customer", "'container_added'", _NO_COUNT),
            row("change", "x", "events", "'container_removed'", _NO_COUNT),
        ]
    )


@registry.add("scan_two_schemas", _two_schemas_sql())
def scan_two_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two schemas of one database are scanned, then a table of one is gone;
    the inventory and the change log of every version are read back."""
    store = _store(spark, "schemas")

    def scan(schema_name: str, *names: str) -> None:
        tables = {name: table(spark, sf_dir, name) for name in names}
        scan_tables(
            store, "shop", tables, schema_name=schema_name, counted=names, modes=[]
        )

    scan("x", "orders", "events")
    scan("y", "customer")
    scan("x", "orders")
    none = F.lit(None)
    containers = store.state("containers").select(
        F.lit("container").alias("part"),
        "schema_name",
        "container_name",
        none.cast("string").alias("change_type"),
        "estimated_count",
    )
    changes = store.log("changes").select(
        F.lit("change").alias("part"),
        "schema_name",
        "container_name",
        "change_type",
        none.cast("bigint").alias("estimated_count"),
    )
    return containers.unionAll(changes)


def _statistics(store: CatalogStore) -> DataFrame:
    return store.state("columns").select(
        "container_name",
        "column_name",
        F.expr("profile['null_ratio'].null_ratio").alias("null_ratio"),
        F.expr("profile['min_max'].min_value").alias("min_value"),
        F.expr("profile['min_max'].max_value").alias("max_value"),
    )


def _statistics_sql(name: str, column: str, ratio: str, low: str, high: str) -> str:
    return (
        f"select '{name}' as container_name, '{column}' as column_name, "
        f"{ratio} as null_ratio, {low} as min_value, {high} as max_value from {name}"
    )


@registry.add(
    "scan_after_emptying",
    union(
        [
            "select 'events' as container_name, 'event_id' as column_name, "
            f"null::double as null_ratio, {_NO_TEXT} as min_value, {_NO_TEXT} as max_value",
            _statistics_sql("customer", "c_custkey", "0::double", *bounds("c_custkey")),
            _statistics_sql(
                "customer", "c_acctbal", "1::double", f"max({_NO_TEXT})", f"max({_NO_TEXT})"
            ),
        ]
    ),
)
def scan_after_emptying(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics after a table lost its rows and a column its values: nothing
    of the first scan is left."""
    store = _store(spark, "emptied")
    events = table(spark, sf_dir, "events").select("event_id")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    scan_tables(store, "shop", {"events": events, "customer": customer})
    blank = F.nullif("c_acctbal", F.col("c_acctbal"))
    after = {
        "events": events.where(F.lit(False)),
        "customer": customer.withColumn("c_acctbal", blank),
    }
    scan_tables(store, "shop", after, force=True)
    return _statistics(store)


def _reread_sql() -> str:
    lacking = "'not read: sensitivity, profile of o_totalprice'"
    parts = []
    for step, error in ((1, lacking), (2, _NO_TEXT)):
        for column in ("o_orderkey", "o_totalprice"):
            low, high = bounds(column)
            ratio = "0::double"
            if step == 1 and column == "o_totalprice":
                low = high = f"max({_NO_TEXT})"
                ratio = "null::double"
            parts.append(
                f"select {step} as step, {error} as error, * from "
                f"({_statistics_sql('orders', column, ratio, low, high)})"
            )
    return union(parts)


@registry.add("scan_rereads_failed_parts", _reread_sql())
def scan_rereads_failed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that cannot be read is recorded as lacking; the next scan reads the
    container again although its schema is the same."""
    store = _store(spark, "reread")
    whole = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    broken = whole.withColumn(
        "o_totalprice", F.raise_error(F.lit("unreadable")).cast("double")
    )
    out = []
    for step, frame in enumerate((broken, whole), start=1):
        scan_tables(store, "shop", {"orders": frame})
        errors = store.state("containers").select("container_name", "error")
        out.append(
            _statistics(store)
            .join(errors, "container_name")
            .select(F.lit(step).alias("step"), "error", *_statistics(store).columns)
        )
    return inventory.one_inventory(out)


_PG_SCHEMA = "(select min(schema_name) from ({sql}) m)"


def _listing_sql() -> str:
    containers, columns = (
        registry.sql[name] for name in ("postgres_containers", "postgres_columns")
    )
    first = _PG_SCHEMA.format(sql=containers)
    return f"""
select c.container_name, container_type, estimated_count, c.native_description, last_modified_at,
       column_name, ordinal, native_type, is_pk, references_container
from (select * from ({containers}) a where schema_name = {first}) c
left join (select * from ({columns}) b) k using (database, schema_name, container_name)
"""


_CATALOG = {
    "geo": ["region", "nation"],
    "sales": ["orders", "lineitem"],
    "people": ["customer", "supplier"],
}


def _catalog_sql() -> str:
    def row(part: str, schema: str, name: str, change: str, count: str, low: str) -> str:
        return (
            f"select '{part}' as part, '{schema}' as schema_name, '{name}' as container_name, "
            f"{change} as change_type, {count} as estimated_count, {low} as lowest"
        )

    lows = {"region": "r_regionkey", "nation": "n_nationkey", "orders": "o_orderkey"}
    places = [(s, n) for s, names in _CATALOG.items() for n in names]
    return union(
        [row("change", s, n, "'container_added'", _NO_COUNT, _NO_TEXT) for s, n in places]
        + [row("change", "people", n, "'container_removed'", _NO_COUNT, _NO_TEXT) for n in _CATALOG["people"]]
        + [row("change", "geo", "region", "'schema_changed'", _NO_COUNT, _NO_TEXT)]
        + [
            row(
                "container", s, n, _NO_TEXT, f"(select count(*) from {n})",
                f"(select min({lows[n]})::varchar from {n})" if n in lows else _NO_TEXT,
            )
            for s, n in places if s != "people"
        ]
    )


@registry.add("scan_catalog", _catalog_sql())
def whole_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three schemas are scanned at once; then one of them is gone and a column
    changes its type. Containers are opened by what is listed; line items only listed."""
    store = _store(spark, "catalog")

    def scan(schemas: dict[str, list[str]], retyped: bool) -> None:
        containers, columns = [], []
        for schema, names in schemas.items():
            frames = {name: table(spark, sf_dir, name) for name in names}
            containers.append(
                spark.createDataFrame(
                    [("shop", schema, n, "table", None, None, None) for n in names],
                    ddl(LISTED_CONTAINERS),
                )
                .drop("estimated_count")
                .join(row_counts(frames), "container_name")
            )
            listed = lake.schema_rows(
                spark, {n: f.schema for n, f in frames.items()}, "shop", schema
            )
            if retyped:
                wide = F.when(F.col("column_name") == "r_regionkey", F.lit("numeric"))
                listed = listed.withColumn("native_type", F.coalesce(wide, "native_type"))
            columns.append(listed)
        readers = {
            schema: lambda _, name: None if name == "lineitem" else table(spark, sf_dir, name)
            for schema in schemas
        }
        scan_catalog(
            store, "shop", inventory.one_inventory(containers),
            inventory.one_inventory(columns), open_table=opening.by_schema(readers), modes=["min_max"],
        )

    scan(_CATALOG, False)
    scan({s: names for s, names in _CATALOG.items() if s != "people"}, True)
    keys = ["r_regionkey", "n_nationkey", "o_orderkey"]
    lowest = (
        store.state("columns").where(F.col("column_name").isin(keys))
        .select(*CONTAINER_KEY, F.col("profile")["min_max"]["min_value"].alias("lowest"))
    )
    none = F.lit(None)
    containers = store.state("containers").join(lowest, CONTAINER_KEY, "left").select(
        F.lit("container").alias("part"), "schema_name", "container_name",
        none.cast("string").alias("change_type"), "estimated_count", "lowest",
    )
    changes = store.log("changes").select(
        F.lit("change").alias("part"), "schema_name", "container_name", "change_type",
        none.cast("bigint").alias("estimated_count"), none.cast("string").alias("lowest"),
    )
    return containers.unionByName(changes)


@registry.add("scan_postgres_listing", _listing_sql())
def scan_postgres_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a server lists of its first schema, taken into the inventory: type,
    comment, estimate, columns and keys."""
    containers = listed.postgres_containers(spark, sf_dir)
    columns = listed.postgres_columns(spark, sf_dir)
    first = containers.agg(F.min("schema_name")).first()[0]
    store = _store(spark, "listing")
    scan_tables(
        store, "shop", {}, schema_name=first, containers=containers, columns=columns
    )
    return (
        store.state("containers")
        .select(
            *CONTAINER_KEY, "container_type", "estimated_count", "native_description",
            "last_modified_at",
        )
        .join(
            store.state("columns").select(
                *COLUMN_KEY, "ordinal", "native_type", "is_pk", "references_container"
            ),
            CONTAINER_KEY,
            "left",
        )
        .drop("database", "schema_name")
    )


def _collection_rows(store: CatalogStore) -> DataFrame:
    kinds = store.state("containers").select(
        "container_name", "container_type", "estimated_count"
    )
    fields = store.state("columns").select(
        "container_name", "column_name", "ordinal", "native_type", "nullable"
    )
    return (
        fields.join(kinds, "container_name")
        .join(_statistics(store), ["container_name", "column_name"])
        .drop("container_name")
    )


@registry.add(
    "scan_collections",
    f"""
select 'collection' as container_type, (select count(*) from events) as estimated_count,
       column_name, ordinal, s.native_type, nullable, null_ratio, min_value, max_value
from ({registry.sql['document_schema']}) s join ({registry.sql['document_profile']}) p using (column_name)
""",
)
def scan_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection of documents in the inventory, by the fields it holds."""
    store = _store(spark, "collections")
    collection = Collection(docs.docs(spark, sf_dir), "document", ["event_id"])
    scan_tables(store, "docs", {"events": collection}, counted=["events"])
    return _collection_rows(store)


@registry.add("scan_collection_files", registry.sql["scan_collections"])
def scan_collection_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same collection from files of one document a line, blank lines between."""
    folder = scratch_dir(spark, "files")
    rows = docs.docs(spark, sf_dir).select("event_id", "document")
    lines = rows.select("event_id", F.explode(F.array(F.col("document"), F.lit("  "))).alias("value"))
    lines.repartition(3, "event_id").select("value").write.text(f"{folder}/events")
    # A file has no order of its own; the documents' key gives the one of the other query.
    read = read_collection(spark, f"{folder}/events").withColumn(
        "event_id", F.get_json_object("document", "$._id").cast("bigint")
    )
    store = _store(spark, "collection-files")
    scan_tables(store, "docs", {"events": Collection(read, "document", ["event_id"])}, counted=["events"])
    return _collection_rows(store)


@registry.add(
    "rescan_forced",
    union(
        [
            f"select {run} as run, {changes} as changes, 2 as containers_done, 0 as containers_skipped, "
            "(select count(*) from orders) as estimated_count from (select 1)"
            for run, changes in ((1, 2), (2, 0))
        ]
        + [
            "select 3 as run, 0 as changes, 0 as containers_done, 2 as containers_skipped, "
            "(select count(*) from orders) as estimated_count from (select 1)"
        ]
    ),
)
def rescan_forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forced rescan of unchanged tables reads them all and records no change."""
    store, out = _store(spark, "forced"), None
    for run, force in ((1, False), (2, True), (3, False)):
        before = store.log("changes").count()
        frames = {n: table(spark, sf_dir, n) for n in ("orders", "region")}
        scan_tables(store, "shop", frames, force=force, counted=["orders"], modes=[])
        last = store.log("scan_runs").orderBy(F.desc("finished_at")).limit(1)
        counted = store.state("containers").where("container_name = 'orders'").first().estimated_count
        row = last.select(
            F.lit(run).alias("run"), F.lit(store.log("changes").count() - before).alias("changes"),
            "containers_done", "containers_skipped", F.lit(counted).cast("bigint").alias("estimated_count"),
        )
        out = row if out is None else out.unionAll(row)
    return out


_WIDE = 400


@registry.add(
    "scan_wide",
    union(
        [
            f"select 'c{i}' as column_name, {i + 1} as ordinal, 0::double as null_ratio, "
            + (
                f"min(n_nationkey * {i + 1})::varchar as min_value, max(n_nationkey * {i + 1})::varchar as max_value, "
                "null::varchar as commonest"
                if i % 2
                else "null::varchar as min_value, null::varchar as max_value, min('v' || (n_nationkey % 1)) as commonest"
            )
            + " from nation"
            for i in range(_WIDE)
        ]
    ),
)
def scan_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of several hundred columns, profiled in blocks."""
    wide = table(spark, sf_dir, "nation").selectExpr(
        *[
            f"n_nationkey * {i + 1} as c{i}" if i % 2 else f"concat('v', n_nationkey % 1) as c{i}"
            for i in range(_WIDE)
        ]
    )
    store = _store(spark, "wide")
    scan_tables(store, "shop", {"wide": wide})
    profile = F.col("profile")
    return store.state("columns").select(
        "column_name", "ordinal", profile["null_ratio"]["null_ratio"].alias("null_ratio"),
        profile["min_max"]["min_value"].alias("min_value"), profile["min_max"]["max_value"].alias("max_value"),
        F.expr("get(profile['top_values'].top_values, 0).value").alias("commonest"),
    )


@registry.add("scan_sensitivity", registry.sql["detect_names_then_values"])
def scan_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict a scan records for each column, judged on all rows."""
    store = _store(spark, "verdicts")
    scan_tables(
        store, "shop", {"contacts": sensitive.contacts(spark, sf_dir)}, modes=[]
    )
    return (
        store.state("columns")
        .where(F.col("sensitivity").isNotNull())
        .select("column_name", "sensitivity")
    )


# ---- documents whose values do not fit the types of an earlier reading

_DIGITS = "123456789012345678901"


@registry.add(
    "document_profile_mixed_types",
    f"""
select 'v' as column_name, 'int' as native_type, 0::double as null_ratio,
       count(*) filter (event_id % 2 = 1)::double / count(*) as unfit_ratio,
       min(event_id) filter (event_id % 2 = 0)::varchar as min_value,
       max(event_id) filter (event_id % 2 = 0)::varchar as max_value from events
union all
select 'amount', 'decimal', 0, 0, '{_DIGITS}' || lpad(min(event_id)::varchar, 9, '0'),
       '{_DIGITS}' || lpad(max(event_id)::varchar, 9, '0') from events
""",
)
def document_profile_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents hold a text where the schema says number, and
    all an amount of thirty digits."""
    events = table(spark, sf_dir, "events")
    v = F.when(
        F.col("event_id") % 2 == 0, F.col("event_id").cast("string")
    ).otherwise(F.concat(F.lit('"t'), "event_id", F.lit('"')))
    digits = F.lpad(F.col("event_id").cast("string"), 9, "0")
    document = F.concat(
        F.lit('{"v":'), v, F.lit(',"amount":{"$numberDecimal":"' + _DIGITS), digits,
        F.lit('"}}'),
    )
    schema = spark.sql(
        "select * from values ('v', 'int', 1), ('amount', 'decimal', 2) "
        "as t(column_name, native_type, ordinal)"
    )
    return documents.document_profile(
        events.select(document.alias("document")), "document", schema
    ).select(
        "column_name", "native_type", "null_ratio", "unfit_ratio", "min_value", "max_value"
    )


# ---- lake folders named by texts that look like numbers

_KEY = (
    "case event_type when 'click' then '1.10' when 'view' then '01' "
    "when 'error' then '2024-1-1' else '7' end"
)


@registry.add(
    "lake_partition_texts",
    f"select event_id, {_KEY} as v, (user_id % 3)::int as k from events",
)
def lake_partition_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder names come back as they were written; plain whole numbers as such."""
    root = scratch_dir(spark, "lake-texts")
    rows = run_sql(
        spark, sf_dir, f"select event_id, {_KEY} as v, user_id % 3 as k from {{events}}"
    )
    rows.write.partitionBy("v", "k").parquet(f"{root}/events")
    return lake.read_dataset(spark, root, "events")


# ---- pages of one schema, notes in their order


@registry.add(
    "container_page_of_schema",
    f"""
select database, schema_name, container_name from {browsing._C}
where database = '5-LOW' and schema_name = 'f' order by container_name limit 1501
""",
)
def container_page_of_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containers_after(
        browsing.containers(spark, sf_dir), database="5-LOW", schema="f", limit=1500
    ).select(*CONTAINER_KEY)


_NOTED = "select 'd' as database, '' as schema_name, concat('u', user_id) as container_name"


@registry.add(
    "annotate_in_order",
    f"""
select 'd' as database, '' as schema_name, 'u' || user_id as container_name,
       arg_max(event_type || event_id, event_id) as description
from events group by user_id
""",
)
def annotate_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a note on its user; the last one stays."""
    notes = run_sql(
        spark,
        sf_dir,
        f"{_NOTED}, concat(event_type, event_id) as description, event_id as sequence "
        "from {events}",
    )
    users = run_sql(
        spark,
        sf_dir,
        f"{_NOTED}, cast(null as string) as description, "
        "cast(null as string) as description_source, "
        "cast(null as timestamp) as description_updated_at "
        "from (select distinct user_id from {events}) u",
    )
    columns = spark.sql(
        "select '' as database, '' as schema_name, '' as container_name, '' as column_name, "
        "'' as description, '' as description_source, "
        "cast(null as timestamp) as description_updated_at, "
        "'' as sensitivity, '' as sensitivity_source where false"
    )
    return inventory.annotate(users, columns, container_notes=notes).containers.select(
        *CONTAINER_KEY, "description"
    )
