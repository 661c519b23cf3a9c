"""A whole scan: list, compare, profile what changed, commit."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import cached_property
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from sondar.functions.sql import ident
from sondar.model import (
    COLUMN_KEY,
    CONTAINER_KEY,
    DONE,
    LISTED_COLUMNS,
    LISTED_CONTAINERS,
    PROFILE,
    SCAN_RUNS,
    ddl,
)
from sondar.operators import drift, inventory
from sondar.operators.documents import (
    MAX_FIELDS,
    document_profile,
    flatten,
    infer_schema,
    require_fields,
)
from sondar.operators.profile import as_mode_map, table_profile
from sondar.operators.sensitivity import detect, record_detected
from sondar.plans.store import CatalogStore
from sondar.session import keep
from sondar.sources.lake import declare_keys, schema_rows

log = logging.getLogger("sondar.scan")

#: Scheduler pools of the tables read side by side begin with this.
POOLS = "sondar-scan"

_FINDINGS = (
    "database string, schema_name string, container_name string, "
    f"column_name string, sensitivity string, profile {PROFILE}, rows bigint"
)



@dataclass(frozen=True)
class Collection:
    """JSON documents without a declared schema: the frame, its document column,
    and the order that says which field came first."""

    frame: DataFrame
    document: str
    order_by: Sequence[str] = ()
    #: A collection of more is refused: its keys are data.
    max_fields: int = MAX_FIELDS

    @cached_property
    def fields(self) -> DataFrame:
        """What the documents hold, read once; one row per top-level field."""
        found = infer_schema(self.frame, self.document, order_by=self.order_by)
        rows = require_fields(found, self.document, self.max_fields)
        return self.frame.sparkSession.createDataFrame(rows, found.schema)

    @cached_property
    def typed(self) -> DataFrame:
        """The fields as typed columns."""
        types = {r.column_name: r.native_type for r in self.fields.collect()}
        return flatten(self.frame, self.document, types)


Table = DataFrame | Collection | Callable[[], DataFrame | Collection]


#: A container within its database: schema and name.
Place = tuple[str, str]


def _listed_fields(
    tables: Mapping[Place, Collection], columns: DataFrame, database: str
) -> DataFrame:
    """The columns of collections, shaped like ``columns``."""
    for (schema_name, name), table in tables.items():
        columns = columns.unionByName(
            table.fields.withColumns(
                {
                    "database": F.lit(database),
                    "schema_name": F.lit(schema_name),
                    "container_name": F.lit(name),
                }
            ),
            allowMissingColumns=True,
        )
    return columns


def _inspect(
    table: DataFrame | Collection,
    key: tuple[str, str, str],
    target: str,
    modes: Sequence[str] | None,
    counts: bool,
    full_detection: bool,
    max_distinct: int | None,
) -> list[str]:
    """Write what one table's data says to folders of its own below ``target``:
    a row per sensitive column, per profiled column, and for the row count.

    Should that fail, it is tried once more, since a lost executor says nothing
    about the table. Should it fail again, every part is tried by itself and the
    columns one by one, so that one unreadable column does not cost the table
    its profile. Returns the parts that could not be had.
    """
    empty = {
        "column_name": F.lit(None).cast("string"),
        "sensitivity": F.lit(None).cast("string"),
        "profile": F.lit(None).cast(PROFILE),
        "rows": F.lit(None).cast("bigint"),
    }

    def shaped(frame: DataFrame) -> DataFrame:
        values = [
            F.col(name) if name in frame.columns else value.alias(name)
            for name, value in empty.items()
        ]
        labels = [F.lit(v).alias(k) for k, v in zip(CONTAINER_KEY, key, strict=True)]
        return frame.select(*labels, *values)

    def profile(names: Sequence[str]) -> DataFrame:
        if isinstance(table, Collection):
            fields = table.fields.where(F.col("column_name").isin(list(names)))
            found = document_profile(
                table.frame, table.document, fields, max_distinct=max_distinct
            )
        else:
            found = table_profile(
                df.selectExpr(*map(ident, names)), modes, max_distinct=max_distinct
            )
        return as_mode_map(found)

    df = table.typed if isinstance(table, Collection) else table
    wanted: dict[str, Callable[[], DataFrame]] = {
        "sensitivity": lambda: detect(df, full=full_detection)
    }
    if counts:
        wanted["rows"] = lambda: df.agg(F.count(F.lit(1)).alias("rows"))
    single = dict(wanted)
    if (modes is None or modes) and df.columns:
        wanted["profile"] = lambda: profile(df.columns)
        single |= {
            f"profile of {name}": lambda name=name: profile([name])
            for name in df.columns
        }

    def write(parts: Sequence[Callable[[], DataFrame]], label: str) -> None:
        frames = [shaped(part()) for part in parts]
        inventory.one_inventory(frames).coalesce(1).write.mode("overwrite").parquet(
            f"{target}/part={label}"
        )

    for _ in range(2):
        try:
            write(list(wanted.values()), "all")
            return []
        except Exception as error:  # noqa: BLE001
            log.warning("inspecting %s failed: %s", key, error)
    lost = []
    for index, (label, part) in enumerate(single.items()):
        try:
            write([part], str(index))
        except Exception as error:  # noqa: BLE001
            log.warning("no %s of %s: %s", label, key, error)
            lost.append(label)
    return lost


def scan_tables(
    store: CatalogStore,
    database: str,
    tables: Mapping[str, Table],
    *,
    schema_name: str = "",
    containers: DataFrame | None = None,
    columns: DataFrame | None = None,
    keys: DataFrame | None = None,
    modes: Sequence[str] | None = None,
    force: bool = False,
    covered: bool = True,
    counted: Iterable[str] = (),
    full_detection: bool = True,
    max_distinct: int | None = None,
    parallel: int = 8,
    now: datetime | None = None,
) -> int:
    """Bring the inventory of one database up to date; returns the version.

    Schemas are read first and compared with the last version; only tables that
    changed are profiled, ``parallel`` of them at a time. A table that cannot
    be opened is recorded as failed and the others go on; one that could only be
    read in part is recorded with what it lacks, and read again by the next scan.
    ``covered=False`` says the listing is not the whole schema, so nothing counts
    as removed; other schemas of the database are never touched.

    ``containers`` and ``columns`` are what a source lists of this schema, such as
    those of ``sources.postgres``; types, comments, estimates and keys come from
    them, and ``tables`` opens the ones whose data is to be read. Without them
    every table is listed by its own schema. ``counted`` names the tables whose
    rows are worth counting (Parquet); their count replaces the listed estimate.
    Tables read side by side have a scheduler pool each, which counts where the
    session's ``spark.scheduler.mode`` is FAIR.
    A listing that names a container or column twice is refused.
    """
    return _scan(
        store,
        database,
        {(schema_name, name): table for name, table in tables.items()},
        F.col("schema_name") == schema_name,
        containers=containers,
        columns=columns,
        keys=keys,
        modes=modes,
        force=force,
        covered=covered,
        counted={(schema_name, name) for name in counted},
        full_detection=full_detection,
        max_distinct=max_distinct,
        parallel=parallel,
        now=now,
    )


def scan_catalog(
    store: CatalogStore,
    database: str,
    containers: DataFrame,
    columns: DataFrame,
    *,
    open_table: Callable[[str, str], Table | None] | None = None,
    keys: DataFrame | None = None,
    modes: Sequence[str] | None = None,
    force: bool = False,
    covered: bool = True,
    counted: Iterable[Place] = (),
    full_detection: bool = True,
    max_distinct: int | None = None,
    parallel: int = 8,
    now: datetime | None = None,
) -> int:
    """Bring the inventory of every schema that a database lists up to date.

    ``containers`` and ``columns`` are what the source lists of the whole database: a
    schema that is not in it any more is gone with all it held, unless ``covered=False``.
    Only containers whose listing changed are opened, by ``open_table``, which is given a schema and a
    name and returns the table, a ``Collection``, or None for what is not to be read;
    see ``sources.opening``.  One that cannot be opened is recorded with the
    reason and tried again by the next scan.  Otherwise as ``scan_tables``.
    """
    return _scan(
        store,
        database,
        {},
        F.lit(True),
        containers=containers,
        columns=columns,
        open_table=open_table,
        keys=keys,
        modes=modes,
        force=force,
        covered=covered,
        counted=set(counted),
        full_detection=full_detection,
        max_distinct=max_distinct,
        parallel=parallel,
        now=now,
    )


def _scan(
    store: CatalogStore,
    database: str,
    tables: Mapping[Place, Table],
    scope: Column,
    *,
    containers: DataFrame | None,
    columns: DataFrame | None,
    open_table: Callable[[str, str], Table | None] | None = None,
    keys: DataFrame | None,
    modes: Sequence[str] | None,
    force: bool,
    covered: bool,
    counted: set[Place],
    full_detection: bool,
    max_distinct: int | None,
    parallel: int,
    now: datetime | None,
) -> int:
    """A scan of the containers of a database that ``scope`` holds for."""
    spark: SparkSession = store.spark
    job_id = uuid.uuid4().hex
    now = now or datetime.now(timezone.utc)
    at = F.lit(now)
    version = store.latest()
    previous, previous_columns = store.state("containers", version), store.state(
        "columns", version
    )
    # Only what this run lists can be missing from it: other schemas stay as they are.
    here = (F.col("database") == database) & scope
    mine, my_columns = previous.where(here), previous_columns.where(here)

    def open_one(table: Table) -> DataFrame | Collection | str | None:
        try:
            found = table() if callable(table) else table
            # Resolves the table; a collection's fields are in its documents.
            if found is not None:
                found.fields if isinstance(found, Collection) else found.schema  # noqa: B018
            return found
        except Exception as error:  # noqa: BLE001 - per-table isolation
            log.warning("cannot read a table: %s", error)
            reason = str(error).partition("\n")[0]
            return f"{type(error).__name__}: {reason}"

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        outcome = dict(zip(tables, pool.map(open_one, tables.values()), strict=True))
    errors = {name: found for name, found in outcome.items() if isinstance(found, str)}
    opened = {name: found for name, found in outcome.items() if name not in errors}

    def collections() -> dict[Place, Collection]:
        return {n: t for n, t in opened.items() if isinstance(t, Collection)}

    folder = f"{store.root}/work/run={job_id}"

    def listing(frame: DataFrame, name: str) -> DataFrame:
        # Read from the source once: everything below sees the same listing.
        untyped = [f.name for f in frame.schema.fields if isinstance(f.dataType, NullType)]
        return keep(frame.withColumns({n: F.col(n).cast("string") for n in untyped}), f"{folder}/{name}")

    if containers is None:
        listed = spark.createDataFrame(
            [
                (
                    database, *place,
                    "collection" if place in collections() else "table",
                    None, None, None, errors.get(place),
                )
                for place in tables
            ],
            ddl({**LISTED_CONTAINERS, "error": "string"}),
        )
    else:
        unread = spark.createDataFrame(
            [(*place, text) for place, text in errors.items()],
            "schema_name string, container_name string, error string",
        )
        listed = (
            listing(containers.where(here).select(*LISTED_CONTAINERS), "listed_containers")
            .join(unread, ["schema_name", "container_name"], "left")
            .select(*LISTED_CONTAINERS, "error")
        )
    columns_listed = columns is not None
    if columns is None:
        columns = spark.createDataFrame([], ddl(LISTED_COLUMNS))
        for schema_name in dict.fromkeys(schema for schema, _ in opened):
            columns = columns.unionByName(
                schema_rows(
                    spark,
                    {
                        name: table.schema
                        for (schema, name), table in opened.items()
                        if schema == schema_name and (schema, name) not in collections()
                    },
                    database,
                    schema_name,
                ),
                allowMissingColumns=True,
            )
        columns = _listed_fields(collections(), columns, database)
    else:
        columns = listing(columns.where(here).select(*LISTED_COLUMNS), "listed_columns")
    if keys is not None:
        columns = declare_keys(columns, keys)
    if containers is not None:
        inventory.require_unique(listed, CONTAINER_KEY)
    if columns_listed:
        inventory.require_unique(columns, COLUMN_KEY)
    compared = drift.compare(drift.fingerprint(listed, columns), mine, force=force)

    # Everything below builds on the comparison, so it is made once and kept
    # where a lost executor does not take it along.
    compared = keep(compared, f"{folder}/compared")

    changed = [
        (row.schema_name, row.container_name)
        for row in compared.where(F.col("outcome") == DONE)
        .select("schema_name", "container_name")
        .collect()
    ] if opened or open_table else []
    lost: dict[Place, list[str]] = {}
    slots = count()

    def own_pool() -> None:
        # Under FAIR scheduling a small table need not wait for the tasks of a large one.
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{POOLS}-{next(slots)}")

    with ThreadPoolExecutor(max_workers=parallel, initializer=own_pool) as pool:
        if open_table:
            # Only what changed is opened.
            found = pool.map(lambda place: open_one(lambda: open_table(*place)), changed)
            for place, table in zip(changed, found, strict=True):
                if isinstance(table, str):
                    lost[place] = [table]
                elif table is not None:
                    opened[place] = table
        todo = [place for place in changed if place in opened]
        jobs = [
            pool.submit(
                _inspect,
                opened[place],
                (database, *place),
                f"{folder}/found/table={index}",
                modes,
                place in counted,
                full_detection,
                max_distinct,
            )
            for index, place in enumerate(todo)
        ]
        lost |= {place: job.result() for place, job in zip(todo, jobs, strict=True)}
    if todo:
        # Folders name the table and part; the rows carry their own keys.
        findings = (
            spark.read.schema(_FINDINGS)
            .option("recursiveFileLookup", "true")
            .parquet(f"{folder}/found")
        )
    else:
        findings = spark.createDataFrame([], _FINDINGS)

    counts = findings.where(F.col("rows").isNotNull()).select(
        *CONTAINER_KEY, F.col("rows").alias("_rows")
    )
    compared = (
        compared.join(counts, CONTAINER_KEY, "left")
        .withColumn("estimated_count", F.coalesce("_rows", "estimated_count"))
        .drop("_rows")
    )
    incomplete = [
        (*place, f"not read: {', '.join(parts)}") for place, parts in lost.items() if parts
    ]
    if incomplete:
        # An error makes the next scan read the container again.
        partly = spark.createDataFrame(
            incomplete, "schema_name string, container_name string, _lacks string"
        )
        compared = (
            compared.join(partly, ["schema_name", "container_name"], "left")
            .withColumn("error", F.coalesce("error", "_lacks"))
            .drop("_lacks")
        )
    by_column = findings.where(F.col("column_name").isNotNull())
    new_changes = drift.changes(
        compared,
        columns,
        mine,
        my_columns,
        job_id=job_id,
        detected_at=at,
        covered=covered,
    )
    new_containers = inventory.upsert_containers(previous, compared, at)
    new_columns = inventory.sync_columns(previous_columns, columns, compared, at)
    if covered:
        gone = drift.removed(compared, mine)
        new_containers = inventory.forget(new_containers, gone)
        new_columns = inventory.forget(new_columns, gone)
    new_columns = record_detected(
        new_columns,
        by_column.where(F.col("sensitivity").isNotNull()).select(
            *COLUMN_KEY, "sensitivity"
        ),
    )
    new_columns = inventory.merge_profiles(
        new_columns,
        by_column.where(F.col("profile").isNotNull()).select(*COLUMN_KEY, "profile"),
    )
    run = inventory.scan_outcomes(compared).select(
        F.lit(job_id).alias("job_id"),
        "database",
        F.lit("done").alias("state"),
        "containers_done",
        "containers_failed",
        "containers_skipped",
        F.lit(None).cast("string").alias("error"),
        at.alias("started_at"),
        F.current_timestamp().alias("finished_at"),
    )
    return store.commit(
        containers=new_containers,
        columns=new_columns,
        changes=new_changes,
        scan_runs=run.select(*SCAN_RUNS),
    )
