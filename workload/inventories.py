"""Fingerprints, drift and inventory state over the derived catalog."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sondar.functions.fixed import NAME_PATTERNS
from sondar.functions.types import modes_for_type_text
from sondar.model import (
    COLUMN_KEY,
    COLUMNS,
    CONTAINER_KEY,
    LISTED_COLUMNS,
    PROFILE,
    PROFILE_VALUE,
    NotPermitted,
)
from sondar.operators import drift, inventory
from sondar.operators.browse import Access, permitted, recent_changes
from sondar.operators.sensitivity import by_name, record_detected, with_recorded
from sondar.session import keep, scratch_dir
from workload import derived as d
from workload import plain, registry, table

_AT = "timestamp '2024-06-01 00:00:00'"


class Looks:
    """Both looks at the catalog and the inventory after the first.

    ``stored`` says that a query reads a look's columns several times: lines that have met
    their orders are written once, and no look derives them again for each use.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, *, stored: bool = False) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.is_stored = stored

    def _read(self, text: str) -> DataFrame:
        return d.frame(self.spark, self.sf_dir, text)

    @cached_property
    def _seen(self) -> DataFrame:
        return keep(self._read(d.SEEN), scratch_dir(self.spark, "looks"))

    def _columns(self, text: str, seen: str) -> DataFrame:
        return self.spark.sql(seen, seen=self._seen) if self.is_stored else self._read(text)

    @cached_property
    def columns(self) -> DataFrame:
        return self._columns(d.COLUMNS_NOW, d.COLUMNS_NOW_SEEN)

    @cached_property
    def first_columns(self) -> DataFrame:
        return self._columns(d.COLUMNS_THEN, d.COLUMNS_THEN_SEEN)

    @cached_property
    def containers(self) -> DataFrame:
        return drift.fingerprint(self._read(d.CONTAINERS_NOW), self.columns)

    @cached_property
    def listed(self) -> DataFrame:
        return self._read(d.CONTAINERS_NOW)

    @cached_property
    def stored_columns(self) -> DataFrame:
        return d.written(self.first_columns).withColumn(
            "profile", F.lit(None).cast(PROFILE)
        )

    @cached_property
    def stored(self) -> DataFrame:
        first = drift.fingerprint(self._read(d.CONTAINERS_THEN), self.first_columns)
        return d.stored_containers(first)

    def compared(self, **options: bool) -> DataFrame:
        return drift.compare(self.containers, self.stored, **options)


def at() -> Column:
    return F.expr(_AT)


@registry.add(
    "schema_fingerprint", f"select {d.KEY}, schema_hash from ({d.HASHED_NOW})"
)
def schema_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Looks(spark, sf_dir).containers.select(*CONTAINER_KEY, "schema_hash")


@registry.add(
    "rescan_plan", f"select {d.KEY}, old_hash, schema_hash, outcome from ({d.COMPARED})"
)
def rescan_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a scan does about each container: unchanged ones are skipped."""
    return Looks(spark, sf_dir).compared().select(
        *CONTAINER_KEY, "old_hash", "schema_hash", "outcome"
    )


@registry.add(
    "rescan_plan_forced",
    f"select database, count(*) filter (outcome <> 'failed')::int as containers_done, "
    f"count(*) filter (outcome = 'failed')::int as containers_failed, "
    f"0::int as containers_skipped from ({d.COMPARED}) group by 1",
)
def rescan_plan_forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.scan_outcomes(Looks(spark, sf_dir).compared(force=True))


@registry.add(
    "scan_outcomes",
    f"select database, count(*) filter (outcome = 'done')::int as containers_done, "
    f"count(*) filter (outcome = 'failed')::int as containers_failed, "
    f"count(*) filter (outcome = 'skipped')::int as containers_skipped "
    f"from ({d.COMPARED}) group by 1",
)
def scan_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.scan_outcomes(Looks(spark, sf_dir).compared())


_COLUMN_CHANGES = f"""
select coalesce(n.database, o.database) as database,
       coalesce(n.schema_name, o.schema_name) as schema_name,
       coalesce(n.container_name, o.container_name) as container_name,
       coalesce(n.column_name, o.column_name) as column_name,
       case when o.column_name is null then 'added' when n.column_name is null then 'removed'
            else 'retyped' end as change,
       case when o.column_name is not null and n.column_name is not null
            then n.column_name || ': ' || o.native_type || ' → ' || n.native_type
            else coalesce(n.column_name, o.column_name) end as detail
from ({plain(d.COLUMNS_NOW)}) n full join ({plain(d.COLUMNS_THEN)}) o
  on n.database = o.database and n.schema_name = o.schema_name
 and n.container_name = o.container_name and n.column_name = o.column_name
where o.column_name is null or n.column_name is null or o.native_type <> n.native_type
"""


@registry.add("column_changes", _COLUMN_CHANGES)
def column_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    looks = Looks(spark, sf_dir)
    return drift.column_changes(looks.stored_columns, looks.columns)


_DETAIL = f"""
select {d.KEY},
       string_agg(detail, ',' order by detail) filter (change = 'added') as added,
       string_agg(detail, ',' order by detail) filter (change = 'removed') as removed,
       string_agg(detail, ',' order by detail) filter (change = 'retyped') as retyped
from ({_COLUMN_CHANGES}) group by all
"""
_REMOVED = f"""
select {d.KEY} from ({plain(d.CONTAINERS_THEN)})
except select {d.KEY} from ({plain(d.CONTAINERS_NOW)})
"""
_CHANGES = f"""
select {d.KEY}, 'container_added' as change_type, null::varchar as old_hash,
       schema_hash as new_hash, null::varchar as added, null::varchar as removed,
       null::varchar as retyped
from ({d.COMPARED}) where outcome = 'done' and old_hash is null
union all
select {d.KEY}, 'schema_changed', old_hash, schema_hash, added, removed, retyped
from ({d.COMPARED}) left join ({_DETAIL}) using ({d.KEY})
where outcome = 'done' and old_hash <> schema_hash
"""
_CHANGES_ALL = (
    _CHANGES
    + f"union all select {d.KEY}, 'container_removed', null, null, null, null, null "
    f"from ({_REMOVED})"
)


def _changes(looks: Looks, covered: bool = True) -> DataFrame:
    return drift.changes(
        looks.compared(),
        looks.columns,
        looks.stored,
        looks.stored_columns,
        job_id="second",
        detected_at=at(),
        covered=covered,
    )


def _flat(changes: DataFrame) -> DataFrame:
    return changes.select(
        *CONTAINER_KEY,
        "change_type",
        "old_hash",
        "new_hash",
        *[
            F.array_join(F.col("detail")[part], ",").alias(part)
            for part in ("added", "removed", "retyped")
        ],
    )


@registry.add("schema_changes", _CHANGES_ALL)
def schema_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_changes(Looks(spark, sf_dir, stored=True)))


@registry.add("schema_changes_partial_scan", _CHANGES)
def schema_changes_partial_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan that did not cover the catalog cannot tell what was removed."""
    return _flat(_changes(Looks(spark, sf_dir, stored=True), covered=False))


@registry.add("removed_containers", _REMOVED)
def removed_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    looks = Looks(spark, sf_dir)
    return drift.removed(looks.listed, looks.stored)


@registry.add(
    "change_feed",
    f"select {d.KEY}, change_type from ({_CHANGES_ALL}) where database = '1-URGENT' "
    "order by schema_name desc, container_name desc limit 100",
)
def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest first; within one scan the ids decide, which rise with the key."""
    changes = drift.with_ids(_changes(Looks(spark, sf_dir, stored=True)), 0)
    return recent_changes(
        changes, database="1-URGENT", since="2024-06-01 00:00:00"
    ).select(*CONTAINER_KEY, "change_type")


# ---- what a scan writes


_SCANNED = "c.outcome in ('done', 'failed')"
_UPSERTED = f"""
select coalesce(o.database, c.database) as database,
       coalesce(o.schema_name, c.schema_name) as schema_name,
       coalesce(o.container_name, c.container_name) as container_name,
       case when {_SCANNED} then c.container_type else o.container_type end as container_type,
       case when {_SCANNED} then c.estimated_count else o.estimated_count end as estimated_count,
       case when c.outcome = 'done' then c.schema_hash when c.outcome = 'failed'
            then coalesce(o.schema_hash, '') else o.schema_hash end as schema_hash,
       case when {_SCANNED} then c.native_description else o.native_description end
         as native_description,
       o.description, o.description_source,
       case when {_SCANNED} then c.error else o.error end as error,
       coalesce({_SCANNED}, false) as rescanned
from ({d.STORED_CONTAINERS}) o full join ({d.COMPARED}) c
  on o.database = c.database and o.schema_name = c.schema_name
 and o.container_name = c.container_name
"""


def _upserted(looks: Looks) -> DataFrame:
    return inventory.upsert_containers(looks.stored, looks.compared(), at()).select(
        *CONTAINER_KEY,
        "container_type",
        "estimated_count",
        "schema_hash",
        "native_description",
        "description",
        "description_source",
        "error",
        (F.col("scanned_at") == at()).alias("rescanned"),
    )


@registry.add("upsert_containers", _UPSERTED)
def upsert_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New scan fields over old ones; what was written about them stays."""
    return _upserted(Looks(spark, sf_dir))


@registry.add(
    "forget_containers", f"select * from ({_UPSERTED}) anti join ({_REMOVED}) using ({d.KEY})"
)
def forget_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    looks = Looks(spark, sf_dir)
    after = _upserted(looks)
    return inventory.forget(after, drift.removed(looks.listed, looks.stored))


_FIELDS = (
    "ordinal, native_type, nullable, is_pk, is_fk, native_description, "
    "references_container, references_column"
)
_STORED_COLUMNS = plain(d.COLUMNS_STORED)
_KEPT = "description, description_source, sensitivity, sensitivity_source"
_SYNCED = f"""
select n.database, n.schema_name, n.container_name, n.column_name,
       {', '.join('n.' + f for f in _FIELDS.split(', '))},
       {', '.join('o.' + f for f in _KEPT.split(', '))}
from ({plain(d.COLUMNS_NOW)}) n
semi join (select * from ({d.COMPARED}) where outcome = 'done') c using ({d.KEY})
left join ({_STORED_COLUMNS}) o using ({d.KEY}, column_name)
union all
select {d.KEY}, column_name, {_FIELDS}, {_KEPT} from ({_STORED_COLUMNS})
anti join (select * from ({d.COMPARED}) where outcome = 'done') using ({d.KEY})
"""
_SYNCED_NAMES = [*COLUMN_KEY, *_FIELDS.split(", "), *_KEPT.split(", ")]


def _synced(looks: Looks) -> DataFrame:
    return inventory.sync_columns(
        looks.stored_columns, looks.columns, looks.compared(), at()
    )


@registry.add("sync_columns", _SYNCED)
def sync_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns after a scan: survivors keep what was written about them."""
    return _synced(Looks(spark, sf_dir, stored=True)).select(*_SYNCED_NAMES)


# ---- verdicts


_FLAT_NAME = (
    "regexp_replace(lower(regexp_replace(column_name, '([a-z0-9])([A-Z])', '\\1_\\2', 'g')), "
    "'[^a-z0-9]+', '', 'g')"
)
_LEVELS = " ".join(
    f"when regexp_matches({_FLAT_NAME}, '{pattern}') then '{level}'"
    for pattern, level in NAME_PATTERNS
)
_BY_NAME = f"""
select {d.KEY}, column_name,
       case {_LEVELS} end
         as sensitivity
from ({plain(d.COLUMNS_NOW)})
"""


def _named(looks: Looks) -> DataFrame:
    return by_name(looks.columns).select(*COLUMN_KEY, "sensitivity")


@registry.add("detect_by_name", _BY_NAME)
def detect_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(Looks(spark, sf_dir))


@registry.add(
    "recorded_verdicts_win",
    f"""
select coalesce(r.database, n.database) as database,
       coalesce(r.schema_name, n.schema_name) as schema_name,
       coalesce(r.container_name, n.container_name) as container_name,
       coalesce(r.column_name, n.column_name) as column_name,
       coalesce(r.sensitivity, n.sensitivity) as sensitivity
from ({_BY_NAME}) n
full join (select * from ({_STORED_COLUMNS}) where sensitivity is not null) r
  on r.database = n.database and r.schema_name = n.schema_name
 and r.container_name = n.container_name and r.column_name = n.column_name
where coalesce(r.sensitivity, n.sensitivity) <> 'none'
""",
)
def recorded_verdicts_win(spark: SparkSession, sf_dir: str) -> DataFrame:
    looks = Looks(spark, sf_dir)
    recorded = looks.stored_columns.select(*COLUMN_KEY, "sensitivity")
    return with_recorded(_named(looks), recorded)


@registry.add(
    "record_sensitivity",
    f"""
select s.database, s.schema_name, s.container_name, s.column_name,
       case when n.sensitivity is not null and coalesce(s.sensitivity_source, 'detected') = 'detected'
            then n.sensitivity else s.sensitivity end as sensitivity,
       case when n.sensitivity is not null and coalesce(s.sensitivity_source, 'detected') = 'detected'
            then 'detected' else s.sensitivity_source end as sensitivity_source
from ({_STORED_COLUMNS}) s left join ({_BY_NAME}) n using ({d.KEY}, column_name)
""",
)
def record_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    looks = Looks(spark, sf_dir)
    found = _named(looks).where(F.col("sensitivity").isNotNull())
    return record_detected(looks.stored_columns, found).select(
        *COLUMN_KEY, "sensitivity", "sensitivity_source"
    )


# ---- annotations and profiles


_CONTAINER_NOTES = f"""
select {d.KEY}, case when estimated_count < 150000 then '   ' else concat(' seen by ', database, ' ') end
         as description
from ({d.CONTAINERS_THEN}) n where estimated_count >= 100000
"""
_NOTES_ON = f"""
select {d.KEY}, column_name,
       case when native_type = 'bigint' then concat('about ', column_name)
            when native_type = 'timestamp' then ' ' end as description,
       case when ordinal = 7 then 'secret' when ordinal = 2 then 'pii' end as sensitivity
from (@COLUMNS) n
union all
select {d.KEY}, 'no_such_column' as column_name, 'x' as description,
       cast(null as varchar(1)) as sensitivity
from ({d.CONTAINERS_THEN}) n where container_type = 'view'
"""
_COLUMN_NOTES = _NOTES_ON.replace("@COLUMNS", d.COLUMNS_STORED)


def _annotated(spark: SparkSession, sf_dir: str) -> inventory.Annotated:
    looks = Looks(spark, sf_dir)
    # Read for the notes, their checks and what they are written on.
    looks.first_columns = keep(looks.first_columns, scratch_dir(spark, "look"))
    notes = spark.sql(
        _NOTES_ON.replace("(@COLUMNS)", "{written}"),
        written=d.written(looks.first_columns),
        orders=table(spark, sf_dir, "orders"),
    )
    return inventory.annotate(
        looks.stored,
        looks.stored_columns,
        container_notes=d.frame(spark, sf_dir, _CONTAINER_NOTES),
        column_notes=notes,
        source="ai",
        written_at=at(),
    )


def _set(table: str, field: str, new: str) -> str:
    return f"case when a.description is not null then {new} else {table}.{field} end as {field}"


@registry.add(
    "annotate_containers",
    f"""
select {d.KEY}, {_set('s', 'description', "nullif(trim(a.description), '')")},
       {_set('s', 'description_source', "'ai'")}
from ({d.STORED_CONTAINERS}) s left join ({plain(_CONTAINER_NOTES)}) a using ({d.KEY})
""",
)
def annotate_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annotated(spark, sf_dir).containers.select(
        *CONTAINER_KEY, "description", "description_source"
    )


@registry.add(
    "annotate_as_granted",
    f"""
select {d.KEY}, description_source, count(*) as columns from (
  select {d.KEY}, {_set('s', 'description_source', "'human'")}
  from ({d.STORED_CONTAINERS}) s left join ({plain(_CONTAINER_NOTES)}) a using ({d.KEY})
  where container_name not like 'order_9%'
) group by all
""",
)
def annotate_as_granted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions written by a caller whose key speaks for a person, and who may not
    see some containers: a note on one of those is refused, the others count as a person's."""
    looks = Looks(spark, sf_dir)
    notes = d.frame(spark, sf_dir, _CONTAINER_NOTES)
    access = Access.from_claims({"containers": {"deny": ["order_9*"]}, "annotate_as_human": True})
    try:
        inventory.annotate(looks.stored, looks.stored_columns, container_notes=notes, access=access)
        raise AssertionError("notes on closed containers were taken")
    except NotPermitted:
        covered = permitted(notes, access)
    written = inventory.annotate(
        looks.stored, looks.stored_columns, container_notes=covered, access=access, source="native"
    )
    return permitted(written.containers, access).groupBy(*CONTAINER_KEY, "description_source").agg(
        F.count(F.lit(1)).alias("columns")
    )


@registry.add(
    "annotate_columns",
    f"""
select {d.KEY}, column_name, {_set('s', 'description', "nullif(trim(a.description), '')")},
       {_set('s', 'description_source', "'ai'")},
       coalesce(a.sensitivity, s.sensitivity) as sensitivity,
       case when a.sensitivity is not null then 'ai' else s.sensitivity_source end
         as sensitivity_source
from ({_STORED_COLUMNS}) s left join ({plain(_COLUMN_NOTES)}) a using ({d.KEY}, column_name)
""",
)
def annotate_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annotated(spark, sf_dir).columns.select(
        *COLUMN_KEY, "description", "description_source", "sensitivity", "sensitivity_source"
    )


@registry.add(
    "annotate_result",
    f"""
select (select count(*) from ({plain(_CONTAINER_NOTES)}) where description is not null) as containers_updated,
       (select count(*) from ({plain(_COLUMN_NOTES)}) where column_name <> 'no_such_column'
          and (description is not null or sensitivity is not null)) as columns_updated,
       (select count(*) from ({plain(_COLUMN_NOTES)}) where column_name = 'no_such_column') as unknown_columns
""",
)
def annotate_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _annotated(spark, sf_dir)
    parts = [
        frame.select(F.lit(name).alias("part"))
        for name, frame in (
            ("containers_updated", out.containers_updated),
            ("columns_updated", out.columns_updated),
            ("unknown_columns", out.unknown_columns),
        )
    ]
    return inventory.one_inventory(parts).agg(
        *[
            F.count_if(F.col("part") == name).alias(name)
            for name in ("containers_updated", "columns_updated", "unknown_columns")
        ]
    )


def _result(**fields: str) -> str:
    names = [
        "distinct_count", "null_ratio", "top_values", "min_value", "max_value", "approximate",
    ]
    values = ", ".join(f"'{n}', {fields.get(n, 'null')}" for n in names)
    return f"cast(named_struct({values}) as {PROFILE_VALUE})"


@registry.add(
    "merge_profiles",
    f"""
select {d.KEY}, column_name,
       case when o.ordinal <= 4 then 0.25 end as null_ratio,
       case when n.column_name is not null and n.nullable then 100 + n.ordinal
            when o.ordinal <= 4 then o.ordinal::bigint end as distinct_count
from ({_STORED_COLUMNS}) o left join ({plain(d.COLUMNS_NOW)}) n using ({d.KEY}, column_name)
""",
)
def merge_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mode that ran again replaces its last result, other modes stay."""
    looks = Looks(spark, sf_dir)
    stored = looks.stored_columns.withColumn(
        "profile",
        F.expr(
            "if(ordinal <= 4, map("
            f"'null_ratio', {_result(null_ratio='0.25d')}, "
            f"'distinct_count', {_result(distinct_count='cast(ordinal as bigint)')}), null)"
        ),
    )
    again = looks.columns.where("nullable").withColumn(
        "profile",
        F.expr(f"map('distinct_count', {_result(distinct_count='cast(100 + ordinal as bigint)')})"),
    )
    return inventory.merge_profiles(stored, again).select(
        *COLUMN_KEY,
        F.expr("profile['null_ratio'].null_ratio").alias("null_ratio"),
        F.expr("profile['distinct_count'].distinct_count").alias("distinct_count"),
    )


@registry.add(
    "profile_modes_by_type_text",
    f"""
select {d.KEY}, column_name,
       case when native_type in ('bigint', 'timestamp') then 'null_ratio,min_max'
            else 'null_ratio,distinct_count,top_values' end as modes
from ({plain(d.COLUMNS_NOW)})
""",
)
def profile_modes_by_type_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Looks(spark, sf_dir).columns.select(
        *COLUMN_KEY,
        F.array_join(modes_for_type_text(F.col("native_type")), ",").alias("modes"),
    )


@registry.add(
    "one_inventory",
    f"""
select database, schema_name, count(*) as columns from (
  select database, schema_name from ({plain(d.COLUMNS_NOW)})
  union all select 'archive' as database, schema_name from ({plain(d.COLUMNS_THEN)}))
group by all
""",
)
def one_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    looks = Looks(spark, sf_dir)
    archive = looks.stored_columns.withColumn("database", F.lit("archive"))
    both = inventory.one_inventory([looks.columns, archive.select(*COLUMNS)])
    return both.groupBy("database", "schema_name").agg(F.count(F.lit(1)).alias("columns"))
