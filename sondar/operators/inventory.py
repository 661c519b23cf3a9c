"""State of an inventory: what a scan writes over what was recorded."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondar.functions.text import blank_to_null
from sondar.model import (
    COLUMN_KEY,
    COLUMNS,
    CONTAINER_KEY,
    CONTAINERS,
    DONE,
    FAILED,
    LISTED_COLUMNS,
    NONE,
    PII,
    PROFILE_VALUE,
    SECRET,
    SKIPPED,
    SOURCE_AI,
    NotPermitted,
    RepeatedKey,
    UnknownContainer,
)
from sondar.operators.browse import Access

_WRITTEN = ["description", "description_source", "description_updated_at"]


def _prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.select(
        *keys, *[F.col(c).alias(prefix + c) for c in df.columns if c not in keys]
    )


def require_unique(listed: DataFrame, keys: Sequence[str], shown: int = 20) -> None:
    """Refuses a listing that names a container or column more than once."""
    twice = listed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times")).where("_times > 1")
    name = F.concat_ws(".", *keys).alias("_name")
    first = [row["_name"] for row in twice.select(name).orderBy("_name").limit(shown).collect()]
    if first:
        raise RepeatedKey(f"listed more than once ({twice.count()} in all): {', '.join(first)}")


def upsert_containers(
    previous: DataFrame, compared: DataFrame, scanned_at: Column
) -> DataFrame:
    """Containers after a scan (``compared`` from ``drift.compare``).

    A scanned container takes everything the source says; what was written
    about it stays. A failed one also keeps the hash of its last good scan.
    Skipped containers and those not looked at stay as they were.
    """
    old = _prefixed(previous, CONTAINER_KEY, "old_").withColumn("_had", F.lit(True))
    new = _prefixed(compared, CONTAINER_KEY, "new_")
    outcome = F.col("new_outcome")
    scanned = F.coalesce(outcome.isin(DONE, FAILED), F.lit(False))

    def pick(name: str) -> Column:
        old_value = F.col("old_" + name)
        if name in _WRITTEN:
            return old_value
        if name == "schema_hash":
            good = F.when(outcome == DONE, F.col("new_schema_hash")).otherwise(
                F.coalesce("old_schema_hash", F.lit(""))
            )
            return F.when(scanned, good).otherwise(old_value)
        if name == "scanned_at":
            return F.when(scanned, scanned_at).otherwise(old_value)
        return F.when(scanned, F.col("new_" + name)).otherwise(old_value)

    joined = old.join(new, CONTAINER_KEY, "full").where(
        F.col("_had") | scanned
    )
    return joined.select(
        *[
            F.col(name) if name in CONTAINER_KEY else pick(name).cast(kind).alias(name)
            for name, kind in CONTAINERS.items()
        ]
    )


def sync_columns(
    previous: DataFrame,
    current: DataFrame,
    compared: DataFrame,
    scanned_at: Column,
) -> DataFrame:
    """Columns after a scan: those of scanned containers become what the source
    lists, keeping descriptions, verdicts and profiles of the survivors; all
    other containers keep theirs."""
    done = compared.where(F.col("outcome") == DONE).select(
        *CONTAINER_KEY, F.lit(True).alias("_done")
    )
    old = _prefixed(previous, COLUMN_KEY, "old_").withColumn("_had", F.lit(True))
    new = _prefixed(current, COLUMN_KEY, "new_").withColumn("_has", F.lit(True))
    scanned = F.col("_done").isNotNull()

    def pick(name: str) -> Column:
        if name == "scanned_at":
            fresh = scanned_at
        else:
            fresh = F.col(("new_" if name in LISTED_COLUMNS else "old_") + name)
        return F.when(scanned, fresh).otherwise(F.col("old_" + name))

    return (
        old.join(new, COLUMN_KEY, "full")
        .join(done, CONTAINER_KEY, "left")
        .where(F.when(scanned, F.col("_has")).otherwise(F.col("_had")))
        .select(
            *[
                F.col(name) if name in COLUMN_KEY else pick(name).cast(kind).alias(name)
                for name, kind in COLUMNS.items()
            ]
        )
    )


def forget(df: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of containers or columns without those of the ``gone`` containers."""
    return df.join(gone.select(*CONTAINER_KEY), CONTAINER_KEY, "left_anti")


def merge_profiles(columns: DataFrame, profiles: DataFrame) -> DataFrame:
    """Stored columns with new results (column key, ``profile``) merged in: a
    mode that ran again is replaced, the others stay. Results for a column that
    is not recorded are ignored."""
    new = profiles.select(*COLUMN_KEY, F.col("profile").alias("_new"))
    empty = F.create_map().cast(f"map<string,{PROFILE_VALUE}>")
    merged = F.map_zip_with(
        F.coalesce("profile", empty),
        F.coalesce("_new", empty),
        lambda _mode, old, fresh: F.coalesce(fresh, old),
    )
    return (
        columns.join(new, COLUMN_KEY, "left")
        .withColumn(
            "profile", F.when(F.col("_new").isNull(), F.col("profile")).otherwise(merged)
        )
        .select(*columns.columns)
    )


def scan_outcomes(compared: DataFrame) -> DataFrame:
    """(database, containers_done, containers_failed, containers_skipped)."""
    outcome = F.col("outcome")
    return compared.groupBy("database").agg(
        F.count_if(outcome == DONE).cast("int").alias("containers_done"),
        F.count_if(outcome == FAILED).cast("int").alias("containers_failed"),
        F.count_if(outcome == SKIPPED).cast("int").alias("containers_skipped"),
    )


def one_inventory(sources: Sequence[DataFrame]) -> DataFrame:
    """Frames of several sources as one; rows carry their database."""
    if not sources:
        raise ValueError("no sources")
    out = sources[0]
    for more in sources[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


@dataclass(frozen=True)
class Annotated:
    """Frames after an annotation. ``unknown_columns`` lists the annotations
    that name a column the inventory does not have."""

    containers: DataFrame
    columns: DataFrame
    containers_updated: DataFrame
    columns_updated: DataFrame
    unknown_columns: DataFrame


def _last_notes(
    notes: DataFrame, keys: Sequence[str], fields: Mapping[str, str]
) -> DataFrame:
    """One row per key with the last value given to each field (under its new
    name), by ``sequence``; an error where that does not say which is the last."""
    at = F.col("sequence") if "sequence" in notes.columns else F.lit(0)
    at = at.cast("bigint")

    def last(name: str) -> Column:
        value, given = F.col(name), F.col(name).isNotNull()
        # The largest and the smallest value under the highest sequence.
        high = F.max(F.when(given, F.struct(at.alias("at"), value.alias("value"))))
        low = F.min(F.when(given, F.struct((-at).alias("at"), value.alias("value"))))
        several = F.raise_error(
            F.concat(F.lit(f"several notes on the {name} of "), F.concat_ws(".", *keys))
        )
        return F.when(high["value"] != low["value"], several.cast("string")).otherwise(
            high["value"]
        )

    return notes.groupBy(*keys).agg(*[last(n).alias(new) for n, new in fields.items()])


def annotate(
    containers: DataFrame,
    columns: DataFrame,
    *,
    container_notes: DataFrame | None = None,
    column_notes: DataFrame | None = None,
    source: str = SOURCE_AI,
    access: Access | None = None,
    written_at: Column | None = None,
) -> Annotated:
    """Write descriptions and verdicts over an inventory.

    ``container_notes`` has the container key and ``description``;
    ``column_notes`` the column key, ``description`` and ``sensitivity``. NULL
    leaves a field as it is, blank clears a description. A note on a container
    the inventory does not have is an error, and then nothing is written.

    With ``access``, that decides whose word a description is, whatever ``source`` says, and
    notes on containers it does not cover are refused.

    Of several notes on one thing the one with the highest ``sequence`` wins, field
    by field; without that column, or with equal ones, several notes that give a
    field different values are refused, since their order is unknown.
    """
    spark = containers.sparkSession
    at = F.current_timestamp() if written_at is None else written_at
    if container_notes is None:
        container_notes = spark.createDataFrame(
            [], ", ".join(f"{key} string" for key in [*CONTAINER_KEY, "description"])
        )
    if column_notes is None:
        column_notes = spark.createDataFrame(
            [],
            ", ".join(
                f"{key} string" for key in [*COLUMN_KEY, "description", "sensitivity"]
            ),
        )
    named = container_notes.select(*CONTAINER_KEY).unionByName(
        column_notes.select(*CONTAINER_KEY)
    )
    if access is not None:
        source = access.source
        closed = named.where(~access.condition()).take(1)
        if closed:
            raise NotPermitted(".".join(part for part in closed[0] if part))
    strangers = named.join(containers, CONTAINER_KEY, "left_anti").take(1)
    if strangers:
        raise UnknownContainer(".".join(part for part in strangers[0] if part))
    wrong = column_notes.where(~F.col("sensitivity").isin(NONE, PII, SECRET)).take(1)
    if wrong:
        raise ValueError(f"unknown sensitivity: {wrong[0].sensitivity!r}")

    def described(name: str, value: Column) -> Column:
        return F.when(F.col("_text").isNotNull(), value).otherwise(F.col(name))

    fields = {
        "description": described("description", blank_to_null(F.col("_text"))),
        "description_source": described("description_source", F.lit(source)),
        "description_updated_at": described("description_updated_at", at),
    }
    # One note per thing: a second one must not double its row.
    notes = _last_notes(container_notes, CONTAINER_KEY, {"description": "_text"})
    new_containers = (
        containers.join(notes, CONTAINER_KEY, "left")
        .withColumns(fields)
        .select(*containers.columns)
    )
    marks = _last_notes(
        column_notes, COLUMN_KEY, {"description": "_text", "sensitivity": "_level"}
    )
    levelled = F.col("_level").isNotNull()
    new_columns = (
        columns.join(marks, COLUMN_KEY, "left")
        .withColumns(
            {
                **fields,
                "sensitivity": F.coalesce("_level", "sensitivity"),
                "sensitivity_source": F.when(levelled, F.lit(source)).otherwise(
                    F.col("sensitivity_source")
                ),
            }
        )
        .select(*columns.columns)
    )
    says = F.coalesce("description", "sensitivity").isNotNull()
    known = columns.select(*COLUMN_KEY)
    return Annotated(
        containers=new_containers,
        columns=new_columns,
        containers_updated=container_notes.where(F.col("description").isNotNull())
        .select(*CONTAINER_KEY)
        .distinct(),
        columns_updated=column_notes.where(says)
        .join(known, COLUMN_KEY, "left_semi")
        .select(*COLUMN_KEY)
        .distinct(),
        unknown_columns=column_notes.join(known, COLUMN_KEY, "left_anti")
        .select(*COLUMN_KEY)
        .distinct(),
    )
