"""What changed between two looks at a catalog."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondar.functions.text import retype_text
from sondar.model import (
    CHANGES,
    COLUMN_KEY,
    CONTAINER_ADDED,
    CONTAINER_KEY,
    CONTAINER_REMOVED,
    DONE,
    FAILED,
    SCHEMA_CHANGED,
    SKIPPED,
)

_FINGERPRINTED = [
    "column_name",
    "ordinal",
    "native_type",
    "nullable",
    "is_pk",
    "is_fk",
    "native_description",
    "references_container",
    "references_column",
]

# The key with the name first: sorts by it seldom look at the other two.
_BY_NAME = ["container_name", "database", "schema_name"]


def _framed(column: str) -> Column:
    """``length:text``, or ``-`` for NULL, so fields cannot run together."""
    text = F.col(column).cast("string")
    return F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-"))


def fingerprint(containers: DataFrame, columns: DataFrame) -> DataFrame:
    """Listed containers with ``schema_hash``: SHA-256 over everything a scan
    reads about the shape, comments included. What people write about a
    container is left out.

    Only a digest per column is brought together per container.
    """
    digests = (
        columns.select(
            *CONTAINER_KEY,
            "ordinal",
            "column_name",
            # As bytes, which are half as long and sort like their digits.
            F.unhex(
                F.sha2(F.concat(*[_framed(name) for name in _FINGERPRINTED]), 256)
            ).alias("digest"),
        )
        .groupBy(*_BY_NAME)
        .agg(
            F.array_sort(
                F.collect_list(F.struct("ordinal", "column_name", "digest"))
            ).alias("digests")
        )
    )
    joined = F.array_join(
        F.transform("digests", lambda d: F.lower(F.hex(d["digest"]))), ""
    )
    return (
        containers.join(digests, CONTAINER_KEY, "left")
        .withColumn(
            "schema_hash",
            F.sha2(
                F.concat(_framed("native_description"), F.coalesce(joined, F.lit(""))),
                256,
            ),
        )
        .drop("digests")
    )


def compare(current: DataFrame, previous: DataFrame, *, force: bool = False) -> DataFrame:
    """Per listed container: what a scan has to do with it.

    ``current`` has ``schema_hash`` and, if it could not be read, ``error``.
    Adds ``old_hash`` (of the last good scan) and ``outcome``: ``failed``,
    ``skipped`` where nothing changed, else ``done``. A container whose last
    scan failed is read again, as is everything with ``force``.
    """
    old = previous.select(
        *CONTAINER_KEY,
        F.nullif("schema_hash", F.lit("")).alias("old_hash"),
        F.col("error").alias("_old_error"),
    )
    same = (
        F.col("old_hash").eqNullSafe(F.col("schema_hash"))
        & F.col("_old_error").isNull()
        & F.lit(not force)
    )
    return (
        current.join(old, CONTAINER_KEY, "left")
        .withColumn(
            "outcome",
            F.when(F.col("error").isNotNull(), F.lit(FAILED))
            .when(same, F.lit(SKIPPED))
            .otherwise(F.lit(DONE)),
        )
        .drop("_old_error")
    )


def column_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """(container key, column_name, change, detail): columns ``added``,
    ``removed`` or ``retyped`` between two column listings."""
    then = previous.select(*COLUMN_KEY, F.col("native_type").alias("_old"))
    now = current.select(*COLUMN_KEY, F.col("native_type").alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), F.lit("added"))
        .when(F.col("_new").isNull(), F.lit("removed"))
        .when(F.col("_old") != F.col("_new"), F.lit("retyped"))
    )
    return (
        then.join(now, COLUMN_KEY, "full")
        .withColumn("change", change)
        .where(F.col("change").isNotNull())
        .select(
            *COLUMN_KEY,
            "change",
            F.when(
                F.col("change") == "retyped",
                retype_text(F.col("column_name"), F.col("_old"), F.col("_new")),
            )
            .otherwise(F.col("column_name"))
            .alias("detail"),
        )
    )


def removed(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Recorded containers (keys) that a complete look no longer found."""
    return previous.select(*CONTAINER_KEY).join(
        current.select(*CONTAINER_KEY), CONTAINER_KEY, "left_anti"
    )


def changes(
    compared: DataFrame,
    current_columns: DataFrame,
    previous: DataFrame,
    previous_columns: DataFrame,
    *,
    job_id: str,
    detected_at: Column,
    covered: bool = True,
) -> DataFrame:
    """Change records of one scan, without ids.

    ``covered`` says the scan saw the whole catalog; only then can anything
    have been removed. A forced rescan of an unchanged container is no change.

    What a scan found stays where its comparison put it; what is recorded moves its
    keys, and the columns their names and types, in one shuffle on the container's key.
    The lists gathered there are as long as the container is wide.
    """
    nothing = F.lit(None)

    def part(df: DataFrame, shape: dict[str, str], **given: Column) -> DataFrame:
        return df.select(
            *CONTAINER_KEY,
            *[given.get(n, nothing).cast(kind).alias(n) for n, kind in shape.items()],
        )

    known = compared.groupBy(*_BY_NAME).agg(
        *[F.max(name).alias(name) for name in ("outcome", "old_hash", "schema_hash")]
    )
    column = F.struct(F.col("column_name").alias("name"), F.col("native_type").alias("type"))
    sides = dict.fromkeys(("then", "now"), "struct<name:string,type:string>")
    lists = (
        part(previous_columns, sides, then=column)
        .unionAll(part(current_columns, sides, now=column))
        .groupBy(*_BY_NAME)
        .agg(*[F.collect_list(side).alias(side) for side in sides])
    )
    done = F.col("outcome") == DONE
    kind = F.when(done & F.col("old_hash").isNull(), F.lit(CONTAINER_ADDED)).when(
        done & (F.col("old_hash") != F.col("schema_hash")), F.lit(SCHEMA_CHANGED)
    )

    def names(columns: str) -> Column:
        return F.transform(columns, lambda c: c["name"])

    def listed(names: Column) -> Column:
        names = F.array_sort(names)
        return F.when(F.size(names) > 0, names)

    def retyped(now: Column) -> Column:
        old = F.get(F.filter("then", lambda then: then["name"] == now["name"]), F.lit(0))
        return F.when(
            old["type"] != now["type"], retype_text(now["name"], old["type"], now["type"])
        )

    detail = F.struct(
        listed(F.array_except(names("now"), names("then"))).alias("added"),
        listed(F.array_except(names("then"), names("now"))).alias("removed"),
        listed(
            F.array_compact(F.transform(F.array_except("now", "then"), retyped))
        ).alias("retyped"),
    )
    changed = F.col("change_type") == SCHEMA_CHANGED
    differs = F.coalesce("detail.added", "detail.removed", "detail.retyped").isNotNull()
    found = (
        known.withColumn("change_type", kind)
        .where(F.col("change_type").isNotNull())
        # Only a container both looks know has a detail, so none has a key with NULLs.
        .join(lists, CONTAINER_KEY, "left")
        .withColumn("detail", detail)
        .select(
            *CONTAINER_KEY,
            "change_type",
            F.when(changed, F.col("old_hash")).alias("old_hash"),
            F.when(done, F.col("schema_hash")).alias("new_hash"),
            F.when(changed & differs, F.col("detail"))
            .cast(CHANGES["detail"])
            .alias("detail"),
        )
    )
    if covered:
        recorded = previous.select(*CONTAINER_KEY).distinct().alias("then")
        looked = compared.where(F.col("outcome").isNotNull()).select(*CONTAINER_KEY).alias("now")
        same = reduce(
            and_, [F.col(f"then.{k}").eqNullSafe(F.col(f"now.{k}")) for k in CONTAINER_KEY]
        )
        found = found.unionAll(
            recorded.join(looked, same, "left_anti").select(
                *CONTAINER_KEY,
                F.lit(CONTAINER_REMOVED).alias("change_type"),
                nothing.cast("string").alias("old_hash"),
                nothing.cast("string").alias("new_hash"),
                nothing.cast(CHANGES["detail"]).alias("detail"),
            )
        )
    return found.select(
        "*", F.lit(job_id).alias("job_id"), detected_at.alias("detected_at")
    )


def with_ids(new_changes: DataFrame, last_id: int) -> DataFrame:
    """Ids above ``last_id`` that rise with database, schema and name; they are
    unique but may leave gaps, so no single task has to number them all."""
    return new_changes.orderBy(*CONTAINER_KEY).select(
        (F.monotonically_increasing_id() + F.lit(last_id + 1)).alias("id"),
        *[F.col(name) for name in CHANGES if name != "id"],
    )
