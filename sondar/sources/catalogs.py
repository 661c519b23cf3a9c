"""Steps the three relational catalogs share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sondar.model import LISTED_COLUMNS, LISTED_CONTAINERS


def listed_containers(df: DataFrame) -> DataFrame:
    """Columns of a container listing, in order and typed."""
    return df.select(
        *[F.col(name).cast(kind).alias(name) for name, kind in LISTED_CONTAINERS.items()]
    )


def attach_keys(
    columns: DataFrame,
    primary: DataFrame | None,
    foreign: DataFrame,
    on: list[str],
) -> DataFrame:
    """Column rows with ``is_pk`` and the target each refers to.

    ``primary`` holds the key columns; ``foreign`` adds ``target``,
    ``target_column`` and ``seq``. A column in several foreign keys keeps the
    one of the highest ``seq``.
    """
    out = columns
    if primary is not None:
        marked = primary.select(*on).distinct().withColumn("is_pk", F.lit(True))
        out = out.join(marked, on, "left").withColumn(
            "is_pk", F.coalesce("is_pk", F.lit(False))
        )
    targets = foreign.groupBy(*on).agg(
        F.max_by(F.struct("target", "target_column"), "seq").alias("_fk")
    )
    return out.join(targets, on, "left").withColumns(
        {
            "is_fk": F.col("_fk.target").isNotNull(),
            "references_container": F.col("_fk.target"),
            "references_column": F.col("_fk.target_column"),
        }
    )


def dense_ordinal(per: list[str], position: Column) -> Column:
    """1, 2, 3 … in position order; a container's columns are few."""
    return F.row_number().over(Window.partitionBy(*per).orderBy(position))


def listed_columns(df: DataFrame) -> DataFrame:
    """Columns of a column listing, in order and typed."""
    return df.select(
        *[F.col(name).cast(kind).alias(name) for name, kind in LISTED_COLUMNS.items()]
    )
