"""MySQL's (and MariaDB's) information_schema as inventory rows.

Frames carry the information_schema's own column names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondar.sources.catalogs import (
    attach_keys,
    dense_ordinal,
    listed_columns,
    listed_containers,
)

# ---- fixed values: schemas that belong to the server
SYSTEM_SCHEMAS = ["information_schema", "mysql", "performance_schema", "sys"]
# ---- fixed values: comments that describe nothing (a view's says VIEW)
_NO_COMMENT = ["", "VIEW"]


def clean_comment(comment: Column) -> Column:
    return F.when(~comment.isin(_NO_COMMENT), comment)


def databases(schemata: DataFrame) -> DataFrame:
    return (
        schemata.where(~F.col("SCHEMA_NAME").isin(SYSTEM_SCHEMAS))
        .select(F.col("SCHEMA_NAME").alias("database"))
        .orderBy("database")
    )


def containers(tables: DataFrame, database: str | None = None) -> DataFrame:
    """Tables and views of one database, or of every one that is not the
    server's."""
    scope = (
        F.col("TABLE_SCHEMA") == database
        if database
        else ~F.col("TABLE_SCHEMA").isin(SYSTEM_SCHEMAS)
    )
    return listed_containers(
        tables.where(scope).withColumns(
            {
                "database": F.col("TABLE_SCHEMA"),
                "schema_name": F.lit(""),
                "container_name": F.col("TABLE_NAME"),
                "container_type": F.when(
                    F.col("TABLE_TYPE").isin("VIEW", "SYSTEM VIEW"), F.lit("view")
                ).otherwise(F.lit("table")),
                "estimated_count": F.col("TABLE_ROWS"),
                "native_description": clean_comment(F.col("TABLE_COMMENT")),
                "last_modified_at": F.date_format(
                    "UPDATE_TIME", "yyyy-MM-dd'T'HH:mm:ss"
                ),
            }
        )
    )


def columns(
    columns_frame: DataFrame, key_column_usage: DataFrame, database: str | None = None
) -> DataFrame:
    """Columns with keys; a reference into another database is qualified."""
    scope = (
        F.col("TABLE_SCHEMA") == database
        if database
        else ~F.col("TABLE_SCHEMA").isin(SYSTEM_SCHEMAS)
    )
    on = ["TABLE_SCHEMA", "TABLE_NAME", "COLUMN_NAME"]
    here = F.col("REFERENCED_TABLE_SCHEMA")
    foreign = key_column_usage.where(
        scope & F.col("REFERENCED_TABLE_NAME").isNotNull()
    ).select(
        *on,
        F.when(
            (F.coalesce(here, F.lit("")) != "") & (here != F.col("TABLE_SCHEMA")),
            F.concat_ws(".", here, "REFERENCED_TABLE_NAME"),
        )
        .otherwise(F.col("REFERENCED_TABLE_NAME"))
        .alias("target"),
        F.col("REFERENCED_COLUMN_NAME").alias("target_column"),
        F.struct("ORDINAL_POSITION", "CONSTRAINT_NAME").alias("seq"),
    )
    described = columns_frame.where(scope).withColumn(
        "ordinal",
        dense_ordinal(["TABLE_SCHEMA", "TABLE_NAME"], F.col("ORDINAL_POSITION")),
    )
    return listed_columns(
        attach_keys(described, None, foreign, on).withColumns(
            {
                "database": F.col("TABLE_SCHEMA"),
                "schema_name": F.lit(""),
                "container_name": F.col("TABLE_NAME"),
                "column_name": F.col("COLUMN_NAME"),
                "native_type": F.col("COLUMN_TYPE"),
                "nullable": F.col("IS_NULLABLE") == "YES",
                "is_pk": F.col("COLUMN_KEY") == "PRI",
                "native_description": clean_comment(F.col("COLUMN_COMMENT")),
            }
        )
    )
