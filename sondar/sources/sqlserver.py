"""SQL Server's ``sys`` catalog as inventory rows.

Frames are named after the views and carry their column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondar.functions.text import clock_sql
from sondar.functions.types import sqlserver_type
from sondar.sources.catalogs import (
    attach_keys,
    dense_ordinal,
    listed_columns,
    listed_containers,
)

# ---- fixed values: the first four databases are the server's
_SYSTEM_DATABASES = 4
# ---- fixed values: extended properties that are descriptions
_DESCRIPTION = "MS_Description"


def databases(sys_databases: DataFrame) -> DataFrame:
    """Databases that are online and open to this login (``has_access``)."""
    return (
        sys_databases.where(
            (F.col("database_id") > _SYSTEM_DATABASES)
            & (F.col("state_desc") == "ONLINE")
            & (F.col("has_access") == 1)
        )
        .select(F.col("name").alias("database"))
        .orderBy("database")
    )


def _objects(sys_objects: DataFrame, sys_schemas: DataFrame) -> DataFrame:
    schemas = sys_schemas.select("schema_id", F.col("name").alias("schema_name"))
    return (
        sys_objects.withColumn("kind", F.trim("type"))
        .where(F.col("kind").isin("U", "V") & (F.col("is_ms_shipped") == 0))
        .join(schemas, "schema_id")
        .withColumn("container_name", F.concat_ws(".", "schema_name", "name"))
    )


def _descriptions(extended_properties: DataFrame) -> DataFrame:
    return extended_properties.where(
        (F.col("class") == 1) & (F.col("name") == _DESCRIPTION)
    ).select(
        F.col("major_id").alias("object_id"),
        F.col("minor_id").alias("column_id"),
        F.nullif(F.col("value").cast("string"), F.lit("")).alias("native_description"),
    )


def containers(
    sys_objects: DataFrame,
    sys_schemas: DataFrame,
    extended_properties: DataFrame,
    partition_stats: DataFrame,
    database: str,
) -> DataFrame:
    """Tables and views with comment, modification time and row count; a view
    has no partitions and so no count."""
    counts = (
        partition_stats.where(F.col("index_id").isin(0, 1))
        .groupBy("object_id")
        .agg(F.sum("row_count").alias("estimated_count"))
    )
    comments = _descriptions(extended_properties).where(F.col("column_id") == 0)
    return listed_containers(
        _objects(sys_objects, sys_schemas)
        .join(comments.drop("column_id"), "object_id", "left")
        .join(counts, "object_id", "left")
        .withColumns(
            {
                "database": F.lit(database),
                "container_type": F.when(
                    F.col("kind") == "U", F.lit("table")
                ).otherwise(F.lit("view")),
                "last_modified_at": F.expr(clock_sql("modify_date")),
            }
        )
    )


def columns(
    sys_objects: DataFrame,
    sys_schemas: DataFrame,
    sys_columns: DataFrame,
    sys_types: DataFrame,
    extended_properties: DataFrame,
    sys_indexes: DataFrame,
    sys_index_columns: DataFrame,
    sys_foreign_keys: DataFrame,
    sys_foreign_key_columns: DataFrame,
    database: str,
) -> DataFrame:
    """Columns with their declared type, keys and comments."""
    on = ["object_id", "column_id"]
    primary = (
        sys_indexes.where(F.col("is_primary_key") == 1)
        .select("object_id", "index_id")
        .join(sys_index_columns, ["object_id", "index_id"])
        .select(*on)
    )
    target_tables = sys_objects.where(F.trim("type") == "U").select(
        F.col("object_id").alias("referenced_object_id"),
        F.col("schema_id"),
        F.col("name").alias("target_name"),
    ).join(sys_schemas.select("schema_id", F.col("name").alias("target_schema")), "schema_id")
    target_columns = sys_columns.select(
        F.col("object_id").alias("referenced_object_id"),
        F.col("column_id").alias("referenced_column_id"),
        F.col("name").alias("target_column"),
    )
    foreign = (
        sys_foreign_keys.select(F.col("object_id").alias("constraint_object_id"))
        .join(sys_foreign_key_columns, "constraint_object_id")
        .join(target_tables, "referenced_object_id")
        .join(target_columns, ["referenced_object_id", "referenced_column_id"])
        .select(
            F.col("parent_object_id").alias("object_id"),
            F.col("parent_column_id").alias("column_id"),
            F.concat_ws(".", "target_schema", "target_name").alias("target"),
            "target_column",
            F.col("constraint_object_id").alias("seq"),
        )
    )
    owners = _objects(sys_objects, sys_schemas).select(
        "object_id", "schema_name", "container_name"
    )
    types = sys_types.select("user_type_id", F.col("name").alias("type_name"))
    described = (
        sys_columns.join(owners, "object_id")
        .join(types, "user_type_id")
        .join(_descriptions(extended_properties), on, "left")
        .withColumn("ordinal", dense_ordinal(["object_id"], F.col("column_id")))
    )
    return listed_columns(
        attach_keys(described, primary, foreign, on).withColumns(
            {
                "database": F.lit(database),
                "column_name": F.col("name"),
                "native_type": sqlserver_type(
                    F.col("type_name"),
                    F.col("max_length"),
                    F.col("precision"),
                    F.col("scale"),
                ),
                "nullable": F.col("is_nullable").cast("boolean"),
            }
        )
    )
