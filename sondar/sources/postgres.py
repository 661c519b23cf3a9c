"""PostgreSQL's system catalog as inventory rows.

Every function takes frames named after the catalog tables, read over JDBC or
from an export of them. ``pg_attribute`` carries ``native_type``, the text of
``format_type(atttypid, atttypmod)``, which only the server can render.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondar.sources.catalogs import (
    attach_keys,
    dense_ordinal,
    listed_columns,
    listed_containers,
)

# ---- fixed values: relation kinds that are listed, and what they are called
_KINDS = {"r": "table", "p": "table", "f": "table", "v": "view", "m": "view"}
# ---- fixed values: kinds whose row estimate means something
_COUNTED = ["r", "p", "m"]
# ---- fixed values: the object id of pg_class, under which comments are filed
_PG_CLASS = 1259


def databases(pg_database: DataFrame) -> DataFrame:
    """Databases that can be connected to and are no templates."""
    return (
        pg_database.where(F.col("datallowconn") & ~F.col("datistemplate"))
        .select(F.col("datname").alias("database"))
        .orderBy("database")
    )


def _relations(pg_class: DataFrame, pg_namespace: DataFrame) -> DataFrame:
    schemas = pg_namespace.where(
        ~F.col("nspname").isin("pg_catalog", "information_schema")
        & ~F.col("nspname").startswith("pg_")
    ).select(F.col("oid").alias("relnamespace"), "nspname")
    return (
        pg_class.where(F.col("relkind").isin(list(_KINDS)) & ~F.col("relispartition"))
        .join(schemas, "relnamespace")
        .withColumn("container_name", F.concat_ws(".", "nspname", "relname"))
    )


def _comments(pg_description: DataFrame) -> DataFrame:
    return pg_description.where(F.col("classoid") == _PG_CLASS).select(
        "objoid", "objsubid", F.col("description").alias("native_description")
    )


def containers(
    pg_class: DataFrame,
    pg_namespace: DataFrame,
    pg_description: DataFrame,
    database: str,
) -> DataFrame:
    """Tables and views with their comments; a row estimate where there is one."""
    comments = _comments(pg_description).where(F.col("objsubid") == 0)
    kinds = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    estimate = F.when(
        F.col("relkind").isin(_COUNTED) & (F.col("reltuples") >= 0),
        F.col("reltuples").cast("bigint"),
    )
    relations = _relations(pg_class, pg_namespace)
    return listed_containers(
        relations.join(comments, relations["oid"] == comments["objoid"], "left")
        .withColumns(
            {
                "database": F.lit(database),
                "schema_name": F.col("nspname"),
                "container_type": kinds[F.col("relkind")],
                "estimated_count": estimate,
                "last_modified_at": F.lit(None),
            }
        )
    )


def _key_columns(pg_constraint: DataFrame, kind: str) -> DataFrame:
    """One row per column of a key; composite keys pair position by position."""
    paired = F.arrays_zip(
        F.col("conkey").alias("from_attnum"),
        F.coalesce("confkey", F.array().cast("array<int>")).alias("to_attnum"),
    )
    return pg_constraint.where(F.col("contype") == kind).select(
        F.col("oid").alias("constraint_oid"),
        F.col("conrelid").alias("attrelid"),
        "confrelid",
        F.inline(paired).alias("attnum", "to_attnum"),
    )


def columns(
    pg_class: DataFrame,
    pg_namespace: DataFrame,
    pg_attribute: DataFrame,
    pg_description: DataFrame,
    pg_constraint: DataFrame,
    database: str,
) -> DataFrame:
    """Columns with dense ordinals, keys and comments; system and dropped
    columns are left out."""
    relations = _relations(pg_class, pg_namespace).select(
        F.col("oid").alias("attrelid"), "nspname", "container_name"
    )
    live = pg_attribute.where((F.col("attnum") > 0) & ~F.col("attisdropped"))
    comments = _comments(pg_description).select(
        F.col("objoid").alias("attrelid"),
        F.col("objsubid").alias("attnum"),
        "native_description",
    )
    # A target may lie in any schema, the system's included.
    targets = pg_class.select(
        F.col("oid").alias("confrelid"),
        F.col("relname"),
        F.col("relnamespace").alias("to_namespace"),
    ).join(
        pg_namespace.select(
            F.col("oid").alias("to_namespace"), F.col("nspname").alias("to_schema")
        ),
        "to_namespace",
    )
    target_columns = pg_attribute.select(
        F.col("attrelid").alias("confrelid"),
        F.col("attnum").alias("to_attnum"),
        F.col("attname").alias("target_column"),
    )
    foreign = (
        _key_columns(pg_constraint, "f")
        .join(targets, "confrelid")
        .join(target_columns, ["confrelid", "to_attnum"])
        .select(
            "attrelid",
            "attnum",
            F.concat_ws(".", "to_schema", "relname").alias("target"),
            "target_column",
            F.col("constraint_oid").alias("seq"),
        )
    )
    described = (
        live.join(relations, "attrelid")
        .join(comments, ["attrelid", "attnum"], "left")
        .withColumn("ordinal", dense_ordinal(["attrelid"], F.col("attnum")))
    )
    keyed = attach_keys(
        described, _key_columns(pg_constraint, "p"), foreign, ["attrelid", "attnum"]
    )
    return listed_columns(
        keyed.withColumns(
            {
                "database": F.lit(database),
                "schema_name": F.col("nspname"),
                "column_name": F.col("attname"),
                "nullable": ~F.col("attnotnull"),
            }
        )
    )
