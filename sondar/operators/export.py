"""The inventory written out: CSV, a Markdown dictionary, a dbt schema file.

Text formats are put together container by container, by Spark, and written in
name order as part files that read as one text when concatenated. ``files=1``
asks for a single file, for catalogs small enough to be one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sondar.functions.text import (
    reference_text,
    shown_description,
    table_cell,
    yaml_scalar,
)
from sondar.model import CONTAINER_KEY, SOURCE_NATIVE
from sondar.operators.browse import Access, in_scope, permitted
from sondar.sources.lake import list_files

_ORDER = ["container_name", "database", "schema_name"]


def _described() -> Column:
    return shown_description(F.col("description"), F.col("native_description"))


def csv_rows(columns: DataFrame) -> DataFrame:
    """One row per column with the thirteen fields of the CSV export."""
    return columns.orderBy(*_ORDER, "ordinal").select(
        "database",
        F.col("schema_name").alias("schema"),
        F.col("container_name").alias("container"),
        F.col("column_name").alias("column"),
        "ordinal",
        "native_type",
        F.col("nullable").cast("int").alias("nullable"),
        F.col("is_pk").cast("int").alias("is_pk"),
        F.col("is_fk").cast("int").alias("is_fk"),
        reference_text(
            F.col("references_container"),
            F.when(
                F.col("references_container").isNotNull(), F.col("references_column")
            ),
        ).alias("references"),
        _described().alias("description"),
        F.coalesce("description_source", F.lit("")).alias("description_source"),
        F.coalesce("sensitivity", F.lit("")).alias("sensitivity"),
    )


def _by_container(columns: DataFrame, line: Column) -> DataFrame:
    """A container's lines joined in ordinal order; a container's columns are
    few, so one group is small whatever the catalog."""
    lines = F.array_sort(F.collect_list(F.struct("ordinal", line.alias("line"))))
    return columns.groupBy(*CONTAINER_KEY).agg(
        F.array_join(F.transform(lines, lambda item: item["line"]), "\n").alias("body"),
        F.count(F.lit(1)).alias("n"),
    )


def markdown_blocks(containers: DataFrame, columns: DataFrame) -> DataFrame:
    """(container key, block, columns): each container's part of the dictionary."""
    empty = F.lit("")
    target = reference_text(
        F.coalesce(F.nullif("references_container", empty), F.lit("?")),
        F.col("references_column"),
    )
    key = F.concat_ws(
        " ",
        F.when(F.col("is_pk"), F.lit("PK")),
        F.when(F.col("is_fk"), F.concat(F.lit("FK → "), target)),
    )
    note = _described()
    written = (
        (F.coalesce("description", empty) != "")
        & ~F.col("description_source").eqNullSafe(F.lit(SOURCE_NATIVE))
        & (note != "")
    )
    tagged = F.when(written, F.concat(note, F.lit(" *(written)*"))).otherwise(note)
    line = F.concat(
        F.lit("| `"),
        "column_name",
        F.lit("` | "),
        "native_type",
        F.lit(" | "),
        F.when(F.col("nullable"), F.lit("yes")).otherwise(F.lit("no")),
        F.lit(" | "),
        key,
        F.lit(" | "),
        table_cell(tagged),
        F.lit(" |"),
    )
    # ---- fixed values: the table's header
    table = F.concat(
        F.lit(
            "\n\n| column | type | null | key | description |\n|---|---|---|---|---|"
        ),
        F.when(F.col("body").isNotNull(), F.concat(F.lit("\n"), "body")).otherwise(
            empty
        ),
    )
    facts = F.concat_ws(
        " · ",
        "container_type",
        F.when(
            F.col("estimated_count").isNotNull(),
            F.concat(F.lit("~"), F.format_number("estimated_count", 0), F.lit(" rows")),
        ),
    )
    failed = F.coalesce("error", empty) != ""
    block = F.concat(
        F.lit("\n## "),
        "container_name",
        F.lit("\n\n"),
        facts,
        F.when(note != "", F.concat(F.lit("\n\n"), note)).otherwise(empty),
        F.when(
            failed,
            F.concat(F.lit("\n\n> Not readable at the last scan: "), "error"),
        ).otherwise(table),
    )
    return containers.join(_by_container(columns, line), CONTAINER_KEY, "left").select(
        *CONTAINER_KEY,
        block.alias("block"),
        F.when(failed, F.lit(0)).otherwise(F.coalesce("n", F.lit(0))).alias("columns"),
    )


def dbt_blocks(containers: DataFrame, columns: DataFrame) -> DataFrame:
    """(container key, block, columns): models of a dbt schema file. A container
    without columns is no model."""
    note = _described()

    def described(indent: str) -> Column:
        return F.when(
            note != "",
            F.concat(F.lit(f"\n{indent}description: "), yaml_scalar(note)),
        ).otherwise(F.lit(""))

    line = F.concat(
        F.lit("      - name: "), yaml_scalar(F.col("column_name")), described(" " * 8)
    )
    block = F.concat(
        F.lit("  - name: "),
        yaml_scalar(F.col("container_name")),
        described(" " * 4),
        F.lit("\n    columns:\n"),
        "body",
    )
    return containers.join(_by_container(columns, line), CONTAINER_KEY).select(
        *CONTAINER_KEY, block.alias("block"), F.col("n").alias("columns")
    )


def _write(df: DataFrame, order: Sequence[str | Column], files: int | None) -> DataFrame:
    if files == 1:
        return df.coalesce(1).sortWithinPartitions(*order)
    if files:
        return df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    return df.orderBy(*order)


def export(
    containers: DataFrame,
    columns: DataFrame,
    path: str,
    form: str = "markdown",
    *,
    database: str | None = None,
    access: Access | None = None,
    files: int | None = None,
    generated_at: str = "",
) -> DataFrame:
    """Write the permitted part of the inventory; returns one row saying where
    and how much (path, bytes_written, containers, columns), never what."""
    containers, columns = in_scope(containers, database), in_scope(columns, database)
    if access is not None:
        containers, columns = permitted(containers, access), permitted(columns, access)
    spark = containers.sparkSession
    # What is written is counted as it is written.
    counts = Observation()
    if form == "csv":
        columns = columns.join(containers.select(*CONTAINER_KEY), CONTAINER_KEY, "left_semi")
        order = [F.col(c) for c in ("container", "database", "schema", "ordinal")]
        (
            _write(csv_rows(columns), order, files)
            .observe(counts, F.count(F.lit(1)).alias("columns"))
            .write.mode("overwrite")
            .options(
                header="true",
                quote='"',
                escape='"',
                emptyValue="",
                ignoreLeadingWhiteSpace="false",
                ignoreTrailingWhiteSpace="false",
            )
            .csv(path)
        )
        # Containers without columns are in no row of it.
        written = containers.count()
    else:
        if form == "markdown":
            blocks = markdown_blocks(containers, columns)
            when = f"Generated {generated_at} from the " if generated_at else "From the "
            # ---- fixed values: the dictionary's heading
            head = (
                f"# Data dictionary — {database or 'every database'}\n\n{when}"
                "inventory. Descriptions marked *written* were added to the "
                "inventory; the rest are the source's own comments."
            )
        elif form == "dbt_yaml":
            blocks = dbt_blocks(containers, columns)
            head = "version: 2\n\nmodels:"
        else:
            raise ValueError(f"unknown export format: {form!r}")
        first = spark.sql("select :head as block", args={"head": head}).select(
            F.lit(0).alias("part"),
            *[F.lit("").alias(c) for c in CONTAINER_KEY],
            "block",
            F.lit(0).alias("columns"),
        )
        body = blocks.select(F.lit(1).alias("part"), *CONTAINER_KEY, "block", "columns")
        order = [F.col("part"), *[F.col(c) for c in _ORDER]]
        (
            _write(first.unionByName(body), order, files)
            .observe(
                counts,
                F.coalesce(F.sum("part"), F.lit(0)).alias("containers"),
                F.coalesce(F.sum("columns"), F.lit(0)).alias("columns"),
            )
            .select("block")
            .write.mode("overwrite")
            .text(path)
        )
        written = counts.get["containers"]
    size = list_files(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return spark.createDataFrame(
        [(path, size, written, counts.get["columns"])],
        "path string, bytes_written bigint, containers bigint, columns bigint",
    )
