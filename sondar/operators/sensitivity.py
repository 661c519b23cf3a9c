"""Which columns hold personal data, and tables with those columns masked."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondar.functions.fixed import VALUE_NEEDS, VALUE_PATTERNS
from sondar.functions.masking import level_from_name, mask_text, value_regexes
from sondar.functions.sql import ident, literal
from sondar.functions.text import value_sql
from sondar.model import (
    DEFAULT_SAMPLE_ROWS,
    NONE,
    PII,
    SENSITIVITY_SAMPLE_ROWS,
    SOURCE_DETECTED,
    NotPermitted,
)
from sondar.operators.browse import Access

# Fewer values than this say nothing about a column.
_MIN_VALUES = 3


def sample(
    df: DataFrame,
    limit: int = DEFAULT_SAMPLE_ROWS,
    *,
    order_by: Sequence[str] = (),
    max_rows: int | None = None,
) -> DataFrame:
    """As many rows as asked for, at most ``max_rows`` if that is given; any
    rows unless ordered."""
    rows = max(0, limit if max_rows is None else min(limit, max_rows))
    return (df.orderBy(*order_by) if order_by else df).limit(rows)


def sample_for(
    df: DataFrame,
    access: Access,
    limit: int = DEFAULT_SAMPLE_ROWS,
    *,
    masked: bool = True,
    recorded: Mapping[str, str] | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Rows for a caller: masked, or as they are if the caller may see that."""
    if masked:
        return masked_sample(df, limit, recorded, order_by=order_by)[0]
    if not access.raw_samples:
        raise NotPermitted("samples without masking")
    return sample(df, limit, order_by=order_by)


#: Columns whose values are judged in one aggregation.
BLOCK = 40


def by_name(names: DataFrame, column: str = "column_name") -> DataFrame:
    """Adds ``sensitivity``: the level each column name alone gives, or NULL."""
    return names.withColumn("sensitivity", level_from_name(F.col(column)))


def _as_texts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.selectExpr(
        *[f"{value_sql(ident(c), types[c])} as {ident(c)}" for c in columns]
    )


def by_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, sensitivity) judged from every value of the frame.

    One pattern has to match more than half of the non-empty values, and there
    must be three of them. Columns and patterns are counted in one aggregation, or
    in one for each block of columns where there are many: a plan that is too large
    to be compiled takes far longer than several.
    """
    columns = list(df.columns if columns is None else columns)
    if len(columns) > BLOCK:
        parts = [by_values(df, columns[i : i + BLOCK]) for i in range(0, len(columns), BLOCK)]
        out = parts[0]
        for more in parts[1:]:
            out = out.unionAll(more)
        return out
    if not columns:
        return df.sparkSession.sql(
            "select '' as column_name, '' as sensitivity where false"
        )
    aggregates = []
    for index, name in enumerate(columns):
        aggregates.append(f"count_if({ident(name)} <> '') as n{index}")
        aggregates += [
            f"count_if({needs.format(ident(name))} and {ident(name)} rlike {literal(pattern)}) "
            f"as m{index}_{which}"
            for which, (needs, pattern) in enumerate(zip(VALUE_NEEDS, value_regexes(), strict=True))
        ]
    rows = ", ".join(
        f"named_struct('column_name', {literal(name)}, 'n', n{index}, 'hits', greatest("
        + ", ".join(f"m{index}_{which}" for which in range(len(VALUE_PATTERNS)))
        + "))"
        for index, name in enumerate(columns)
    )
    # Every value pattern stands for the same level.
    return (
        _as_texts(df, columns)
        .selectExpr(*aggregates)
        .selectExpr(f"inline(array({rows}))")
        .selectExpr(
            "column_name",
            f"if(n >= {_MIN_VALUES} and 2 * hits > n, {literal(PII)}, null) "
            "as sensitivity",
        )
    )


def _rows_frame(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    values = ", ".join(f"({literal(name)})" for name in names)
    return spark.sql(f"select * from values {values} as t(column_name)")


def detect(
    df: DataFrame,
    *,
    full: bool = True,
    order_by: Sequence[str] = (),
    sample_rows: int = SENSITIVITY_SAMPLE_ROWS,
) -> DataFrame:
    """(column_name, sensitivity) of the columns recognised as sensitive.

    Names first; values are read only for columns whose name says nothing, and
    not at all if there is none. Those are judged on the whole table, in one
    pass; ``full=False`` judges them on ``sample_rows`` rows.
    """
    spark = df.sparkSession
    named = by_name(_rows_frame(spark, df.columns))
    undecided = [
        row.column_name for row in named.collect() if row.sensitivity is None
    ]
    levels = named.where(F.col("sensitivity").isNotNull())
    if undecided:
        if full:
            judged = by_values(df, undecided)
        else:
            # take() stops at the first partitions that fill the sample; a
            # limit below an aggregation would start a task per file split.
            few = df.orderBy(*order_by) if order_by else df
            rows = _as_texts(few, undecided).take(sample_rows)
            schema = ", ".join(f"{ident(name)} string" for name in undecided)
            judged = by_values(spark.createDataFrame(rows, schema))
        levels = levels.unionByName(judged.where(F.col("sensitivity").isNotNull()))
    return levels


def with_recorded(detected: DataFrame, recorded: DataFrame) -> DataFrame:
    """Verdicts of both, the recorded one first; ``none`` means leave alone.

    Frames share ``sensitivity`` and any number of key columns.
    """
    keys = [name for name in detected.columns if name != "sensitivity"]
    known = recorded.where(F.col("sensitivity").isNotNull()).select(
        *keys, F.col("sensitivity").alias("recorded")
    )
    return (
        detected.join(known, keys, "full")
        .select(*keys, F.coalesce("recorded", "sensitivity").alias("sensitivity"))
        .where(F.col("sensitivity") != NONE)
    )


def sensitive_columns(
    df: DataFrame,
    recorded: Mapping[str, str] | None = None,
    *,
    full: bool = True,
    order_by: Sequence[str] = (),
) -> dict[str, str]:
    """Column -> level for the columns of ``df`` to hide."""
    recorded = recorded or {}
    open_columns = [name for name in df.columns if name not in recorded]
    levels = {
        name: level
        for name, level in recorded.items()
        if level != NONE and name in df.columns
    }
    if open_columns:
        found = detect(
            df.selectExpr(
                *[ident(c) for c in dict.fromkeys([*open_columns, *order_by])]
            ),
            full=full,
            order_by=order_by,
        )
        levels |= {
            row.column_name: row.sensitivity
            for row in found.collect()
            if row.column_name in open_columns
        }
    return levels


def mask_table(df: DataFrame, levels: Mapping[str, str]) -> DataFrame:
    """The table with the named columns masked; those become text, the others
    are not touched."""
    types = {f.name: f.dataType for f in df.schema.fields}
    hidden = {c: level for c, level in levels.items() if level != NONE and c in types}
    if not hidden:
        return df
    return df.withColumns(
        {
            name: mask_text(F.expr(value_sql(ident(name), types[name])), level)
            for name, level in hidden.items()
        }
    )


def masked_sample(
    df: DataFrame,
    limit: int = DEFAULT_SAMPLE_ROWS,
    recorded: Mapping[str, str] | None = None,
    *,
    order_by: Sequence[str] = (),
) -> tuple[DataFrame, list[str]]:
    """A few rows with sensitive columns masked, and the names of those.

    Columns are judged on the whole table, so on the rows shown as well,
    whichever those are.
    """
    levels = sensitive_columns(df, recorded, order_by=order_by)
    rows = sample(df, limit, order_by=order_by)
    return mask_table(rows, levels), sorted(levels)


def record_detected(columns: DataFrame, detected: DataFrame) -> DataFrame:
    """Stored columns with new detections; a verdict written by an agent or a
    person stays, an earlier detection is replaced."""
    keys = [name for name in detected.columns if name != "sensitivity"]
    fresh = detected.select(*keys, F.col("sensitivity").alias("_new"))
    takes = F.col("_new").isNotNull() & (
        F.coalesce("sensitivity_source", F.lit(SOURCE_DETECTED)) == SOURCE_DETECTED
    )
    return (
        columns.join(fresh, keys, "left")
        .withColumns(
            {
                "sensitivity": F.when(takes, F.col("_new")).otherwise(
                    F.col("sensitivity")
                ),
                "sensitivity_source": F.when(takes, F.lit(SOURCE_DETECTED)).otherwise(
                    F.col("sensitivity_source")
                ),
            }
        )
        .select(*columns.columns)
    )
