"""What a declared type allows, and how foreign catalogs spell types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondar.functions import fixed
from sondar.model import DISTINCT_COUNT, MIN_MAX, NULL_RATIO, TOP_VALUES

RANGE_MODES = (NULL_RATIO, MIN_MAX)
CATEGORY_MODES = (NULL_RATIO, DISTINCT_COUNT, TOP_VALUES)


def modes_for(dtype: T.DataType) -> tuple[str, ...]:
    """The statistics worth gathering for a column of this type."""
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType, T.BooleanType)):
        return CATEGORY_MODES
    if isinstance(
        dtype,
        (
            T.NumericType,
            T.DateType,
            T.TimestampType,
            T.TimestampNTZType,
            T.DayTimeIntervalType,
            T.YearMonthIntervalType,
        ),
    ):
        return RANGE_MODES
    return (NULL_RATIO,)


def _modes(names: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(name) for name in names])


def modes_for_type_text(native_type: Column) -> Column:
    """Same choice from the text of a foreign type.

    Matched on fragments, group by group: ``interval`` is temporal although it
    holds ``int``, and ``enum`` counts as numeric because it holds ``num``.
    """
    text = F.lower(native_type)

    def holds(fragments: list[str]) -> Column:
        return text.rlike("|".join(fragments))

    return (
        F.when(holds(fixed.OPAQUE_TYPES), _modes((NULL_RATIO,)))
        .when(holds(fixed.TEMPORAL_TYPES), _modes(RANGE_MODES))
        .when(holds(fixed.NUMERIC_TYPES), _modes(RANGE_MODES))
        .when(holds(fixed.CATEGORICAL_TYPES), _modes(CATEGORY_MODES))
        .otherwise(_modes((NULL_RATIO,)))
    )


def modes_for_document_type(native_type: Column) -> Column:
    """Choice for a document field; a field of several types (``a|b``) gets a
    null ratio only, since a range over mixed types says nothing."""
    ranged = fixed.DOCUMENT_NUMERIC + fixed.DOCUMENT_TEMPORAL
    return (
        F.when(native_type.isin(ranged), _modes(RANGE_MODES))
        .when(native_type.isin(fixed.DOCUMENT_CATEGORICAL), _modes(CATEGORY_MODES))
        .otherwise(_modes((NULL_RATIO,)))
    )


# ---- fixed values: single-key objects that stand for a typed document value
EXTENDED_TYPES = {
    "$oid": "objectId",
    "$date": "date",
    "$timestamp": "timestamp",
    "$binary": "binData",
    "$regularExpression": "regex",
    "$regex": "regex",
    "$code": "javascript",
    "$numberDecimal": "decimal",
    "$numberLong": "long",
    "$numberInt": "int",
    "$numberDouble": "double",
}


def document_type(value: Column) -> Column:
    """The type name of one document value (VARIANT); NULL for a null value.

    A whole number is ``int`` within 32 bits and ``long`` beyond; fractions are
    ``double``.
    """
    shape = F.schema_of_variant(value)
    number = F.try_variant_get(value, "$", "bigint")
    special = F.lit("object")
    for key, name in EXTENDED_TYPES.items():
        special = F.when(shape.startswith(f"OBJECT<{key}:"), F.lit(name)).when(
            shape.startswith(f"OBJECT<`{key}`:"), F.lit(name)
        ).otherwise(special)
    return (
        F.when(shape.isNull() | (shape == "VOID"), F.lit(None).cast("string"))
        .when(shape == "BOOLEAN", F.lit("bool"))
        .when(
            shape == "BIGINT",
            F.when(number.between(-(2**31), 2**31 - 1), F.lit("int")).otherwise(
                F.lit("long")
            ),
        )
        .when(
            shape.startswith("DECIMAL") | shape.isin("DOUBLE", "FLOAT"),
            F.lit("double"),
        )
        .when(shape == "STRING", F.lit("string"))
        .when(shape == "BINARY", F.lit("binData"))
        .when(shape.startswith("ARRAY"), F.lit("array"))
        .when(shape == "DATE", F.lit("date"))
        .when(shape.startswith("TIMESTAMP"), F.lit("date"))
        .when(shape.startswith("OBJECT"), special)
        .otherwise(F.lower(shape))
    )


def sqlserver_type(
    name: Column, max_length: Column, precision: Column, scale: Column
) -> Column:
    """The declared type: ``decimal(12,2)``, ``nvarchar(255)``, ``varchar(max)``."""
    # nchar and nvarchar give their length in bytes, two to a character.
    size = F.when(
        name.isin("nchar", "nvarchar"), F.floor(max_length / 2)
    ).otherwise(max_length)
    sized = ["char", "varchar", "nchar", "nvarchar", "binary", "varbinary"]
    return (
        F.when(
            name.isin("decimal", "numeric"),
            F.format_string("%s(%d,%d)", name, precision, scale),
        )
        .when(name.isin(sized) & (max_length == -1), F.concat(name, F.lit("(max)")))
        .when(name.isin(sized), F.concat(name, F.lit("("), size.cast("string"), F.lit(")")))
        .otherwise(name)
    )
