"""Values and descriptions as text, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondar.functions.sql import ident, literal
from sondar.model import SEARCH_DESCRIPTION_CHARS


def _double_sql(x: str) -> str:
    """Shortest decimal form: plain from 1e-4 up to 1e16, else ``1.5e+16``.

    Spark writes ``1.5E7``; the digits are the same, so only the layout of
    mantissa and exponent is redone. No rounding happens. The size of the number
    says which layout Spark gave it, so that each value is written only once.
    """
    raw, size = f"cast({x} as string)", f"abs({x})"
    # Both decimals hold every digit that a number of this size has.
    whole = f"concat(cast(cast({x} as bigint) as string), '.0')"
    large = f"trim(trailing '0' from cast(cast({x} as decimal(38,12)) as string))"
    small = f"trim(trailing '0' from cast(cast({x} as decimal(38,24)) as string))"
    bare = f"replace({raw}, '.0E', 'E')"
    return (
        f"case when {size} >= 1e-3d and {size} < 1e7d or {x} = 0d then {raw} "
        f"when isnan({x}) then 'nan' "
        f"when {size} = double('Infinity') then if({x} > 0d, 'inf', '-inf') "
        f"when {size} >= 1e16d then replace({bare}, 'E', 'e+') "
        f"when {size} >= 1e7d then if({x} = cast({x} as bigint), {whole}, {large}) "
        f"when {size} >= 1e-4d then {small} "
        f"when {size} >= 1e-9d then replace({bare}, 'E-', 'e-0') "
        f"else replace({bare}, 'E', 'e') end"
    )


def clock_sql(x: str) -> str:
    """ISO date and time; a fraction only where there is one, six digits."""
    whole = f"date_format({x}, \"yyyy-MM-dd'T'HH:mm:ss\")"
    return (
        f"if(date_format({x}, 'SSSSSS') = '000000', {whole}, "
        f"date_format({x}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"))"
    )


def _time_sql(x: str) -> str:
    """``clock_sql`` of a timestamp column, from Spark's own text where the year has four digits."""
    text = f"cast({x} as string)"
    padded = f"rpad(replace({text}, ' ', 'T'), if(length({text}) = 19, 19, 26), '0')"
    return f"if({text} >= '0001', {padded}, {clock_sql(x)})"


def _date_sql(x: str) -> str:
    text = f"cast({x} as string)"
    return f"if({text} >= '0001', {text}, date_format({x}, 'yyyy-MM-dd'))"


def json_ready_sql(x: str, dtype: T.DataType, depth: int = 0) -> str:
    """The value in a shape JSON can carry, keeping text, numbers and booleans.

    Dates and times become ISO text, bytes base64, decimals and intervals text;
    maps get text keys; arrays, maps and structs are converted inside.
    """
    if isinstance(dtype, (T.StringType, T.BooleanType, T.IntegralType, T.DoubleType)):
        return x
    if isinstance(dtype, T.FloatType):
        return f"cast({x} as double)"
    item = f"v{depth}"
    if isinstance(dtype, T.ArrayType):
        inner = json_ready_sql(item, dtype.elementType, depth + 1)
        return f"transform({x}, {item} -> {inner})"
    if isinstance(dtype, T.MapType):
        keys = value_sql(item, dtype.keyType, depth + 1)
        values = json_ready_sql(item, dtype.valueType, depth + 1)
        return (
            f"map_from_arrays(transform(map_keys({x}), {item} -> {keys}), "
            f"transform(map_values({x}), {item} -> {values}))"
        )
    if isinstance(dtype, T.StructType):
        fields = ", ".join(
            f"{literal(field.name)}, "
            + json_ready_sql(f"{x}.{ident(field.name)}", field.dataType, depth)
            for field in dtype.fields
        )
        return f"if({x} is null, null, named_struct({fields}))"
    return value_sql(x, dtype, depth)


def value_sql(x: str, dtype: T.DataType, depth: int = 0) -> str:
    """SQL text that renders ``x`` as text, NULL kept.

    Floating point is written like ``10000000.0``, booleans ``True``/``False``,
    times in ISO form, bytes base64, nested values as JSON.
    """
    if isinstance(dtype, T.BooleanType):
        return f"if({x}, 'True', if({x} is null, null, 'False'))"
    if isinstance(dtype, T.DoubleType):
        return _double_sql(x)
    if isinstance(dtype, T.FloatType):
        return _double_sql(f"cast({x} as double)")
    if isinstance(dtype, T.TimestampNTZType):
        return _time_sql(x)
    if isinstance(dtype, T.TimestampType):
        return f"concat({_time_sql(x)}, date_format({x}, 'xxx'))"
    if isinstance(dtype, T.DateType):
        return _date_sql(x)
    if isinstance(dtype, T.BinaryType):
        return f"base64({x})"
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        ready = json_ready_sql(x, dtype, depth)
        return f"to_json({ready}, map('ignoreNullFields', 'false'))"
    if isinstance(dtype, T.VariantType):
        return f"to_json({x})"
    if isinstance(dtype, T.StringType):
        return x
    return f"cast({x} as string)"


def value_text(name: str, dtype: T.DataType) -> Column:
    """The named column as text."""
    return F.expr(value_sql(ident(name), dtype))


def json_ready(df: DataFrame) -> DataFrame:
    """Every column in a shape JSON can carry."""
    return df.select(
        *[
            F.expr(json_ready_sql(ident(f.name), f.dataType)).alias(f.name)
            for f in df.schema.fields
        ]
    )


def strip(text: Column) -> Column:
    """White space of any kind removed from both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def shortened(text: Column) -> Column:
    """Cut to what a search hit carries, with an ellipsis where cut."""
    head = F.regexp_replace(
        F.substring(text, 1, SEARCH_DESCRIPTION_CHARS), r"(?U)\s+$", ""
    )
    return F.when(
        F.length(text) > SEARCH_DESCRIPTION_CHARS, F.concat(head, F.lit("…"))
    ).otherwise(text)


def shown_description(written: Column, native: Column) -> Column:
    """What was written, else what the source says, else ''."""
    return F.coalesce(
        F.nullif(written, F.lit("")), F.nullif(native, F.lit("")), F.lit("")
    )


def reference_text(container: Column, column: Column) -> Column:
    """``table.column``; the table alone where the column is not known."""
    return F.concat_ws(".", container, F.nullif(column, F.lit("")))


def retype_text(name: Column, old: Column, new: Column) -> Column:
    return F.concat(name, F.lit(": "), old, F.lit(" → "), new)


def table_cell(text: Column) -> Column:
    """Safe inside a Markdown table row."""
    escaped = F.replace(text, F.lit("|"), F.lit("\\|"))
    return strip(F.replace(escaped, F.lit("\n"), F.lit(" ")))


def yaml_scalar(text: Column) -> Column:
    """A quoted scalar: a JSON string is a YAML string."""
    # to_json of a one-field struct is {"v":"..."}; the string is between.
    wrapped = F.to_json(F.struct(text.alias("v")))
    return F.substr(wrapped, F.lit(6), F.length(wrapped) - 6)
