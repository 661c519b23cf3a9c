"""Schema and statistics of JSON documents that declare none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondar.functions.sql import ident, literal
from sondar.functions.types import document_type, modes_for_document_type
from sondar.model import NULL_RATIO, UnknownColumn
from sondar.operators.numbering import numbered
from sondar.operators.profile import table_profile

_STRICT = {"mode": "FAILFAST"}
#: Fields beyond which a collection's keys are taken for data.
MAX_FIELDS = 10_000


def _fields(document: Column) -> Column:
    """Top-level fields in written order, one generated row each."""
    return F.posexplode(F.from_json(document, "map<string,variant>", _STRICT))


def infer_schema(
    df: DataFrame,
    document: str,
    *,
    order_by: Sequence[str] = (),
    sample_documents: int | None = None,
) -> DataFrame:
    """(column_name, ordinal, native_type, nullable, is_pk, is_fk) of a column
    of JSON objects.

    Each top-level field once, in the order first seen, with every type it was
    seen holding joined by a bar; nullable where any document lacks it or holds
    null. Nested values are ``object`` and ``array``. Judged on all documents,
    or on the first ``sample_documents``; malformed documents fail the query.

    Fields are combined map-side to one row per name and task, and the distinct
    names numbered part by part, so that names which are data do no harm here;
    who has them in the driver asks ``require_fields`` first.
    """
    text = F.col(ident(document))
    keys = [F.col(ident(name)) for name in order_by] or [F.monotonically_increasing_id()]
    docs = df.select(
        F.struct(*[key.alias(f"k{i}") for i, key in enumerate(keys)]).alias("at"),
        text.alias("document"),
    ).where(F.col("document").isNotNull())
    if sample_documents is not None:
        docs = (docs.orderBy("at") if order_by else docs).limit(sample_documents)
        if not order_by:
            # Any documents will do, but both readers below must see the same.
            docs = df.sparkSession.createDataFrame(docs.collect(), docs.schema)
    total = docs.agg(F.count(F.lit(1)))
    seen = (
        docs.select("at", _fields(F.col("document")).alias("position", "field", "value"))
        .select("at", "position", "field", document_type(F.col("value")).alias("kind"))
        .groupBy("field")
        .agg(
            F.min(F.struct("at", "position")).alias("first_seen"),
            F.collect_set("kind").alias("kinds"),
            F.count("kind").alias("present"),
        )
    )
    return numbered(seen, [F.col("first_seen")], "ordinal").select(
        F.col("field").alias("column_name"),
        "ordinal",
        F.array_join(F.array_sort("kinds"), "|").alias("native_type"),
        (F.col("present") < total.scalar()).alias("nullable"),
        (F.col("field") == "_id").alias("is_pk"),
        F.lit(False).alias("is_fk"),
    )


def require_fields(schema: DataFrame, document: str, max_fields: int = MAX_FIELDS) -> list[Row]:
    """The rows of a schema by ordinal; one of more than ``max_fields`` fields is refused
    before more than one row beyond that reaches the driver."""
    rows = schema.orderBy("ordinal").limit(max_fields + 1).collect()
    if len(rows) > max_fields:
        raise ValueError(f"{document} has more than {max_fields} fields; are its keys data?")
    return rows


def _get(kind: str, *paths: str) -> str:
    """SQL that reads ``{0}`` as ``kind`` from the first path that has it."""
    return ", ".join(
        f"try_variant_get({{0}}, {literal(path)}, {literal(kind)})" for path in paths
    )


def _decimal(text: str) -> str:
    """A decimal as a struct that sorts like the number and ends with its text.

    One type cannot hold 34 digits with any scale: whole part, nine digits and
    eighteen digits of fraction are compared one after the other, as far as each
    has room. What is no number of at most 38 whole digits is NULL.
    """
    parts = ", ".join(
        f"'d{scale}', try_cast({text} as decimal(38,{scale}))" for scale in (0, 9, 18)
    )
    return (
        f"if(try_cast({text} as decimal(38,0)) is null, null, "
        f"named_struct({parts}, 'text', {text}))"
    )


# How a field of one type is read for its statistics; typed values may come as
# plain JSON or as single-key objects.
_READ_AS = {
    "int": f"coalesce({_get('bigint', '$', '$["$numberInt"]')})",
    "long": f"coalesce({_get('bigint', '$', '$["$numberLong"]')})",
    "double": f"coalesce({_get('double', '$', '$["$numberDouble"]')})",
    "decimal": _decimal(_get("string", '$["$numberDecimal"]')),
    "bool": _get("boolean", "$"),
    "string": _get("string", "$"),
    "date": (
        f"coalesce({_get('timestamp', '$["$date"]')}, "
        f"timestamp_millis({_get('bigint', '$["$date"]["$numberLong"]')}))"
    ),
    "timestamp": f"timestamp_seconds({_get('bigint', '$["$timestamp"]["t"]')})",
}


def flatten(df: DataFrame, document: str, fields: dict[str, str]) -> DataFrame:
    """One typed column per named field (name -> document type).

    A field of one simple type comes as that type; any other as ``true`` where
    it is present. A missing field and a null one are both NULL, and so is a value
    that does not fit the type. The document is parsed once, whatever the number
    of fields.
    """
    return _flattened(df, document, fields)


def _flattened(
    df: DataFrame,
    document: str,
    fields: dict[str, str],
    present_as: dict[str, str] | None = None,
    fit_as: dict[str, str] | None = None,
) -> DataFrame:
    """:func:`flatten`; with ``present_as`` and ``fit_as`` also a column per field
    that is NULL where the field is missing or null, and one that is NULL where
    it is there but does not fit its type."""
    names = {f"f{index}": name for index, name in enumerate(fields)}
    schema = T.StructType([T.StructField(n, T.VariantType()) for n in fields])
    parsed = df.select(
        F.from_json(F.col(ident(document)), schema, _STRICT).alias("d")
    ).select(*[F.col(f"d.{ident(name)}").alias(alias) for alias, name in names.items()])
    out = []
    for alias, name in names.items():
        present = f"if({alias} is null or is_variant_null({alias}), null, true)"
        text = _READ_AS.get(fields[name], present).replace("{0}", alias)
        out.append(f"{text} as {ident(name)}")
        if present_as:
            out.append(f"{present} as {ident(present_as[name])}")
        if fit_as:
            fits = f"if({present} and ({text}) is null, null, true)"
            out.append(f"{fits} as {ident(fit_as[name])}")
    return parsed.selectExpr(*out)


def document_profile(
    df: DataFrame,
    document: str,
    schema: DataFrame,
    *,
    max_fields: int = MAX_FIELDS,
    **options: object,
) -> DataFrame:
    """Profile of the fields in ``schema`` (from :func:`infer_schema`) over all
    documents, each with the statistics its type allows.

    The null ratio counts documents that lack the field or hold null. Values that
    do not fit the type (a schema of other documents, numbers beyond 38 digits)
    are in no range or count; ``unfit_ratio`` says how many documents hold one.
    A collection of more than ``max_fields`` fields is refused.
    """
    with_modes = schema.select(
        "column_name",
        "native_type",
        "ordinal",
        modes_for_document_type(F.col("native_type")).alias("modes"),
    )
    rows = require_fields(with_modes, document, max_fields)
    if not rows:
        raise UnknownColumn(document)
    fields = {row.column_name: row.native_type for row in rows}
    modes = {row.column_name: row.modes for row in rows}
    # Two more columns a field, under names no field has, read in the same pass.
    longest = max(map(len, fields))
    there = {name: f"{i}p" + " " * (longest + 1) for i, name in enumerate(fields)}
    fit = {name: f"{i}f" + " " * (longest + 1) for i, name in enumerate(fields)}
    asked = {name: [m for m in modes[name] if m != NULL_RATIO] for name in fields}
    asked |= {name: [NULL_RATIO] for name in [*there.values(), *fit.values()]}
    found = table_profile(
        _flattened(df, document, fields, there, fit), asked, **options
    )
    owners = ", ".join(
        f"{literal(alias)}, {literal(name)}"
        for aliases in (there, fit)
        for name, alias in aliases.items()
    )
    own = f"element_at(map({owners}), column_name)"
    ratios = (
        found.selectExpr(f"{own} as _field", "column_name as _alias", "null_ratio as _r")
        .where("_field is not null")
        .groupBy(F.col("_field").alias("column_name"))
        .agg(
            F.max(F.when(F.col("_alias").isin(list(there.values())), F.col("_r"))).alias("_nulls"),
            F.max(F.when(F.col("_alias").isin(list(fit.values())), F.col("_r"))).alias("unfit_ratio"),
        )
    )
    positions = ", ".join(f"{literal(n)}, {i}" for i, n in enumerate(fields, start=1))
    profile = (
        found.where(F.col("column_name").isin(list(fields)))
        .join(ratios, "column_name")
        .withColumns(
            {
                "null_ratio": F.col("_nulls"),
                "ordinal": F.expr(f"element_at(map({positions}), column_name)"),
                "modes": F.array_append("modes", F.lit(NULL_RATIO)),
            }
        )
        .drop("_nulls")
    )
    kinds = ", ".join(
        f"{literal(name)}, {literal(kind)}" for name, kind in fields.items()
    )
    # Decimals are shown as written, without zeros that pad their fraction.
    plain = {
        name: F.when(
            F.expr(f"element_at(map({kinds}), column_name) = 'decimal'"),
            F.regexp_replace(
                F.get_json_object(name, "$.text"), r"^([^.eE]*)(?:\.0+|(\.\d*[1-9])0+)$", "$1$2"
            ),
        ).otherwise(F.col(name))
        for name in ("min_value", "max_value")
    }
    return profile.withColumns(
        {**plain, "native_type": F.expr(f"element_at(map({kinds}), column_name)")}
    )
