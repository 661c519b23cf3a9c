"""Relational tables read in parallel slices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession


def slice_options(
    column: str, lower: object, upper: object, slices: int
) -> dict[str, str]:
    """Options that split a table scan into ranges of one column."""
    if slices < 1:
        raise ValueError("slices must be at least 1")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(slices),
    }


def _literal(value: object) -> str:
    if isinstance(value, bool):
        return "1" if value else "0"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def range_predicates(column: str, bounds: Sequence[object]) -> list[str]:
    """Conditions that split a table at ``bounds``, values of any ordered key such as
    names or identifiers: every row meets exactly one, NULL the first.

    Quantiles of a sample make good bounds. The database compares them, so they have to
    be in its own order; repeated ones are refused.
    """
    edges = [_literal(b) for b in bounds]
    if len(set(edges)) < len(edges):
        raise ValueError("bounds repeat a value")
    if not edges:
        return ["1 = 1"]
    inside = [f"{column} >= {a} and {column} < {b}" for a, b in pairwise(edges)]
    return [f"{column} < {edges[0]} or {column} is null", *inside, f"{column} >= {edges[-1]}"]


def hash_predicates(hashed: str, slices: int) -> list[str]:
    """Conditions that deal rows out by a whole-number hash of any key, in the database's own
    words (``hashtext(name)``, ``crc32(name)``, ``checksum(name)``): every row meets
    exactly one, NULL the first."""
    if slices < 1:
        raise ValueError("slices must be at least 1")
    # The remainder may be negative; twice taken, it is not.
    place = f"((({hashed}) % {slices}) + {slices}) % {slices}"
    return [f"{place} = {i}" + (f" or ({hashed}) is null" if i == 0 else "") for i in range(slices)]


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    slice_column: str | None = None,
    slices: int = 16,
    predicates: Sequence[str] | None = None,
    fetch_rows: int = 10_000,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """One table or view. Filters, column choice and limits reach the database.

    ``predicates`` (see ``range_predicates`` and ``hash_predicates``) make a slice each,
    where no numeric key is at hand.

    With ``slice_column`` (an indexed number or date) the table is read in that
    many ranges; the bounds come from one min/max query to the database. The
    first and last ranges are open, so rows outside the bounds are not lost.
    """
    base = {
        "url": url,
        "fetchsize": str(fetch_rows),
        "pushDownPredicate": "true",
        "pushDownLimit": "true",
        **(options or {}),
    }
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties={
            name: value for name, value in base.items() if name != "url"})
    extra: dict[str, str] = {}
    if slice_column:
        bounds = (
            spark.read.format("jdbc")
            .options(**base)
            .option(
                "query",
                f"select min({slice_column}) as lo, max({slice_column}) as hi "
                f"from {table}",
            )
            .load()
            .first()
        )
        if bounds is not None and bounds[0] is not None:
            extra = slice_options(slice_column, bounds[0], bounds[1], slices)
    return (
        spark.read.format("jdbc")
        .options(**base, **extra)
        .option("dbtable", table)
        .load()
    )
