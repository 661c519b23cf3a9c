"""Opens what a listing names: a reader for each container of a whole-catalog scan."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from sondar.sources import jdbc, lake

#: Takes a schema and a container name; None for what is not to be read.
Opener = Callable[[str, str], DataFrame | None]


def lake_datasets(spark: SparkSession, root: str, **options: object) -> Opener:
    """The datasets of a lake folder, by name."""
    return lambda _schema, name: lake.read_dataset(spark, root, name, **options)


def jdbc_tables(spark: SparkSession, url: str, *, quote: str = '"', **options: object) -> Opener:
    """The tables of a database, each part of a qualified name quoted."""

    def opened(schema: str, name: str) -> DataFrame:
        plain = name.removeprefix(f"{schema}.") if schema else name
        parts = [schema, plain] if schema else [plain]
        close = {"[": "]"}.get(quote, quote)
        quoted = ".".join(quote + part.replace(close, close * 2) + close for part in parts)
        return jdbc.read_table(spark, url, quoted, **options)

    return opened


def by_schema(openers: Mapping[str, Opener]) -> Opener:
    """A reader for each schema; containers of other schemas are listed only."""
    return lambda schema, name: openers[schema](schema, name) if schema in openers else None
