"""Registered queries: each operator over the given tables, with the SQL that
must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]


@dataclass
class Registry:
    queries: dict[str, Query] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        """Registers the decorated query; ``sql`` is its DuckDB equivalent."""

        def register(query: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"{name} is registered twice")
            self.queries[name] = query
            if sql is not None:
                self.sql[name] = sql
            return query

        return register


registry = Registry()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_sql(spark: SparkSession, sf_dir: str, text: str, **given: DataFrame) -> DataFrame:
    """SQL over the given tables, named ``{lineitem}`` and so on in the text; a frame
    in ``given`` stands for the table of its name."""
    used = {n: given.get(n, table(spark, sf_dir, n)) for n in TABLES if "{" + n + "}" in text}
    return spark.sql(text, **used)


def plain(text: str) -> str:
    """The same SQL for a database that has the tables under their names."""
    return text.replace("{", "").replace("}", "")
