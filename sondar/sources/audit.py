"""The trail of calls made against an inventory, as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondar.model import AUDIT, ddl


def read_trail(spark: SparkSession, path: str) -> DataFrame:
    """Call records; a glob such as ``audit.jsonl*`` takes rotated files in."""
    return spark.read.schema(ddl(AUDIT)).json(path)


def parse_trail(lines: DataFrame, column: str = "value") -> DataFrame:
    """Call records from a column of JSON lines."""
    return lines.select(F.from_json(column, ddl(AUDIT)).alias("r")).select("r.*")


def reads_by_caller(trail: DataFrame) -> DataFrame:
    """Who read what: calls, failures and rows per caller, tool and container."""
    return trail.groupBy(
        "key_id", "tool", F.col("params")["container"].alias("container")
    ).agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(F.col("outcome") != "ok").alias("failed"),
        F.coalesce(F.sum("rows_returned"), F.lit(0)).alias("rows_returned"),
    )


def unmasked_reads(trail: DataFrame) -> DataFrame:
    """Who has seen raw rows, of what, how often and when last."""
    return (
        trail.where(F.col("unmasked") & (F.col("outcome") == "ok"))
        .groupBy("key_id", F.col("params")["container"].alias("container"))
        .agg(
            F.count(F.lit(1)).alias("reads"),
            F.coalesce(F.sum("rows_returned"), F.lit(0)).alias("rows_returned"),
            F.max("ts").alias("last_read"),
        )
    )
