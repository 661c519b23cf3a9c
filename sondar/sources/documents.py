"""Document collections as JSON text, one document per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values: databases that belong to a document server
SYSTEM_DATABASES = ["admin", "local", "config"]


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """(document) from files of one JSON object per line."""
    lines = spark.read.text(path)
    return lines.where(F.trim("value") != "").select(F.col("value").alias("document"))


def databases(names: DataFrame) -> DataFrame:
    """User databases from a listing (``name``)."""
    return (
        names.where(~F.col("name").isin(SYSTEM_DATABASES))
        .select(F.col("name").alias("database"))
        .orderBy("database")
    )
