"""Counts and ranges of Parquet datasets from their footers, without reading a column.

The second version of the Parquet source answers COUNT, MIN and MAX from the
statistics in the footers. Its settings belong to a session, so these questions are asked
in a session beside the caller's; what comes back is a row per column or dataset.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sondar.functions.sql import ident
from sondar.operators.profile import light_profile
from sondar.sources.lake import partitions_as_written

log = logging.getLogger("sondar.footers")

# Ranges that the footers hold exactly: texts may be cut short there, and floats
# leave out what is not a number.
_RANGED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.DateType)
_COUNTED = (
    *_RANGED, T.FloatType, T.DoubleType, T.StringType, T.BinaryType, T.DecimalType,
    T.TimestampType, T.TimestampNTZType,
)


def beside(spark: SparkSession) -> SparkSession:
    """A session like the caller's in which aggregates are answered from footers."""
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    other.conf.set("spark.sql.sources.useV1SourceList", "")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return other


def footer_frame(other: SparkSession, folder: str, ranged: Sequence[str], counted: Sequence[str]) -> DataFrame:
    """``light_profile`` of columns of a dataset, in a session from ``beside``."""
    with partitions_as_written(other):
        df = other.read.parquet(folder)
    chosen = [c for c in df.columns if c in {*ranged, *counted}]
    return light_profile(df.select(*map(ident, chosen)), ranged, counted)


def footer_profile(spark: SparkSession, folder: str) -> DataFrame:
    """(column_name, ordinal, native_type, null_ratio, min_value, max_value, from_footers): one row per
    column of a Parquet dataset.

    Null ratios come from the footers, and the ranges of whole numbers, booleans and dates;
    ranges of other columns are read, those columns only, and so is all that footers
    without statistics cannot say. ``from_footers`` says which rows needed no column.
    """
    with partitions_as_written(spark):
        df = spark.read.parquet(folder)
    types = {f.name: f.dataType for f in df.schema.fields}
    # Partition keys are in the folders' names, not in the footers.
    stored = set(df.columns) - set(_partition_keys(df))
    counted = [c for c, t in types.items() if c in stored and isinstance(t, _COUNTED)]
    ranged = [c for c in counted if isinstance(types[c], _RANGED)]
    found: dict[str, dict] = {}
    if counted:
        try:
            for row in footer_frame(beside(spark), folder, ranged, counted).collect():
                found[row["column_name"]] = row.asDict()
        except Exception as error:  # noqa: BLE001 - files without statistics
            log.warning("footers of %s say too little: %s", folder, str(error).partition("\n")[0])
            ranged = []
    rest = [c for c in df.columns if c not in ranged]
    if rest:
        lacking = [c for c in rest if c not in found]
        for row in light_profile(df.select(*map(ident, rest)), rest, lacking).collect():
            known = found.get(row["column_name"], {})
            found[row["column_name"]] = row.asDict() | {"null_ratio": known.get("null_ratio", row["null_ratio"])}
    rows = [
        (c, i, types[c].simpleString(), found[c]["null_ratio"], found[c]["min_value"], found[c]["max_value"], c in ranged)
        for i, c in enumerate(df.columns, start=1)
    ]
    return spark.createDataFrame(
        rows, "column_name string, ordinal int, native_type string, null_ratio double, "
        "min_value string, max_value string, from_footers boolean")


def _partition_keys(df: DataFrame) -> list[str]:
    """The columns that come from folder names: those no file of the dataset holds."""
    found: list[str] = []
    for path in df.inputFiles()[:1]:
        found = [part.partition("=")[0] for part in path.split("/")[:-1] if "=" in part]
    return [c for c in df.columns if c in found]


def footer_counts(spark: SparkSession, folders: Mapping[str, str], parallel: int = 8) -> DataFrame:
    """(container_name, estimated_count) of Parquet datasets, by folder: a small job of its own
    for each, ``parallel`` at a time, so that the plan does not grow with the number of tables."""
    other = beside(spark)

    def count(folder: str) -> int:
        return other.read.parquet(folder).selectExpr("count(1) as n").first()["n"]

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        counts = list(pool.map(count, folders.values()))
    return spark.createDataFrame(list(zip(folders, counts, strict=True)), "container_name string, estimated_count bigint")
