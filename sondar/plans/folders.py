"""Statistics of a dataset kept for each of its folders, and merged.

Counts, ranges and distinct-count sketches of disjoint rows can be merged, so a rescan
reads only folders whose files changed since, such as the newest day of a table by
days, and merges what it finds with what is kept of the others.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondar.functions.sql import ident, literal
from sondar.functions.text import value_sql
from sondar.operators.profile import has_range
from sondar.sources.lake import partitions_as_written

#: Kept of a column in a folder. Ranges are in the engine's own text, which casts back to the type.
ROWS = (
    "folder string, state string, column_name string, native_type string, "
    "rows bigint, present bigint, low string, high string, sketch binary"
)
#: Base-2 logarithm of a sketch's size: a relative error of about 0.8 %.
LOG_SIZE = 14


@dataclass(frozen=True)
class Refreshed:
    """A merged profile, and how many folders were read and kept for it."""

    profile: DataFrame
    read: int
    kept: int
    dropped: int


def _parent(path: str) -> str:
    return f"regexp_replace({path}, '/[^/]*$', '')"


def folder_states(spark: SparkSession, root: str, suffix: str = ".parquet") -> DataFrame:
    """(folder, path, state) of every folder below ``root`` that holds data files; ``state`` changes
    with their names, sizes and times. Files are listed, not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}")
        .load(root).selectExpr("_metadata.file_path as file", "path", "length", "modificationTime")
    )
    return files.groupBy(F.expr(f"{_parent('file')} as folder"), F.expr(f"{_parent('path')} as path")).agg(
        F.expr("concat_ws(':', count(1), sum(length), hex(bit_xor(xxhash64(file, length, modificationTime)))) as state"))


def _atomic(dtype: T.DataType) -> bool:
    return not isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def folder_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(folder, column_name, native_type, rows, present, low, high, sketch) of a frame read from
    files: one aggregation by folder, map-side combined."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    aggregates, parts = ["count(1) as rows"], []
    for i, name in enumerate(columns):
        dtype, ref = fields[name], ident(name)
        low = high = sketch = "null"
        aggregates.append(f"count({ref}) as n{i}")
        if _atomic(dtype) and has_range(dtype):
            aggregates += [f"min({ref}) as lo{i}", f"max({ref}) as hi{i}"]
            low, high = f"lo{i}", f"hi{i}"
        if _atomic(dtype):
            if isinstance(dtype, (T.FloatType, T.DoubleType)):
                ref = f"{ref} + 0.0d"
            plain = ref if isinstance(dtype, (T.IntegralType, T.StringType, T.BinaryType)) else f"cast({ref} as string)"
            aggregates.append(f"hll_sketch_agg({plain}, {LOG_SIZE}) as s{i}")
            sketch = f"s{i}"
        parts.append(
            f"named_struct('column_name', {literal(name)}, 'native_type', {literal(dtype.simpleString())}, "
            f"'present', n{i}, 'low', cast({low} as string), 'high', cast({high} as string), 'sketch', cast({sketch} as binary))")
    grouped = df.groupBy(F.expr(f"{_parent('_metadata.file_path')} as folder")).agg(*map(F.expr, aggregates))
    return grouped.selectExpr("folder", "rows", f"inline(array({', '.join(parts)}))")


def merged(kept: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per column from the rows of all folders, as ``table_profile`` has them: null ratio,
    range, and a distinct count that is approximate."""
    aggregates, rows = [], []
    for i, field in enumerate(schema.fields):
        dtype = field.dataType
        mine = f"column_name = {literal(field.name)}"
        aggregates += [f"sum(if({mine}, rows, null)) as r{i}", f"sum(if({mine}, present, null)) as n{i}"]
        low = high = distinct = "null"
        if _atomic(dtype) and has_range(dtype):
            kind = dtype.simpleString()
            zero = " + 0.0d" if isinstance(dtype, (T.FloatType, T.DoubleType)) else ""
            aggregates += [f"{f}(if({mine}, cast({x} as {kind}), null)) as {a}{i}" for f, x, a in (("min", "low", "lo"), ("max", "high", "hi"))]
            shown = T.DoubleType() if zero else dtype
            low, high = value_sql(f"(lo{i}{zero})", shown), value_sql(f"(hi{i}{zero})", shown)
        if _atomic(dtype):
            aggregates.append(f"hll_sketch_estimate(hll_union_agg(if({mine}, sketch, null))) as d{i}")
            distinct = f"coalesce(d{i}, 0)"
        rows.append(
            f"named_struct('column_name', {literal(field.name)}, 'ordinal', {i + 1}, 'native_type', {literal(dtype.simpleString())}, "
            f"'null_ratio', cast((r{i} - n{i}) / nullif(r{i}, 0) as double), 'distinct_count', cast({distinct} as bigint), "
            f"'min_value', cast({low} as string), 'max_value', cast({high} as string), 'approximate', true)")
    return kept.selectExpr(*aggregates).selectExpr(f"inline(array({', '.join(rows)}))")


class FolderStatistics:
    """Keeps the rows of a dataset's folders below ``root``, a whole new version each time; a
    version counts once it is named in ``commits``, which is written last. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def latest(self) -> int:
        try:
            commits = self.spark.read.schema("version bigint").json(f"{self.root}/commits")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return 0
            raise
        return commits.agg(F.max("version")).first()[0] or 0

    def rows(self, version: int | None = None) -> DataFrame:
        version = self.latest() if version is None else version
        if not version:
            return self.spark.createDataFrame([], ROWS)
        return self.spark.read.schema(ROWS).parquet(f"{self.root}/rows/version={version}")

    def refresh(self, dataset: str, *, columns: Sequence[str] | None = None) -> Refreshed:
        """Reads the folders of a Parquet dataset that are new or changed, forgets those that are gone,
        and merges. A changed schema, or another choice of columns, reads everything again. Partition
        keys are text as written, so that a new folder does not change their type."""
        spark, version = self.spark, self.latest()
        with partitions_as_written(spark):
            schema = spark.read.parquet(dataset).schema
        if columns is not None:
            schema = T.StructType([schema[name] for name in columns])
        now = folder_states(spark, dataset).withColumn("state", F.sha2(F.concat_ws("|", "state", F.lit(schema.simpleString())), 256))
        before = self.rows(version)
        known = before.select("folder", F.col("state").alias("_old")).distinct()
        # Folders only, not files or rows: one for each day of a table by days.
        compared = now.join(known, "folder", "full").collect()
        stale = [r for r in compared if r["state"] is not None and r["state"] != r["_old"]]
        gone = sum(r["state"] is None for r in compared)
        kept = before
        if stale or gone:
            states = spark.createDataFrame(
                [(r["folder"], r["state"]) for r in compared if r["state"] is not None], "folder string, state string")
            kept = before.join(states, ["folder", "state"], "left_semi")
            if stale:
                with partitions_as_written(spark):
                    df = spark.read.option("basePath", dataset).parquet(*[r["path"] for r in stale])
                found = folder_statistics(df, schema.names).join(states, "folder")
                kept = kept.unionByName(found)
            target = f"{self.root}/rows/version={version + 1}"
            kept.select(*[F.col(c).cast(t) for c, t in (p.split() for p in ROWS.split(", "))]).write.mode("overwrite").parquet(target)
            spark.range(1).select(F.lit(version + 1).cast("bigint").alias("version")).write.mode("append").json(f"{self.root}/commits")
            kept = self.rows(version + 1)
        return Refreshed(merged(kept, schema), len(stale), len(compared) - len(stale) - gone, gone)
