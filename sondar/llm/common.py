"""Helpers shared by the operators: staged tables, text slices, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sondar.session import scratch_dir

# Removes the shuffle files of a query once it has ended; no later query reads
# them, because what is used again is written to the shared folder.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_released(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, None)
    if before is None:
        yield
        return
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back: computed once,
    its lineage cut, and safe from the loss of an executor."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    with _shuffles_released(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str, chars: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows with about ``chars`` bytes of a column, so
    that Python objects are made for a small part of a batch at a time."""
    values = batch.column(column)
    start = size = 0
    for i in range(len(values)):
        size += len(values[i].as_buffer()) if values[i].is_valid else 0
        if size >= chars:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < len(values):
        yield batch.slice(start)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node each node of ``edges`` (u, v) can reach.

    Alternates large-star and small-star steps, each one minimum per node and
    one join; a round's edges go to the shared folder.  The number of edges
    never grows, so a hot node costs what its edges cost.  Rows with a null and
    loops are ignored.
    """
    now = staged(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    seen = None
    for _ in range(rounds):
        state = now.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))
        ).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        ).distinct()
        large = staged(large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")),
            F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")),
        )).alias("e")).select("e.*").where("u <> v")
        now = staged(small.distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )


PIVOTS_PER_PART = 16


def boundaries(rows: DataFrame, column: str, parts: int, count: int) -> list[int]:
    """Values of a long column at which range parts begin, from rows picked by a hash
    of the value: the same rows give the same boundaries, whatever their order.
    At most ``4 * PIVOTS_PER_PART`` values a part reach the driver."""
    if parts < 2:
        return []
    wanted = parts * PIVOTS_PER_PART
    every = max(1, count // wanted)
    picked = rows.where(F.pmod(F.xxhash64(column), F.lit(every)) == 0).select(column).distinct()
    found = sorted(r[0] for r in picked.orderBy(F.xxhash64(column)).limit(4 * wanted).collect())
    return sorted({found[i * len(found) // parts] for i in range(1, parts)}) if found else []
