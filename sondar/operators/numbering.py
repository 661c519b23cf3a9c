"""Consecutive numbers over rows that no single task has to see together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondar.session import keep, scratch_dir


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The frame with a column that counts 1, 2, ... in the given order.

    Rows are sorted by range and numbered within their part; a part's numbers begin after
    those of the parts before. The parts are written once, since a second sort might
    draw other borders; the driver gets the size of each.
    """
    spark = df.sparkSession
    # The lower 33 bits of the id are the row's place in its part.
    parted = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(
        {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
    )
    kept = keep(parted, scratch_dir(spark, "numbered"))
    sizes = sorted(tuple(row) for row in kept.groupBy("_part").agg(F.count(F.lit(1))).collect())
    before, starts = 0, []
    for part, size in sizes:
        starts += [F.lit(part), F.lit(before)]
        before += size
    start = F.element_at(F.create_map(*starts), F.col("_part")) if starts else F.lit(0)
    return kept.withColumn(name, (F.col("_at") + start + 1).cast("int")).drop("_part", "_at")
