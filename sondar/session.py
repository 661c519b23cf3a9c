"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


#: Used where ``spark.checkpoint.dir`` is unset, such as in a session that is already running.
SCRATCH = "sondar.scratch.dir"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach, below the shared folder that the
    session names in ``spark.checkpoint.dir``, or else in ``sondar.scratch.dir``."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get(SCRATCH, None)
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{shared.rstrip('/')}/sondar/{label}-{uuid.uuid4().hex}"


def keep(df: DataFrame, path: str) -> DataFrame:
    """The frame written to ``path`` and read back.

    What several results build on is then computed once and survives a lost
    executor; ``path`` has to be on storage all executors share.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
