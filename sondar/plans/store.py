"""An inventory kept as versioned Parquet.

Each commit writes whole new ``containers`` and ``columns`` and that run's
``changes`` and ``scan_runs`` under its version; the version counts only once
its row is in ``commits``, which is written last. A run that dies leaves the
previous version as it was. One writer at a time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondar.model import CHANGES, COLUMNS, CONTAINERS, SCAN_RUNS, ddl
from sondar.operators.drift import with_ids

_COMMITS = "version bigint, committed_at timestamp"
_STATE = {"containers": CONTAINERS, "columns": COLUMNS}
_CLUSTERED = {
    "containers": ["container_name", "database", "schema_name"],
    "columns": ["container_name", "database", "schema_name", "ordinal"],
}
_LOGS = {"changes": CHANGES, "scan_runs": SCAN_RUNS}


class CatalogStore:
    """Reads and commits versions below ``root``, a folder all executors share."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/version={version}"

    def latest(self) -> int:
        """The last committed version, 0 before the first."""
        try:
            commits = self.spark.read.schema(_COMMITS).json(f"{self.root}/commits")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return 0
            raise
        return commits.agg(F.max("version")).first()[0] or 0

    def state(self, name: str, version: int | None = None) -> DataFrame:
        """``containers`` or ``columns`` as of a version, the latest by default."""
        version = self.latest() if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], ddl(_STATE[name]))
        return self.spark.read.schema(ddl(_STATE[name])).parquet(self.path(name, version))

    def log(self, name: str) -> DataFrame:
        """``changes`` or ``scan_runs`` of every committed version."""
        version = self.latest()
        if version == 0:
            return self.spark.createDataFrame([], ddl(_LOGS[name]))
        schema = ddl({**_LOGS[name], "version": "bigint"})
        return (
            self.spark.read.schema(schema)
            .parquet(f"{self.root}/{name}")
            .where(F.col("version") <= version)
            .drop("version")
        )

    def commit(
        self,
        *,
        containers: DataFrame | None = None,
        columns: DataFrame | None = None,
        changes: DataFrame | None = None,
        scan_runs: DataFrame | None = None,
    ) -> int:
        """Write the next version; a part left out is carried over (state) or
        empty (logs). Returns the version."""
        current = self.latest()
        version = current + 1
        given = {"containers": containers, "columns": columns}
        for name, schema in _STATE.items():
            frame = given[name]
            frame = self.state(name, current) if frame is None else frame
            # Pages go by these keys: what lies before a cursor is skipped by the files' statistics.
            order = _CLUSTERED[name]
            frame.select(*schema).repartitionByRange(*order).sortWithinPartitions(*order).write.mode(
                "overwrite"
            ).parquet(self.path(name, version))
        if changes is not None:
            last = self.log("changes").agg(F.max("id")).first()[0] or 0
            with_ids(changes, last).write.mode("overwrite").parquet(
                self.path("changes", version)
            )
        else:
            self._write_empty("changes", version)
        if scan_runs is not None:
            scan_runs.select(*SCAN_RUNS).write.mode("overwrite").parquet(
                self.path("scan_runs", version)
            )
        else:
            self._write_empty("scan_runs", version)
        (
            self.spark.range(1)
            .select(
                F.lit(version).cast("bigint").alias("version"),
                F.current_timestamp().alias("committed_at"),
            )
            .write.mode("append")
            .json(f"{self.root}/commits")
        )
        return version

    def _write_empty(self, name: str, version: int) -> None:
        self.spark.createDataFrame([], ddl(_LOGS[name])).write.mode("overwrite").parquet(
            self.path(name, version)
        )
