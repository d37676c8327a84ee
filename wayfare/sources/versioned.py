"""A Parquet table that keeps its earlier contents.

Layout below the table folder::

    data/snapshot_id=<id>/*.parquet    rows of one version
    log/*.parquet                      a row for each version

A write puts the data down first, counts it again from the files and only then adds the log row, so a failed write
leaves no visible version. Readers find the current version in the log. One writer at a time: two that write at once
both succeed, and the log does not tell which of them saw the other.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wayfare.schemas import TARGET_FILE_BYTES
from wayfare.session import folder_exists, remove_folder, scoped_conf
from wayfare.sources.sinks import list_files

LOG = "sequence bigint, snapshot_id bigint, parent_id bigint, committed_at timestamp, operation string, record_count bigint"


class VersionedTable:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _log(self) -> DataFrame:
        if not folder_exists(self.spark, f"{self.folder}/log"):
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).parquet(f"{self.folder}/log")

    def _current(self):
        return self._log().orderBy(F.desc("sequence")).first()

    def _data_path(self, snapshot_id: int) -> str:
        return f"{self.folder}/data/snapshot_id={snapshot_id}"

    def exists(self) -> bool:
        return self._current() is not None

    def write(
        self,
        df: DataFrame,
        cluster_by: list[str] | None = None,
        committed_at: datetime | None = None,
        target_bytes: int = TARGET_FILE_BYTES,
    ) -> int:
        """Create the table or replace its rows, keeping the earlier version, and return the new snapshot id.

        Without ``cluster_by`` the rows are written as they are partitioned, with no further shuffle. With it, rows are
        gathered by those columns into files of about ``target_bytes``; AQE splits a column value that holds more than that
        over several files.
        """
        previous = self._current()
        snapshot_id = uuid.uuid4().int >> 65
        path = self._data_path(snapshot_id)
        written = Observation()
        rows = df.hint("rebalance", *cluster_by) if cluster_by else df
        sized = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": target_bytes} if cluster_by else {}
        with scoped_conf(self.spark, **sized):
            rows.observe(written, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").parquet(path)
        expected, found = written.get["n"], self.spark.read.schema(df.schema).parquet(path).count()
        if expected != found:
            remove_folder(self.spark, path)
            raise RuntimeError(f"{path}: wrote {expected} rows but read {found}")
        entry = (
            previous.sequence + 1 if previous else 1,
            snapshot_id,
            previous.snapshot_id if previous else None,
            committed_at or datetime.now(timezone.utc),
            "overwrite" if previous else "append",
            found,
        )
        self.spark.createDataFrame([entry], LOG).coalesce(1).write.mode("append").parquet(f"{self.folder}/log")
        return snapshot_id

    def read(self, snapshot_id: int | None = None) -> DataFrame:
        """Rows of the current version, or of an earlier one."""
        if snapshot_id is None:
            current = self._current()
            if current is None:
                raise FileNotFoundError(f"no committed version in {self.folder}")
            snapshot_id = current.snapshot_id
        return self.spark.read.parquet(self._data_path(snapshot_id))

    def snapshots(self) -> DataFrame:
        """The commits in their order, with the rows that each one has."""
        return self._log().orderBy("sequence").select("committed_at", "snapshot_id", "parent_id", "operation", "record_count")

    def files(self, snapshot_id: int | None = None) -> DataFrame:
        return list_files(self.read(snapshot_id))
