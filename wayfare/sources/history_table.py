"""Dimension history as a partitioned Parquet table.

Open rows are one partition, closed rows are filed by the instant that closed them. A merge reads and replaces the open
partition and adds the partition of its own instant; all other closed rows are neither read nor written, however
long the history grows. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators.history import FROM, TO, merge_history, start_history
from wayfare.session import folder_exists, work_folder

PERIOD, OPEN = "period", "open"


class HistoryTable:
    def __init__(self, spark: SparkSession, folder: str, key: str, checked: Sequence[str]):
        self.spark, self.folder, self.key, self.checked = spark, folder.rstrip("/"), key, list(checked)

    def exists(self) -> bool:
        return folder_exists(self.spark, f"{self.folder}/{PERIOD}={OPEN}")

    def _rows(self) -> DataFrame:
        return self.spark.read.parquet(self.folder).withColumn(PERIOD, F.col(PERIOD).cast("string"))

    def read(self) -> DataFrame:
        """All versions, open and closed."""
        return self._rows().drop(PERIOD)

    def current(self) -> DataFrame:
        """The open versions; no file of closed ones is read."""
        return self._rows().filter(F.col(PERIOD) == OPEN).drop(PERIOD)

    def _write(self, rows: DataFrame, period: str) -> None:
        filed = rows.withColumn(PERIOD, F.lit(period)).hint("rebalance")
        writer = filed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(PERIOD).parquet(self.folder)

    def merge(self, source: DataFrame, as_of: datetime) -> None:
        """Bring the history up to the state of ``source`` at ``as_of``; the first merge starts it.

        The rules are those of ``merge_history``. Closed versions are written before the open ones, under the instant's own
        name, so a merge that was cut off, or is run again at the same instant, gives the same history. An instant
        before that of an open version is an error.
        """
        if not self.exists():
            self._write(start_history(source, as_of), OPEN)
            return
        latest = self.current().agg(F.unix_micros(F.max(FROM))).first()[0]
        moment = as_of if as_of.tzinfo else as_of.astimezone()
        micros = round((moment - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds() * 1_000_000)
        if latest is not None and latest > micros:
            raise ValueError(f"a version is open since after {as_of}")
        path = work_folder(self.spark, "history")
        merged = merge_history(self.current(), source, self.key, self.checked, as_of)
        merged.write.parquet(path)
        merged = self.spark.read.schema(merged.schema).parquet(path)
        period = f"closed-{micros}"
        closed = merged.filter(F.col(TO).isNotNull())
        if not closed.isEmpty():
            if folder_exists(self.spark, f"{self.folder}/{PERIOD}={period}"):  # an earlier merge at this instant
                before = self._rows().filter(F.col(PERIOD) == period).drop(PERIOD)
                both = work_folder(self.spark, "closed")
                closed.unionByName(before).dropDuplicates([self.key, FROM]).write.parquet(both)
                closed = self.spark.read.schema(closed.schema).parquet(both)
            self._write(closed, period)
        self._write(merged.filter(F.col(TO).isNull()), OPEN)
