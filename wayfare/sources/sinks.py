"""Plain sinks, and table and namespace commands."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wayfare.schemas import SINK_BATCH_ROWS
from wayfare.session import remove_folder, scoped_conf, work_folder


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_coalesced(df: DataFrame, path: str, files: int = 2) -> None:
    """Write at most ``files`` files.

    ``df`` is written in its own partitions first, and only these files are read and written by that many tasks.
    ``coalesce`` alone would run the last stage of ``df``, such as a final aggregation, on those few tasks, and a shuffle
    would carry rows that are larger than their files. Large tables are laid out by ``VersionedTable.write(cluster_by=...)``.
    """
    spark, staged = df.sparkSession, work_folder(df.sparkSession, "staged")
    df.write.option("compression", "zstd").parquet(staged)
    try:
        with scoped_conf(spark, **{"spark.sql.files.minPartitionNum": max(files, spark.sparkContext.defaultParallelism)}):
            spark.read.schema(df.schema).parquet(staged).coalesce(files).write.mode("overwrite").parquet(path)
    finally:
        remove_folder(spark, staged)


def list_files(df: DataFrame) -> DataFrame:
    """Data files behind a file scan: path, rows and size. Reads file footers only, no data columns."""
    return (
        df.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("bytes"))
        .groupBy("file_path", "bytes")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .select("file_path", "record_count", F.col("bytes").alias("file_size_in_bytes"))
    )


def run_fully(df: DataFrame) -> float:
    """Execute ``df`` without keeping its rows and return the seconds it took."""
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def run_counted(df: DataFrame) -> tuple[float, int]:
    """As ``run_fully``, with the number of rows that came out. They are counted on their way, not by a second job."""
    seen = Observation()
    seconds = run_fully(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seconds, seen.get["rows"]


def write_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace a catalog table. ``path`` places its files outside the catalog's own folder."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    batch_rows: int = SINK_BATCH_ROWS,
    connections: int = 8,
) -> None:
    """Replace a table of a relational database; at most ``connections`` tasks write at the same time."""
    df.write.jdbc(
        url,
        table,
        mode="overwrite",
        properties={**(properties or {}), "batchsize": str(batch_rows), "numPartitions": str(connections)},
    )


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    if location is None:
        spark.sql(f"create namespace if not exists {name}")
    else:
        spark.sql(f"create namespace if not exists {name} location :location", args={"location": location})


def drop_namespace(spark: SparkSession, name: str) -> None:
    """Drop a namespace with all that is in it."""
    spark.sql(f"drop namespace if exists {name} cascade")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"drop table if exists {name}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
