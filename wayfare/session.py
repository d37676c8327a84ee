"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# AQE splits skewed join partitions and sizes shuffles at run time. Forcing the skew rule keeps it active when a
# grouping above the join could have reused the join's partitioning. The hash-join limit lets AQE skip the sort of a
# merge join once it has seen that every partition of one side is small. A table whose size is only known at run time is
# broadcast up to the adaptive limit; the limit for sizes known beforehand is Spark's own.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


def build(app_name: str = "wayfare", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextlib.contextmanager
def scoped_conf(spark: SparkSession, **settings: object) -> Iterator[None]:
    """Set session options (``__`` stands for a dot) and put the former values back, also after an error."""
    settings = {key.replace("__", "."): str(value) for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextlib.contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` in memory and on local disk inside the block. For inputs that several short queries share."""
    df.persist()
    try:
        yield df
    finally:
        df.unpersist()


@functools.lru_cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="wayfare-")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new path under the shared folder that the session names in ``spark.checkpoint.dir``.

    All work folders of an application are removed when its driver ends; ``remove_folder`` does so earlier.
    Only a local session may do without that setting; it then gets a temporary folder of this machine.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = _local_folder(context.applicationId)
    folder = f"{base.rstrip('/')}/wayfare/{context.applicationId}"
    _clear_at_exit(spark, folder)
    return f"{folder}/{purpose}-{uuid.uuid4().hex}"


@functools.lru_cache
def _clear_at_exit(spark: SparkSession, folder: str) -> None:
    def clear() -> None:
        with contextlib.suppress(Exception):  # the session may be over already
            remove_folder(spark, folder)

    atexit.register(clear)


def _file_system(spark: SparkSession, folder: str):
    """The folder as a path, and the file system that holds it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path, files = _file_system(spark, folder)
    return files.exists(path)


def remove_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder through the file system that holds it; False if there was none."""
    path, files = _file_system(spark, folder)
    return files.delete(path, True)
