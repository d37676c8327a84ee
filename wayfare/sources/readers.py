"""File scans and schema conformance."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.schemas import TRIPS, ZONES
from wayfare.sources.drift import missing_path, read_drifting

# Fixed value: name pattern of the public monthly trip files.
TRIP_FILES = "yellow_tripdata_*.parquet"


def read_trips(
    spark: SparkSession,
    folder: str,
    pattern: str = TRIP_FILES,
    schema: T.StructType | None = None,
    lineage: str | None = None,
) -> DataFrame:
    """All trip files of ``folder`` as one table, also where the types of a column differ from file to file.

    The pattern is expanded by the file system that holds the folder, so the folder may be remote. Without a schema a column
    has the common type of its types in the files, with one the declared type; ``drift_changes`` counts the values
    that this changes. ``lineage`` names a column for the path of each row's file.
    """
    try:
        return read_drifting(spark, f"{folder.rstrip('/')}/{pattern}", schema, lineage)
    except AnalysisException as error:
        if not missing_path(error):
            raise
        raise FileNotFoundError(f"no files match {pattern} in {folder}") from error


def read_zones(spark: SparkSession, path: str, schema: T.StructType = ZONES) -> DataFrame:
    """Zone lookup file with a header line. The declared schema saves a pass over the data."""
    return spark.read.csv(path, header=True, schema=schema)


def does_not_fit(value: Column, kind: T.DataType | str) -> Column:
    """Whether a value is there but has no counterpart in a type."""
    return value.isNotNull() & value.try_cast(kind).isNull()


def strict_cast(value: Column, kind: T.DataType | str, name: str) -> Column:
    """The value in a type; one that does not fit stops the job, whatever the session's ANSI mode."""
    message = F.concat(F.lit(f"{name} does not fit {getattr(kind, 'simpleString', lambda: kind)()}: "), value.cast("string"))
    return F.coalesce(value.try_cast(kind), F.when(value.isNotNull(), F.raise_error(message).cast(kind)))


def _declared(df: DataFrame, schema: T.StructType) -> list[tuple[T.StructField, str | None]]:
    present = {c.lower(): c for c in df.columns}
    return [(field, present.get(field.name.lower())) for field in schema.fields]


def conform(df: DataFrame, schema: T.StructType = TRIPS, unreadable: str = "null") -> DataFrame:
    """Project to the declared columns in declared order; absent ones become NULL, others are dropped.

    A value that its declared type can't hold becomes NULL (``unreadable="null"``; ``unreadable_counts`` tells how many)
    or stops the job (``"error"``).
    """
    if unreadable not in ("null", "error"):
        raise ValueError(f"unreadable must be null or error, not {unreadable!r}")
    columns = []
    for field, source in _declared(df, schema):
        if source is None:
            value = F.lit(None).cast(field.dataType)
        elif unreadable == "error" and df.schema[source].dataType != field.dataType:
            value = strict_cast(F.col(f"`{source}`"), field.dataType, field.name)
        else:
            value = F.col(f"`{source}`").try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def unreadable_counts(df: DataFrame, schema: T.StructType = TRIPS) -> DataFrame:
    """``column, unreadable``: how many values of each declared column of ``df`` its declared type can't hold."""
    counts = [
        F.count_if(does_not_fit(F.col(f"`{source}`"), field.dataType)).alias(field.name)
        for field, source in _declared(df, schema)
        if source is not None
    ]
    if not counts:
        return df.sparkSession.createDataFrame([], "column string, unreadable bigint")
    row = df.agg(*counts)
    return row.unpivot([], row.columns, "column", "unreadable")
