"""Relations made by Spark itself: constants and date series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def constant_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def date_series(bounds: DataFrame, first: Column | str, last: Column | str, name: str = "date_day") -> DataFrame:
    """One row per day from ``first`` to ``last`` of the one-row frame ``bounds``."""
    first, last = (F.to_date(F.col(c) if isinstance(c, str) else c) for c in (first, last))
    return bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias(name))
