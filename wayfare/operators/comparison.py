"""Row-level comparison of two tables, duplicates counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Names that both tables have, sorted."""
    return sorted(set(left.columns) & set(right.columns))


def missing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` without a counterpart in ``right``, as often as they are missing, over the common columns."""
    columns = common_columns(left, right)
    return left.select(*columns).exceptAll(right.select(*columns))


def _paired_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """How often each row occurs on either side, from one pass over each."""
    columns = common_columns(left, right)
    sides = left.select(*columns, F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionAll(
        right.select(*columns, F.lit(0).alias("__l"), F.lit(1).alias("__r"))
    )
    return sides.groupBy(*columns).agg(F.sum("__l").alias("left_rows"), F.sum("__r").alias("right_rows"))


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that do not occur equally often on both sides, with their counts."""
    return _paired_counts(left, right).filter("left_rows <> right_rows")


def compare_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: row counts, rows missing on either side, and whether both sides are identical."""
    totals = {
        "left_rows": F.col("left_rows"),
        "right_rows": F.col("right_rows"),
        "left_only": F.greatest(F.col("left_rows") - F.col("right_rows"), F.lit(0)),
        "right_only": F.greatest(F.col("right_rows") - F.col("left_rows"), F.lit(0)),
    }
    summary = _paired_counts(left, right).agg(
        *[F.coalesce(F.sum(value), F.lit(0)).alias(name) for name, value in totals.items()]
    )
    return summary.withColumn("identical", (F.col("left_only") == 0) & (F.col("right_only") == 0))
