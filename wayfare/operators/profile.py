"""Partition balance and schema of a table."""

from __future__ import annotations

import contextlib
import io
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType


def partition_rows(df: DataFrame) -> DataFrame:
    """Rows in each partition of ``df``, with 0 for empty partitions.

    A scan is counted without reading a column, as its partitions follow from the files. A shuffle into a given number of
    partitions carries only the columns that place the rows. Behind an adaptive shuffle, whose partitions are sized by
    their bytes, all columns stay in the plan: one looks whether a value is NULL, or hashes a column that can't be. The
    partitions behind a shuffle are those that the run itself made, up to the last one with rows.
    """
    changing = adaptive(df)
    touched = _touched(df) if changing and not placed(df) else []
    counts = df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("n"), *touched)
    if touched:
        counts = counts.filter(reduce(or_, [F.col("n") > 0, *[F.col(c) for c in counts.columns if c.startswith("touched")]]))
    counts = counts.select("partition_id", "n")
    if changing:
        every = counts.agg(F.explode(F.sequence(F.lit(0), F.max("partition_id"))).alias("partition_id"))
    else:
        every = df.sparkSession.range(df.rdd.getNumPartitions()).select(F.col("id").cast("int").alias("partition_id"))
    return every.join(counts, "partition_id", "left").select("partition_id", F.coalesce("n", F.lit(0)).alias("rows"))


def _touched(df: DataFrame) -> list[Column]:
    """Aggregates that need every column of ``df``."""
    fields = [f for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    nulls = [F.bool_or(F.col(f"`{f.name}`").isNull()) for f in fields if f.nullable]
    fixed = [F.col(f"`{f.name}`") for f in fields if not f.nullable]
    hashed = [F.bool_or(F.xxhash64(*fixed) == 0)] if fixed else []
    return [c.alias(f"touched_{i}") for i, c in enumerate(nulls + hashed)]


def _physical_plan(df: DataFrame) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as text:
        df.explain("simple")
    return text.getvalue()


def adaptive(df: DataFrame) -> bool:
    """Whether the plan of ``df`` is adapted while it runs, so that its partitions are not known beforehand."""
    return "AdaptiveSparkPlan" in _physical_plan(df)


# Lines of a plan that neither drop nor multiply rows.
_KEEPS_ROWS = re.compile(r"[ +-]*(== |(\*\(\d+\) ?)?(AdaptiveSparkPlan|ResultQueryStage|ShuffleQueryStage|Project|Coalesce)\b|$)")


def placed(df: DataFrame) -> bool:
    """Whether the rows of ``df`` come from one shuffle into a number of partitions that was asked for.

    Adaptive execution leaves such a shuffle as it is, whatever the sizes of its partitions. Rows dealt out in turn are
    sorted by all their columns before, and come from partitions that an earlier shuffle may have sized by their bytes. So
    their number in a partition is only known if there is no such shuffle, and nothing afterwards drops or multiplies rows.
    """
    lines = _physical_plan(df).partition("== Initial Plan ==")[0].splitlines()
    for i, line in enumerate(lines):
        if ":-" in line[: len(line) - len(line.lstrip(" :+-"))]:  # several inputs meet above the shuffle
            return False
        if line.lstrip(" +-").startswith("Exchange "):
            in_turn = "Exchange RoundRobinPartitioning" in line
            if in_turn and (any("Exchange" in x for x in lines[i + 1 :]) or not all(map(_KEEPS_ROWS.match, lines[:i]))):
                return False
            return re.search(r", REPARTITION_BY_NUM, \[plan_id=\d+\]$", line) is not None
    return False


BALANCE = (
    "total_rows", "partitions", "populated_partitions", "empty_partitions",
    "min_rows", "max_rows", "avg_rows", "avg_rows_populated", "skew_ratio",
)


def partition_skew(df: DataFrame) -> DataFrame:
    """One row: partitions, empty ones, smallest, largest and mean size, and largest by mean."""
    populated = F.when(F.col("rows") > 0, F.col("rows"))
    balance = partition_rows(df).agg(
        F.sum("rows").alias("total_rows"),
        F.count(F.lit(1)).alias("partitions"),
        F.count(populated).alias("populated_partitions"),
        F.count_if(F.col("rows") == 0).alias("empty_partitions"),
        F.min("rows").alias("min_rows"),
        F.max("rows").alias("max_rows"),
        F.avg("rows").alias("avg_rows"),
        F.avg(populated).alias("avg_rows_populated"),
        (F.max("rows") / F.nullif(F.avg("rows"), F.lit(0))).alias("skew_ratio"),
    )
    return balance.select(*BALANCE)


def schema_rows(df: DataFrame) -> DataFrame:
    """The columns of ``df``: position, name, type and whether NULL is allowed."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")
