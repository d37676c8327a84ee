"""Results of checks and measurements as rows (check, metric, value)."""

from __future__ import annotations

import contextlib
import io
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT = "check string, metric string, value string"


def from_values(spark: SparkSession, check: str, values: Mapping[str, object]) -> DataFrame:
    return spark.createDataFrame([(check, k, None if v is None else str(v)) for k, v in values.items()], REPORT)


def from_row(df: DataFrame, check: str) -> DataFrame:
    """Turn a one-row frame into one report row per column."""
    text = df.select(*[(_digits(c) if kind in ("double", "float") else F.col(c).cast("string")).alias(c) for c, kind in df.dtypes])
    return text.unpivot([], text.columns, "metric", "value").select(F.lit(check).alias("check"), "metric", "value")


def _digits(name: str) -> Column:
    """A floating-point number as text, without an exponent from 0.0001 up to 10^16, where SQL engines write plain digits."""
    text = F.col(name).cast("string")
    plain = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(text.contains("E") & (F.abs(name) >= 1e-4) & (F.abs(name) < 1e16), plain).otherwise(text)


def from_pairs(df: DataFrame, check: str) -> DataFrame:
    """One report row for each row of a frame of two columns: the metric's name and its value."""
    name, value = df.columns
    return df.select(F.lit(check).alias("check"), F.col(name).cast("string").alias("metric"), F.col(value).cast("string").alias("value"))


def from_schema(schema: DataFrame, check: str) -> DataFrame:
    null = F.when(F.col("nullable"), " null").otherwise(" not null")
    return schema.select(
        F.lit(check).alias("check"), F.col("column").alias("metric"), F.concat("type", null).alias("value")
    )


def combine(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def write_report(report: DataFrame, path: str, title: str) -> DataFrame:
    """Save a report as JSON lines with its title and the time it was captured, and return it as saved."""
    stamped = report.select(F.lit(title).alias("title"), F.current_timestamp().alias("captured_at"), "*")
    stamped.coalesce(1).write.mode("overwrite").json(path)
    return report.sparkSession.read.schema(stamped.schema).json(path)


def sample_text(df: DataFrame, rows: int = 20, truncate: int = 60) -> str:
    """The first rows as a text table."""
    with contextlib.redirect_stdout(io.StringIO()) as text:
        df.show(rows, truncate)
    return text.getvalue()


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The output of EXPLAIN."""
    with contextlib.redirect_stdout(io.StringIO()) as text:
        df.explain(mode)
    return text.getvalue()


def plan_operators(plans: Mapping[str, DataFrame], operators: Sequence[str], spark: SparkSession) -> DataFrame:
    """For each named frame, whether its plan has each of the operators, without executing it."""
    texts = {name: plan_text(df) for name, df in plans.items()}
    parts = [from_values(spark, name, {o: str(o in text).lower() for o in operators}) for name, text in texts.items()]
    return combine(parts)


def assert_plan_contains(df: DataFrame, *operators: str) -> None:
    plan = plan_text(df)
    absent = [name for name in operators if name not in plan]
    if absent:
        raise AssertionError(f"not in the plan: {', '.join(absent)}\n{plan}")
