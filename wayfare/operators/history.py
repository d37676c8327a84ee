"""Dimension history (slowly changing dimension, type 2)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FROM, TO = "valid_from", "valid_to"


def update_rows(df: DataFrame, condition: Column, **values: object) -> DataFrame:
    """Set the given columns in the rows that satisfy ``condition``; where it is NULL the row stays as it is."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {
            name: F.when(condition, (value if isinstance(value, Column) else F.lit(value)).cast(types[name])).otherwise(
                F.col(name)
            )
            for name, value in values.items()
        }
    )


def find_row(df: DataFrame, key: str, value: object):
    """The row with that key; an error when there is none."""
    row = df.filter(F.col(key) == F.lit(value)).first()
    if row is None:
        raise LookupError(f"no row with {key} = {value!r}")
    return row


def start_history(source: DataFrame, as_of: datetime) -> DataFrame:
    """First version: every row of the source, open since ``as_of``."""
    return source.select("*", F.lit(as_of).cast("timestamp").alias(FROM), F.lit(None).cast("timestamp").alias(TO))


def merge_history(
    history: DataFrame, source: DataFrame, key: str, checked: Sequence[str], as_of: datetime
) -> DataFrame:
    """The history after comparing its open rows with ``source`` at time ``as_of``.

    New keys are added. Where a checked column differs (NULL counts as a value) the open row is closed and a new one
    opened at the same instant; a row that was opened at that very instant is replaced, as it never held. Unchanged keys, and
    keys that the source lacks, stay open. Keys are unique in ``source`` and among the open rows. The result must not be
    written over the files that ``history`` is read from. ``HistoryTable`` merges without passing the closed rows.
    """
    attributes = [c for c in history.columns if c not in (key, FROM, TO)]
    now, no_end = F.lit(as_of).cast("timestamp"), F.lit(None).cast("timestamp")
    # closed rows carry another flag than any source row, so they pass the join unmatched, spread by their keys
    old = history.select(F.struct(key, *attributes, FROM, TO).alias("old"), F.col(key).alias("k"), F.col(TO).isNull().alias("open"))
    new = source.select(F.struct(key, *attributes).alias("new"), F.col(key).alias("k"), F.lit(True).alias("open"))
    differs = reduce(lambda a, b: a | b, (~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in checked))

    def version(side: str, start: Column, end: Column) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in (key, *attributes)], start.alias(FROM), end.alias(TO))

    opened = version("new", now, no_end)
    kept = version("old", F.col(f"old.{FROM}"), F.col(f"old.{TO}"))
    closed = version("old", F.col(f"old.{FROM}"), now)
    versions = (
        F.when(F.col("old").isNull(), F.array(opened))
        .when(F.col("new").isNull() | ~differs, F.array(kept))
        .when(F.col(f"old.{FROM}") == now, F.array(opened))
        .otherwise(F.array(closed, opened))
    )
    joined = old.join(new, ["k", "open"], "full_outer")
    return joined.select(F.explode(versions).alias("v")).select("v.*").select(*history.columns)


def versions_of(history: DataFrame, key: str, value: object) -> DataFrame:
    """All versions of one key, oldest first."""
    return history.filter(F.col(key) == F.lit(value)).orderBy(FROM)


def changed_keys(history: DataFrame, key: str) -> DataFrame:
    """Keys with more than one version, and how many they have."""
    return history.groupBy(key).agg(F.count(F.lit(1)).alias("versions")).filter("versions > 1")


def history_violations(history: DataFrame, key: str) -> DataFrame:
    """Number of keys that break each rule of a well-formed history.

    Every key has exactly one open version, versions end after they start, and each one ends where the next starts.
    A key's versions are few: at most one per merge.
    """
    following = F.lead(FROM).over(Window.partitionBy(key).orderBy(FROM))
    steps = history.withColumn("__next", following)
    per_key = steps.groupBy(key).agg(
        F.count_if(F.col(TO).isNull()).alias("open"),
        F.count_if(F.col(TO) <= F.col(FROM)).alias("reversed"),
        F.count_if(F.col("__next").isNotNull() & ~F.col(TO).eqNullSafe(F.col("__next"))).alias("broken"),
    )
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("open") != 1).alias("not_one_open"),
        F.count_if(F.col("reversed") > 0).alias("reversed_interval"),
        F.count_if(F.col("broken") > 0).alias("gap_or_overlap"),
    )
