"""Declared data checks and checks of the window results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions import epoch_seconds
from wayfare.functions.kinds import common_type
from wayfare.operators.joins import join_null_safe
from wayfare.operators.ranking import HOUR, RANK
from wayfare.operators.rolling import ROLLING, SECOND
from wayfare.schemas import RAW, ROLLING_SECONDS, TripColumns


@dataclass(frozen=True)
class Check:
    """``kind`` is ``unique``, ``not_null`` or ``relationships``; the last names the parent column."""

    model: str
    column: str
    kind: str
    parent: str | None = None
    parent_column: str | None = None


def unique(model: str, *columns: str) -> list[Check]:
    return [Check(model, c, "unique") for c in columns]


def not_null(model: str, *columns: str) -> list[Check]:
    return [Check(model, c, "not_null") for c in columns]


def relationship(model: str, column: str, parent: str, parent_column: str) -> list[Check]:
    return [Check(model, column, "relationships", parent, parent_column)]


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of NULLs of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with their number of rows; NULL is not a key."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter("n_rows > 1")


def _key(column: Column, kind: T.DataType) -> Column:
    """A value in a type as text: equal values give equal texts, different ones different texts."""
    value = column.cast(kind)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0).cast(kind)  # makes a negative zero a positive one
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)  # local time names two instants alike when clocks go back
    elif isinstance(kind, T.BinaryType):
        value = F.hex(value)
    return value.cast("string")


def _entry(number: int, there: Column, key: Column, side: str) -> Column:
    sides = [F.lit(int(side == name)).alias(name) for name in ("child", "parent")]
    return F.when(there, F.struct(F.lit(number).alias("number"), key.alias("key"), *sides))


def _entries(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> dict[str, list[Column]]:
    """Of each model, what one of its rows says to each check: its key as a child, or as a parent."""
    found: dict[str, list[Column]] = {}
    for number, check in enumerate(checks):
        child, entries = F.col(f"`{check.column}`"), found.setdefault(check.model, [])
        kind = models[check.model].schema[check.column].dataType
        if check.kind == "not_null":
            entries.append(_entry(number, child.isNull(), F.lit(""), "child"))
        elif check.kind == "unique":
            entries.append(_entry(number, child.isNotNull(), _key(child, kind), "child"))
        else:
            parent = F.col(f"`{check.parent_column}`")
            both = common_type([kind, models[check.parent].schema[check.parent_column].dataType])
            entries.append(_entry(number, child.isNotNull(), _key(child, both), "child"))
            of_parent = _entry(number, parent.isNotNull(), _key(parent, both), "parent")
            found.setdefault(check.parent, []).append(of_parent)
    return found


def run_checks(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """(model, column, check, failures) for each declared check, in their order.

    Failures are NULL rows, values that repeat, or rows without a parent; NULL keys count for ``not_null`` only. Keys of
    two types are compared in their common type. Every model is read once: a row becomes one (check, key) for each
    test that it takes part in, as a child or as a parent. These are counted by task before the one shuffle, so a hot
    key costs no more than any other, and all tests are settled from the counts. Models that are costly to compute should
    be written first and read back.
    """
    spark = next(iter(models.values())).sparkSession
    schema = "number int, key string, child int, parent int"
    parts = [spark.createDataFrame([(number, None, 0, 0) for number in range(len(checks))], schema)]  # checks without an entry
    for model, entries in _entries(models, checks).items():
        rows = models[model].select(F.explode(F.array(*entries)).alias("entry"))
        parts.append(rows.filter("entry is not null").select("entry.*"))
    counts = reduce(DataFrame.unionAll, parts).groupBy("number", "key").agg(F.sum("child").alias("rows"), F.sum("parent").alias("parents"))
    tests = {
        "not_null": F.sum("rows"),
        "unique": F.count_if(F.col("rows") > 1),
        "relationships": F.sum(F.when(F.col("parents") == 0, F.col("rows")).otherwise(0)),
    }
    settled = counts.groupBy("number").agg(*[value.alias(kind) for kind, value in tests.items()])
    names = F.array(*[F.struct(F.lit(c.model).alias("model"), F.lit(c.column).alias("column"), F.lit(c.kind).alias("check")) for c in checks])
    check = names[F.col("number")]
    failures = F.coalesce(*[F.when(check["check"] == kind, F.col(kind)) for kind in tests])
    return settled.orderBy("number").select(check["model"].alias("model"), check["column"].alias("column"), check["check"].alias("check"), failures.alias("failures"))


def rank_check(cleaned: DataFrame, ranked: DataFrame, cols: TripColumns = RAW) -> DataFrame:
    """For every (zone, hour) of either table: the rank-one fares against the maximum fare computed on its own."""
    keys = [cols.pickup_zone, HOUR]
    first = (
        ranked.filter(F.col(RANK) == 1)
        .groupBy(*keys)
        .agg(F.min(cols.fare).alias("lowest_first"), F.max(cols.fare).alias("highest_first"))
    )
    best = cleaned.groupBy(cols.pickup_zone, F.hour(cols.pickup).alias(HOUR)).agg(F.max(cols.fare).alias("max_fare"))
    agree = F.col("max_fare").eqNullSafe(F.col("lowest_first")) & F.col("max_fare").eqNullSafe(F.col("highest_first"))
    return join_null_safe(best, first, keys, "full_outer").withColumn("ok", agree)


def _anchors(seconds: DataFrame, zone: str, every: int) -> DataFrame:
    """The (zone, second) pairs whose second ``every`` divides, and the last one of each zone."""
    last = seconds.groupBy(zone).agg(F.max(SECOND).alias(SECOND))
    return seconds.filter(F.col(SECOND) % every == 0).select(zone, SECOND).unionByName(last)


def rolling_check(
    cleaned: DataFrame,
    rolling: DataFrame,
    cols: TripColumns = RAW,
    window: int = ROLLING_SECONDS,
    every: int = 997,
    bucket: int = 86_400,
) -> DataFrame:
    """``zone, anchor, window_count, recount, ok`` for sampled instants of every zone: the count that the rolling table
    claims against a recount of the trips in that window.

    The anchors are the seconds that ``every`` divides, in either table, and each zone's last one. Trips are counted by second
    and by bucket, a day; a window takes its whole buckets from the latter, and only the two that it cuts are looked at
    by the second. So an anchor meets a few rows of its zone, whatever the zone's size. An anchor that one table
    lacks, or that has two different claims, is not ok.
    """
    zone = cols.pickup_zone
    per_second = cleaned.groupBy(zone, epoch_seconds(cols.pickup).alias(SECOND)).agg(F.count(F.lit(1)).alias("n"))
    per_second = per_second.withColumn("__bucket", F.floor(F.col(SECOND) / bucket))
    per_bucket = per_second.groupBy(zone, "__bucket").agg(F.sum("n").alias("n"))
    claims = rolling.groupBy(zone, SECOND).agg(F.min(ROLLING).alias("window_count"), F.max(ROLLING).alias("__highest"))
    anchors = _anchors(per_second, zone, every).unionByName(_anchors(claims, zone, every)).distinct()

    first = F.col(SECOND) - window
    low, high = F.floor(first / bucket), F.floor(F.col(SECOND) / bucket)
    inner = F.when(high > low + 1, F.sequence(low + 1, high - 1)).otherwise(F.array().cast("array<bigint>"))
    whole = anchors.select(zone, SECOND, F.explode(inner).alias("__bucket"))
    cut = anchors.select(zone, F.col(SECOND).alias("__anchor"), F.explode(F.array_distinct(F.array(low, high))).alias("__bucket"))
    inside = (F.col(SECOND) >= F.col("__anchor") - window) & (F.col(SECOND) <= F.col("__anchor"))
    cut = join_null_safe(cut, per_second, [zone, "__bucket"]).filter(inside).select(zone, F.col("__anchor").alias(SECOND), "n")
    counted = join_null_safe(whole, per_bucket, [zone, "__bucket"]).select(zone, SECOND, "n").unionByName(cut)
    recount = counted.groupBy(zone, SECOND).agg(F.sum("n").alias("recount"))

    found = join_null_safe(join_null_safe(anchors, claims, [zone, SECOND], "left"), recount, [zone, SECOND], "left")
    agree = F.coalesce((F.col("window_count") == F.col("recount")) & (F.col("window_count") == F.col("__highest")), F.lit(False))
    return found.select(zone, F.col(SECOND).alias("anchor"), "window_count", "recount", agree.alias("ok"))
