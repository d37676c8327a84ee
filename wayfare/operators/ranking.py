"""Dense ranks and top groups.

``dense_rank`` over a plain window sends every row of a group to one task. Here the rows are first reduced to the
distinct values of each group. Those are ranked in value ranges cut at the group's quantiles, each opened by a row with
the number of higher values, and the ranks are joined back. No task sees a whole group, and the join key is the group with the value, so a
hot group is spread out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.operators.joins import join_null_safe
from wayfare.schemas import RAW, TripColumns

HOUR = "pickup_hour"
RANK = "fare_rank"


PIECES = 256
PIECE_VALUES = 10_000


def _pieces(distinct: DataFrame, keys: list[str], value: str, pieces: int, piece_values: int) -> DataFrame:
    """Add the number of each value's piece, 0 for the highest values; NULL has a piece of its own.

    Groups of more than ``piece_values`` values are cut at their own quantiles, so that pieces are of about the same size
    however the values are spread. The limits of a group are found from a sketch of fixed size.
    """
    number = F.col(value).cast("double")
    counts = distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > piece_values).drop("__n")
    shares = [i / pieces for i in range(1, pieces)]
    large = join_null_safe(distinct.filter(~F.isnan(number)), counts, keys)
    limits = large.groupBy(*keys).agg(F.percentile_approx(number, shares).alias("__limits"))
    at = F.coalesce(F.size(F.filter("__limits", lambda limit: limit >= number)), F.lit(0))
    piece = F.when(F.col(value).isNull(), F.lit(pieces)).otherwise(at)
    return join_null_safe(distinct, limits, keys, "left").withColumn("__piece", piece).drop("__limits")


def value_ranks(
    df: DataFrame, keys: Sequence[str], value: str, rank: str = RANK, pieces: int = PIECES, piece_values: int = PIECE_VALUES
) -> DataFrame:
    """Dense rank, highest value first, of each distinct (keys, value); NULL values come last.

    ``pieces`` and ``piece_values`` affect the size of the pieces that are ranked alone, not the result.
    """
    keys = list(keys)
    distinct = _pieces(df.select(*keys, value).distinct(), keys, value, pieces, piece_values)
    sizes = distinct.groupBy(*keys, "__piece").agg(F.count(F.lit(1)).alias("__n"))
    above = Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    opening = sizes.select(
        *keys,
        F.lit(None).cast(df.schema[value].dataType).alias(value),
        "__piece",
        F.lit(0).alias("__is_value"),
        F.coalesce(F.sum("__n").over(above), F.lit(0)).alias("__step"),
    )
    values = distinct.select(*keys, value, "__piece", F.lit(1).alias("__is_value"), F.lit(1).cast("bigint").alias("__step"))
    running = (
        Window.partitionBy(*keys, "__piece")
        .orderBy("__is_value", F.desc_nulls_last(value))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = values.unionAll(opening).withColumn(rank, F.sum("__step").over(running).cast("int"))
    return ranked.filter("__is_value = 1").select(*keys, value, rank)


def hour_of(cols: TripColumns = RAW, grain: str = "day") -> Column:
    """The hour a trip starts in: of its day (0 to 23), or of the calendar (the time the hour begins)."""
    if grain not in ("day", "calendar"):
        raise ValueError(f"grain must be day or calendar, not {grain!r}")
    return F.hour(cols.pickup) if grain == "day" else F.date_trunc("hour", cols.pickup)


def rank_trips_by_fare(df: DataFrame, cols: TripColumns = RAW, grain: str = "day", **pieces: int) -> DataFrame:
    """Add the hour and the dense fare rank within (pickup zone, hour); ``grain`` as in ``hour_of``."""
    hourly = df.withColumn(HOUR, hour_of(cols, grain))
    keys = [cols.pickup_zone, HOUR]
    ranks = value_ranks(hourly, keys, cols.fare, **pieces)
    return join_null_safe(hourly, ranks, [*keys, cols.fare])


def top_fares(df: DataFrame, cols: TripColumns = RAW) -> DataFrame:
    """Trips with the highest fare of their (pickup zone, hour of day), ties included.

    Rank one is the group maximum, so this needs an aggregate and a join with one row per group, no ranking.
    """
    hourly = df.withColumn(HOUR, F.hour(cols.pickup))
    best = hourly.groupBy(F.col(cols.pickup_zone).alias("__zone"), F.col(HOUR).alias("__hour")).agg(
        F.max(cols.fare).alias("__best")
    )
    same = (
        F.col(cols.pickup_zone).eqNullSafe(F.col("__zone"))
        & F.col(HOUR).eqNullSafe(F.col("__hour"))
        & F.col(cols.fare).eqNullSafe(F.col("__best"))
    )
    return hourly.join(best, same).drop("__zone", "__hour", "__best")


def busiest_groups(df: DataFrame, cols: TripColumns = RAW, n: int = 1) -> DataFrame:
    """The ``n`` (pickup zone, hour of day) groups with most trips; equal counts are ordered by zone and hour."""
    return (
        df.groupBy(cols.pickup_zone, F.hour(cols.pickup).alias(HOUR))
        .agg(F.count(F.lit(1)).alias("trips"))
        .orderBy(F.desc("trips"), cols.pickup_zone, HOUR)
        .limit(n)
    )


def pair_counts(df: DataFrame, cols: TripColumns = RAW) -> DataFrame:
    """Trips per (pickup zone, dropoff zone), counting rows with a vendor."""
    return df.groupBy(cols.pickup_zone, cols.dropoff_zone).agg(F.count(cols.vendor).alias("trip_count"))
