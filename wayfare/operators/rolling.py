"""Trips per zone in the trailing seven days.

The count at time t covers ``[t - window, t]``, both ends included, in whole seconds. A sliding range frame would
keep a zone's rows in one task and visit the frame again for every row. Here trips are first counted per zone and
second. Each such count enters the total at its second and leaves it after ``window`` seconds; a running sum of
entries and exits, ordered so that exits at t apply after t, is the answer. The running sum is taken inside short
time slices, each opened by a row with the sum of all earlier slices, so a task sees at most one slice of a zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.functions import epoch_seconds
from wayfare.operators.joins import join_null_safe
from wayfare.schemas import RAW, ROLLING_SECONDS, TripColumns

SECOND = "pickup_ts"
ROLLING = "rolling_7d_trip_count"


def rolling_counts(
    per_second: DataFrame, zone: str, second: str, count: str, window: int, slice_seconds: int, result: str
) -> DataFrame:
    """Trailing count for every (zone, second) of a table with one row per (zone, second)."""
    change = F.explode(
        F.array(
            F.struct(F.col(second).alias("at"), F.lit(0).alias("exit"), F.col(count).alias("delta")),
            F.struct((F.col(second) + window).alias("at"), F.lit(1).alias("exit"), (-F.col(count)).alias("delta")),
        )
    )
    changes = per_second.select(zone, change.alias("c")).select(
        zone, F.floor(F.col("c.at") / slice_seconds).alias("__slice"), "c.at", "c.exit", "c.delta"
    )
    totals = changes.groupBy(zone, "__slice").agg(F.sum("delta").alias("__total"))
    earlier = Window.partitionBy(zone).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    opening = totals.select(
        zone,
        "__slice",
        F.lit(None).cast("bigint").alias("at"),
        F.lit(-1).alias("exit"),
        F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("delta"),
    )
    running = Window.partitionBy(zone, "__slice").orderBy("at", "exit").rowsBetween(Window.unboundedPreceding, 0)
    summed = changes.unionAll(opening).withColumn(result, F.sum("delta").over(running))
    return summed.filter("exit = 0").select(zone, F.col("at").alias(second), result)


def rolling_trip_count(
    df: DataFrame,
    cols: TripColumns = RAW,
    counted: Column | None = None,
    window: int = ROLLING_SECONDS,
    slice_seconds: int = 86_400,
) -> DataFrame:
    """Add the pickup second and the number of trips of the pickup zone in the trailing window.

    All rows count unless ``counted`` is given; then rows where it is NULL do not.
    """
    counted = F.lit(1) if counted is None else counted
    timed = df.withColumn(SECOND, epoch_seconds(cols.pickup))
    per_second = timed.groupBy(cols.pickup_zone, SECOND).agg(F.count(counted).alias("__n"))
    counts = rolling_counts(per_second, cols.pickup_zone, SECOND, "__n", window, slice_seconds, ROLLING)
    return join_null_safe(timed, counts, [cols.pickup_zone, SECOND])
