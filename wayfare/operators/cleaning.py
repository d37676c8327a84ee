"""Validity filter, deduplication and the cleaned trip table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.functions import fingerprint, fingerprint_sql, initials
from wayfare.schemas import FINGERPRINT, MIN_FARE, RAW, ZONE_RANGE, TripColumns

KEY = "trip_fingerprint"
DURATION = "trip_duration_minutes"
NAME = "driver_name"


def valid_trip_sql(cols: TripColumns = RAW, min_fare: float = MIN_FARE, zones: tuple[int, int] = ZONE_RANGE) -> str:
    """Fare high enough, end after start, both zones in range. NULL in any term makes the whole test not true."""
    low, high = zones
    return (
        f"{cols.fare} >= {float(min_fare)}D and {cols.dropoff} > {cols.pickup}"
        f" and {cols.pickup_zone} between {low} and {high} and {cols.dropoff_zone} between {low} and {high}"
    )


def is_valid_trip(cols: TripColumns = RAW, min_fare: float = MIN_FARE, zones: tuple[int, int] = ZONE_RANGE) -> Column:
    return F.expr(valid_trip_sql(cols, min_fare, zones))


def derived_sql(
    df: DataFrame, cols: TripColumns = RAW, null_token: str | None = None, binary: bool = False
) -> dict[str, str]:
    """The added columns of a cleaned trip as SQL text. ``60.0D`` is a double; ``60.0`` would be a decimal and round."""
    seconds = f"unix_timestamp({cols.dropoff}) - unix_timestamp({cols.pickup})"
    return {DURATION: f"({seconds}) / 60.0D", KEY: fingerprint_sql(df, null_token=null_token, binary=binary)}


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``order_by``, ties broken by all other columns, so the choice is repeatable.

    Spark drops all but the first row per key before the shuffle as well, so a key that holds a large share of the
    rows reaches its task as one row per input partition.
    """
    if not keys:
        raise ValueError("keep_first needs at least one key column")
    named = {c.lower() for c in (*keys, *order_by)}
    rest = [c for c in df.columns if c.lower() not in named]
    order = [F.col(f"`{c}`") for c in (*order_by, *rest)] or [F.lit(1)]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__position", position).filter("__position = 1").drop("__position")


def keep_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, whichever Spark meets first. Use it where only the keys matter."""
    return df.dropDuplicates(list(keys))


def _find(df: DataFrame, name: str) -> str | None:
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def mask_name(df: DataFrame, name: str = NAME, masked: str = "driver_initials") -> DataFrame:
    """Replace a name column by initials; a table without that column is returned as it is."""
    column = _find(df, name)
    return df.withColumn(masked, initials(F.col(column))).drop(column) if column else df


def clean_trips(
    df: DataFrame,
    cols: TripColumns = RAW,
    min_fare: float = MIN_FARE,
    zones: tuple[int, int] = ZONE_RANGE,
    null_token: str | None = None,
    binary: bool = False,
) -> DataFrame:
    """Valid trips, one per fingerprint, with duration and fingerprint added and names masked.

    The filter is written first; Spark carries it into the file scan. With ``binary`` the fingerprints are bytes, for
    callers that join or count by them.
    """
    added = {name: F.expr(text) for name, text in derived_sql(df, cols, null_token, binary).items()}
    kept = df.filter(is_valid_trip(cols, min_fare, zones)).withColumns(added)
    return mask_name(keep_first(kept, [KEY], [cols.pickup]))


# How the SQL form writes a value of each kind before it is hashed. It is spelled out apart from the fingerprint module, so
# that comparing the two forms can tell when either goes wrong.
SQL_SPELLING = {
    "int": "ifnull(cast(try_cast({0} as bigint) as string), cast({0} as string))",
    "ts": "left(cast({0} as string), 19)",
    "dec": "ifnull(cast(try_cast({0} as decimal(12,2)) as string), cast({0} as string))",
    "str": "cast({0} as string)",
}
CLEAN_TRIPS_SQL = """
with valid as (
    select * from {view}
    where {fare} >= :min_fare and {dropoff} > {pickup}
      and {pickup_zone} between :low and :high and {dropoff_zone} between :low and :high
),
keyed as (
    select *,
           timestampdiff(SECOND, date_trunc('SECOND', {pickup}), date_trunc('SECOND', {dropoff})) / 60D as trip_duration_minutes,
           sha2(concat_ws('||', {spelled}), 256) as trip_fingerprint
    from valid
),
placed as (
    select *, row_number() over (partition by trip_fingerprint order by {order}) as __position from keyed
)
select * except ({dropped}) from placed where __position = 1
"""


def clean_trips_text(df: DataFrame, view: str, cols: TripColumns = RAW) -> str:
    """The SQL of the cleaned trips over a view of ``df``, with the bounds as named parameters."""
    present = {c.lower(): f"`{c}`" for c in df.columns}
    spelled = [SQL_SPELLING[kind].format(present[name.lower()]) for name, kind in FINGERPRINT if name.lower() in present]
    names = {role: f"`{getattr(cols, role)}`" for role in ("fare", "pickup", "dropoff", "pickup_zone", "dropoff_zone")}
    order = [names["pickup"], *[c for name, c in present.items() if name != cols.pickup.lower()]]
    dropped = ["__position", *([present[NAME]] if NAME in present else [])]
    return CLEAN_TRIPS_SQL.format(view=view, spelled=", ".join(spelled), order=", ".join(order), dropped=", ".join(dropped), **names)


def clean_trips_sql(
    df: DataFrame,
    view: str = "trip_input",
    cols: TripColumns = RAW,
    min_fare: float = MIN_FARE,
    zones: tuple[int, int] = ZONE_RANGE,
) -> DataFrame:
    """The same table by SQL over a temporary view, written on its own; names are dropped rather than masked."""
    df.createOrReplaceTempView(view)
    bounds = {"min_fare": float(min_fare), "low": zones[0], "high": zones[1]}
    return df.sparkSession.sql(clean_trips_text(df, view, cols), args=bounds)


def retention(
    df: DataFrame,
    cols: TripColumns = RAW,
    min_fare: float = MIN_FARE,
    zones: tuple[int, int] = ZONE_RANGE,
) -> DataFrame:
    """Raw rows, cleaned rows and the share dropped in percent, in one pass over the input."""
    valid = is_valid_trip(cols, min_fare=min_fare, zones=zones)
    raw, cleaned = F.col("raw_rows"), F.col("cleaned_rows")
    return df.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_distinct(F.when(valid, fingerprint(df))).alias("cleaned_rows"),
    ).select(raw, cleaned, ((raw - cleaned) / F.nullif(raw, F.lit(0)) * 100).alias("dropped_pct"))
