"""Star schema: staging, fact and dimension models, and their declared checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions import (
    day_name,
    duration_minutes_exact,
    fingerprint,
    initials,
    is_weekend,
    month_name,
    payment_key,
    rate_key,
    sunday_based_weekday,
    varchar,
)
from wayfare.operators.checks import Check, not_null, relationship, unique
from wayfare.operators.cleaning import KEY, is_valid_trip, keep_first
from wayfare.operators.joins import Dimension
from wayfare.schemas import MIN_FARE, PAYMENT_TYPES, RATE_CODES, RAW, STAGED, TRIPS, ZONE_RANGE, ZONES
from wayfare.sources.generated import constant_rows, date_series
from wayfare.sources.readers import conform, does_not_fit, strict_cast

# Raw column, staged name and staged type.
STAGED_TRIP_COLUMNS = [
    ("VendorID", "vendor_id", "int"),
    ("tpep_pickup_datetime", "pickup_datetime", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "passenger_count", "int"),
    ("trip_distance", "trip_distance", "decimal(10,2)"),
    ("PULocationID", "pickup_location_id", "int"),
    ("DOLocationID", "dropoff_location_id", "int"),
    ("fare_amount", "fare_amount", "decimal(10,2)"),
    ("extra", "extra", "decimal(10,2)"),
    ("mta_tax", "mta_tax", "decimal(10,2)"),
    ("tip_amount", "tip_amount", "decimal(10,2)"),
    ("tolls_amount", "tolls_amount", "decimal(10,2)"),
    ("improvement_surcharge", "improvement_surcharge", "decimal(10,2)"),
    ("total_amount", "total_amount", "decimal(10,2)"),
]
# Columns of the fact table in order.
FACT_COLUMNS = [
    "trip_fingerprint",
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_date",
    "passenger_count",
    "trip_distance",
    "pickup_location_id",
    "dropoff_location_id",
    "rate_code_id",
    "payment_type_id",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "store_and_fwd_flag",
    "driver_initials",
    "trip_duration_minutes",
]

# Default range of the date dimension.
FIRST_DAY, LAST_DAY = "2024-01-01", "2026-12-31"

# The declared checks.
CHECKS: list[Check] = [
    *unique("stg_trips", "trip_fingerprint"),
    *not_null(
        "stg_trips",
        "trip_fingerprint",
        "pickup_datetime",
        "dropoff_datetime",
        "fare_amount",
        "pickup_location_id",
        "dropoff_location_id",
    ),
    *unique("stg_zones", "location_id"),
    *not_null("stg_zones", "location_id"),
    *unique("fact_trips", "trip_fingerprint"),
    *not_null("fact_trips", "trip_fingerprint", "pickup_location_id", "dropoff_location_id", "pickup_date"),
    *relationship("fact_trips", "pickup_location_id", "dim_location", "location_id"),
    *relationship("fact_trips", "dropoff_location_id", "dim_location", "location_id"),
    *relationship("fact_trips", "rate_code_id", "dim_rate_code", "rate_code_id"),
    *relationship("fact_trips", "payment_type_id", "dim_payment_type", "payment_type_id"),
    *relationship("fact_trips", "pickup_date", "dim_date", "date_day"),
    *unique("dim_location", "location_id"),
    *not_null("dim_location", "location_id"),
    *unique("dim_date", "date_day"),
    *not_null("dim_date", "date_day"),
    *unique("dim_rate_code", "rate_code_id"),
    *not_null("dim_rate_code", "rate_code_id"),
    *unique("dim_payment_type", "payment_type_id"),
    *not_null("dim_payment_type", "payment_type_id"),
]
# The history table's key and the columns whose change opens a new version.
HISTORY_KEY, HISTORY_CHECKED = "location_id", ["borough", "zone_name", "service_zone"]


def _staged(source: str, kind: str, name: str) -> Column:
    same = TRIPS[source].dataType.simpleString() == kind
    return F.col(source) if same else strict_cast(F.col(source), kind, name)


def stage_trips(
    raw: DataFrame, min_fare: float = MIN_FARE, zones: tuple[int, int] = ZONE_RANGE, binary: bool = False
) -> DataFrame:
    """Typed, derived, valid and deduplicated trips. The fare test sees the amount rounded to cents.

    A value that its type can't hold stops the job; ``split_unfit`` sets such rows aside beforehand. Rounding adds half a
    cent at most, so the test of the raw amount drops nothing that the rounded one keeps, and it reaches the scan.
    ``binary`` is that of ``clean_trips``.
    """
    raw = conform(raw, TRIPS, unreadable="error").filter(F.col(RAW.fare) >= min_fare - 0.01)
    passengers = "passenger_count"
    staged = raw.select(
        *[_staged(source, kind, name).alias(name) for source, name, kind in STAGED_TRIP_COLUMNS],
        varchar("store_and_fwd_flag", 1).alias("store_and_fwd_flag"),
        rate_key("VendorID", passengers).alias("rate_code_id"),
        payment_key(passengers).alias("payment_type_id"),
        duration_minutes_exact("tpep_pickup_datetime", "tpep_dropoff_datetime").alias("trip_duration_minutes"),
        initials(varchar("driver_name", 100)).alias("driver_initials"),
        fingerprint(raw, binary=binary).alias(KEY),
    )
    valid = staged.filter(is_valid_trip(STAGED, min_fare=min_fare, zones=zones))
    return keep_first(valid, [KEY], [STAGED.pickup])


def split_unfit(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that can be staged, and the others with the names of the columns whose values do not fit in ``unfit``."""
    present = {c.lower(): c for c in raw.columns}
    kinds = {f.name: [f.dataType] for f in TRIPS.fields}
    for source, _, kind in STAGED_TRIP_COLUMNS:
        kinds[source].append(kind)
    tests = []
    for name, wanted in kinds.items():
        if name.lower() in present:
            value = F.col(f"`{present[name.lower()]}`")
            misfit = does_not_fit(value, wanted[0]) | does_not_fit(value.try_cast(wanted[0]), wanted[-1])
            tests.append(F.when(misfit, F.lit(name)))
    unfit = F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")
    marked = raw.withColumn("unfit", unfit)
    return marked.filter(F.size("unfit") == 0).drop("unfit"), marked.filter(F.size("unfit") > 0)


def stage_zones(raw: DataFrame) -> DataFrame:
    return conform(raw, ZONES).select(
        F.col("LocationID").alias("location_id"),
        varchar("Borough", 50).alias("borough"),
        varchar("Zone", 100).alias("zone_name"),
        varchar("service_zone", 50).alias("service_zone"),
    )


def fact_trips(staged: DataFrame) -> DataFrame:
    return staged.withColumn("pickup_date", F.to_date("pickup_datetime")).select(*FACT_COLUMNS)


def dim_location(staged_zones: DataFrame) -> DataFrame:
    return staged_zones.select("location_id", "borough", "zone_name", "service_zone")


def dim_date(days: DataFrame) -> DataFrame:
    """Calendar attributes of each ``date_day``."""
    day = "date_day"
    return days.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.day(day).alias("day"),
        sunday_based_weekday(day).alias("day_of_week"),
        month_name(day).alias("month_name"),
        day_name(day).alias("day_name"),
        is_weekend(day).alias("is_weekend"),
    )


def calendar(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    return date_series(spark.range(1), F.lit(first), F.lit(last))


def dim_rate_code(spark: SparkSession) -> DataFrame:
    return constant_rows(spark, RATE_CODES, "rate_code_id int, description string")


def dim_payment_type(spark: SparkSession) -> DataFrame:
    return constant_rows(spark, PAYMENT_TYPES, "payment_type_id int, description string")


def build_models(
    raw_trips: DataFrame,
    raw_zones: DataFrame,
    days: DataFrame | None = None,
    min_fare: float = MIN_FARE,
    zones: tuple[int, int] = ZONE_RANGE,
) -> dict[str, DataFrame]:
    """All models by name."""
    spark = raw_trips.sparkSession
    staged, staged_zones = stage_trips(raw_trips, min_fare, zones), stage_zones(raw_zones)
    return {
        "stg_trips": staged,
        "stg_zones": staged_zones,
        "fact_trips": fact_trips(staged),
        "dim_location": dim_location(staged_zones),
        "dim_date": dim_date(calendar(spark) if days is None else days),
        "dim_rate_code": dim_rate_code(spark),
        "dim_payment_type": dim_payment_type(spark),
    }


def star_dimensions(models: dict[str, DataFrame]) -> list[Dimension]:
    """The fact table's references to its dimensions."""
    return [
        Dimension(models["dim_location"], "pickup_location_id", "location_id", "pickup"),
        Dimension(models["dim_location"], "dropoff_location_id", "location_id", "dropoff"),
        Dimension(models["dim_date"], "pickup_date", "date_day", "date"),
        Dimension(models["dim_rate_code"], "rate_code_id", "rate_code_id", "rate_code"),
        Dimension(models["dim_payment_type"], "payment_type_id", "payment_type_id", "payment_type"),
    ]
