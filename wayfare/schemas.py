"""Declared schemas and the names the operators use for their columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Column names, order and kinds of the public trip-record layout. The fingerprint is a hash over
# these columns in this order, so the list must not change.
FINGERPRINT = [
    ("VendorID", "int"),
    ("tpep_pickup_datetime", "ts"),
    ("tpep_dropoff_datetime", "ts"),
    ("passenger_count", "int"),
    ("trip_distance", "dec"),
    ("RatecodeID", "int"),
    ("store_and_fwd_flag", "str"),
    ("PULocationID", "int"),
    ("DOLocationID", "int"),
    ("payment_type", "int"),
    ("fare_amount", "dec"),
    ("extra", "dec"),
    ("mta_tax", "dec"),
    ("tip_amount", "dec"),
    ("tolls_amount", "dec"),
    ("improvement_surcharge", "dec"),
    ("total_amount", "dec"),
    ("congestion_surcharge", "dec"),
    ("Airport_fee", "dec"),
    ("driver_name", "str"),
]

# Storage type of each raw trip column.
_INT, _LONG, _DOUBLE, _TEXT, _TIME = (
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.StringType(),
    T.TimestampNTZType(),
)
TRIPS = T.StructType(
    [
        T.StructField("VendorID", _INT),
        T.StructField("tpep_pickup_datetime", _TIME),
        T.StructField("tpep_dropoff_datetime", _TIME),
        T.StructField("passenger_count", _LONG),
        T.StructField("trip_distance", _DOUBLE),
        T.StructField("RatecodeID", _LONG),
        T.StructField("store_and_fwd_flag", _TEXT),
        T.StructField("PULocationID", _INT),
        T.StructField("DOLocationID", _INT),
        T.StructField("payment_type", _LONG),
        T.StructField("fare_amount", _DOUBLE),
        T.StructField("extra", _DOUBLE),
        T.StructField("mta_tax", _DOUBLE),
        T.StructField("tip_amount", _DOUBLE),
        T.StructField("tolls_amount", _DOUBLE),
        T.StructField("improvement_surcharge", _DOUBLE),
        T.StructField("total_amount", _DOUBLE),
        T.StructField("congestion_surcharge", _DOUBLE),
        T.StructField("Airport_fee", _DOUBLE),
        T.StructField("driver_name", _TEXT),
    ]
)

# Header of the zone lookup file.
ZONES = T.StructType(
    [
        T.StructField("LocationID", _INT),
        T.StructField("Borough", _TEXT),
        T.StructField("Zone", _TEXT),
        T.StructField("service_zone", _TEXT),
    ]
)

# Members of the two constant dimensions.
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
]
PAYMENT_TYPES = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]

# Validity rule, dashboard window and table layout.
MIN_FARE = 2.5
ZONE_RANGE = (1, 263)
ROLLING_SECONDS = 7 * 24 * 60 * 60
TARGET_FILE_BYTES = 128 * 1024 * 1024
SINK_BATCH_ROWS = 50_000


@dataclass(frozen=True)
class TripColumns:
    """Which column plays which role. The defaults are the raw trip layout."""

    vendor: str = "VendorID"
    pickup: str = "tpep_pickup_datetime"
    dropoff: str = "tpep_dropoff_datetime"
    pickup_zone: str = "PULocationID"
    dropoff_zone: str = "DOLocationID"
    fare: str = "fare_amount"


RAW = TripColumns()
STAGED = TripColumns(
    vendor="vendor_id",
    pickup="pickup_datetime",
    dropoff="dropoff_datetime",
    pickup_zone="pickup_location_id",
    dropoff_zone="dropoff_location_id",
)
