from datetime import datetime, timedelta

DAY = datetime(2024, 1, 1)


def at(seconds):
    return DAY + timedelta(seconds=seconds)


TRIP_SCHEMA = (
    "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "PULocationID int, DOLocationID int, fare_amount double"
)


def trips(spark, rows):
    """Rows of (vendor, pickup second, dropoff second, pickup zone, dropoff zone, fare)."""
    times = [(v, None if p is None else at(p), None if d is None else at(d), *rest) for v, p, d, *rest in rows]
    return spark.createDataFrame(times, TRIP_SCHEMA)
