import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import trips
from wayfare.operators import checks, ranking, rolling
from wayfare.operators.comparison import compare_rows
from wayfare.schemas import ROLLING_SECONDS

FEW = {"max_examples": 12, "deadline": None, "suppress_health_check": [HealthCheck.function_scoped_fixture]}


def native_rolling(df, counted=None, window=ROLLING_SECONDS):
    timed = df.withColumn("pickup_ts", F.unix_timestamp("tpep_pickup_datetime"))
    frame = Window.partitionBy("PULocationID").orderBy("pickup_ts").rangeBetween(-window, 0)
    return timed.withColumn(rolling.ROLLING, F.count(F.lit(1) if counted is None else counted).over(frame))


def native_rank(df):
    order = Window.partitionBy("PULocationID", "pickup_hour").orderBy(F.desc("fare_amount"))
    return df.withColumn("pickup_hour", F.hour("tpep_pickup_datetime")).withColumn("fare_rank", F.dense_rank().over(order))


def same(left, right):
    result = compare_rows(left, right).first()
    return result.identical and result.left_rows > 0 and left.columns == right.columns


def test_rolling_edges(spark):
    week = ROLLING_SECONDS
    seconds = [0, 0, 1, week, week + 1, week + 2, 86_399, 86_400, 3 * week]
    df = trips(spark, [(1, s, s + 60, 7, 1, 9.0) for s in seconds])
    counts = sorted((r.pickup_ts, r.rolling_7d_trip_count) for r in rolling.rolling_trip_count(df).collect())
    base = counts[0][0]
    assert [(t - base, n) for t, n in counts] == [
        (0, 2),
        (0, 2),
        (1, 3),
        (86_399, 4),
        (86_400, 5),
        (week, 6),
        (week + 1, 5),
        (week + 2, 5),
        (3 * week, 1),
    ]


def test_rolling_null_keys_and_counted_column(spark):
    rows = [(None, 0, 9, 1, 1, 1.0), (1, 5, 9, 1, 1, 1.0), (1, None, 9, 1, 1, 1.0), (1, None, 9, 1, 1, 1.0)]
    df = trips(spark, rows + [(1, 3, 9, None, 1, 1.0), (None, 4, 9, None, 1, 1.0)])
    assert same(rolling.rolling_trip_count(df), native_rolling(df))
    counted = F.col("VendorID")
    assert same(rolling.rolling_trip_count(df, counted=counted), native_rolling(df, counted))


@settings(**FEW)
@given(
    st.lists(st.tuples(st.integers(-50, 50), st.integers(1, 3)), min_size=1, max_size=60),
    st.integers(1, 30),
    st.integers(1, 40),
)
def test_rolling_equals_native_window(spark, rows, window, slice_seconds):
    df = trips(spark, [(1, s, s, z, 1, 1.0) for s, z in rows])
    mine = rolling.rolling_trip_count(df, window=window, slice_seconds=slice_seconds)
    assert same(mine, native_rolling(df, window=window))


def test_rolling_with_a_hot_zone(spark):
    random.seed(1)
    rows = [(1, random.randrange(30 * 86_400), 0, random.choice([1, 1, 2, 3]), 1, 1.0) for _ in range(4000)]
    df = trips(spark, rows)
    assert same(rolling.rolling_trip_count(df), native_rolling(df))


def test_rank_ties_nulls_and_nan(spark):
    fares = [5.0, 5.0, 4.99, None, None, float("nan"), -0.5, 1e300, 0.0, -0.0, float("inf")]
    df = trips(spark, [(1, 0, 9, z, 1, f) for z in (1, None) for f in fares])
    assert same(ranking.rank_trips_by_fare(df), native_rank(df))


@settings(**FEW)
@given(
    st.lists(st.tuples(st.integers(0, 7200), st.integers(1, 2), st.integers(0, 400)), min_size=1, max_size=60),
    st.sampled_from([(256, 10_000), (4, 0), (16, 3), (2, 5)]),
)
def test_rank_equals_native_window(spark, rows, pieces):
    df = trips(spark, [(1, s, s, z, 1, f / 100) for s, z, f in rows])
    assert same(ranking.rank_trips_by_fare(df, pieces=pieces[0], piece_values=pieces[1]), native_rank(df))


def test_rank_in_pieces_with_nulls_and_nan(spark):
    fares = [5.0, 5.0, 4.99, None, None, float("nan"), -0.5, 1e300, 0.0, -0.0, float("inf")]
    df = trips(spark, [(1, 0, 9, z, 1, f) for z in (1, None) for f in fares])
    assert same(ranking.rank_trips_by_fare(df, pieces=3, piece_values=1), native_rank(df))


@pytest.mark.parametrize("value", ["rand(7)", "1e12 + id * 1e9", "case when id % 3 = 0 then rand(7) else exp(id / 1000) end"])
def test_pieces_are_bounded_however_values_are_spread(spark, value):
    values = spark.range(0, 300_000, 1, 8).selectExpr("1 as zone", f"{value} as fare").distinct()
    sizes = ranking._pieces(values, ["zone"], "fare", 256, 10_000).groupBy("zone", "__piece").count()
    largest, total, pieces = sizes.agg(F.max("count"), F.sum("count"), F.count("*")).first()
    assert total == values.count() and largest < 3 * total / 256 and pieces <= 257


def test_rank_by_calendar_hour(spark):
    df = trips(spark, [(1, s, 9, 1, 1, float(f)) for s, f in [(0, 5), (10, 7), (86_400, 6), (86_401, 1)]])
    ranks = ranking.rank_trips_by_fare(df, grain="calendar").select("fare_amount", "fare_rank").collect()
    assert sorted(tuple(r) for r in ranks) == [(1.0, 2), (5.0, 2), (6.0, 1), (7.0, 1)]
    with pytest.raises(ValueError):
        ranking.hour_of(grain="week")


def test_rank_of_decimals(spark):
    df = trips(spark, [(1, 0, 9, 1, 1, f) for f in (1.25, 1.5, 1.25, 7.0)])
    df = df.withColumn("fare_amount", F.col("fare_amount").cast("decimal(10,2)"))
    assert same(ranking.rank_trips_by_fare(df), native_rank(df))


def test_top_fares_are_rank_one(spark):
    df = trips(spark, [(1, 0, 9, z, 1, f) for z in (1, 2, None) for f in (3.0, 3.0, 2.0, None)])
    df = df.unionAll(trips(spark, [(1, 0, 9, 9, 1, None)]))
    assert same(ranking.top_fares(df), native_rank(df).filter("fare_rank = 1").drop("fare_rank"))


def test_busiest_group(spark):
    df = trips(spark, [(1, s, 9, z, 1, 1.0) for s, z in [(0, 2), (10, 2), (3600, 1), (3601, 1), (0, 3)]])
    assert [tuple(r) for r in ranking.busiest_groups(df).collect()] == [(1, 1, 2)]


def test_pair_counts_skip_missing_vendor(spark):
    df = trips(spark, [(1, 0, 9, 1, 2, 1.0), (None, 0, 9, 1, 2, 1.0), (None, 0, 9, 3, 2, 1.0)])
    assert {tuple(r) for r in ranking.pair_counts(df).collect()} == {(1, 2, 1), (3, 2, 0)}


def test_spot_checks_find_wrong_results(spark):
    df = trips(spark, [(1, s, 9, z, 1, float(s % 7)) for s in range(0, 50_000, 900) for z in (1, 2)])
    ranked, rolled = ranking.rank_trips_by_fare(df), rolling.rolling_trip_count(df)
    assert checks.rank_check(df, ranked).filter("not ok").count() == 0
    assert checks.rolling_check(df, rolled).filter("not ok").count() == 0
    extra = ranked.limit(1).withColumn("PULocationID", F.lit(77)).withColumn("fare_rank", F.lit(1))
    assert [r.PULocationID for r in checks.rank_check(df, ranked.unionAll(extra)).filter("not ok").collect()] == [77]
    more = rolled.limit(1).withColumn("PULocationID", F.lit(78))
    assert [r.PULocationID for r in checks.rolling_check(df, rolled.unionAll(more)).filter("not ok").collect()] == [78]
    wrong_rank = ranked.filter("not (PULocationID = 2 and fare_rank = 1)")
    assert {r.PULocationID for r in checks.rank_check(df, wrong_rank).filter("not ok").collect()} == {2}
    wrong_count = rolled.withColumn(rolling.ROLLING, F.col(rolling.ROLLING) + F.when(F.col("PULocationID") == 1, 1).otherwise(0))
    assert {r.PULocationID for r in checks.rolling_check(df, wrong_count).filter("not ok").collect()} == {1}


def test_rolling_check_looks_at_several_instants(spark):
    """A wrong count in the middle of a long series, a row that is missing, and one that is there twice."""
    rows = [(1, s * 7_000, s * 7_000 + 60, z, 1, 5.0) for s in range(400) for z in (1, 2)] + [(1, 700_000, 700_060, None, 1, 5.0)]
    df = trips(spark, rows)
    rolled = rolling.rolling_trip_count(df)
    start = rolled.agg(F.min(rolling.SECOND)).first()[0]
    fine = checks.rolling_check(df, rolled, every=600).collect()
    assert all(r.ok for r in fine) and len(fine) > 100 and {r.PULocationID for r in fine} == {1, 2, None}
    at = min(r.anchor for r in fine if r.PULocationID == 1 and r.anchor > start + 1_400_000)
    spoiled = rolled.withColumn(rolling.ROLLING, F.col(rolling.ROLLING) + F.when((F.col(rolling.SECOND) == at) & (F.col("PULocationID") == 1), 1).otherwise(0))
    assert [(r.PULocationID, r.anchor) for r in checks.rolling_check(df, spoiled, every=600).filter("not ok").collect()] == [(1, at)]
    gone = rolled.filter((F.col(rolling.SECOND) != at) | (F.col("PULocationID") != 1))
    assert [(r.anchor, r.window_count) for r in checks.rolling_check(df, gone, every=600).filter("not ok").collect()] == [(at, None)]
    assert checks.rolling_check(df, rolled, every=600, bucket=3600).filter("not ok").count() == 0
    assert checks.rolling_check(df, rolled, every=600, window=100).filter("ok").count() < len(fine)
