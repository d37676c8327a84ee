import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import trips
from wayfare.operators import cleaning
from wayfare.operators.comparison import compare_rows
from wayfare.plans.reports import plan_text
from wayfare.plans.warehouse import stage_trips


def test_validity_boundaries(spark):
    ok = (1, 0, 60, 1, 263, 2.5)
    bad = [
        (1, 0, 60, 1, 263, 2.49),
        (1, 0, 60, 1, 263, 2.495),
        (1, 0, 60, 1, 263, None),
        (1, 0, 0, 1, 1, 9.0),
        (1, 60, 0, 1, 1, 9.0),
        (1, None, 60, 1, 1, 9.0),
        (1, 0, None, 1, 1, 9.0),
        (1, 0, 60, 0, 1, 9.0),
        (1, 0, 60, 264, 1, 9.0),
        (1, 0, 60, 1, 0, 9.0),
        (1, 0, 60, 1, 264, 9.0),
        (1, 0, 60, None, 1, 9.0),
        (1, 0, 60, 1, None, 9.0),
    ]
    kept = trips(spark, [ok, *bad]).filter(cleaning.is_valid_trip()).collect()
    assert len(kept) == 1 and kept[0].DOLocationID == 263


def test_rounded_fare_passes_in_staging_only(spark):
    df = trips(spark, [(2, 0, 60, 1, 1, 2.495)])
    assert cleaning.clean_trips(df).count() == 0
    assert stage_trips(df).count() == 1


def test_clean_trips(spark):
    row = (1, 0, 90, 1, 2, 5.0)
    df = trips(spark, [row, row, (1, 0, 90, 1, 3, 5.0), (1, 0, 90, 1, 2, 1.0)]).withColumn(
        "driver_name", F.lit("Ann Bo")
    )
    result = cleaning.clean_trips(df)
    assert result.columns == [
        "VendorID",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "PULocationID",
        "DOLocationID",
        "fare_amount",
        "trip_duration_minutes",
        "trip_fingerprint",
        "driver_initials",
    ]
    rows = result.collect()
    assert sorted(r.DOLocationID for r in rows) == [2, 3]
    assert {(r.trip_duration_minutes, r.driver_initials) for r in rows} == {(1.5, "A.B.")}
    assert compare_rows(result, cleaning.clean_trips_sql(df)).first().identical


EDGES = [
    (1, 0, 90, 1, 2, 2.5), (1, 0, 90, 1, 2, 2.5), (2, 5, 65, 1, 2, 2.75), (2, 5, 5, 1, 2, 9.0), (3, 7, 20, 263, 5, 8.125), (3, 7, 20, 263, 5, 8.126),
    (3, 7, 21, 264, 5, 8.0), (4, 1, 2, 0, 1, 7.0), (5, 1, 3, 1, 1, 6.0), (5, 1, 4, 1, 263, 6.0), (None, 9, 99, 3, 4, 1e10), (None, 9, 99, 3, 4, 2e10),
]


def test_both_forms_agree_at_the_edges(spark):
    df = trips(spark, EDGES)
    found = compare_rows(cleaning.clean_trips(df), cleaning.clean_trips_sql(df)).first()
    assert found.identical and found.left_rows == 7


@pytest.mark.parametrize(
    "right, wrong",
    [
        (">= :min_fare", "> :min_fare"),
        ("{dropoff} > {pickup}", "{dropoff} >= {pickup}"),
        ("{pickup_zone} between :low and :high", "{pickup_zone} between :low and :high + 1"),
        ("{dropoff_zone} between :low and :high", "{dropoff_zone} between :low + 1 and :high"),
        ("/ 60D", "/ 3600D"),
        ("timestampdiff(SECOND", "timestampdiff(MINUTE"),
        ("'||'", "'|'"),
        ("256)", "224)"),
        ("__position = 1", "__position <= 2"),
    ],
)
def test_the_comparison_finds_a_wrong_query(spark, monkeypatch, right, wrong):
    assert right in cleaning.CLEAN_TRIPS_SQL
    monkeypatch.setattr(cleaning, "CLEAN_TRIPS_SQL", cleaning.CLEAN_TRIPS_SQL.replace(right, wrong, 1))
    df = trips(spark, EDGES)
    assert not compare_rows(cleaning.clean_trips(df), cleaning.clean_trips_sql(df)).first().identical


@pytest.mark.parametrize("kind, wrong", [("dec", "cast(cast({0} as decimal(12,1)) as string)"), ("int", "cast({0} + 1 as string)"), ("ts", "left(cast({0} as string), 16)")])
def test_the_comparison_finds_a_wrong_kind(spark, monkeypatch, kind, wrong):
    monkeypatch.setitem(cleaning.SQL_SPELLING, kind, wrong)
    df = trips(spark, EDGES[:9])
    assert not compare_rows(cleaning.clean_trips(df), cleaning.clean_trips_sql(df)).first().identical


def test_keep_first_is_repeatable(spark):
    rows = [(1, 5, "b"), (1, 3, "z"), (1, 3, "a"), (2, 1, None), (None, 1, "n"), (None, 0, "m")]
    for partitions in (1, 3):
        df = spark.createDataFrame(rows, "k int, t int, v string").repartition(partitions)
        kept = {tuple(r) for r in cleaning.keep_first(df, ["k"], ["t"]).collect()}
        assert kept == {(1, 3, "a"), (2, 1, None), (None, 0, "m")}


def test_copies_are_dropped_before_the_shuffle(spark):
    df = trips(spark, [(1, 0, 60, 1, 1, 9.0)] * 10)
    plan = plan_text(cleaning.clean_trips(df), "simple")
    before, after = plan.split("Exchange hashpartitioning(trip_fingerprint")
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_filter_reaches_the_scan(spark, tmp_path):
    trips(spark, [(1, 0, 60, 1, 1, 9.0)]).write.parquet(str(tmp_path / "t"))
    plan = plan_text(cleaning.clean_trips(spark.read.parquet(str(tmp_path / "t"))))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    for part in ("GreaterThanOrEqual(fare_amount,2.5)", "LessThanOrEqual(PULocationID,263)", "DOLocationID"):
        assert part in pushed


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([1, 2, None]), st.integers(0, 3)), min_size=1, max_size=30))
def test_keep_first_properties(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int")
    once = cleaning.keep_first(df, ["k"])
    assert once.count() == len({k for k, _ in rows})
    assert compare_rows(once, cleaning.keep_first(once, ["k"])).first().identical
    assert cleaning.keep_any(df, ["k"]).count() == once.count()


def test_retention(spark):
    row = (1, 0, 90, 1, 2, 5.0)
    result = cleaning.retention(trips(spark, [row, row, (1, 0, 90, 1, 2, 1.0), (1, 0, 90, 1, 3, 5.0)])).first()
    assert tuple(result) == (4, 2, 50.0)
    assert cleaning.retention(trips(spark, [])).first().dropped_pct is None
