import pytest
from pyspark.sql import functions as F

from helpers import trips
from wayfare import __main__ as command
from wayfare.operators.history import history_violations, update_rows
from wayfare.plans import reports, tuning, warehouse
from wayfare.plans.jobs import run_lakehouse, run_warehouse
from wayfare.plans.reports import plan_text
from wayfare.sources.versioned import VersionedTable

ZONES = "LocationID int, Borough string, Zone string, service_zone string"


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(v, s * 1800, s * 1800 + 600, z, 3 - z, 5.0 + s % 4) for s in range(60) for z in (1, 2) for v in (1, 2)]
    rows += rows[:10] + [(1, 0, 60, 1, 2, 1.0), (1, 60, 0, 1, 2, 9.0), (1, 0, 60, 999, 2, 9.0)]
    return trips(spark, rows).withColumn("passenger_count", F.lit(2).cast("bigint"))


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame([(1, "B", "one", "s"), (2, "B", "two", "s")], ZONES)


def values(report, check):
    return {r.metric: r.value for r in report.filter(F.col("check") == check).collect()}


def test_lakehouse(spark, raw, zones, tmp_path):
    folder = str(tmp_path)
    result = run_lakehouse(raw, zones, folder, measure=True)
    assert values(result["profile"], "retention") == {"raw": "253", "cleaned": "240", "dropped_pct": str(13 / 253 * 100)}
    assert values(result["equivalence"], "sql_and_dataframe")["identical"] == "true"
    assert values(result["windows"], "rank")["failures"] == "0"
    assert "Scan" in values(result["equivalence"], "plans")["sql"]
    assert sum(int(n) for n in values(result["profile"], "rows_per_partition").values()) == 253
    assert {values(result["files"], n)["rows"] for n in ("trips_silver", "trips_gold", "trips_gold_rolling_7d")} == {"240"}
    assert "BroadcastHashJoin" in values(result["tuning"], "join_plans")["broadcast"]
    rolling = values(result["windows"], "rolling")
    assert int(rolling["groups"]) >= 2 and rolling["failures"] == "0"
    strategy = values(result["tuning"], "join_strategy")
    assert (strategy["broadcast_in_plan"], strategy["sort_merge_in_plan"]) == ("True", "True")
    assert strategy["broadcast_rows"] == strategy["sort_merge_rows"] == "240"
    output = values(result["tuning"], "output_files")
    assert output["coalesced_files"] in ("1", "2") and output["plain_rows"] == output["coalesced_rows"] == "2"
    for name in ("trips_silver", "trips_gold", "trips_gold_rolling_7d"):
        assert VersionedTable(spark, f"{folder}/{name}").read().count() == 240
    run_lakehouse(raw, zones, folder)
    operations = [r.operation for r in VersionedTable(spark, f"{folder}/trips_silver").snapshots().collect()]
    assert operations == ["append", "overwrite"]


def test_warehouse(spark, raw, zones, tmp_path):
    result = run_warehouse(raw, zones, str(tmp_path))
    assert result.count() == 27
    assert result.filter("failures > 0").count() == 0
    fact = VersionedTable(spark, f"{tmp_path}/fact_trips").read()
    assert len(fact.columns) == 21 and fact.count() == 240
    days = VersionedTable(spark, f"{tmp_path}/dim_date").read()
    assert days.count() == 1096
    renamed = update_rows(zones, F.col("LocationID") == 2, Zone="two Updated")
    run_warehouse(raw, renamed, str(tmp_path))
    history = spark.read.parquet(f"{tmp_path}/location_history").drop("period")
    assert {(r.location_id, r.zone_name, r.valid_to is None) for r in history.collect()} == {
        (1, "one", True),
        (2, "two", False),
        (2, "two Updated", True),
    }
    assert tuple(history_violations(history, "location_id").first()) == (2, 0, 0, 0)


def test_rows_that_do_not_fit_are_kept_aside(spark, raw, zones, tmp_path):
    odd = raw.withColumn("fare_amount", F.when(F.col("VendorID") == 1, 1e8).otherwise(F.col("fare_amount")))
    with pytest.raises(Exception, match="fare_amount does not fit"):
        warehouse.stage_trips(odd).collect()
    result = run_warehouse(odd, zones, str(tmp_path))
    assert result.filter("failures > 0").count() == 0
    unfit = VersionedTable(spark, f"{tmp_path}/stg_trips_unfit").read()
    ones = raw.filter("VendorID = 1").count()
    assert unfit.count() == ones and {tuple(r.unfit) for r in unfit.collect()} == {("fare_amount",)}


def test_staged_fare_test_reaches_the_scan(spark, raw, tmp_path):
    raw.write.parquet(str(tmp_path / "t"))
    plan = plan_text(warehouse.stage_trips(spark.read.parquet(str(tmp_path / "t"))))
    assert "GreaterThanOrEqual(fare_amount,2.49)" in plan


def test_command_line(spark, raw, zones, tmp_path, capsys):
    raw.write.parquet(str(tmp_path / "in" / "yellow_tripdata_2024-01.parquet"))
    zones.toPandas().to_csv(tmp_path / "zones.csv", index=False)
    common = ["--trips", str(tmp_path / "in"), "--zones", str(tmp_path / "zones.csv"), "--out"]
    command.main(["warehouse", *common, str(tmp_path / "w")])
    command.main(["lakehouse", *common, str(tmp_path / "l")])
    printed = capsys.readouterr().out
    assert "relationships" in printed and "dropped_pct" in printed


def test_shuffle_comparison_restores_settings(spark, raw):
    keys = ["spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions"]
    before = [spark.conf.get(k) for k in keys]
    result = values(tuning.compare_shuffle_partitions(raw, default=20, tuned=2, runs=1), "shuffle_partitions")
    assert {"default_run_1", "tuned_run_1", "saving_pct"} <= set(result)
    assert result["default_rows"] == result["tuned_rows"] == str(raw.select("PULocationID", "DOLocationID").distinct().count())
    assert [spark.conf.get(k) for k in keys] == before


def test_comparisons_count_a_bounded_number_of_rows_in_a_task(spark):
    trips = spark.range(2_000).selectExpr("1 as VendorID", "int(id % 50) as PULocationID", "int(id % 40) as DOLocationID")
    shuffle = values(tuning.compare_shuffle_partitions(trips, default=8, tuned=2, runs=1, rows_per_task=100), "shuffle_partitions")
    assert (shuffle["tuned_partitions"], shuffle["default_partitions"]) == ("20", "80")
    assert shuffle["default_rows"] == shuffle["tuned_rows"] == "200"
    files = values(tuning.compare_output_files(trips, partitions=3, files=2, rows_per_task=100), "output_files")
    assert int(files["plain_files"]) > 3 and files["coalesced_files"] == "2"
    assert files["plain_rows"] == files["coalesced_rows"] == "200"


def test_large_and_small_numbers_are_reported_in_plain_digits(spark):
    values = [2.4e7, 216e6 / 7, -1.5e12, 9999999999999998.0, 1.2345678901234567e-4, 5e-4, 4e6, 0.25, 0.0, float("nan"), float("inf"), None]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"v{i} double" for i in range(len(values))))
    assert [r.value for r in reports.from_row(df, "x").collect()] == [
        "24000000.0", "30857142.85714286", "-1500000000000.0", "9999999999999998.0", "0.00012345678901234567", "0.0005",
        "4000000.0", "0.25", "0.0", "NaN", "Infinity", None,
    ]


def test_reports(spark, tmp_path):
    report = reports.from_row(spark.sql("select 1 as a, null as b"), "x")
    assert [tuple(r) for r in report.collect()] == [("x", "a", "1"), ("x", "b", None)]
    saved = reports.write_report(report, str(tmp_path / "r"), "Title").collect()
    assert {r.title for r in saved} == {"Title"} and saved[0].captured_at is not None
    assert "|  a|" in reports.sample_text(spark.sql("select 1 as a"))


def test_plan_operators(spark, raw):
    plans = {"counted": raw.groupBy("VendorID").count(), "sorted": raw.orderBy("VendorID")}
    found = reports.plan_operators(plans, ["HashAggregate", "Sort "], spark)
    assert {(r.check, r.metric): r.value for r in found.collect()} == {
        ("counted", "HashAggregate"): "true",
        ("counted", "Sort "): "false",
        ("sorted", "HashAggregate"): "false",
        ("sorted", "Sort "): "true",
    }
    with pytest.raises(AssertionError, match="CartesianProduct"):
        reports.assert_plan_contains(plans["sorted"], "Sort ", "CartesianProduct")
