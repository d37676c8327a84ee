import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.kinds import common_type, holds
from wayfare.plans.reports import plan_text
from wayfare.schemas import TRIPS
from wayfare.sources.drift import drift_changes, file_groups, read_drifting
from wayfare.sources.readers import read_trips

BYTE, INT, LONG, FLOAT, DOUBLE = T.ByteType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()
TEXT, DATE, NTZ, ZONED = T.StringType(), T.DateType(), T.TimestampNTZType(), T.TimestampType()


@pytest.mark.parametrize(
    "kinds, common",
    [
        ([INT, INT], INT),
        ([INT, LONG, BYTE], LONG),
        ([LONG, FLOAT], DOUBLE),
        ([INT, T.DecimalType(5, 2)], T.DecimalType(12, 2)),
        ([T.DecimalType(10, 2), T.DecimalType(8, 4)], T.DecimalType(12, 4)),
        ([T.DecimalType(38, 2), T.DecimalType(38, 20)], DOUBLE),
        ([T.DecimalType(5, 2), DOUBLE], DOUBLE),
        ([DATE, NTZ], NTZ),
        ([T.NullType(), INT], INT),
        ([INT, TEXT], TEXT),
        ([DATE, INT], TEXT),
        ([], TEXT),
    ],
)
def test_common_type(kinds, common):
    assert common_type(kinds) == common_type(kinds[::-1]) == common
    for kind in kinds:
        if common not in (DOUBLE, TEXT):
            assert holds(common, kind)


def test_times_with_and_without_a_zone_do_not_meet():
    with pytest.raises(TypeError):
        common_type([NTZ, ZONED])


def test_what_a_type_holds():
    assert holds(DOUBLE, INT) and holds(DOUBLE, FLOAT) and not holds(DOUBLE, LONG)
    assert not holds(INT, LONG) and not holds(LONG, DOUBLE) and not holds(TEXT, INT)
    assert not holds(T.DecimalType(10, 2), T.DecimalType(10, 3))


def month(df, tmp_path, name):
    df.write.parquet(str(tmp_path / f"yellow_tripdata_{name}.parquet"))


@pytest.fixture
def months(spark, tmp_path):
    month(spark.sql("select 1 as VendorID, 2L as passenger_count, 3.5D as fare_amount, 'N' as store_and_fwd_flag"), tmp_path, "01")
    month(spark.sql("select 2 as VendorID, 3L as passenger_count, 4.5D as fare_amount, 'Y' as store_and_fwd_flag"), tmp_path, "02")
    month(spark.sql("select 3L as vendorid, 2.5D as passenger_count, 5.25 as fare_amount, 9 as tip"), tmp_path, "03")
    month(spark.sql("select 4L as VendorID, 1.0D as passenger_count, 6.25 as fare_amount"), tmp_path, "04")
    return str(tmp_path)


def test_files_are_grouped_by_what_reads_them(spark, months):
    groups = file_groups(spark, f"{months}/yellow*")
    assert sorted(len(g.paths) for g in groups) == [2, 2]
    assert all(len({p.split("tripdata_")[1][:2] for p in g.paths} & {"01", "02"}) in (0, 2) for g in groups)


def test_drifting_files_are_one_table(spark, months):
    rows = read_trips(spark, months, lineage="file")
    kinds = dict(rows.dtypes)
    assert kinds.pop("file") == "string" and {k.lower(): v for k, v in kinds.items()} == {
        "vendorid": "bigint", "passenger_count": "double", "fare_amount": "double", "store_and_fwd_flag": "string", "tip": "int",
    }
    found = sorted((r.VendorID, r.passenger_count, r.fare_amount, r.store_and_fwd_flag, r.tip, r.file[-2] != "") for r in rows.collect())
    assert found == [(1, 2.0, 3.5, "N", None, True), (2, 3.0, 4.5, "Y", None, True), (3, 2.5, 5.25, None, 9, True), (4, 1.0, 6.25, None, None, True)]
    assert all(f"tripdata_0{r.VendorID}" in r.file for r in rows.collect())


def test_the_declared_schema_reads_drifting_files(spark, months):
    rows = read_trips(spark, months, schema=TRIPS)
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in TRIPS]
    assert sorted((r.VendorID, r.passenger_count) for r in rows.collect()) == [(1, 2), (2, 3), (3, 2), (4, 1)]
    changes = {(r.column, r.type): (r.target, r.files, r.changed) for r in drift_changes(spark, f"{months}/yellow*", TRIPS).collect()}
    assert changes["passenger_count", "double"] == ("bigint", 2, 1)
    assert changes["VendorID", "bigint"] == ("int", 2, 0) and changes["VendorID", "int"] == ("int", 2, 0)
    assert {k for k, v in changes.items() if v[2]} == {("passenger_count", "double")}


def test_widening_counts_what_it_changes(spark, tmp_path):
    month(spark.sql("select 9007199254740993L as n union all select 5L"), tmp_path, "1")
    month(spark.sql("select 0.5D as n"), tmp_path, "2")
    month(spark.sql("select 'a' as n"), tmp_path, "3")
    assert {r.changed for r in drift_changes(spark, str(tmp_path / "*")).collect()} == {0}  # text holds them all
    two = str(tmp_path / "yellow_tripdata_[12].parquet")
    assert {(r.type, r.target, r.changed) for r in drift_changes(spark, two).collect()} == {("bigint", "double", 1), ("double", "double", 0)}


def test_each_group_is_scanned_once_with_its_own_columns(spark, months):
    plan = plan_text(read_trips(spark, months).filter("fare_amount > 4").select("VendorID"))
    assert plan.count("Scan parquet") == 4  # two groups, each in the tree and in the details
    assert "passenger_count" not in plan and "PushedFilters: [IsNotNull(fare_amount), GreaterThan(fare_amount,4.0)]" in plan


def test_files_without_drift_are_one_scan(spark, tmp_path):
    for name in "12":
        month(spark.range(4).withColumn("x", F.lit(name)), tmp_path, name)
    rows = read_trips(spark, str(tmp_path))
    assert plan_text(rows, "simple").count("FileScan") == 1 and rows.count() == 8
    with pytest.raises(FileNotFoundError, match="missing"):
        read_trips(spark, str(tmp_path), "missing*")


def test_times_that_can_not_be_put_together_are_named(spark, tmp_path):
    month(spark.sql("select timestamp_ntz'2024-01-01 00:00:00' as t"), tmp_path, "1")
    month(spark.sql("select timestamp'2024-01-01 00:00:00' as t"), tmp_path, "2")
    with pytest.raises(TypeError, match="column t"):
        read_drifting(spark, str(tmp_path / "*"))
