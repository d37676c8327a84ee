import contextlib
from datetime import datetime

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from wayfare import session
from wayfare.schemas import TRIPS
from wayfare.sources import generated, readers, sinks, versioned
from wayfare.sources.versioned import VersionedTable


def test_read_trips(spark, tmp_path):
    for month in (1, 2):
        spark.range(3).withColumn("m", F.lit(month)).coalesce(1).write.parquet(
            str(tmp_path / f"yellow_tripdata_2024-0{month}.parquet")
        )
    spark.range(9).write.parquet(str(tmp_path / "other.parquet"))
    assert readers.read_trips(spark, str(tmp_path)).groupBy("m").count().count() == 2
    with pytest.raises(FileNotFoundError, match="missing"):
        readers.read_trips(spark, str(tmp_path), "missing*.parquet")


def test_read_zones(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('"LocationID","Borough","Zone","service_zone"\n5,"SI","Arden, Heights","Boro"\n264,"Unknown",,\n')
    rows = readers.read_zones(spark, str(path)).orderBy("LocationID").collect()
    assert [tuple(r) for r in rows] == [(5, "SI", "Arden, Heights", "Boro"), (264, "Unknown", None, None)]


def test_conform(spark):
    df = spark.createDataFrame([("x", "7", 2.0)], "extra_column string, vendorid string, Passenger_Count double")
    result = readers.conform(df)
    assert result.schema.names == TRIPS.names
    assert [f.dataType for f in result.schema] == [f.dataType for f in TRIPS]
    row = result.first()
    assert (row.VendorID, row.passenger_count, row.fare_amount) == (7, 2, None)


def test_generated(spark):
    bounds = spark.sql("select timestamp_ntz'2024-02-27 10:00:00' as lo, timestamp_ntz'2024-03-01 00:00:00' as hi")
    assert [str(r[0]) for r in generated.date_series(bounds, "lo", "hi").collect()] == [
        "2024-02-27",
        "2024-02-28",
        "2024-02-29",
        "2024-03-01",
    ]
    assert generated.constant_rows(spark, [(1, "a")], "k int, v string").collect() == [(1, "a")]


def test_versioned_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    first = table.write(spark.range(10), committed_at=datetime(2024, 1, 1))
    second = table.write(table.read().filter("id < 4"), committed_at=datetime(2024, 1, 2))
    assert table.exists()
    assert (table.read().count(), table.read(first).count()) == (4, 10)
    log = [tuple(r)[1:] for r in table.snapshots().collect()]
    assert log == [(first, None, "append", 10), (second, first, "overwrite", 4)]
    files = table.files().collect()
    assert sum(f.record_count for f in files) == 4 and all(f.file_size_in_bytes > 0 for f in files)


def test_log_is_in_commit_order(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.write(spark.range(1), committed_at=datetime(2024, 2, 1))
    table.write(spark.range(2), committed_at=datetime(2024, 1, 1))
    assert [r.operation for r in table.snapshots().collect()] == ["append", "overwrite"]
    assert table.read().count() == 2


def test_a_new_table_is_looked_at_without_a_failing_read(spark, tmp_path, capfd):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists() and table.snapshots().count() == 0
    table.write(spark.range(1))
    assert "PATH_NOT_FOUND" not in capfd.readouterr().err
    assert len(list((tmp_path / "t" / "log").glob("*.parquet"))) == 1


def test_target_size_is_for_clustered_writes_only(spark, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(versioned, "scoped_conf", lambda _, **options: asked.append(options) or contextlib.nullcontext())
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.write(spark.range(5))
    table.write(spark.range(5), ["id"])
    assert asked == [{}, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": versioned.TARGET_FILE_BYTES}]


def test_unreadable_values_are_counted_or_stop_the_job(spark):
    df = spark.createDataFrame([("7", "x"), ("bad", "y"), (None, "z")], "VendorID string, store_and_fwd_flag string")
    counts = {r.column: r.unreadable for r in readers.unreadable_counts(df).collect()}
    assert counts == {"VendorID": 1, "store_and_fwd_flag": 0}
    assert [r.VendorID for r in readers.conform(df).collect()] == [7, None, None]
    with pytest.raises(Exception, match="VendorID does not fit int: bad"):
        readers.conform(df, unreadable="error").collect()
    with pytest.raises(ValueError):
        readers.conform(df, unreadable="drop")


def test_lineage_and_declared_schema(spark, tmp_path):
    for month in (1, 2):
        spark.range(3).select(F.lit(month).alias("VendorID")).write.parquet(str(tmp_path / f"yellow_tripdata_{month}.parquet"))
    rows = readers.read_trips(spark, str(tmp_path), schema=TRIPS, lineage="file")
    assert rows.columns == [*TRIPS.names, "file"]
    assert all(f"yellow_tripdata_{r.VendorID}." in r.file and r.fare_amount is None for r in rows.collect())


def test_work_folders_can_be_removed(spark):
    path = session.work_folder(spark, "gone")
    spark.range(3).write.parquet(path)
    assert session.remove_folder(spark, path) and not session.remove_folder(spark, path)


def test_failed_write_leaves_no_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.write(spark.range(10))
    with pytest.raises(Exception, match="stop"):
        table.write(spark.range(10).withColumn("x", F.raise_error(F.lit("stop")).cast("int")))
    assert table.snapshots().count() == 1 and table.read().count() == 10


def test_empty_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.write(spark.range(0))
    assert table.read().count() == 0


def test_clustered_write_splits_a_hot_value(spark, tmp_path):
    hot = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id"))
    df = spark.range(0, 400_000, 1, 16).select(hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("t"))
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.write(df, cluster_by=["k"], target_bytes=2 * 1024 * 1024)
    with_hot = table.read().filter("k = 1").select(F.col("_metadata.file_path")).distinct().count()
    assert with_hot > 1
    assert table.read().count() == 400_000


def test_few_files_are_computed_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "files")
    task = F.udf(lambda _: TaskContext.get().partitionId(), "int")
    sinks.write_coalesced(spark.range(0, 100, 1, 5).withColumn("task", task("id")), path, 2)
    written = spark.read.parquet(path)
    assert written.select("task").distinct().count() == 5 and written.count() == 100
    assert sinks.list_files(written).count() == 2


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "files")
    sinks.write_parquet(spark.range(0, 100, 1, 5), path)
    assert sinks.list_files(spark.read.parquet(path)).count() == 5
    sinks.write_coalesced(spark.range(0, 100, 1, 5), path, 2)
    assert sinks.list_files(spark.read.parquet(path)).count() == 2
    assert sinks.run_fully(spark.range(10)) > 0
    for rows in (spark.range(10), spark.range(0), spark.range(10).filter("id > 10"), spark.range(10).join(spark.range(0), "id")):
        seconds, counted = sinks.run_counted(rows)
        assert seconds > 0 and counted == rows.count()


def test_tables(spark, tmp_path):
    sinks.create_namespace(spark, "sinks_test", str(tmp_path / "ns"))
    sinks.create_namespace(spark, "sinks_test")
    assert not sinks.table_exists(spark, "sinks_test.t")
    for rows in (3, 5):
        sinks.write_table(spark.range(rows), "sinks_test.t")
    assert spark.table("sinks_test.t").count() == 5
    sinks.drop_table(spark, "sinks_test.t")
    assert not sinks.table_exists(spark, "sinks_test.t")
    sinks.write_table(spark.range(1), "sinks_test.t", str(tmp_path / "t"))
    sinks.drop_namespace(spark, "sinks_test")
    assert not spark.catalog.databaseExists("sinks_test")


def test_jdbc_options():
    calls = {}

    class Writer:
        def jdbc(self, url, table, mode, properties):
            calls.update(url=url, table=table, mode=mode, properties=properties)

    class Frame:
        write = Writer()

    sinks.write_jdbc(Frame(), "jdbc:x", "raw.trips", {"user": "u"})
    assert calls["mode"] == "overwrite"
    assert calls["properties"] == {"user": "u", "batchsize": "50000", "numPartitions": "8"}


def test_scoped_conf_restores(spark):
    key, unset = "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError):
        with session.scoped_conf(spark, **{key: 3, unset: -1}):
            assert spark.conf.get(key) == "3"
            raise RuntimeError
    assert spark.conf.get(key) == before
    assert spark.conf.get(unset) != "-1"


def test_held_releases_after_an_error(spark):
    df = spark.range(5)
    with pytest.raises(RuntimeError):
        with session.held(df):
            assert df.is_cached and df.count() == 5
            raise RuntimeError
    assert not df.is_cached


def test_work_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = session.work_folder(spark, "x"), session.work_folder(spark, "x")
    assert one.startswith(base) and one != two


def test_cluster_without_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"
        applicationId = "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_folder(Session(), "x")
