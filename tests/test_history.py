from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wayfare.operators import history
from wayfare.operators.comparison import compare_rows
from wayfare.plans.jobs import update_history
from wayfare.plans.reports import plan_text
from wayfare.sources import history_table
from wayfare.sources.history_table import HistoryTable

SCHEMA = "location_id int, borough string, zone_name string, service_zone string"
CHECKED = ["borough", "zone_name", "service_zone"]
DAYS = [datetime(2024, 1, d) for d in range(1, 10)]


def merge(old, source, day):
    return history.merge_history(old, source, "location_id", CHECKED, day)


def test_merge_rules(spark):
    first = spark.createDataFrame(
        [(1, "B", "same", "s"), (2, "B", "old", "s"), (3, "B", None, "s"), (4, "B", "gone", "s")], SCHEMA
    )
    second = spark.createDataFrame(
        [(1, "B", "same", "s"), (2, "B", "new", "s"), (3, "B", "value", "s"), (5, "B", "added", None)], SCHEMA
    )
    result = merge(history.start_history(first, DAYS[0]), second, DAYS[1])
    rows = {(r.location_id, r.zone_name, r.valid_from, r.valid_to) for r in result.collect()}
    assert rows == {
        (1, "same", DAYS[0], None),
        (2, "old", DAYS[0], DAYS[1]),
        (2, "new", DAYS[1], None),
        (3, None, DAYS[0], DAYS[1]),
        (3, "value", DAYS[1], None),
        (4, "gone", DAYS[0], None),
        (5, "added", DAYS[1], None),
    }
    assert compare_rows(result, merge(result, second, DAYS[2])).first().left_only == 0
    assert {tuple(r) for r in history.changed_keys(result, "location_id").collect()} == {(2, 2), (3, 2)}
    assert [r.zone_name for r in history.versions_of(result, "location_id", 2).collect()] == ["old", "new"]


def test_each_merge_reads_the_history_once(spark, tmp_path):
    spark.createDataFrame([(1, "B", "x", "s")], SCHEMA).write.parquet(str(tmp_path / "z"))
    source = spark.read.parquet(str(tmp_path / "z"))
    result, scans = history.start_history(source, DAYS[0]), []
    for day in DAYS[1:6]:
        result = merge(result, source, day)
        scans.append(plan_text(result, "simple").count("FileScan"))
    assert scans == [2, 3, 4, 5, 6]
    assert result.count() == 1


def test_closed_rows_stay_and_null_keys_never_match(spark):
    first = spark.createDataFrame([(1, "B", "a", "s"), (None, "B", "n", "s")], SCHEMA)
    second = spark.createDataFrame([(1, "B", "b", "s")], SCHEMA)
    result = merge(merge(history.start_history(first, DAYS[0]), second, DAYS[1]), first.filter("location_id = 1"), DAYS[2])
    rows = sorted(((r.location_id, r.zone_name, r.valid_from, r.valid_to) for r in result.collect()), key=str)
    expected = [(1, "a", DAYS[0], DAYS[1]), (1, "b", DAYS[1], DAYS[2]), (1, "a", DAYS[2], None), (None, "n", DAYS[0], None)]
    assert rows == sorted(expected, key=str)


states = st.dictionaries(st.integers(1, 4), st.sampled_from(["x", "y", None]), max_size=4)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(states, min_size=1, max_size=4))
def test_history_is_well_formed(spark, runs):
    def table(state):
        return spark.createDataFrame([(k, "B", v, "s") for k, v in state.items()], SCHEMA)

    result = history.start_history(table(runs[0]), DAYS[0])
    for day, state in zip(DAYS[1:], runs[1:]):
        result = merge(result, table(state), day)
    found = history.history_violations(result, "location_id").first()
    seen = {k for state in runs for k in state}
    assert tuple(found) == (len(seen), 0, 0, 0)
    current = {r.location_id: r.zone_name for r in result.filter("valid_to is null").collect()}
    expected = {}
    for state in runs:
        expected.update(state)
    assert current == expected


def test_violations_are_found(spark):
    rows = [
        (1, DAYS[0], None),
        (1, DAYS[1], None),
        (2, DAYS[0], DAYS[1]),
        (3, DAYS[0], DAYS[1]),
        (3, DAYS[2], None),
        (4, DAYS[3], DAYS[2]),
        (4, DAYS[5], None),
    ]
    df = spark.createDataFrame(rows, "k int, valid_from timestamp, valid_to timestamp")
    assert tuple(history.history_violations(df, "k").first()) == (4, 2, 1, 3)


def test_update_and_lookup(spark):
    df = spark.createDataFrame([(5, "Zone 5"), (6, "Zone 6"), (None, "none")], "LocationID int, Zone string")
    changed = history.update_rows(df, F.col("LocationID") == 5, Zone="Zone 5 Updated")
    assert history.find_row(changed, "LocationID", 5).Zone == "Zone 5 Updated"
    assert history.find_row(changed, "LocationID", 6).Zone == "Zone 6"
    assert changed.filter("LocationID is null").first().Zone == "none"
    assert changed.schema == df.schema
    with pytest.raises(LookupError):
        history.find_row(df, "LocationID", 7)


def test_update_history_end_to_end(spark, tmp_path):
    folder = str(tmp_path / "history")
    base = spark.createDataFrame([(5, "SI", "Zone 5", "s"), (6, "SI", "Zone 6", "s")], SCHEMA)
    update_history(base, folder, DAYS[0])
    renamed = history.update_rows(base, F.col("location_id") == 5, zone_name="Zone 5 Updated")
    update_history(renamed, folder, DAYS[1])
    result = update_history(renamed, folder, DAYS[2])
    versions = history.versions_of(result, "location_id", 5).collect()
    assert [(v.zone_name, v.valid_from, v.valid_to) for v in versions] == [
        ("Zone 5", DAYS[0], DAYS[1]),
        ("Zone 5 Updated", DAYS[1], None),
    ]
    assert result.count() == 3


def table_of(spark, tmp_path):
    return HistoryTable(spark, str(tmp_path / "history"), "location_id", CHECKED)


def rows_of(table):
    return sorted(((r.location_id, r.zone_name, r.valid_from, r.valid_to) for r in table.read().collect()), key=str)


def state(spark, values):
    return spark.createDataFrame([(k, "B", v, "s") for k, v in values.items()], SCHEMA)


def test_table_like_the_merged_frame(spark, tmp_path):
    table, frame = table_of(spark, tmp_path), None
    for day, values in zip(DAYS, ({1: "a", 2: "b"}, {1: "a", 2: "c", 3: None}, {2: "b", 3: "d"}, {1: "x", 2: "b", 3: None})):
        table.merge(state(spark, values), day)
        frame = merge(frame, state(spark, values), day) if frame else history.start_history(state(spark, values), day)
        expected = sorted(((r.location_id, r.zone_name, r.valid_from, r.valid_to) for r in frame.collect()), key=str)
        assert rows_of(table) == expected
        before = rows_of(table)
        table.merge(state(spark, values), day)  # again at the same instant
        assert rows_of(table) == before
    assert tuple(history.history_violations(table.read(), "location_id").first()) == (3, 0, 0, 0)


def test_a_merge_neither_reads_nor_writes_closed_rows(spark, tmp_path):
    table = table_of(spark, tmp_path)
    for day, name in zip(DAYS[:3], "abc"):
        table.merge(state(spark, {1: name, 2: "same"}), day)
    closed = {p: p.stat().st_mtime_ns for p in (tmp_path / "history").glob("period=closed*/*.parquet")}
    assert len(closed) == 2
    plan = plan_text(merge(table.current(), state(spark, {1: "d"}), DAYS[3]))
    assert plan.count("PartitionFilters: [isnotnull(period") == 1 and "(period#" in plan and "= open" in plan
    table.merge(state(spark, {1: "d", 2: "same"}), DAYS[3])
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "history").glob("period=closed*/*.parquet")}
    assert closed.items() <= after.items() and len(after) == 3


def test_a_merge_that_was_cut_off_can_be_run_again(spark, tmp_path, monkeypatch):
    table = table_of(spark, tmp_path)
    table.merge(state(spark, {1: "a", 2: "b"}), DAYS[0])
    write = HistoryTable._write

    def closed_only(self, rows, period):
        if period == history_table.OPEN:
            raise RuntimeError("lost")
        write(self, rows, period)

    monkeypatch.setattr(HistoryTable, "_write", closed_only)
    with pytest.raises(RuntimeError):
        table.merge(state(spark, {1: "z", 2: "b"}), DAYS[1])
    monkeypatch.setattr(HistoryTable, "_write", write)
    table.merge(state(spark, {1: "z", 2: "b"}), DAYS[1])
    assert rows_of(table) == sorted([(1, "a", DAYS[0], DAYS[1]), (1, "z", DAYS[1], None), (2, "b", DAYS[0], None)], key=str)


def test_two_states_at_one_instant(spark, tmp_path):
    table = table_of(spark, tmp_path)
    table.merge(state(spark, {1: "a", 2: "b"}), DAYS[0])
    table.merge(state(spark, {1: "x", 2: "b"}), DAYS[1])
    table.merge(state(spark, {1: "y", 2: "c"}), DAYS[1])  # 1 is corrected, 2 changes too
    assert rows_of(table) == sorted(
        [(1, "a", DAYS[0], DAYS[1]), (1, "y", DAYS[1], None), (2, "b", DAYS[0], DAYS[1]), (2, "c", DAYS[1], None)], key=str
    )
    with pytest.raises(ValueError, match="open since"):
        table.merge(state(spark, {1: "q"}), DAYS[0])
