import pytest
from pyspark.sql import functions as F

from wayfare.functions import fingerprint
from wayfare.operators import joins
from wayfare.plans import registry
from wayfare.plans.reports import assert_plan_contains, plan_text


@pytest.fixture
def fact(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (9, "d"), (None, "e")], "k int, v string")


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "key int, name string")


@pytest.fixture
def jobs_run(spark):
    """How many jobs of this test have been started so far."""
    spark.sparkContext.setJobGroup("joins", "joins")
    yield lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("joins"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_job_runs_before_the_action(spark, fact, lookup, jobs_run, tmp_path):
    lookup.write.parquet(str(tmp_path / "lookup"))
    stored = spark.read.parquet(str(tmp_path / "lookup"))
    before = jobs_run()
    computed = stored.groupBy("key").agg(F.max("name").alias("name"))
    joined = joins.lookup_join(fact, computed, fact.k == computed.key)
    starred = joins.star_lookup(fact, [joins.Dimension(computed, "k", "key", "a"), joins.Dimension(stored, "k", "key", "b")])
    plan_text(joined), plan_text(starred)
    assert jobs_run() == before
    assert joined.count() == 3 and starred.count() == 5 and jobs_run() > before


def executed(df):
    rows = df.collect()
    return plan_text(df, "simple").split("== Initial Plan ==")[0], rows


def test_the_size_met_at_run_time_decides(spark, fact):
    """A computed lookup whose size can't be foretold: small enough it is broadcast, else not, in the same plan."""
    lookup = spark.range(3000).selectExpr("id % 40 as key", "sha2(string(id), 256) as name").groupBy("key").agg(F.max("name").alias("name"))
    build = lambda: joins.lookup_join(fact, lookup, fact.k == lookup.key)
    plans = {}
    for size in ("1MB", "100"):
        with joins.broadcast_limit(spark, size):
            plans[size], rows = executed(build())
            assert len(rows) == 4
    assert "BroadcastHashJoin" in plans["1MB"] and "Broadcast" not in plans["100"]


def test_a_stored_lookup_is_broadcast_without_a_shuffle(spark, fact, tmp_path):
    spark.range(50).selectExpr("id as key", "string(id) as name").write.parquet(str(tmp_path / "l"))
    lookup = spark.read.parquet(str(tmp_path / "l"))
    joined = joins.lookup_join(fact, lookup, fact.k == lookup.key)
    assert_plan_contains(joined, "BroadcastHashJoin")
    assert "Exchange hashpartitioning" not in plan_text(joined, "simple")


def test_merge_join(fact, lookup):
    merged = joins.merge_join(fact, lookup, fact.k == lookup.key)
    assert_plan_contains(merged, "SortMergeJoin")
    assert merged.count() == 3
    with pytest.raises(AssertionError):
        assert_plan_contains(merged, "BroadcastHashJoin")


def test_join_null_safe(spark, fact):
    other = spark.createDataFrame([(1, 10), (None, 20)], "k int, w int")
    rows = joins.join_null_safe(fact, other, ["k"], "left").collect()
    assert {(r.v, r.w) for r in rows} == {("a", 10), ("b", 10), ("c", None), ("d", None), ("e", 20)}


def test_orphans(fact, lookup):
    assert [tuple(r) for r in joins.orphans(fact, "k", lookup, "key").collect()] == [(9, 1)]


def test_match_fingerprints(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",)], "trip_fingerprint string")
    right = spark.createDataFrame([("b",), ("c",)], "trip_fingerprint string")
    rows = {tuple(r) for r in joins.match_fingerprints(left, right).collect()}
    assert rows == {("left_only", 1, 2, 0), ("matched", 1, 1, 1), ("right_only", 1, 0, 1)}
    assert joins.join_on_fingerprint(left, right, "full_outer").count() == 4


def test_star_lookup_keeps_unknown_keys(fact, lookup):
    dimension = joins.Dimension(lookup, "k", "key", "num")
    rows = joins.star_lookup(fact, [dimension]).collect()
    assert {(r.v, r.num_name) for r in rows} == {("a", "one"), ("b", "one"), ("c", "two"), ("d", None), ("e", None)}


@pytest.mark.parametrize("query", [registry.join_fingerprint, registry.match_fingerprints])
def test_fingerprints_are_shuffled_as_bytes(spark, query):
    plan = plan_text(query(spark, "/root/testdata/sf0.001"), "simple")
    assert plan.count("unhex(sha2(") == plan.count("sha2(") > 0


def test_binary_fingerprints_are_the_same_hashes(spark):
    df = spark.createDataFrame([(1, 2.5), (None, 2.5), (None, None)], "VendorID int, fare_amount double")
    both = df.select(fingerprint(df).alias("t"), F.lower(F.hex(fingerprint(df, binary=True))).alias("b"))
    assert both.filter("t <> b").count() == 0 and both.select("t").distinct().count() == 3
