"""One key holds a third of the rows: what the executed plans do with it."""

import pytest
from pyspark.sql import functions as F

from wayfare import session
from wayfare.operators import cleaning, joins, ranking, rolling
from wayfare.plans.reports import plan_text

SMALL_LIMITS = {
    "spark.sql.shuffle.partitions": 32,
    "spark.sql.autoBroadcastJoinThreshold": -1,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Every third row: zone 161, one second, one fare."""
    hot = F.col("id") % 3 == 0
    path = str(tmp_path_factory.mktemp("skew") / "t")
    spark.range(0, 150_000, 1, 8).select(
        F.when(hot, 161).otherwise(F.col("id") % 263 + 1).cast("int").alias("PULocationID"),
        F.timestamp_seconds(1_704_067_200 + F.when(hot, 7).otherwise(F.col("id") * 17))
        .cast("timestamp_ntz")
        .alias("tpep_pickup_datetime"),
        F.when(hot, 52.0).otherwise(F.col("id") % 9973 / 100).alias("fare_amount"),
        F.when(hot, -1).otherwise(F.col("id")).alias("record"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        F.lit(1).alias("VendorID"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def executed_plan(df):
    df.collect()
    return plan_text(df, "simple").split("== Initial Plan ==")[0]


@pytest.mark.parametrize(
    "build",
    [
        ranking.rank_trips_by_fare,
        rolling.rolling_trip_count,
        lambda df: joins.merge_join(
            df, df.sparkSession.range(300).withColumnRenamed("id", "zone"), F.col("PULocationID") == F.col("zone")
        ),
    ],
    ids=["rank", "rolling", "merge_join"],
)
def test_hot_join_partitions_are_split(spark, skewed, build):
    with session.scoped_conf(spark, **SMALL_LIMITS):
        plan = executed_plan(build(skewed))
    assert "skew=true" in plan


def test_windows_never_see_the_rows_of_a_hot_group(spark, skewed):
    """The largest window partition is bounded by distinct values, not by the 50,000 rows of the hot zone."""
    hourly = skewed.withColumn(ranking.HOUR, F.hour("tpep_pickup_datetime"))
    ranks = ranking.value_ranks(hourly, ["PULocationID", ranking.HOUR], "fare_amount")
    assert ranks.groupBy("PULocationID", ranking.HOUR).count().agg(F.max("count")).first()[0] < 100
    for plan in (plan_text(ranking.rank_trips_by_fare(skewed), "simple"), plan_text(rolling.rolling_trip_count(skewed), "simple")):
        for part in plan.split("Window [")[1:]:
            assert "HashAggregate" in part, "a window must sit on counted or distinct rows"


def test_copies_reach_the_final_task_once_per_input_partition(spark, skewed):
    kept = cleaning.keep_first(skewed, ["record"])
    assert kept.count() == 100_001
    assert plan_text(kept, "simple").count("WindowGroupLimit") == 2
