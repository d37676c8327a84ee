from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wayfare.operators import checks, comparison, profile
from wayfare.plans import registry, warehouse
from wayfare.plans.reports import plan_text
from wayfare.session import scoped_conf


def test_declared_checks_are_complete():
    kinds = [c.kind for c in warehouse.CHECKS]
    assert (kinds.count("unique"), kinds.count("not_null"), kinds.count("relationships")) == (7, 15, 5)


def test_run_checks_finds_each_fault(spark):
    child = spark.createDataFrame([("a", 1), ("a", 2), ("b", 9), (None, None), ("c", 9)], "id string, ref int")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "pk bigint")
    declared = [
        *checks.unique("child", "id"),
        *checks.not_null("child", "id", "ref"),
        *checks.relationship("child", "ref", "parent", "pk"),
        *checks.unique("parent", "pk"),
    ]
    result = checks.run_checks({"child": child, "parent": parent}, declared).collect()
    assert {tuple(r) for r in result} == {
        ("child", "id", "unique", 1),
        ("child", "id", "not_null", 1),
        ("child", "ref", "not_null", 1),
        ("child", "ref", "relationships", 2),
        ("parent", "pk", "unique", 1),
    }


def test_relationships_use_a_common_type_and_their_own_parent(spark):
    child = spark.createDataFrame([(1.0, 1), (2.0, 2), (2.0, 9)], "ref double, both int")
    one, two = (spark.createDataFrame([(i,) for i in ids], "pk int") for ids in ([1, 2], [1, 2, 9]))
    text = spark.createDataFrame([("1",), ("2",), ("x",)], "pk string")
    declared = [
        *checks.relationship("child", "ref", "one", "pk"),
        *checks.relationship("child", "both", "one", "pk"),
        *checks.relationship("child", "both", "two", "pk"),
        *checks.relationship("child", "both", "text", "pk"),
    ]
    result = checks.run_checks({"child": child, "one": one, "two": two, "text": text}, declared).collect()
    assert [r.failures for r in result] == [0, 1, 0, 1]


def test_each_model_is_read_and_shuffled_once(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 7 as ref", "id as x").write.parquet(str(tmp_path / "c"))
    spark.range(7).selectExpr("id as pk", "id as up").write.parquet(str(tmp_path / "p"))
    child, parent = spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "p"))
    declared = [
        *checks.not_null("c", "id", "ref", "x"),
        *checks.unique("c", "id"),
        *checks.relationship("c", "ref", "p", "pk"),
        *checks.relationship("c", "x", "p", "up"),
        *checks.unique("p", "pk"),
    ]
    result = checks.run_checks({"c": child, "p": parent}, declared)
    plan = plan_text(result, "simple")
    assert plan.count("FileScan") == 2  # one for each model
    # one exchange of counts for all models together, one of the few settled checks
    assert plan.count("Exchange hashpartitioning(number") == plan.count("Exchange hashpartitioning") == 2
    assert plan.index("HashAggregate(keys=[number") < plan.index("Union")
    assert [r.failures for r in result.collect()] == [0, 0, 0, 0, 0, 93, 0]


def test_a_hot_key_is_counted_before_the_shuffle(spark, tmp_path):
    spark.range(0, 60_000, 1, 4).selectExpr("if(id % 3 = 0, 7, id) as ref").write.parquet(str(tmp_path / "c"))
    child, parent = spark.read.parquet(str(tmp_path / "c")), spark.range(0, 60_000, 2).withColumnRenamed("id", "pk")
    result = checks.run_checks({"c": child, "p": parent}, [*checks.relationship("c", "ref", "p", "pk"), *checks.unique("c", "ref")])
    assert [r.failures for r in result.collect()] == [20_000 + 20_000, 1]
    shuffled = plan_text(result, "formatted")
    assert "partial_sum(child" in shuffled


def test_keys_that_look_alike_as_text_are_told_apart_by_their_type(spark):
    rows = spark.sql("select * from values (0.0D, X'FF'), (-0.0D, X'FE'), (1.5D, X'FF') as t(d, b)")
    declared = [*checks.unique("m", "d"), *checks.unique("m", "b"), *checks.relationship("m", "d", "n", "k")]
    whole = spark.sql("select * from values (0L), (1L) as t(k)")
    assert [r.failures for r in checks.run_checks({"m": rows, "n": whole}, declared).collect()] == [1, 1, 1]


def test_empty_model_fails_nothing(spark):
    empty = spark.createDataFrame([], "id int")
    result = checks.run_checks({"m": empty}, [*checks.unique("m", "id"), *checks.not_null("m", "id")]).collect()
    assert [r.failures for r in result] == [0, 0]


def test_single_checks(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (None, 3), (None, None)], "a int, b int")
    assert [tuple(r) for r in checks.duplicate_keys(df, "a").collect()] == [(1, 2)]
    assert tuple(checks.null_counts(df, ["a", "b"]).first()) == (2, 2)


def test_comparison(spark):
    left = spark.createDataFrame([(1, "a", 0), (1, "a", 0), (2, None, 0)], "x int, y string, z int")
    right = spark.createDataFrame([("a", 1), (None, 2), (None, 2)], "y string, x int")
    assert comparison.common_columns(left, right) == ["x", "y"]
    assert tuple(comparison.compare_rows(left, right).first()) == (3, 3, 1, 1, False)
    assert {tuple(r) for r in comparison.row_differences(left, right).collect()} == {(1, "a", 2, 1), (2, None, 1, 2)}
    assert [tuple(r) for r in comparison.missing_rows(left, right).collect()] == [(1, "a")]
    empty = left.limit(0)
    assert tuple(comparison.compare_rows(empty, empty).first()) == (0, 0, 0, 0, True)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(*[st.lists(st.tuples(st.sampled_from([1, 2, None]), st.sampled_from(["a", None])), max_size=12)] * 2)
def test_comparison_properties(spark, a, b):
    left, right = (spark.createDataFrame(rows, "x int, y string") for rows in (a, b))
    forth, back = (comparison.compare_rows(*p).first() for p in ((left, right), (right, left)))
    assert (forth.left_only, forth.right_only) == (back.right_only, back.left_only)
    assert forth.left_only == comparison.missing_rows(left, right).count()
    assert forth.identical == back.identical == (sorted(map(repr, a)) == sorted(map(repr, b)))


def test_partition_skew(spark):
    df = spark.range(0, 400, 1, 4).filter("id >= 300")
    assert {tuple(r) for r in profile.partition_rows(df).collect()} == {(0, 0), (1, 0), (2, 0), (3, 100)}
    assert profile.partition_skew(df).first().asDict() == {
        "total_rows": 100,
        "partitions": 4,
        "populated_partitions": 1,
        "empty_partitions": 3,
        "min_rows": 0,
        "max_rows": 100,
        "avg_rows": 25.0,
        "avg_rows_populated": 100.0,
        "skew_ratio": 4.0,
    }


def test_partition_rows_behind_an_adaptive_shuffle(spark):
    df = spark.range(0, 200_000, 1, 8).selectExpr("id", "id % 1000 as k", "sha2(string(id), 256) as t").repartition(F.col("k"))
    settings = {"spark.sql.shuffle.partitions": 48, "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB"}
    with scoped_conf(spark, **settings, **{"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}):
        made = sorted(r[1] for r in df.rdd.mapPartitionsWithIndex(lambda i, rows: [(i, sum(1 for _ in rows))]).collect())
        rows = sorted(r.rows for r in profile.partition_rows(df).collect())
    assert sum(rows) == 200_000 and rows == made and len(rows) > 4


def test_a_scan_is_counted_without_its_columns(spark, tmp_path):
    spark.range(0, 900, 1, 3).selectExpr("id", "sha2(string(id), 256) as t").write.parquet(str(tmp_path / "t"))
    rows = profile.partition_rows(spark.read.parquet(str(tmp_path / "t")))
    assert "ReadSchema: struct<>" in plan_text(rows) and sum(r.rows for r in rows.collect()) == 900


def test_rows_placed_by_construction(spark):
    df = spark.range(100).withColumn("t", F.lit("x")).repartitionById(6, F.when(F.col("id") < 90, 3).otherwise(1))
    assert {tuple(r) for r in profile.partition_rows(df).collect()} == {(0, 0), (1, 10), (2, 0), (3, 90)}


def test_rows_placed_by_construction_move_without_their_other_columns(spark, tmp_path):
    spark.range(0, 900, 1, 3).selectExpr("id", "id % 7 as k", "sha2(string(id), 256) as t").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    by_key = df.repartitionById(9, F.col("k").cast("int"))
    assert "ReadSchema: struct<k:bigint>" in plan_text(profile.partition_rows(by_key))
    dealt = [by_key, df.repartition(5), df.repartition(5, "k"), df.repartition(5, "k").filter("id > 10").withColumn("u", F.upper("t"))]
    for rows in [*dealt, df.repartition(5, "k").coalesce(2)]:
        made = rows.rdd.mapPartitionsWithIndex(lambda i, part: [(i, sum(1 for _ in part))]).filter(lambda r: r[1]).collect()
        counted = {(r.partition_id, r.rows) for r in profile.partition_rows(rows).collect() if r.rows}
        assert profile.placed(rows) and counted == set(made)
    for rows in (df, df.repartition("k"), df.join(df.repartition(5, "k"), "k"), df.repartition(5, "k").union(df)):
        assert not profile.placed(rows)


def test_rows_dealt_in_turn_keep_the_columns_that_order_them(spark, tmp_path):
    spark.range(0, 900, 1, 3).selectExpr("id", "sha2(string(id), 256) as t", "sequence(0, id % 50) as a").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    listed, grouped = df.repartition(5).select("id", "t", F.explode("a")), df.groupBy("id").agg(F.max("t").alias("t")).repartition(5)
    adaptive = "spark.sql.adaptive."
    settings = {adaptive + "advisoryPartitionSizeInBytes": "16KB", adaptive + "coalescePartitions.minPartitionSize": "1KB"}
    with scoped_conf(spark, **settings, **{adaptive + "coalescePartitions.parallelismFirst": "false"}):
        for rows in (listed, grouped):
            made = rows.rdd.mapPartitionsWithIndex(lambda i, part: [(i, sum(1 for _ in part))]).collect()
            assert [tuple(r) for r in profile.partition_rows(rows).orderBy("partition_id").collect()] == sorted(made)
            assert not profile.placed(rows)
        assert profile.placed(df.repartition(5)) and profile.placed(df.repartition(5, "t").select("id", F.explode("a")))


def test_data_profile_moves_only_the_line_number(spark):
    rows = registry.data_profile(spark, "/root/testdata/sf0.001")
    assert "ReadSchema: struct<l_linenumber:int>" in plan_text(rows)


def test_schema_rows(spark):
    rows = profile.schema_rows(spark.range(1).selectExpr("id", "string(null) as s")).collect()
    assert [tuple(r) for r in rows] == [(0, "id", "bigint", False), (1, "s", "string", True)]
