from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wayfare import functions as fn
from wayfare.functions.fingerprint import fingerprint, fingerprint_sql, resolve
from wayfare.plans import registry
from wayfare.plans.reports import plan_text
from wayfare.session import scoped_conf


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_durations(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 0, 900_000), datetime(2024, 1, 1, 0, 1, 0, 100_000))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    row = df.select(
        fn.duration_minutes_whole("a", "b").alias("whole"), fn.duration_minutes_exact("a", "b").alias("exact")
    ).first()
    assert row.whole == 1.0
    assert row.exact == 59_200_000 / 60_000_000.0


def test_initials(spark):
    names = [None, "", "A", "Ann", "Ann Bo", "Ann Bo Cy", "Ann ", " Bo"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert values(df, fn.initials("name")) == [None, ".", "A.", "A.", "A.B.", "A.B.", "A..", ".B."]


def test_varchar(spark):
    df = spark.createDataFrame([("YY",), ("N",), (None,)], "flag string")
    assert values(df, fn.varchar("flag", 1)) == ["Y", "N", None]


def test_derived_keys(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (2, None), (2, 0), (2, 5), (2, 7)], "vendor int, passengers bigint")
    rows = df.select(fn.rate_key("vendor", "passengers"), fn.payment_key("passengers")).collect()
    assert [tuple(r) for r in rows] == [(1, None), (1, 2), (None, None), (1, 1), (1, 2), (3, 2)]


def test_calendar_names(spark):
    df = spark.sql("select date'2024-05-05' as d")
    row = df.select(
        fn.month_name("d").alias("m"),
        fn.day_name("d").alias("n"),
        fn.sunday_based_weekday("d").alias("w"),
        fn.is_weekend("d").alias("e"),
    ).first()
    assert tuple(row) == ("May      ", "Sunday   ", 0, True)


SPEC = [("a", "str"), ("b", "int"), ("c", "dec"), ("t", "ts")]


def test_fingerprint_normalises(spark):
    schema = "a string, b double, c double, t timestamp_ntz"
    t, u = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 5)
    df = spark.createDataFrame([("x", 1.0, 2.5, t), ("x", 1.2, 2.501, u), ("x", 1.0, 2.51, t)], schema)
    first, same, other = values(df, fingerprint(df, SPEC))
    assert first == same != other
    text = F.concat_ws("||", F.lit("x"), F.lit("1"), F.lit("2.50"), F.lit("2024-01-01 00:00:00"))
    assert first == values(df, F.sha2(text, 256))[0]


def test_fingerprint_forms_agree(spark):
    df = spark.createDataFrame([("x", 1, 2.5), (None, 2, None)], "a string, b int, c double")
    df.createOrReplaceTempView("forms")
    for token in (None, "it's \\ null"):
        sql = spark.sql(f"select {fingerprint_sql(df, SPEC, token)} as f from forms")
        assert values(sql, F.col("f")) == values(df, fingerprint(df, SPEC, token))


def test_fingerprint_nulls(spark):
    df = spark.createDataFrame([(None, "1"), ("1", None)], "a string, d string")
    spec = [("a", "str"), ("d", "str")]
    assert len(set(values(df, fingerprint(df, spec)))) == 1
    assert len(set(values(df, fingerprint(df, spec, null_token="-")))) == 2


def test_values_beyond_their_kind_keep_rows_apart(spark):
    df = spark.createDataFrame([(1e15, "x"), (2e15, "x"), (None, "x"), (float("nan"), "x")], "c double, a string")
    assert len(set(values(df, fingerprint(df, [("c", "dec"), ("a", "str")])))) == 4
    texts = spark.createDataFrame([("one",), ("two",), ("3",), (None,)], "b string")
    assert len(set(values(texts, fingerprint(texts, [("b", "int")])))) == 4


def test_exact_duration_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 10, 1, 30), datetime(2024, 3, 10, 3, 30))], "a timestamp_ntz, b timestamp_ntz")
    with scoped_conf(spark, spark__sql__session__timeZone="America/New_York"):
        assert values(df, fn.duration_minutes_exact("a", "b")) == [120.0]
        assert values(df, fn.duration_minutes_whole("a", "b")) == [120.0]


def test_fingerprint_is_never_null(spark):
    df = spark.range(1).select(F.lit(None).cast("string").alias("a"))
    assert df.select(fingerprint(df, [("a", "str")]).alias("f")).schema["f"].nullable is False


def test_resolve_ignores_case_and_reports_missing(spark):
    df = spark.createDataFrame([(1, "x")], "vendorid int, A string")
    assert resolve(df, [("VendorID", "int"), ("a", "str"), ("z", "str")]) == [("vendorid", "int"), ("A", "str")]
    with pytest.raises(ValueError, match="z"):
        resolve(df, [("z", "str")], missing="error")


@pytest.mark.parametrize("query", [registry.trip_fingerprint, registry.trip_fingerprint_nullsafe])
def test_fingerprints_are_made_before_rows_are_copied(spark, query):
    plan = plan_text(query(spark, "/root/testdata/sf0.001"), "simple")
    assert 0 < plan.index("Generate ") < plan.index("sha2(")
