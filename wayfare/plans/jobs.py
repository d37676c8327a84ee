"""The two batch jobs from files to finished tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators.checks import rank_check, rolling_check, run_checks
from wayfare.operators.cleaning import clean_trips, clean_trips_sql
from wayfare.operators.comparison import compare_rows
from wayfare.operators.joins import lookup_join, merge_join
from wayfare.operators.profile import partition_rows, partition_skew, schema_rows
from wayfare.operators.ranking import busiest_groups, rank_trips_by_fare
from wayfare.operators.rolling import rolling_trip_count
from wayfare.plans import reports, tuning
from wayfare.plans.warehouse import CHECKS, HISTORY_CHECKED, HISTORY_KEY, build_models, fact_trips, split_unfit
from wayfare.schemas import MIN_FARE, RAW, STAGED, ZONE_RANGE
from wayfare.sources.history_table import HistoryTable
from wayfare.sources.versioned import VersionedTable


def _write(spark: SparkSession, folder: str, df: DataFrame, written_at: datetime, cluster_by: list[str]) -> DataFrame:
    """Write a table in files of the target size, clustered by the columns it is read by."""
    table = VersionedTable(spark, folder)
    table.write(df, cluster_by, committed_at=written_at)
    return table.read()


def _file_report(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """Files, rows and bytes of the current version of each table."""
    return reports.combine(
        [
            reports.from_row(
                VersionedTable(spark, f"{folder}/{name}").files().agg(
                    F.count(F.lit(1)).alias("files"),
                    F.sum("record_count").alias("rows"),
                    F.sum("file_size_in_bytes").alias("bytes"),
                    F.max("file_size_in_bytes").alias("largest_file"),
                ),
                name,
            )
            for name in names
        ]
    )


def run_lakehouse(
    raw: DataFrame,
    zones: DataFrame,
    folder: str,
    min_fare: float = MIN_FARE,
    zone_range: tuple[int, int] = ZONE_RANGE,
    measure: bool = False,
) -> dict[str, DataFrame]:
    """Cleaned, ranked and rolling trip tables below ``folder``, and the reports of this run.

    The cleaned table is written once and read back, so the later steps start from files instead of repeating the
    deduplication. ``measure`` adds the timed comparisons, which run their queries several times.
    """
    spark, now = raw.sparkSession, datetime.now(timezone.utc)
    by_zone = [RAW.pickup_zone]
    cleaned = _write(spark, f"{folder}/trips_silver", clean_trips(raw, RAW, min_fare, zone_range), now, by_zone)
    ranked = _write(spark, f"{folder}/trips_gold", rank_trips_by_fare(cleaned), now, by_zone)
    rolling = _write(spark, f"{folder}/trips_gold_rolling_7d", rolling_trip_count(cleaned), now, by_zone)

    raw_rows, cleaned_rows = raw.count(), cleaned.count()
    dropped = (raw_rows - cleaned_rows) / raw_rows * 100 if raw_rows else None
    by_sql = clean_trips_sql(raw, cols=RAW, min_fare=min_fare, zones=zone_range)
    result = {
        "profile": reports.combine(
            [
                reports.from_row(partition_skew(raw), "partitions"),
                reports.from_pairs(partition_rows(raw), "rows_per_partition"),
                reports.from_schema(schema_rows(raw), "schema"),
                reports.from_values(
                    spark, "retention", {"raw": raw_rows, "cleaned": cleaned_rows, "dropped_pct": dropped}
                ),
            ]
        ),
        "equivalence": reports.combine(
            [
                reports.from_row(compare_rows(by_sql, cleaned), "sql_and_dataframe"),
                reports.from_values(
                    spark,
                    "plans",
                    {"sql": reports.plan_text(by_sql), "dataframe": reports.plan_text(clean_trips(raw, RAW, min_fare, zone_range))},
                ),
            ]
        ),
        "files": _file_report(spark, folder, ["trips_silver", "trips_gold", "trips_gold_rolling_7d"]),
        "windows": reports.combine(
            [
                reports.from_row(busiest_groups(cleaned), "busiest_group"),
                reports.from_row(_failures(rank_check(cleaned, ranked)), "rank"),
                reports.from_row(_failures(rolling_check(cleaned, rolling)), "rolling"),
            ]
        ),
    }
    if measure:
        on = F.col(RAW.pickup_zone) == F.col("LocationID")
        joined = {"broadcast": lookup_join(cleaned, zones, on), "merge": merge_join(cleaned, zones, on)}
        result["tuning"] = reports.combine(
            [
                tuning.compare_joins(cleaned, zones, on),
                reports.from_values(spark, "join_plans", {name: reports.plan_text(df) for name, df in joined.items()}),
                tuning.compare_shuffle_partitions(cleaned),
                tuning.compare_output_files(cleaned),
            ]
        )
    return {
        name: reports.write_report(report, f"{folder}/reports/{name}", name) for name, report in result.items()
    }


def _failures(check: DataFrame) -> DataFrame:
    return check.agg(F.count(F.lit(1)).alias("groups"), F.count_if(~F.col("ok")).alias("failures"))


def run_warehouse(
    raw_trips: DataFrame,
    raw_zones: DataFrame,
    folder: str,
    days: DataFrame | None = None,
    min_fare: float = MIN_FARE,
    zone_range: tuple[int, int] = ZONE_RANGE,
    as_of: datetime | None = None,
) -> DataFrame:
    """Write every model and the location history below ``folder`` and return the results of the declared checks.

    Raw rows with a value that its type can't hold are not staged but kept in ``stg_trips_unfit``.
    """
    spark, as_of = raw_trips.sparkSession, as_of or datetime.now(timezone.utc)
    fit, unfit = split_unfit(raw_trips)
    models = build_models(fit, raw_zones, days, min_fare, zone_range)
    staged = _write(spark, f"{folder}/stg_trips", models["stg_trips"], as_of, [STAGED.pickup_zone])
    VersionedTable(spark, f"{folder}/stg_trips_unfit").write(unfit, committed_at=as_of)
    models.update(stg_trips=staged, fact_trips=fact_trips(staged))
    keys = {"fact_trips": STAGED.pickup_zone}
    written = {
        name: staged if name == "stg_trips" else _write(spark, f"{folder}/{name}", model, as_of, [keys.get(name, model.columns[0])])
        for name, model in models.items()
    }
    update_history(written["dim_location"], f"{folder}/location_history", as_of)
    return run_checks(written, CHECKS)


def update_history(dimension: DataFrame, folder: str, as_of: datetime) -> DataFrame:
    """Bring the location history up to date and return it."""
    table = HistoryTable(dimension.sparkSession, folder, HISTORY_KEY, HISTORY_CHECKED)
    table.merge(dimension, as_of)
    return table.read()
