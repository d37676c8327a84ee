"""Side-by-side measurements of join strategies, shuffle partition counts and output files."""

from __future__ import annotations

import time
from collections.abc import Callable
from math import ceil
from statistics import mean

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators.joins import lookup_join, merge_join
from wayfare.operators.ranking import pair_counts
from wayfare.plans.reports import from_values, plan_text
from wayfare.schemas import RAW, TripColumns
from wayfare.session import scoped_conf, work_folder
from wayfare.sources.sinks import list_files, run_counted, run_fully, write_coalesced, write_parquet


def timed_runs(build: Callable[[], DataFrame], runs: int) -> tuple[list[float], int]:
    """Seconds of ``runs`` executions after one that is not timed, and the rows that came out of that one."""
    _, rows = run_counted(build())
    return [run_fully(build()) for _ in range(runs)], rows


def _saving(before: float, after: float) -> float:
    """By how many percent ``after`` is less than ``before``."""
    return (before - after) / before * 100


# That one task counts. A task's table of pairs takes some hundred bytes a pair, so this bounds it at a few hundred MB.
ROWS_PER_TASK = 2_000_000


def _share(df: DataFrame, tasks: int, rows_per_task: int) -> int:
    """By how much to multiply ``tasks`` for each to count ``rows_per_task`` rows of ``df`` at most, on average."""
    return max(1, ceil(df.count() / (tasks * rows_per_task)))


def _counting(spark: SparkSession, partitions: int, fewest: int) -> dict[str, object]:
    """Settings for a count in so many partitions, of a table that is scanned in ``fewest`` pieces or more."""
    scans = int(spark.conf.get("spark.sql.files.minPartitionNum", None) or spark.sparkContext.defaultParallelism)
    return {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.files.minPartitionNum": max(scans, fewest),
    }


def compare_joins(fact: DataFrame, lookup: DataFrame, on: Column | str, runs: int = 2) -> DataFrame:
    """Broadcast against sort-merge join: whether each plan has its operator, rows, run times and saving."""
    spark = fact.sparkSession
    broadcast = lookup_join(fact, lookup, on)
    values: dict[str, object] = {"broadcast_in_plan": "BroadcastHashJoin" in plan_text(broadcast)}
    by_broadcast, values["broadcast_rows"] = timed_runs(lambda: broadcast, runs)
    with scoped_conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": -1}):
        merge = merge_join(fact, lookup, on)
        values["sort_merge_in_plan"] = "SortMergeJoin" in plan_text(merge)
        by_merge, values["sort_merge_rows"] = timed_runs(lambda: merge, runs)
    values.update({f"broadcast_run_{i}": t for i, t in enumerate(by_broadcast, 1)})
    values.update({f"sort_merge_run_{i}": t for i, t in enumerate(by_merge, 1)})
    values.update(broadcast_mean=mean(by_broadcast), sort_merge_mean=mean(by_merge))
    values["broadcast_saving_pct"] = _saving(mean(by_merge), mean(by_broadcast))
    return from_values(spark, "join_strategy", values)


def compare_shuffle_partitions(
    df: DataFrame,
    cols: TripColumns = RAW,
    default: int = 200,
    tuned: int | None = None,
    runs: int = 3,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The two-zone count with the default and with a tuned number of shuffle partitions.

    Adaptive execution is off meanwhile, as it would choose the number itself. Both numbers are multiplied alike for
    a table with more than ``rows_per_task`` rows for each of the fewer partitions; the report has those used.
    """
    spark = df.sparkSession
    tuned = tuned or max(spark.sparkContext.defaultParallelism, 2)
    share = _share(df, min(default, tuned), rows_per_task)
    default, tuned = default * share, tuned * share
    values: dict[str, object] = {"default_partitions": default, "tuned_partitions": tuned}
    means = {}
    for label, partitions in (("default", default), ("tuned", tuned)):
        with scoped_conf(spark, **_counting(spark, partitions, min(default, tuned))):
            seconds, values[f"{label}_rows"] = timed_runs(lambda: pair_counts(df, cols), runs)
        means[label] = mean(seconds)
        values.update({f"{label}_run_{i}": t for i, t in enumerate(seconds, 1)})
        values[f"{label}_mean"] = means[label]
    values["saving_pct"] = _saving(means["default"], means["tuned"])
    return from_values(spark, "shuffle_partitions", values)


def compare_output_files(
    df: DataFrame,
    cols: TripColumns = RAW,
    partitions: int | None = None,
    files: int = 2,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Files, rows in them and write time of the two-zone count as partitioned and coalesced.

    ``partitions`` is multiplied for a table with more than ``rows_per_task`` rows for each.
    """
    spark = df.sparkSession
    folder = work_folder(spark, "output-files")
    values: dict[str, object] = {}
    partitions = partitions or max(spark.sparkContext.defaultParallelism, 2)
    partitions *= _share(df, partitions, rows_per_task)
    sinks = {"plain": write_parquet, "coalesced": lambda rows, path: write_coalesced(rows, path, files)}
    with scoped_conf(spark, **_counting(spark, partitions, partitions)):
        for label, sink in sinks.items():
            start = time.perf_counter()
            sink(pair_counts(df, cols), f"{folder}/{label}")
            values[f"{label}_seconds"] = time.perf_counter() - start
            written = list_files(spark.read.parquet(f"{folder}/{label}")).agg(F.count(F.lit(1)), F.sum("record_count"))
            values[f"{label}_files"], values[f"{label}_rows"] = written.first()
    return from_values(spark, "output_files", values)
