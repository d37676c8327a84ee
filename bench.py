"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder and ``BENCH_CPUS`` the number of cores. Every query runs once uncounted; its
time is the mean of the runs after that, each executed fully into Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare import session
from wayfare.operators.ranking import pair_counts
from wayfare.plans import registry
from wayfare.sources.sinks import run_fully

HEADLINES = [
    "trip_filter",
    "trip_fingerprint",
    "clean_trips",
    "clean_trips_sql",
    "retention_rate",
    "dedup_ordered",
    "fare_dense_rank",
    "top_fare_per_group",
    "busiest_group",
    "rolling_7d_trips",
    "pair_counts",
    "join_broadcast_zone",
    "join_merge_zone",
    "match_fingerprints",
    "star_lookup",
    "stg_trips",
    "fact_trips",
    "row_diff",
    "check_relationships",
    "declared_checks",
    "scd2_history",
    "versioned_overwrite",
]
RUNS = 2
# the published comparison: the two-zone count over this many cached rows of 263 zones, with many and with few partitions
PUBLISHED_ROWS, PUBLISHED_ZONES = 5_828_220, 263


def published_trips(trips: DataFrame) -> DataFrame:
    """The test trips, repeated up to the published number of rows, their places folded into the published zones."""
    copies = -(-PUBLISHED_ROWS // max(trips.count(), 1))
    repeated = trips.select("VendorID", "PULocationID", "DOLocationID", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("n"))
    zone = lambda c, step: (F.pmod(F.col(c) + F.col("n") * step, F.lit(PUBLISHED_ZONES)) + 1).alias(c)
    return repeated.select("VendorID", zone("PULocationID", 7), zone("DOLocationID", 13)).limit(PUBLISHED_ROWS)


def measure(build) -> float:
    """Seconds to build and execute a query; some queries write tables while they are built."""
    run_fully(build())
    start = time.perf_counter()
    for _ in range(RUNS):
        run_fully(build())
    return round((time.perf_counter() - start) / RUNS, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="bench-")
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": work,
    }
    spark = session.build("wayfare-bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")

    times = {name: measure(lambda q=registry.QUERIES[name]: q(spark, folder)) for name in HEADLINES}

    trips = registry.trips(spark, folder)
    for name, rows in (("cached_pair_counts", trips), ("published_pair_counts", published_trips(trips).repartition(int(cpus)))):
        with session.held(rows) as cached:
            for partitions in sorted({200, 24, int(cpus)}, reverse=True):
                fixed = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": partitions}
                with session.scoped_conf(spark, **fixed):
                    times[f"{name}_{partitions}"] = measure(lambda: pair_counts(cached))
    session.remove_folder(spark, work)
    spark.stop()

    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
