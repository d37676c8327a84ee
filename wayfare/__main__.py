"""Command line: ``spark-submit`` or ``python -m wayfare lakehouse|warehouse --trips DIR --zones CSV --out DIR``."""

from __future__ import annotations

import argparse

from wayfare import session
from wayfare.plans.jobs import run_lakehouse, run_warehouse
from wayfare.plans.reports import sample_text
from wayfare.schemas import TRIPS
from wayfare.sources.readers import TRIP_FILES, read_trips, read_zones


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="wayfare", description=__doc__)
    parser.add_argument("job", choices=["lakehouse", "warehouse"])
    parser.add_argument("--trips", required=True, help="folder with the monthly trip files")
    parser.add_argument("--pattern", default=TRIP_FILES)
    parser.add_argument("--zones", required=True, help="zone lookup CSV")
    parser.add_argument("--out", required=True, help="folder for tables and reports")
    parser.add_argument("--declared", action="store_true", help="read the files by the declared schema")
    parser.add_argument("--measure", action="store_true", help="add the timed comparisons")
    options = parser.parse_args(arguments)

    spark = session.build()
    trips = read_trips(spark, options.trips, options.pattern, TRIPS if options.declared else None)
    zones = read_zones(spark, options.zones)
    if options.job == "lakehouse":
        for name, report in run_lakehouse(trips, zones, options.out, measure=options.measure).items():
            print(name, sample_text(report, rows=100, truncate=100), sep="\n")
    else:
        print(sample_text(run_warehouse(trips, zones, options.out), rows=100, truncate=100))


if __name__ == "__main__":
    main()
