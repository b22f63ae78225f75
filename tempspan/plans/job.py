"""The batch job: observation files in, wave periods out.

    spark-submit tempspan/plans/job.py --data-dir DIR [--mode heatwaves|coldwaves|both]
        [--check-data-quality] [--output-dir DIR] [--station CODE | --all-stations]
        [--skip-damaged] [--rows-shown N]

The data is read once for everything that was asked for: both kinds and the quality
report come from one table of station days. Written below the output directory:
``periods`` (Parquet by kind), one CSV directory per kind, and ``rejects`` (CSV): every
input that was left out, with the reason.

All counts in the log are taken from the written tables, that of the loaded records as a sum
over the station days, so they cost no scan and are exact when executors are lost.
"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempspan.operators.daily import (
    fold_other_stations, from_start_year, only_station, station_day_readings, station_days,
)
from tempspan.operators.periods import detect_kinds, of_kind
from tempspan.operators.quality import quality_totals_of_days, report_rows
from tempspan.operators.views import present
from tempspan.rules import COLDWAVE, HEATWAVE, RULES, WaveRule
from tempspan.runtime import removed_at_end, write_shared
from tempspan.schema import DEFAULT_START_YEAR, DEFAULT_STATION, DEFAULT_STATION_NAME, STATION
from tempspan.sinks.files import write_periods, write_results_csv
from tempspan.sinks.report import print_quality, print_report
from tempspan.sources.archives import read_archives
from tempspan.sources.inventory import first_files, list_files, summarize_files
from tempspan.sources.observations import (
    Ingested, observations_from_lines, read_observations, union_sources,
)

log = logging.getLogger("tempspan")

MODES = {"heatwaves": ("heatwaves",), "coldwaves": ("coldwaves",),
         "both": ("heatwaves", "coldwaves")}


def find_waves(days: DataFrame, rules: Sequence[WaveRule], station: str | None,
               start_year: int = DEFAULT_START_YEAR) -> DataFrame:
    """Periods of all ``rules`` from ``station_days``, for one station or all of them."""
    readings = {rule.kind: station_day_readings(rule) for rule in rules}
    wanted = wanted_days(days, station, start_year)
    return detect_kinds(wanted, rules, readings, repeated_days=False)


def wanted_days(days: DataFrame, station: str | None, start_year: int) -> DataFrame:
    wanted = from_start_year(days, start_year)
    return wanted if station is None else only_station(wanted, station)


def daily_records(days: DataFrame, rules: Sequence[WaveRule]) -> DataFrame:
    """One row: for each kind the station days that have the readings of its rule."""
    return days.agg(*(
        F.count_if(reduce(and_, [F.col(c).isNotNull() for c in station_day_readings(rule) if c]))
        .alias(rule.kind)
        for rule in rules
    ))


def loaded_records(days: DataFrame) -> int:
    """How many observations a written table of station days was made from."""
    return days.agg(F.coalesce(F.sum("observations"), F.lit(0))).first()[0]


def check_input(spark: SparkSession, path: str) -> bool:
    """Whether there are input files; logs how many, and the first few."""
    try:
        files = list_files(spark, path)
    except FileNotFoundError:
        log.warning("%s does not exist", path)
        return False
    found = summarize_files(files).first()
    log.info("%d files, %d bytes in %s", found["files"], found["bytes"], path)
    for row in first_files(files).toLocalIterator():
        log.info("  %s (%d bytes)", row["name"], row["size"])
    return found["files"] > 0


def load(spark: SparkSession, data_dir: str | None, archives: str | None,
         skip_damaged: bool = False) -> Ingested:
    parts = []
    if data_dir is not None:
        parts.append(read_observations(spark, data_dir, skip_damaged=skip_damaged))
    if archives is not None:
        parts.append(observations_from_lines(read_archives(spark, archives, skip_damaged)))
    if not parts:
        raise ValueError("give a data directory, archives, or both")
    return Ingested(union_sources(*[p.observations for p in parts]),
                    union_sources(*[p.rejects for p in parts]))


def run(spark: SparkSession, data_dir: str | None, mode: str = "both",
        output_dir: str = "results", check_data_quality: bool = False,
        station: str | None = DEFAULT_STATION, station_name: str = DEFAULT_STATION_NAME,
        start_year: int = DEFAULT_START_YEAR, archives: str | None = None,
        skip_damaged: bool = False,
        rules: Sequence[WaveRule] = (HEATWAVE, COLDWAVE),
        rows_shown: int | None = None) -> None:
    """The whole job. ``mode`` chooses between the built-in rules; others always run.

    A single station's results are printed in full, those of all stations only counted;
    ``rows_shown`` prints so many rows of either. Shared tables are removed at the end.
    """
    rules = [rule for rule in rules if rule.kind not in RULES or rule.kind in MODES[mode]]
    with removed_at_end(spark):
        ingested = load(spark, data_dir, archives, skip_damaged)
        rejects = write_shared(ingested.rejects, "rejects")
        rejects.write.mode("overwrite").option("header", True).csv(f"{output_dir}/rejects")
        for row in rejects.groupBy("reason").count().orderBy("reason").collect():
            log.warning("left out %d inputs: %s; see %s/rejects", row["count"], row["reason"],
                        output_dir)

        records = ingested.observations
        if check_data_quality and station is not None:
            records = fold_other_stations(records, station)
        days = write_shared(station_days(records), "station_days")
        log.info("loaded %d records", loaded_records(days))
        if check_data_quality:
            totals = quality_totals_of_days(days, station or DEFAULT_STATION)
            print_quality(report_rows(totals, station_name))

        waves = write_shared(find_waves(days, rules, station, start_year), "waves")
        found = {row["kind"]: row["count"] for row in waves.groupBy("kind").count().collect()}
        daily = daily_records(wanted_days(days, station, start_year), rules).first()

        for rule in rules:
            n_found = found.get(rule.kind, 0)
            log.info("%d daily records for %s from %d onwards", daily[rule.kind], rule.kind,
                     start_year)
            log.info("found %d %s", n_found, rule.kind)
            write_periods(waves, f"{output_dir}/periods", rule)
            keys = (STATION,) if station is None else ()
            results = present(of_kind(waves, rule), rule, keys)
            write_results_csv(results, f"{output_dir}/{rule.kind}", rule)
            where = "all stations" if station is None else station_name
            title = f"{rule.report_title} ({where}) from {start_year} onwards:"
            if station is None and rows_shown is None:
                print(f"\n{title} {n_found}, in {output_dir}/{rule.kind}")
            elif rows_shown != 0:
                titles = [*["Station" for _ in keys], *rule.report_titles()]
                print_report(results, title, titles, rows_shown)


# The names of the first five options and their defaults are the interface.
def parse_arguments(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Find heatwaves and coldwaves.")
    parser.add_argument("--mode", choices=list(MODES), default="both")
    parser.add_argument("--data-dir", default="extracted_data",
                        help="directory of observation files")
    parser.add_argument("--archives", default=None,
                        help="read this directory or glob of tar archives instead")
    parser.add_argument("--output-dir", default="results")
    parser.add_argument("--station", default=DEFAULT_STATION, help="station code")
    parser.add_argument("--station-name", default=DEFAULT_STATION_NAME)
    parser.add_argument("--all-stations", action="store_true")
    parser.add_argument("--start-year", type=int, default=DEFAULT_START_YEAR)
    parser.add_argument("--check-data-quality", action="store_true")
    parser.add_argument("--skip-damaged", action="store_true",
                        help="leave damaged inputs out and list them instead of failing")
    parser.add_argument("--rows-shown", type=int, default=None,
                        help="print so many result rows (default: all of a single station)")
    parser.add_argument("--log-level", choices=["DEBUG", "INFO", "WARNING", "ERROR"],
                        default="INFO")
    return parser.parse_args(arguments)


def main(arguments: Sequence[str] | None = None) -> int:
    options = parse_arguments(arguments)
    logging.basicConfig(format="%(asctime)s %(levelname)s %(message)s")
    log.setLevel(options.log_level)
    spark = SparkSession.builder.appName("tempspan").getOrCreate()
    data_dir = None if options.archives else options.data_dir
    try:
        if not check_input(spark, options.archives or options.data_dir):
            log.error("no input files")
            return 1
        run(spark, data_dir, options.mode, options.output_dir, options.check_data_quality,
            None if options.all_stations else options.station, options.station_name,
            options.start_year, options.archives, options.skip_damaged,
            rows_shown=options.rows_shown)
    except Exception:
        log.exception("job failed")
        return 1
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
