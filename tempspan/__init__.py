"""Extreme-weather periods from station observations, as Spark DataFrame jobs.

Typical use::

    from tempspan import read_observations, daily_extremes, detect, HEATWAVE

    found = read_observations(spark, "hdfs:///weather/raw")
    days = daily_extremes(found.observations)
    waves = detect(days, HEATWAVE)

Every operator takes and returns a DataFrame with the column names as arguments, so it
serves weather files and any other (station, time, reading) table alike.
"""

from tempspan.operators.daily import daily_extremes, from_start_year, only_station, station_days
from tempspan.operators.periods import consecutive_periods, detect, detect_kinds, run_ids
from tempspan.operators.quality import quality_report
from tempspan.operators.views import (
    list_periods, present, result_records, summary_json, yearly_summary,
)
from tempspan.rules import COLDWAVE, HEATWAVE, WaveRule
from tempspan.sinks.files import read_periods, read_results_csv, write_periods, write_results_csv
from tempspan.sinks.report import report_lines
from tempspan.sources.archives import read_archives
from tempspan.sources.inventory import list_files
from tempspan.sources.observations import read_observations

__all__ = [
    "COLDWAVE", "HEATWAVE", "WaveRule",
    "consecutive_periods", "daily_extremes", "detect", "detect_kinds", "from_start_year",
    "list_files", "list_periods", "only_station", "present", "quality_report",
    "read_archives", "read_observations", "read_periods", "read_results_csv",
    "report_lines", "result_records", "run_ids", "station_days", "summary_json", "write_periods",
    "write_results_csv", "yearly_summary",
]
