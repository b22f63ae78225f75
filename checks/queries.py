"""One query per operator of the library, on the shared test tables.

``events`` stands for observations with the user as station, and ``orders`` for a series
over several years with the order priority as station. The rules keep the library's form
with thresholds that suit these tables.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.damaged import damaged_inputs, tar_of
from checks.render import observation_files
from tempspan.operators.daily import (
    daily_extremes, from_start_year, only_station, station_day_readings, station_days,
)
from tempspan.operators.periods import (
    as_kind, detect, detect_kinds, flag_days, periods_of, run_ids,
)
from tempspan.operators.quality import (
    quality_report, quality_totals, quality_totals_of_days, report_rows,
)
from tempspan.operators.views import (
    list_periods, present, result_records, summary_json, yearly, yearly_summary,
)
from tempspan.plans import job
from tempspan.rules import COLDWAVE, HEATWAVE
from tempspan.runtime import fresh_folder, qualified, write_shared
from tempspan.schema import LINES, OBSERVATION_FIELDS, STATION
from tempspan.sinks.files import (
    read_periods, read_results_csv, write_periods, write_results_csv,
)
from tempspan.sinks.report import report_lines
from tempspan.sources.archives import read_archives
from tempspan.sources.headers import detect_headers, header_slices, without_header
from tempspan.sources.inventory import first_files, list_files, summarize_files
from tempspan.sources.lines import data_lines, explode_lines, scan_lines
from tempspan.sources.observations import (
    attach_layouts, cast_fields, derive_day, file_headers, observations_from_lines,
    read_observations, require_keys, slice_fields, union_sources,
)
from tempspan.sources.streams import write_file

Query = Callable[[SparkSession, str], DataFrame]

EVENT_HEAT = dataclasses.replace(HEATWAVE, extreme_temp_threshold=100.0)
EVENT_COLD = dataclasses.replace(COLDWAVE, temp_threshold=120.0, extreme_temp_threshold=10.0)
ORDER_HEAT = dataclasses.replace(HEATWAVE, temp_threshold=250_000.0,
                                 extreme_temp_threshold=400_000.0)
ORDER_COLD = dataclasses.replace(COLDWAVE, temp_threshold=400_000.0,
                                 extreme_temp_threshold=100_000.0)
ORDER_DEAR = dataclasses.replace(ORDER_HEAT, kind="dear", min_duration=3)
ORDER_START_YEAR = 1997
ORDER_STATION = "1-URGENT"
QUALITY_STATION = "view"

# Lines of prose stand in for header and comment lines: they start with a capital T, and
# the header also has the word "the".
PROSE_MARK, PROSE_KEY = "T", "the"
PROSE_FIELDS = ("the", "and", "ing ", "tion", "er", ".", "of ")
TEXT_COLUMNS = tuple(OBSERVATION_FIELDS)


# Tables as observations

def events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet").select(
        "user_id", F.to_date("ts").alias("day"), F.col("value").alias("tx"),
        F.col("value").alias("tn"))


def gappy_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events in which some readings lack the maximum, some the minimum, some the day."""
    value, kind = F.col("value"), F.col("event_type")
    return spark.read.parquet(f"{sf}/events.parquet").select(
        "user_id", "event_type",
        F.when((value < 3) | (value >= 4), F.to_date("ts")).alias("day"),
        F.when(kind != "error", value).alias("tx"),
        F.when(value > 10, value).alias("tn"))


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderpriority").alias("station"), F.to_date("o_orderdate").alias("day"),
        F.col("o_totalprice").alias("tx"), F.col("o_totalprice").alias("tn"))


USER = {"keys": ["user_id"], "day": "day"}
PRIORITY = {"keys": ["station"], "day": "day"}


def event_days(spark, sf, tn=None):
    return daily_extremes(events(spark, sf), **USER, tx="tx", tn=tn)


def order_days(spark, sf, tn=None):
    return daily_extremes(orders(spark, sf), **PRIORITY, tx="tx", tn=tn,
                          start_year=ORDER_START_YEAR)


def event_waves(spark, sf, rule):
    tn = None if rule.warm else "tn"
    return detect(event_days(spark, sf, tn), rule, **USER, tx="tx", tn=tn)


def order_waves(spark, sf, rule):
    tn = None if rule.warm else "tn"
    return detect(order_days(spark, sf, tn), rule, **PRIORITY, tx="tx", tn=tn)


def both_kinds(observations, rules, keys, start_year):
    days = station_days(observations, keys, "day", "tx", "tn")
    readings = {rule.kind: station_day_readings(rule) for rule in rules}
    return detect_kinds(from_start_year(days, start_year, "day"), rules, readings, keys, "day")


# Sources

def document_lines(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return explode_lines(documents, "text", "line", "line_no")


def document_headers(spark, sf):
    return detect_headers(document_lines(spark, sf), "doc_id", F.col("line_no"), "line",
                          PROSE_MARK, PROSE_KEY)


def q_header_reject(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id")
    return without_header(documents, document_headers(spark, sf), "doc_id")


def q_header_offsets(spark, sf):
    slices = header_slices(document_headers(spark, sf), PROSE_FIELDS, PROSE_FIELDS[0])
    names = F.array(*[F.lit(f) for f in PROSE_FIELDS])
    return slices.select("doc_id", F.inline(F.arrays_zip(
        names.alias("field"), F.col("starts").alias("start"),
        F.col("lengths").alias("length")))).toDF("doc_id", "field", "start", "length")


def text_fields(spark, sf):
    root = observation_files(spark, sf)
    lines = scan_lines(spark, root)
    headers = write_shared(file_headers(lines), "headers")
    return slice_fields(attach_layouts(data_lines(lines), headers, list_files(spark, root)))


def q_fixed_width_parse(spark, sf):
    return text_fields(spark, sf).select(*TEXT_COLUMNS)


def q_typed_cast(spark, sf):
    return cast_fields(text_fields(spark, sf)).select(*TEXT_COLUMNS)


def q_required_keys(spark, sf):
    typed = cast_fields(text_fields(spark, sf))
    return require_keys(typed).select(*TEXT_COLUMNS)


def q_derive_date(spark, sf):
    typed = require_keys(cast_fields(text_fields(spark, sf)))
    return derive_day(typed).select(*TEXT_COLUMNS, "DATE")


def q_directory_scan(spark, sf):
    root = observation_files(spark, sf)
    folder = F.regexp_extract(F.split_part("source", F.lit(root), F.lit(-1)), "^/([^/]+)/", 1)
    return data_lines(scan_lines(spark, root)).select(folder.alias("folder"), "value")


def q_rejected_files(spark, sf):
    """Inputs that are left out and why, by folder: bytes of the files without a header (their
    number is that of the writing tasks), and the number of damaged and empty ones. Each kind of damage has a folder with files of its own."""
    root = observation_files(spark, sf)
    folder = F.regexp_extract(F.split_part("source", F.lit(root), F.lit(-1)), "^/([^/]+)/", 1)
    rejects = read_observations(spark, root).rejects.select("source", "reason")
    # The files are compressed, so the bytes of their text are counted line by line.
    line_bytes = F.sum(F.octet_length("value") + 1).cast("long")
    texts = scan_lines(spark, root).groupBy("source").agg(line_bytes.alias("bytes"))
    headerless = rejects.join(texts, "source").groupBy(folder.alias("folder"), "reason").agg(
        F.sum("bytes").alias("bytes"), F.lit(0).cast("long").alias("inputs"))
    files, archives = damaged_inputs(spark, sf)
    out = read_observations(spark, files, skip_damaged=True).rejects.unionByName(
        observations_from_lines(read_archives(spark, archives, skip_damaged=True)).rejects)
    folder = F.regexp_extract("source", "/([^/!]+)/chunk-", 1).alias("folder")
    damaged = out.groupBy(folder, "reason").agg(
        F.lit(0).cast("long").alias("bytes"), F.count(F.lit(1)).alias("inputs"))
    return headerless.unionByName(damaged)


def q_union_sources(spark, sf):
    from_text = read_observations(spark, observation_files(spark, sf)).observations
    from_table = orders(spark, sf).toDF("LOCATION", "DATE", "TX_DRYB_10", "TN_DRYB_10")
    missing = {name: F.lit(None).cast(kind) for name, kind in OBSERVATION_FIELDS.items()
               if name not in from_table.columns}
    return union_sources(from_text, from_table.withColumns(missing))


def q_archive_lines(spark, sf):
    """Documents packed into archives in nested folders, read back by the archive reader."""
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    root = fresh_folder(spark, "archives")
    n = write_archives(documents, qualified(spark, root)).count()
    lines = read_archives(spark, root) if n else spark.createDataFrame([], LINES)
    doc_id = F.element_at(F.split("source", "/"), -1).cast("long").alias("doc_id")
    return data_lines(lines).select(doc_id, F.col("value").alias("line"))


def write_archives(documents: DataFrame, root: str, per_archive: int = 200) -> DataFrame:
    """The names of the archives that the tasks write: several a folder, named by partition and
    number. A task that runs again writes the same files again."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, per_archive):
                rows = batch.slice(start, per_archive).to_pylist()
                name = f"{root}/part={number % 3}/from-{part}-{number}.tgz"
                write_file(name, tar_of((f"doc/{r['doc_id']}", (r["text"] or "").encode()) for r in rows))
                number += 1
                yield pa.RecordBatch.from_pydict({"name": [name]})

    return documents.mapInArrow(pack, "name string")


def q_input_inventory(spark, sf):
    """Events as one text file for each type: bytes of each, and the first files listed."""
    root = fresh_folder(spark, "inventory")
    text = F.concat_ws(",", "event_id", "user_id", "value").alias("value")
    events_ = spark.read.parquet(f"{sf}/events.parquet").where("event_type IS NOT NULL")
    events_.select("event_type", text).repartition("event_type").write.partitionBy(
        "event_type").text(root)
    files = list_files(spark, root)
    kind = F.regexp_extract("source", "event_type=([^/]+)/", 1).alias("name")
    all_files = files.groupBy(kind).agg(F.sum("size").alias("bytes"), F.lit("all").alias("part"))
    first = first_files(files, 2).select(
        F.lit("").alias("name"), F.col("size").alias("bytes"), F.lit("first").alias("part"))
    total = summarize_files(files).select(F.lit("").alias("name"), "bytes", F.lit("total").alias("part"))
    return all_files.unionByName(first).unionByName(total)


# Daily values and runs

def q_station_daily_max(spark, sf):
    here = only_station(orders(spark, sf), ORDER_STATION, "station")
    return daily_extremes(here, **PRIORITY, tx="tx", start_year=ORDER_START_YEAR)


def q_station_daily_max_min(spark, sf):
    here = only_station(orders(spark, sf), ORDER_STATION, "station")
    return daily_extremes(here, **PRIORITY, tx="tx", tn="tn", start_year=ORDER_START_YEAR)


def q_start_year_filter(spark, sf):
    table = spark.read.parquet(f"{sf}/orders.parquet")
    return from_start_year(table, ORDER_START_YEAR, "o_orderdate").select(
        "o_orderkey", "o_orderdate", "o_totalprice")


def q_condition_flags(spark, sf):
    days = event_days(spark, sf, "tn")
    hot = flag_days(days, EVENT_HEAT, "is_hot", "is_tropical", "tx")
    return flag_days(hot, EVENT_COLD, "is_cold", "is_high_frost", "tx", "tn")


def q_run_ids(spark, sf):
    hot = event_days(spark, sf).filter(EVENT_HEAT.qualifies(F.col("tx")))
    return run_ids(hot, **USER)


def q_periods_cold(spark, sf):
    return periods_of(event_days(spark, sf, "tn"), EVENT_COLD, **USER, tx="tx", tn="tn")


def q_waves_station(rule):
    def query(spark, sf):
        tn = None if rule.warm else "tn"
        here = only_station(orders(spark, sf), ORDER_STATION, "station")
        days = daily_extremes(here, **PRIORITY, tx="tx", tn=tn, start_year=ORDER_START_YEAR)
        return present(detect(days, rule, **PRIORITY, tx="tx", tn=tn), rule, keys=())
    return query


# Quality report

QUALITY = {"code": QUALITY_STATION, "station": "event_type", "day": "day", "tx": "tx",
           "tn": "tn"}


def q_quality_counts(spark, sf):
    return quality_totals(gappy_events(spark, sf), **QUALITY).select("total", "station")


def q_quality_nulls(spark, sf):
    return quality_totals(gappy_events(spark, sf), **QUALITY).select(
        "station_nulls", "tx_nulls", "tn_nulls", "day_nulls")


def q_quality_stats(spark, sf):
    totals = quality_totals(gappy_events(spark, sf), **QUALITY)
    return totals.select("tx_min", "tx_max", F.round("tx_avg", 6).alias("tx_avg"),
                         "tn_min", "tn_max", F.round("tn_avg", 6).alias("tn_avg"))


def rounded(report):
    return report.withColumns({"percentage": F.round("percentage", 6), "avg": F.round("avg", 6)})


def q_quality_report(spark, sf):
    return rounded(quality_report(gappy_events(spark, sf), station_name="View", **QUALITY))


def q_quality_report_of_days(spark, sf):
    days = station_days(gappy_events(spark, sf), ["event_type"], "day", "tx", "tn")
    totals = quality_totals_of_days(days, QUALITY_STATION, "event_type", "day")
    return rounded(report_rows(totals, "View", "event_type", "day", "tx", "tn"))


# Sinks and jobs

def q_record_count(spark, sf):
    """Records as the batch job counts them: from the written station days, beside their number."""
    days = write_shared(station_days(events(spark, sf), ["user_id"], "day", "tx", "tn"), "days")
    return spark.createDataFrame(
        [(job.loaded_records(days), days.count())], "observations long, station_days long")


def q_daily_records(spark, sf):
    """What the batch job logs as daily records of each kind."""
    days = station_days(gappy_events(spark, sf), ["user_id"], "day", "tx", "tn")
    renamed = from_start_year(days, 2003, "day")
    return job.daily_records(renamed, [EVENT_HEAT, EVENT_COLD])


def q_report_lines(spark, sf):
    waves = event_waves(spark, sf, EVENT_HEAT).withColumn(
        "max_temperature", F.round("max_temperature", 1))
    return report_lines(present(waves, EVENT_HEAT, keys=()))


def q_periods_repeated_days(spark, sf):
    """Detection straight on events, of which a station has many on a day."""
    return present(detect(events(spark, sf), EVENT_HEAT, **USER, tx="tx"), EVENT_HEAT, ["user_id"])


def q_summary_custom(spark, sf):
    """A rule of the caller's own beside the built-in kinds, in table and JSON."""
    rules = [ORDER_HEAT, ORDER_COLD, ORDER_DEAR]
    found = both_kinds(orders(spark, sf), rules, ["station"], ORDER_START_YEAR)
    summary = yearly_summary(found, rules)
    text = summary_json(summary, rules).select(
        F.lit("json").alias("kind"), F.lit(None).cast("int").alias("year"),
        F.get_json_object("summary", "$.dear.1999.count").cast("long").alias("count"),
        F.get_json_object("summary", "$.dear.1999.max_temperature").cast("double")
        .alias("extreme_temperature"))
    return summary.unionByName(text)


def q_csv_roundtrip(spark, sf):
    path = fresh_folder(spark, "csv")
    waves = event_waves(spark, sf, EVENT_COLD).withColumnRenamed("user_id", STATION)
    write_results_csv(present(waves, EVENT_COLD), path, EVENT_COLD)
    return read_results_csv(spark, path, EVENT_COLD)


def q_period_store(spark, sf):
    path = fresh_folder(spark, "periods")
    rules = [ORDER_HEAT, ORDER_COLD]
    waves = both_kinds(orders(spark, sf), rules, ["station"], ORDER_START_YEAR)
    waves = write_shared(waves, "waves")
    for rule in rules:
        write_periods(waves, path, rule)
    return read_periods(spark, path, {"station": "string"})


def q_wave_job(spark, sf):
    """The whole batch job, from observation files to its two CSV results."""
    out = fresh_folder(spark, "results")
    rules = [EVENT_HEAT, EVENT_COLD]
    job.run(spark, observation_files(spark, sf), "both", out, station=None, rules=rules,
            rows_shown=0)
    hot, cold = [as_kind(read_results_csv(spark, f"{out}/{rule.kind}", rule), rule)
                 for rule in rules]
    return hot.unionByName(cold)


def order_summary(spark, sf):
    rules = [ORDER_HEAT, ORDER_COLD]
    return yearly_summary(both_kinds(orders(spark, sf), rules, ["station"], ORDER_START_YEAR))


def q_both_kinds(spark, sf):
    return both_kinds(gappy_events(spark, sf), [EVENT_HEAT, EVENT_COLD], ["user_id"], 2003)


QUERIES: dict[str, Query] = {
    "explode_lines": document_lines,
    "header_detect": document_headers,
    "header_reject": q_header_reject,
    "header_offsets": q_header_offsets,
    "line_filter": lambda s, d: data_lines(document_lines(s, d), "line", PROSE_MARK),
    "directory_scan": q_directory_scan,
    "rejected_files": q_rejected_files,
    "fixed_width_parse": q_fixed_width_parse,
    "typed_cast": q_typed_cast,
    "required_keys": q_required_keys,
    "derive_date": q_derive_date,
    "union_sources": q_union_sources,
    "archive_lines": q_archive_lines,
    "input_inventory": q_input_inventory,
    "station_daily_max": q_station_daily_max,
    "station_daily_max_min": q_station_daily_max_min,
    "daily_max": lambda s, d: daily_extremes(gappy_events(s, d), **USER, tx="tx"),
    "daily_max_min": lambda s, d: daily_extremes(gappy_events(s, d), **USER, tx="tx", tn="tn"),
    "start_year_filter": q_start_year_filter,
    "condition_flags": q_condition_flags,
    "run_ids": q_run_ids,
    "periods_hot": lambda s, d: periods_of(event_days(s, d), EVENT_HEAT, **USER, tx="tx"),
    "periods_cold": q_periods_cold,
    "heatwaves": lambda s, d: present(event_waves(s, d, EVENT_HEAT), EVENT_HEAT, ["user_id"]),
    "coldwaves": lambda s, d: present(event_waves(s, d, EVENT_COLD), EVENT_COLD, ["user_id"]),
    "both_kinds": q_both_kinds,
    "heatwaves_station": q_waves_station(ORDER_HEAT),
    "coldwaves_station": q_waves_station(ORDER_COLD),
    "heatwaves_by_year": lambda s, d: list_periods(
        order_waves(s, d, ORDER_HEAT), ORDER_HEAT, "1999", ["station"]),
    "coldwaves_by_year": lambda s, d: list_periods(
        order_waves(s, d, ORDER_COLD), ORDER_COLD, 1999, ["station"]),
    "period_records": lambda s, d: result_records(list_periods(
        order_waves(s, d, ORDER_HEAT), ORDER_HEAT, "", ["station"]), ORDER_HEAT),
    "summary_heatwaves": lambda s, d: yearly(order_waves(s, d, ORDER_HEAT), ORDER_HEAT),
    "summary_coldwaves": lambda s, d: yearly(order_waves(s, d, ORDER_COLD), ORDER_COLD),
    "summary": order_summary,
    "summary_json": lambda s, d: summary_json(order_summary(s, d)),
    "quality_counts": q_quality_counts,
    "quality_nulls": q_quality_nulls,
    "quality_stats": q_quality_stats,
    "quality_report": q_quality_report,
    "quality_report_of_days": q_quality_report_of_days,
    "record_count": q_record_count,
    "daily_records": q_daily_records,
    "periods_repeated_days": q_periods_repeated_days,
    "summary_custom": q_summary_custom,
    "report_lines": q_report_lines,
    "csv_roundtrip": q_csv_roundtrip,
    "period_store": q_period_store,
    "wave_job": q_wave_job,
}
