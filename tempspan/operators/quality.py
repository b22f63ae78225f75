"""Data-quality report in one pass.

All counts and statistics come from a single aggregation, whose one row then becomes the
eight rows of the report. Numbers stay numeric; a station without readings has NULL
statistics, and shares of nothing are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempspan.functions.columns import percentage
from tempspan.schema import DAY, DEFAULT_STATION, DEFAULT_STATION_NAME, STATION, TN, TX

# How the rows of the report are called.
TOTAL, AT_STATION = "Total Records", "{name} Station Records"
NULLS, STATISTICS = "{column} - Null Values", "{column} - Statistics"

REPORT_COLUMNS = ("metric", "count", "percentage", "min", "max", "avg")


def quality_totals(observations: DataFrame, code: object = DEFAULT_STATION,
                   station: str = STATION, day: str = DAY, tx: str = TX,
                   tn: str = TN) -> DataFrame:
    """One row of totals over the observations themselves."""
    here = F.col(station) == F.lit(code)

    def missing(column: str) -> Column:
        return F.count_if(here & F.col(column).isNull())

    def statistics(column: str, name: str) -> list[Column]:
        value = F.when(here, F.col(column))
        return [F.min(value).alias(f"{name}_min"), F.max(value).alias(f"{name}_max"),
                F.avg(value).alias(f"{name}_avg")]

    return observations.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(here).alias("station"),
        missing(station).alias("station_nulls"),
        missing(tx).alias("tx_nulls"),
        missing(tn).alias("tn_nulls"),
        missing(day).alias("day_nulls"),
        *statistics(tx, "tx"),
        *statistics(tn, "tn"),
    )


def quality_totals_of_days(days: DataFrame, code: object = DEFAULT_STATION,
                           station: str = STATION, day: str = DAY) -> DataFrame:
    """The same row of totals from ``station_days``, without another pass over the data."""
    here = F.col(station) == F.lit(code)
    rows = F.col("observations")

    def total(value: Column, where: Column = here) -> Column:
        return F.coalesce(F.sum(F.when(where, value)), F.lit(0).cast("long"))

    def statistics(name: str) -> list[Column]:
        readings = F.sum(F.when(here, F.col(f"{name}_count")))
        return [
            F.min(F.when(here, F.col(f"{name}_min"))).alias(f"{name}_min"),
            F.max(F.when(here, F.col(f"{name}_max"))).alias(f"{name}_max"),
            F.try_divide(F.sum(F.when(here, F.col(f"{name}_sum"))), readings)
            .alias(f"{name}_avg"),
        ]

    return days.agg(
        total(rows, F.lit(True)).alias("total"),
        total(rows).alias("station"),
        total(rows, here & F.col(station).isNull()).alias("station_nulls"),
        total(rows - F.col("tx_count")).alias("tx_nulls"),
        total(rows - F.col("tn_count")).alias("tn_nulls"),
        total(rows, here & F.col(day).isNull()).alias("day_nulls"),
        *statistics("tx"),
        *statistics("tn"),
    )


def report_rows(totals: DataFrame, station_name: str = DEFAULT_STATION_NAME,
                station: str = STATION, day: str = DAY, tx: str = TX,
                tn: str = TN) -> DataFrame:
    """The report: ``metric, count, percentage, min, max, avg`` in eight ordered rows."""
    at_station = F.col("station")

    def counted(metric: str, count: str, share: Column | None = None) -> Column:
        return _row(metric, count=F.col(count), percentage=share)

    def nulls(column: str, count: str) -> Column:
        return counted(NULLS.format(column=column), count, percentage(F.col(count), at_station))

    def statistics(column: str, name: str) -> Column:
        return _row(STATISTICS.format(column=column), min=F.col(f"{name}_min"),
                    max=F.col(f"{name}_max"), avg=F.col(f"{name}_avg"))

    rows = [
        counted(TOTAL, "total"),
        counted(AT_STATION.format(name=station_name), "station",
                percentage(at_station, F.col("total"))),
        nulls(station, "station_nulls"),
        nulls(tx, "tx_nulls"),
        statistics(tx, "tx"),
        nulls(tn, "tn_nulls"),
        statistics(tn, "tn"),
        nulls(day, "day_nulls"),
    ]
    return totals.select(F.inline(F.array(*rows)))


def quality_report(observations: DataFrame, code: object = DEFAULT_STATION,
                   station_name: str = DEFAULT_STATION_NAME, station: str = STATION,
                   day: str = DAY, tx: str = TX, tn: str = TN) -> DataFrame:
    totals = quality_totals(observations, code, station, day, tx, tn)
    return report_rows(totals, station_name, station, day, tx, tn)


def _row(metric: str, **values: Column | None) -> Column:
    types = {"count": "long"}
    cells = [F.lit(metric).alias("metric")]
    for name in REPORT_COLUMNS[1:]:
        value = values.get(name)
        value = F.lit(None) if value is None else value
        cells.append(value.cast(types.get(name, "double")).alias(name))
    return F.struct(*cells)
