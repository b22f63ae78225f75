"""Observations to one row per station and day.

Every function is one aggregation by (keys, day). Spark aggregates inside each input task
first, so what is shuffled is at most one row per task, station and day, and a station
that holds a third of all observations sends no more than its calendar days.

The two kinds of wave look at different observations: a warm day is the maximum over all
observations that have a maximum; a cold day only uses observations that have both a
maximum and a minimum, for both of its values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempspan.rules import WaveRule
from tempspan.schema import DAY, DEFAULT_START_YEAR, STATION, TN, TX

# Columns of ``station_days`` beside the keys and the day.
PAIRED_TX = "paired_tx"
PAIRED_TN = "paired_tn"


def only_station(observations: DataFrame, code: object, station: str = STATION) -> DataFrame:
    return observations.filter(F.col(station) == F.lit(code))


def from_start_year(frame: DataFrame, year: int = DEFAULT_START_YEAR,
                    time: str = DAY) -> DataFrame:
    """Rows from 1 January of ``year`` on; rows without a day go.

    The comparison is on the date or time column itself, so on Parquet it prunes row
    groups, which a comparison on ``year(...)`` does not.
    """
    return frame.filter(F.col(time) >= F.make_date(F.lit(year), F.lit(1), F.lit(1)))


def daily_extremes(observations: DataFrame, keys: Sequence[str] = (STATION,),
                   day: str = DAY, tx: str = TX, tn: str | None = None,
                   start_year: int | None = DEFAULT_START_YEAR) -> DataFrame:
    """Daily maximum of ``tx`` per keys and day.

    With ``tn``: daily maximum and minimum over the observations that have both values.
    """
    usable = observations.filter(F.col(tx).isNotNull())
    if tn is not None:
        usable = usable.filter(F.col(tn).isNotNull())
    if start_year is not None:
        usable = from_start_year(usable, start_year, day)
    wanted = [F.max(tx).alias(tx)]
    if tn is not None:
        wanted.append(F.min(tn).alias(tn))
    return usable.groupBy(*keys, day).agg(*wanted)


def station_days(observations: DataFrame, keys: Sequence[str] = (STATION,),
                 day: str = DAY, tx: str = TX, tn: str = TN) -> DataFrame:
    """Everything the periods and the quality report need, in one pass over the data.

    One row per keys and day (a NULL day included): the number of observations, count,
    sum, minimum and maximum of both readings, and the two values over paired
    observations. It is smaller than the observations by the number of readings per day.
    """
    x, n = F.col(tx), F.col(tn)
    return observations.groupBy(*keys, day).agg(
        F.count(F.lit(1)).alias("observations"),
        *_moments(x, "tx"),
        *_moments(n, "tn"),
        F.max(F.when(n.isNotNull(), x)).alias(PAIRED_TX),
        F.min(F.when(x.isNotNull(), n)).alias(PAIRED_TN),
    )


def fold_other_stations(observations: DataFrame, code: object, station: str = STATION,
                        columns: Sequence[str] = (STATION, DAY, TX, TN)) -> DataFrame:
    """All rows, with ``columns`` NULL in those of other stations.

    For a report on one station among all: its ``station_days`` are unchanged, and the
    rows of the other stations, of which only the number matters, become one group.
    """
    here = F.col(station) == F.lit(code)
    return observations.withColumns({c: F.when(here, F.col(c)) for c in columns})


def _moments(reading: Column, name: str) -> list[Column]:
    return [
        F.count(reading).alias(f"{name}_count"),
        F.sum(reading).alias(f"{name}_sum"),
        F.min(reading).alias(f"{name}_min"),
        F.max(reading).alias(f"{name}_max"),
    ]


def station_day_readings(rule: WaveRule) -> tuple[str, str | None]:
    """The columns of ``station_days`` that hold this rule's daily maximum and minimum."""
    return ("tx_max", None) if rule.warm else (PAIRED_TX, PAIRED_TN)
