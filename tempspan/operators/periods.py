"""Runs of consecutive qualifying days.

Non-qualifying days are dropped first; among the days that are left, the day number minus
its rank by date is the same for exactly the days of one unbroken run. So a missing day
and a day that does not qualify both end a run.

One shuffle, by the keys: the window sorts each key's days, and the aggregation by (keys,
run) reuses that partitioning. A key has at most one row per calendar day here (36,525 in
a century), so its group is bounded by the calendar and not by the number of observations.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tempspan.functions.columns import day_number
from tempspan.rules import WaveRule
from tempspan.schema import DAY, STATION, TN, TX

PERIOD = ("start_date", "end_date", "duration", "extreme_days")


def flag_days(days: DataFrame, rule: WaveRule, condition: str, extreme: str,
              tx: str = TX, tn: str | None = None) -> DataFrame:
    """Add the rule's two day flags as 0 or 1 (0 where a reading is missing)."""
    x, n = F.col(tx), None if tn is None else F.col(tn)
    return days.withColumns({
        condition: F.when(rule.qualifies(x), 1).otherwise(0),
        extreme: F.when(rule.is_extreme(x, n), 1).otherwise(0),
    })


def run_ids(days: DataFrame, keys: Sequence[str] = (STATION,), day: str = DAY,
            run: str = "group_id") -> DataFrame:
    """Add the run that each (qualifying) day belongs to, unique within its keys.

    Repeated days get the same run.
    """
    by_day = W.partitionBy(*keys).orderBy(day)
    return days.withColumn(run, day_number(F.col(day)) - F.dense_rank().over(by_day))


def consecutive_periods(days: DataFrame, condition: Column, extreme: Column,
                        reading: Column, keys: Sequence[str] = (STATION,), day: str = DAY,
                        repeated_days: bool = True) -> DataFrame:
    """Maximal runs of consecutive days that meet ``condition``; rows without a day go.

    Result: keys, ``group_id, start_date, end_date, duration, extreme_days, highest,
    lowest``: the days of the run that meet ``extreme``, and the bounds of ``reading``.

    A day may have several rows: it counts when any of them does, and they are merged
    before the shuffle by keys, at no exchange of their own when ``days`` comes from
    ``daily_extremes`` or ``station_days``. A caller whose days are unique, as in a table
    written from those, may say so with ``repeated_days=False``.
    """
    qualifying = days.filter(condition & F.col(day).isNotNull()).select(
        *keys, day, extreme.alias("is_extreme"), reading.alias("reading"))
    highest = lowest = "reading"
    if repeated_days:
        highest, lowest = "highest", "lowest"
        qualifying = qualifying.groupBy(*keys, day).agg(
            F.bool_or("is_extreme").alias("is_extreme"),
            F.max("reading").alias(highest),
            F.min("reading").alias(lowest),
        )
    first, last = F.min(day), F.max(day)
    return run_ids(qualifying, keys, day).groupBy(*keys, "group_id").agg(
        first.alias("start_date"),
        last.alias("end_date"),
        (F.datediff(last, first) + 1).cast("long").alias("duration"),
        F.count_if("is_extreme").alias("extreme_days"),
        F.max(highest).alias("highest"),
        F.min(lowest).alias("lowest"),
    )


def periods_of(days: DataFrame, rule: WaveRule, keys: Sequence[str] = (STATION,),
               day: str = DAY, tx: str = TX, tn: str | None = None,
               repeated_days: bool = True) -> DataFrame:
    """All runs of days that qualify under ``rule``, whatever their length."""
    x, n = F.col(tx), None if tn is None else F.col(tn)
    runs = consecutive_periods(
        days, rule.qualifies(x), rule.is_extreme(x, n), rule.reading(x, n), keys, day,
        repeated_days)
    temperature = F.col(rule.bound).alias(rule.temperature_column)
    return runs.select(*keys, "group_id", *PERIOD, temperature)


def detect(days: DataFrame, rule: WaveRule, keys: Sequence[str] = (STATION,),
           day: str = DAY, tx: str = TX, tn: str | None = TN,
           repeated_days: bool = True) -> DataFrame:
    """The periods that satisfy ``rule``: keys, start and end date, duration, the rule's
    extreme-day count and its temperature. ``tn`` is only used by cold rules."""
    periods = periods_of(days, rule, keys, day, tx, None if rule.warm else tn, repeated_days)
    return (
        periods
        .filter(rule.accepts(F.col("duration"), F.col("extreme_days")))
        .withColumnRenamed("extreme_days", rule.extreme_days_column)
        .drop("group_id")
    )


def detect_kinds(days: DataFrame, rules: Sequence[WaveRule],
                 readings: Mapping[str, tuple[str, str | None]],
                 keys: Sequence[str] = (STATION,), day: str = DAY,
                 repeated_days: bool = True) -> DataFrame:
    """Periods of several rules in one pass over ``days``.

    ``readings`` names, by kind, the columns with the daily maximum and minimum. A day
    becomes one row per rule it qualifies under, and the kind joins the keys, so all
    rules share the scan, the daily aggregation and the shuffle. Result: keys, ``kind,
    start_date, end_date, duration, extreme_days, extreme_temperature``.
    """
    marks = []
    for rule in rules:
        tx, tn = readings[rule.kind]
        x, n = F.col(tx), None if tn is None else F.col(tn)
        mark = F.struct(
            F.lit(rule.kind).alias("kind"),
            F.coalesce(rule.is_extreme(x, n), F.lit(False)).alias("is_extreme"),
            rule.reading(x, n).alias("reading"),
        )
        marks.append(F.when(rule.qualifies(x), mark))
    marked = days.select(*keys, day, F.inline(F.array_compact(F.array(*marks))))

    periods = consecutive_periods(marked, F.lit(True), F.col("is_extreme"), F.col("reading"),
                                  [*keys, "kind"], day, repeated_days)
    accepted, temperature = F.lit(False), F.lit(None).cast("double")
    for rule in rules:
        chosen = F.col("kind") == rule.kind
        accepted = accepted | (chosen & rule.accepts(F.col("duration"), F.col("extreme_days")))
        temperature = F.when(chosen, F.col(rule.bound)).otherwise(temperature)
    return periods.filter(accepted).select(
        *keys, "kind", *PERIOD, temperature.alias("extreme_temperature"))


def of_kind(periods: DataFrame, rule: WaveRule) -> DataFrame:
    """One kind out of ``detect_kinds``, with the columns that ``detect`` gives."""
    return (
        periods.filter(F.col("kind") == rule.kind)
        .drop("kind")
        .withColumnsRenamed({
            "extreme_days": rule.extreme_days_column,
            "extreme_temperature": rule.temperature_column,
        })
    )


def as_kind(periods: DataFrame, rule: WaveRule) -> DataFrame:
    """The reverse of ``of_kind``: periods of one rule in the form that ``detect_kinds``
    gives, so that kinds can be put together with ``unionByName``."""
    return periods.withColumn("kind", F.lit(rule.kind)).withColumnsRenamed({
        rule.extreme_days_column: "extreme_days",
        rule.temperature_column: "extreme_temperature",
    })
