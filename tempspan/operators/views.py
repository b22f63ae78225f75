"""Views over detected periods: result rows, listings by year, yearly summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempspan.functions.columns import in_year, result_date
from tempspan.rules import RULES, WaveRule
from tempspan.schema import STATION


def present(periods: DataFrame, rule: WaveRule,
            keys: Sequence[str] = (STATION,)) -> DataFrame:
    """Result rows of ``detect`` in start-date order, with dates as ``dd MMM yyyy``.

    Keys break ties, so the order is the same on every run. Pass ``keys=()`` for the
    five result columns alone. A global sort first samples its input; the few result rows
    are exchanged before it, so that the sampling does not repeat the detection.
    """
    ties = [c for c in periods.columns if c in (*keys, "end_date")]
    settled = periods.repartition("start_date", *ties)
    return settled.orderBy("start_date", *ties).select(
        *keys,
        result_date(F.col("start_date")).alias("start_date_formatted"),
        result_date(F.col("end_date")).alias("end_date_formatted"),
        "duration", rule.extreme_days_column, rule.temperature_column,
    )


def parse_year(year: int | str | None) -> int | None:
    """An optional year argument; absent or empty means no filter."""
    if year is None or year == "":
        return None
    try:
        return int(year)
    except ValueError:
        raise ValueError(f"Invalid year: {year}") from None


def list_periods(periods: DataFrame, rule: WaveRule, year: int | str | None = None,
                 keys: Sequence[str] = (STATION,)) -> DataFrame:
    """Result rows of the periods that start in ``year`` (all without one).

    A period over New Year belongs to the year it starts in.
    """
    wanted = parse_year(year)
    if wanted is not None:
        periods = periods.filter(in_year(F.col("start_date"), wanted))
    return present(periods, rule, keys)


def result_records(results: DataFrame, rule: WaveRule,
                   record: str = "record") -> DataFrame:
    """Each row of ``present`` as a JSON object under the headings of the result file."""
    titles = rule.result_titles()
    cells = [F.col(c).alias(titles.get(c, c)) for c in results.columns]
    return results.select(F.to_json(F.struct(*cells)).alias(record))


def yearly(periods: DataFrame, rule: WaveRule) -> DataFrame:
    """``(year, count, temperature)`` of the periods of one kind by start year."""
    return periods.groupBy(F.year("start_date").alias("year")).agg(
        F.count(F.lit(1)).alias("count"),
        rule.most_extreme(rule.temperature_column).alias(rule.temperature_column),
    )


def yearly_summary(periods: DataFrame,
                   rules: Sequence[WaveRule] = tuple(RULES.values())) -> DataFrame:
    """``(kind, year, count, extreme_temperature)`` from ``detect_kinds`` in one pass.

    A kind of none of the ``rules`` has no temperature, since nothing says which it is.
    """
    warm = [rule.kind for rule in rules if rule.warm]
    cold = [rule.kind for rule in rules if not rule.warm]
    return (
        periods.groupBy("kind", F.year("start_date").alias("year"))
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.max("extreme_temperature").alias("_highest"),
            F.min("extreme_temperature").alias("_lowest"),
        )
        .select(
            "kind", "year", "count",
            F.when(F.col("kind").isin(warm), F.col("_highest"))
            .when(F.col("kind").isin(cold), F.col("_lowest")).alias("extreme_temperature"),
        )
    )


def summary_json(summary: DataFrame,
                 rules: Sequence[WaveRule] = tuple(RULES.values())) -> DataFrame:
    """One row with the summary as JSON: an object per rule, in it one entry per year.

    What is gathered into the one row is a count and a temperature per year.
    """
    parts = []
    for rule in rules:
        entry = F.struct(
            F.col("year").cast("string").alias("key"),
            F.struct("count", F.col("extreme_temperature").alias(rule.temperature_column))
            .alias("value"),
        )
        entries = F.collect_list(F.when(F.col("kind") == rule.kind, entry))
        parts.append(F.map_from_entries(F.sort_array(entries)).alias(rule.kind))
    return summary.agg(*parts).select(
        F.to_json(F.struct(*(rule.kind for rule in rules))).alias("summary"))
