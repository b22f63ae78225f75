"""Wave rules: what makes a day count, and which runs of days make a period."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


# The headings that the results of every rule share, in a file and in print.
FILE_TITLES = {
    "start_date_formatted": "From date",
    "end_date_formatted": "To date (inc.)",
    "duration": "Duration (in days)",
}
PRINT_TITLES = ["From date", "To date (inc.)", "Duration (days)"]


@dataclass(frozen=True)
class WaveRule:
    """A period is a run of at least ``min_duration`` consecutive qualifying days, of
    which at least ``extreme_days_required`` are extreme days. Extreme days are counted
    over the whole run.

    ``warm`` rules qualify and grade a day by its maximum with inclusive lower bounds and
    report the highest maximum. Cold rules qualify by the maximum and grade by the
    minimum, with strict upper bounds, and report the lowest minimum.
    """

    kind: str
    warm: bool
    min_duration: int
    temp_threshold: float
    extreme_days_required: int
    extreme_temp_threshold: float
    extreme_days_column: str
    temperature_column: str
    extreme_days_title: str
    temperature_title: str
    report_title: str
    report_extreme_title: str
    report_temperature_title: str

    def qualifies(self, tx: Column) -> Column:
        return tx >= self.temp_threshold if self.warm else tx < self.temp_threshold

    def is_extreme(self, tx: Column, tn: Column | None) -> Column:
        if self.warm:
            return tx >= self.extreme_temp_threshold
        return tn < self.extreme_temp_threshold

    def reading(self, tx: Column, tn: Column | None) -> Column:
        """The daily value whose highest (warm) or lowest (cold) one the period reports."""
        return tx if self.warm else tn

    @property
    def bound(self) -> str:
        """Which bound of a run's readings the period reports."""
        return "highest" if self.warm else "lowest"

    def most_extreme(self, reading: Column | str) -> Column:
        return F.max(reading) if self.warm else F.min(reading)

    def accepts(self, duration: Column, extreme_days: Column) -> Column:
        return (duration >= self.min_duration) & (extreme_days >= self.extreme_days_required)

    def result_titles(self) -> dict[str, str]:
        """Column headings of the result file, keyed by result column."""
        return {
            **FILE_TITLES,
            self.extreme_days_column: self.extreme_days_title,
            self.temperature_column: self.temperature_title,
        }

    def report_titles(self) -> list[str]:
        return [*PRINT_TITLES, self.report_extreme_title, self.report_temperature_title]


# The two published definitions and their result headings.
HEATWAVE = WaveRule(
    kind="heatwaves",
    warm=True,
    min_duration=5,
    temp_threshold=25.0,
    extreme_days_required=3,
    extreme_temp_threshold=30.0,
    extreme_days_column="tropical_days",
    temperature_column="max_temperature",
    extreme_days_title="Number of tropical days",
    temperature_title="Max temperature",
    report_title="Heatwaves",
    report_extreme_title="Tropical days",
    report_temperature_title="Max temp (°C)",
)
COLDWAVE = WaveRule(
    kind="coldwaves",
    warm=False,
    min_duration=5,
    temp_threshold=0.0,
    extreme_days_required=3,
    extreme_temp_threshold=-10.0,
    extreme_days_column="high_frost_days",
    temperature_column="min_temperature",
    extreme_days_title="Number of high frost days",
    temperature_title="Min temperature",
    report_title="Coldwaves",
    report_extreme_title="High frost days",
    report_temperature_title="Min temp (°C)",
)
RULES: dict[str, WaveRule] = {rule.kind: rule for rule in (HEATWAVE, COLDWAVE)}
