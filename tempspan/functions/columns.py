"""Column expressions shared by the readers and operators.

Text never makes a job fail: numbers and dates that cannot be read become NULL whether
or not the session runs in ANSI mode.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tempspan.schema import RESULT_DATE_FORMAT, TIME_PATTERN


def blank_to_null(text: Column) -> Column:
    """The text as it is, or NULL when there is nothing but spaces in it."""
    return F.when(F.trim(text) != "", text)


def to_double(text: Column) -> Column:
    """The number in the text; NULL for blanks, malformed numbers and NaN.

    Blanks, the most common case in sparse files, are set aside first: a cast that fails
    costs far more than one that succeeds.
    """
    return F.nanvl(blank_to_null(text).try_cast("double"), F.lit(None).cast("double"))


def to_day(text: Column) -> Column:
    """Calendar day of a printed time stamp; the day is the one printed, also at 00:00.

    A pattern and a cast accept the same texts as parsing by format, at a third of the
    time, and without an exception for each text that does not fit.
    """
    return F.when(text.rlike(TIME_PATTERN), text.try_cast("timestamp_ntz").cast("date"))


def result_date(day: Column) -> Column:
    return F.date_format(day, RESULT_DATE_FORMAT)


def parse_result_date(text: Column) -> Column:
    return F.try_to_date(text, RESULT_DATE_FORMAT)


def in_year(day: Column, year: int) -> Column:
    """Whether the day lies in the year, as a range that Parquet can prune by; no day
    lies in a year that the calendar does not have."""
    if not dt.MINYEAR <= year <= dt.MAXYEAR:
        return F.lit(False)
    return day.between(F.lit(dt.date(year, 1, 1)), F.lit(dt.date(year, 12, 31)))


def day_number(day: Column) -> Column:
    """Days since 1970-01-01."""
    return F.unix_date(day)


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole, and 0 when the whole is 0."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))
