"""Headers of observation files: finding them, and turning them into column slices.

Finding the header takes one row per file from one scan in which only comment lines
survive, and a small aggregation by file. Nothing is collected and no job runs per file.

Slices. The time field starts at the line start, though the header line itself starts
with the comment mark; every other field starts where its name first occurs in the
header. A field ends where the next field that is present begins, and the last one at the
end of the header. So a field that the header lacks reads as NULL and leaves its
neighbours alone, and the fields may stand in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempspan.schema import HEADER_MARK, OBSERVATION_FIELDS, TIME_FIELD

# No line is longer than Spark's own limit for one value.
UNLIMITED = 2**31 - 1


def detect_headers(lines: DataFrame, source: str | Sequence[str], order: Column,
                   line: str = "value", mark: str = HEADER_MARK, key: str = TIME_FIELD,
                   keep: Sequence[Column] = ()) -> DataFrame:
    """``(source..., header)``: per source the first line, by ``order``, that starts with
    ``mark`` and contains ``key``. Sources without such a line have no row.

    ``keep`` are further aggregates to carry, such as the file size.
    """
    sources = [source] if isinstance(source, str) else list(source)
    text = F.col(line)
    return (
        lines.filter(text.startswith(mark) & text.contains(key))
        .withColumn("_order", order)
        .groupBy(*sources)
        .agg(F.min_by(text, "_order").alias("header"), *keep)
    )


def without_header(sources: DataFrame, headers: DataFrame,
                   source: str | Sequence[str] = "source") -> DataFrame:
    """The sources that have no header and are therefore not read."""
    on = [source] if isinstance(source, str) else list(source)
    return sources.join(headers.select(*on), on, "left_anti")


def header_slices(headers: DataFrame, fields: Sequence[str] = tuple(OBSERVATION_FIELDS),
                  first: str | None = TIME_FIELD, clip_last: bool = True) -> DataFrame:
    """Replace ``header`` by ``starts`` and ``lengths``: one 1-based start and one length
    per field, NULL for a field that the header lacks.

    ``clip_last=False`` lets the last field run on to the end of each line instead of the
    end of the header.
    """
    header = F.col("header")

    def start_of(field: str) -> Column:
        if field == first:
            return F.lit(1)
        return F.nullif(F.instr(header, field), F.lit(0))

    end = F.length(header) + 1 if clip_last else F.lit(UNLIMITED)
    others = [c for c in headers.columns if c != "header"]
    return (
        headers
        .withColumn("starts", F.array(*[start_of(f) for f in fields]))
        .withColumn("_bounds", F.array_append(F.array_compact("starts"), end))
        .select(
            *others, "starts",
            F.transform(
                "starts",
                lambda a: F.array_min(F.filter("_bounds", lambda b: b > a)) - a,
            ).alias("lengths"),
        )
    )
