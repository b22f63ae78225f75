"""Results as lines of text for people."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what is printed in place of an empty result.
NO_RESULTS = "No results found."


# The width of a leading column and of a number, and what stands between.
LEADING_WIDTH, NUMBER_WIDTH, BETWEEN = 12, 15, " | "
# The columns of the quality report and the length of its rules.
QUALITY_LINE, QUALITY_RULE = "%-30s %-15s %-15s %-30s %-15s", "-" * 105


def cell_formats(kinds: Sequence[str]) -> str:
    """The format of a line with a cell of each kind: text, count, heading or decimal."""
    formats = {
        "text": f"%-{LEADING_WIDTH}s", "heading": f"%-{NUMBER_WIDTH}s",
        "count": f"%-{NUMBER_WIDTH}d", "decimal": f"%-{LEADING_WIDTH}.1f",
    }
    return BETWEEN.join(formats[kind] for kind in kinds)


def heading(titles: Sequence[str], dates: int = 2) -> str:
    kinds = ["text"] * dates + ["heading"] * (len(titles) - dates)
    return cell_formats(kinds) % tuple(titles)


def report_lines(results: DataFrame, dates: int = 2, line: str = "line") -> DataFrame:
    """One text line per result row, in row order: leading columns as text, then numbers,
    those with a fraction with one decimal."""
    kinds = ["text"] * dates + [
        "decimal" if isinstance(field.dataType, T.DoubleType) else "count"
        for field in results.schema[dates:]
    ]
    return results.select(F.format_string(cell_formats(kinds), *results.columns).alias(line))


def quality_lines(report: DataFrame, line: str = "line") -> DataFrame:
    """One text line per row of the quality report."""
    def cell(text: str, *columns: str) -> Column:
        known = F.col(columns[0]).isNotNull()
        return F.when(known, F.format_string(text, *columns)).otherwise("")

    return report.select(F.format_string(
        QUALITY_LINE, "metric",
        cell("%d", "count"), cell("%.2f%%", "percentage"),
        cell("Min: %.2f, Max: %.2f", "min", "max"), cell("Avg: %.2f", "avg"),
    ).alias(line))


def print_quality(report: DataFrame) -> None:
    titles = QUALITY_LINE % ("Metric", "Count", "Percentage", "Range", "Average")
    print(f"\nData Quality Report:\n{QUALITY_RULE}\n{titles}\n{QUALITY_RULE}")
    for row in quality_lines(report).toLocalIterator():
        print(row[0])


def print_report(results: DataFrame, title: str, titles: Sequence[str],
                 rows: int | None = None) -> None:
    """Print a title, the heading and all rows, or the first ``rows`` of them.

    Rows are streamed from the executors, a partition at a time.
    """
    print(f"\n{title}\n{'=' * 80}\n{heading(titles, len(titles) - 3)}\n{'-' * 80}")
    lines = report_lines(results, len(titles) - 3)
    shown = 0
    for row in (lines if rows is None else lines.limit(rows)).toLocalIterator():
        print(row[0])
        shown += 1
    if not shown:
        print(NO_RESULTS)
