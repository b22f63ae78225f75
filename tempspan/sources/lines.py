"""Text lines: scanning directories, splitting documents, dropping comment lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempspan.schema import HEADER_MARK


def scan_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All lines of all files below ``path``, as ``schema.LINES``.

    One scan with one plan however many files there are, and large uncompressed files are
    split over tasks. Spark passes over names that start with ``_`` or ``.``. A line ends at
    a newline; a carriage return before it belongs to the line's end. A file that cannot be
    read to its end fails the job: see ``damage.damaged_files`` for reading the others.
    """
    return (
        spark.read
        .option("recursiveFileLookup", True)
        .option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("source"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_block_start").alias("offset"),
            without_return(F.col("value")).alias("value"),
        )
    )


def without_return(line: Column) -> Column:
    """The line without one carriage return at its end."""
    return F.when(line.endswith("\r"), F.left(line, F.length(line) - 1)).otherwise(line)


def explode_lines(documents: DataFrame, text: str, line: str = "line",
                  line_no: str | None = None) -> DataFrame:
    """One row per line of a text column, keeping the other columns.

    Splits on newline only, so a trailing newline leaves an empty last line. ``line_no``
    names an optional column with the 0-based position of the line.
    """
    others = [c for c in documents.columns if c != text]
    pieces = F.split(F.col(text), "\n")
    if line_no is None:
        return documents.select(*others, F.explode(pieces).alias(line))
    return documents.select(*others, F.posexplode(pieces).alias(line_no, line))


def is_data_line(line: Column, mark: str = HEADER_MARK) -> Column:
    """Neither a comment (starts with ``mark``) nor blank."""
    return ~line.startswith(mark) & (F.ltrim(line) != "")


def data_lines(lines: DataFrame, line: str = "value", mark: str = HEADER_MARK) -> DataFrame:
    return lines.filter(is_data_line(F.col(line), mark))
