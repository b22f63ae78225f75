"""Observation files made from the events table, for the queries that read text.

Every event becomes one fixed-width line. Events are spread by type over three layouts
(standard order, reversed order with other widths, some fields missing), each with a
header, and all of them are written once more without any header. Every file gets its
header from the first row of its partition, so any number of files may be written.
Some lines have a blank station or a time that cannot be read, and low readings are
followed by a comment line and a blank line. Fixed-width lines are mostly blanks, so the files
are compressed: as plain text they take some 40 times the room of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempspan.runtime import fresh_folder
from tempspan.schema import OBSERVATION_FIELDS, TIME_FORMAT

STANDARD = [("DTG", 21), *[(f, 24) for f in list(OBSERVATION_FIELDS)[1:]]]
REVERSED = [("DTG", 24), *[(f, 26) for f in list(OBSERVATION_FIELDS)[:0:-1]]]
SPARSE = [("DTG", 22), ("LOCATION", 22), ("NAME", 12), ("ALTITUDE", 22), ("TN_DRYB_10", 25),
          ("T_WETB_10", 12), ("TX_DRYB_10", 25), ("U_10", 22)]
HEADERLESS = "headerless"
# The other fields hold the event's number modulo the first value, and are blank at every
# multiple of the second.
FILLED = {
    "LATITUDE": (90, 7), "LONGITUDE": (180, 11), "U_BOOL_10": (2, 5), "T_DRYB_10": (41, 3),
    "TN_10CM_PAST_6H_10": (37, 4), "T_DEWP_10": (29, 6), "T_DEWP_SEA_10": (31, 8),
    "T_DRYB_SEA_10": (23, 9), "U_SEA_10": (101, 10),
}

_rendered: dict[tuple[str, str], str] = {}


def header_of(layout: list[tuple[str, int]]) -> str:
    cells = [f"# {name}" if name == "DTG" else name for name, _ in layout]
    return "".join(cell.ljust(width) for cell, (_, width) in zip(cells, layout))


def cells_of() -> dict[str, Column]:
    value, kind = F.col("value"), F.col("event_type")
    text, number = value.cast("string"), F.col("event_id")
    return {
        "DTG": F.when((value >= 2) & (value < 3), F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", TIME_FORMAT)),
        "LOCATION": F.when(value < 2, "").otherwise(F.col("user_id").cast("string")),
        "NAME": kind,
        "ALTITUDE": number.cast("string"),
        **{name: F.when(number % every != 0, (number % modulus).cast("string")).otherwise("")
           for name, (modulus, every) in FILLED.items()},
        "TX_DRYB_10": text,
        "TN_DRYB_10": F.when(kind == "signup", "").otherwise(text),
        "T_WETB_10": F.when(kind == "view", "NaN").otherwise(""),
        "U_10": F.when(kind == "click", "n/a").otherwise(F.col("user_id").cast("string")),
    }


def line_of(layout: list[tuple[str, int]]) -> Column:
    cells = cells_of()
    return F.concat(*[
        F.rpad(F.coalesce(cells.get(name, F.lit("")), F.lit("")), width, " ")
        for name, width in layout
    ])


def observation_files(spark: SparkSession, sf_dir: str) -> str:
    """The folder with the rendered files, written once per application and table set."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _rendered:
        root = fresh_folder(spark, "observation_files")
        events = spark.read.parquet(f"{sf_dir}/events.parquet")
        kind = F.coalesce("event_type", F.lit(""))
        standard, reversed_ = kind.isin("click", "view"), kind.isin("error", "purchase")
        _write(events.filter(standard), STANDARD, f"{root}/standard/files", True)
        _write(events.filter(reversed_), REVERSED, f"{root}/reversed/more/files", True)
        _write(events.filter(~standard & ~reversed_), SPARSE, f"{root}/sparse", True)
        _write(events, STANDARD, f"{root}/{HEADERLESS}", False)
        _rendered[key] = root
    return _rendered[key]


def _write(events: DataFrame, layout: list[tuple[str, int]], path: str, header: bool) -> None:
    first_of_partition = F.col("id").bitwiseAND(2**33 - 1) == 0
    head = F.when(first_of_partition, header_of(layout)) if header else F.lit(None)
    low = F.col("value") < 10
    lines = F.array(
        head,
        F.col("line"),
        F.when(low, F.concat(F.lit("# remark on "), F.col("event_id").cast("string"))),
        F.when(low, "   "),
    )
    (
        events.select("event_id", "value", line_of(layout).alias("line"))
        .withColumn("id", F.monotonically_increasing_id())
        .select(F.explode(F.array_compact(lines)).alias("value"))
        .write.option("compression", "gzip").text(path)
    )
