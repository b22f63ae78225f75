"""Fixed-width observation files as typed rows.

Two scans of the text, whatever the number of files: one that keeps comment lines only
and yields one header per file, and one that reads the data. The headers are written to
the shared folder in between, so exact sizes decide how the lines get their slices:

1. Up to ``broadcast_limit`` bytes the slices of all files are broadcast, and the lines
   do not move.
2. With more files than that, those that differ from the most common header are
   broadcast, when they stay within the limit, and all others get its slices.
3. Beyond that, the files are split into ranges of their paths whose headers fit the limit
   each. One range after another is read, with a broadcast of its own, and its lines are
   written to the shared folder beside their slices, which are the same for all lines of a
   file and take next to no room there. So no more than one broadcast is alive at a time,
   Spark opens only the files of the range, and the lines do not move.
4. Where not even one range fits, which takes a limit near the size of a single header,
   lines and headers meet in a shuffled join by file *and* chunk of the file. A chunk holds
   at most ``CHUNK_BYTES`` of text, so no key grows with the size of a file.

Departures from a plain left-to-right reading of the format, on purpose: see ``headers``
for missing and reordered fields, and ``to_double`` for NaN.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempspan.functions.columns import blank_to_null, to_day, to_double
from tempspan.runtime import write_shared
from tempspan.schema import DAY, OBSERVATION_FIELDS, REQUIRED_FIELDS, TIME_FIELD
from tempspan.sources.archives import DAMAGED_AT, NO_ARCHIVE_AT
from tempspan.sources.damage import damaged_files, undamaged_lines
from tempspan.sources.headers import detect_headers, header_slices, without_header
from tempspan.sources.inventory import list_files
from tempspan.sources.lines import data_lines, scan_lines

BROADCAST_LIMIT = 128 * 1024 * 1024
CHUNK_BYTES = 128 * 1024 * 1024


class Ingested(NamedTuple):
    """Typed observations, and ``(source, size, reason)`` of every input that is left out."""

    observations: DataFrame
    rejects: DataFrame


def read_observations(spark: SparkSession, path: str | list[str], clip_last: bool = True,
                      skip_damaged: bool = False,
                      broadcast_limit: int = BROADCAST_LIMIT) -> Ingested:
    """Read every observation file below ``path``.

    Raises FileNotFoundError when there are no files and ValueError when none has a
    header; a file without a header is otherwise left out and listed in ``rejects``. A
    damaged compressed file fails the job; with ``skip_damaged`` it is left out as a whole
    and listed there too.
    """
    if not skip_damaged:
        files = list_files(spark, path)
        return _ingest(scan_lines(spark, path), files, clip_last, broadcast_limit)
    damaged = damaged_files(spark, path)
    lines = undamaged_lines(spark, path, damaged)
    files = list_files(spark, path).join(damaged.select("source"), "source", "left_anti")
    found = _ingest(lines, files, clip_last, broadcast_limit)
    named = damaged.select("source", "size", F.lit("damaged").alias("reason"))
    return Ingested(found.observations, found.rejects.unionByName(named))


def observations_from_lines(lines: DataFrame, clip_last: bool = True,
                            broadcast_limit: int = BROADCAST_LIMIT) -> Ingested:
    """Read observations from lines that are already a table (``schema.LINES``)."""
    sources = lines.groupBy("source").agg(
        F.max("size").alias("size"), F.min("offset").alias("offset"))
    return _ingest(lines, sources, clip_last, broadcast_limit)


def _ingest(lines: DataFrame, sources: DataFrame, clip_last: bool,
            broadcast_limit: int) -> Ingested:
    headers = write_shared(file_headers(lines), "headers")
    bytes_of_headers = layout_bytes(headers)
    if bytes_of_headers == 0:
        if sources.isEmpty():
            raise FileNotFoundError("no input files")
        raise ValueError("no input file has a header")
    sliced = attach_layouts(data_lines(lines), headers, sources, clip_last, broadcast_limit,
                            bytes_of_headers)
    observations = derive_day(require_keys(cast_fields(slice_fields(sliced))))
    reason = F.when(F.col("size") == 0, "empty").otherwise("no header")
    if "offset" in sources.columns:
        reason = (F.when(F.col("offset") == DAMAGED_AT, "damaged")
                  .when(F.col("offset") == NO_ARCHIVE_AT, "no archive").otherwise(reason))
    rejects = without_header(sources, headers).select("source", "size", reason.alias("reason"))
    return Ingested(observations, rejects)


def file_headers(lines: DataFrame) -> DataFrame:
    """``(source, header, size)`` of every file that has a header."""
    position = F.struct("offset", F.monotonically_increasing_id())
    return detect_headers(lines, "source", position, keep=[F.max("size").alias("size")])


def layout_bytes(headers: DataFrame) -> int:
    """Upper bound of the memory that the slices of these headers take, 0 for none.

    A broadcast row holds its key twice and eight bytes per number.
    """
    return headers.agg(F.coalesce(F.sum(row_bytes()), F.lit(0))).first()[0]


def row_bytes() -> Column:
    return 2 * F.octet_length("source") + 2 * 8 * len(OBSERVATION_FIELDS) + 128


def attach_layouts(lines: DataFrame, headers: DataFrame, sources: DataFrame,
                   clip_last: bool = True, broadcast_limit: int = BROADCAST_LIMIT,
                   bytes_of_headers: int | None = None) -> DataFrame:
    """Give every line the slices of its file; lines of files without a header go."""
    def slices(frame: DataFrame) -> DataFrame:
        return spread_slices(header_slices(frame, clip_last=clip_last))

    measured = with_narrow(lines)
    if bytes_of_headers is None:
        bytes_of_headers = layout_bytes(headers)
    if bytes_of_headers <= broadcast_limit:
        return attach_by_broadcast(measured, slices(headers))
    common = most_common(headers)
    others = write_shared(differing(sources, headers, common), "differing_headers")
    if layout_bytes(others) <= broadcast_limit:
        default = slices(lines.sparkSession.createDataFrame([(common,)], "header string"))
        return attach_by_difference(measured, slices(others), default.first().asDict())
    ranges = source_ranges(headers, bytes_of_headers, broadcast_limit)
    if not ranges:
        return attach_by_chunk(measured, slices(headers))
    return land_ranges([(measured.filter(r), slices(headers.filter(r))) for r in ranges])


def land_ranges(groups: Sequence[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Lines with their slices, one (lines, slices) group written after the other.

    The slices of a group are built once and forgotten when its lines are written.
    """
    landed = [write_shared(attach_by_broadcast(*group), "lines_of_range") for group in groups]
    return reduce(DataFrame.unionByName, landed)


def source_ranges(headers: DataFrame, bytes_of_headers: int, limit: int) -> list[Column]:
    """Conditions that split the sources into ranges whose headers fit the limit each; none
    when a single range does not fit."""
    wanted = 2 * -(-bytes_of_headers // max(limit, 1))
    if wanted > headers.count():
        return []
    dealt = headers.repartitionByRange(wanted, "source").withColumn("part", F.spark_partition_id())
    parts = dealt.groupBy("part").agg(
        F.min("source").alias("low"), F.sum(row_bytes()).alias("bytes")).orderBy("low").collect()
    if max(part["bytes"] for part in parts) > limit:
        return []
    lows = [part["low"] for part in parts]
    ends = [F.col("source") < high for high in lows[1:]] + [F.lit(True)]
    starts = [F.lit(True)] + [F.col("source") >= low for low in lows[1:]]
    return [start & end for start, end in zip(starts, ends)]


def most_common(headers: DataFrame) -> str:
    counts = headers.groupBy("header").count()
    return counts.orderBy(F.desc("count"), "header").first()["header"]


def differing(sources: DataFrame, headers: DataFrame, common: str) -> DataFrame:
    """``(source, header, has_header)`` of the files whose header is not ``common``."""
    known = sources.select("source").join(headers.select("source", "header"), "source", "left")
    return known.filter(~F.col("header").eqNullSafe(common)).withColumn(
        "has_header", F.col("header").isNotNull())


def spread_slices(layouts: DataFrame,
                  fields: Sequence[str] = tuple(OBSERVATION_FIELDS)) -> DataFrame:
    """``starts`` and ``lengths`` as two plain columns per field.

    Columns of their own are pruned with the fields that nobody asks for, and keep the
    code that cuts all fields small enough for the JVM to compile.
    """
    others = [c for c in layouts.columns if c not in ("starts", "lengths")]
    return layouts.selectExpr(
        *others,
        *[f"starts[{i}] AS {f}_start" for i, f in enumerate(fields)],
        *[f"lengths[{i}] AS {f}_length" for i, f in enumerate(fields)],
    )


def with_narrow(lines: DataFrame, line: str = "value") -> DataFrame:
    """Mark the lines in which every character is one byte."""
    return lines.withColumn("narrow", F.length(line) == F.octet_length(line))


def attach_by_broadcast(lines: DataFrame, layouts: DataFrame) -> DataFrame:
    return lines.join(F.broadcast(layouts.drop("size")), "source")


def attach_by_difference(lines: DataFrame, others: DataFrame,
                         default: Mapping[str, int | None]) -> DataFrame:
    """Slices from ``others`` for the files listed there, else the default ones."""
    joined = lines.join(F.broadcast(others), "source", "left")
    joined = joined.filter(F.coalesce("has_header", F.lit(True)))
    listed = F.col("has_header").isNotNull()
    return joined.withColumns({
        column: F.when(listed, F.col(column)).otherwise(F.lit(value).cast("int"))
        for column, value in default.items()
    })


def attach_by_chunk(lines: DataFrame, layouts: DataFrame,
                    chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    chunk_of = F.floor(F.col("offset") / chunk_bytes)
    last_chunk = F.floor(F.col("size") / chunk_bytes)
    chunks = F.sequence(F.lit(0).cast("long"), last_chunk)
    per_chunk = layouts.withColumn("chunk", F.explode(chunks)).drop("size")
    return lines.withColumn("chunk", chunk_of).join(per_chunk, ["source", "chunk"])


def slice_fields(lines: DataFrame, fields: Sequence[str] = tuple(OBSERVATION_FIELDS),
                 line: str = "value") -> DataFrame:
    """Cut each line at its slices into trimmed text columns.

    Positions count characters. Spark finds a character by walking from the start of the
    text, so ``narrow`` lines are cut by bytes instead, which it reaches directly.
    """
    cut = """trim(CASE WHEN narrow
        THEN CAST(substring(CAST({line} AS BINARY), {field}_start, {field}_length) AS STRING)
        ELSE substring({line}, {field}_start, {field}_length) END) AS {field}"""
    cells = lines.selectExpr(*[cut.format(line=line, field=field) for field in fields])
    # Catalyst moves filters on the cells below this projection and into the header join,
    # with a copy of the cutting expressions for each. It does not move them past metrics,
    # while unused cells are still pruned. So every requested field is cut once. The name
    # follows from the plan: equal scans stay equal, and different ones in a query differ.
    return cells.observe(f"cut_{cells.semanticHash():x}", F.count(F.lit(1)).alias("lines"))


def cast_fields(fields: DataFrame,
                types: Mapping[str, str] = OBSERVATION_FIELDS) -> DataFrame:
    """Blank text to NULL, numeric fields to double; malformed numbers to NULL."""
    return fields.select(*[
        (to_double(F.col(name)) if kind == "double" else blank_to_null(F.col(name))).alias(name)
        for name, kind in types.items()
    ])


def require_keys(observations: DataFrame,
                 keys: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Rows that have all keys."""
    return observations.filter(reduce(and_, [F.col(k).isNotNull() for k in keys]))


def derive_day(observations: DataFrame, time: str = TIME_FIELD, day: str = DAY) -> DataFrame:
    """Add the calendar day of the printed time, NULL when it cannot be read."""
    return observations.withColumn(day, to_day(F.col(time)))


def union_sources(*sources: DataFrame) -> DataFrame:
    """Observations of several inputs in one frame; repeated rows are kept."""
    return reduce(DataFrame.unionByName, sources)
