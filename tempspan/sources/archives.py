"""Tar archives (plain or compressed by gzip, bzip2, xz or zstd) as text lines.

A compressed stream cannot be read from the middle, so one archive is the smallest piece of
work: archives are spread over tasks, and each task reads its archive as a stream, in
fixed memory however large it and its members are, and passes members on as blocks of
text cut at line ends, which Spark then splits into lines. Members are never written to
local disk, so their names cannot reach outside a folder. Archives are known by their names, their
compression by their first bytes; other files below the path are listed among the rejects.
"""

from __future__ import annotations

import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempspan.runtime import write_shared
from tempspan.sources import streams
from tempspan.sources.lines import without_return
from tempspan.sources.streams import files_to_stream

ARCHIVE_NAME = r"(?i)\.(tar(\.[a-z0-9]+)?|tgz|taz|tbz2?|txz|tzst)$"
BLOCK_BYTES = streams.BLOCK_BYTES
#: Offsets of the rows that stand for damage and for files that are no archives.
DAMAGED_AT = -1
NO_ARCHIVE_AT = -2


def read_archives(spark: SparkSession, path: str | list[str],
                  skip_damaged: bool = False) -> DataFrame:
    """The lines of all archives below ``path``, unpacked once into the shared folder.

    ``source`` is ``archive!member``. Pass the result to ``observations_from_lines``.
    """
    files = files_to_stream(spark, path)
    named = F.col("source").rlike(ARCHIVE_NAME)
    others = files.filter(~named).select(
        "source", "size", F.lit(NO_ARCHIVE_AT).cast("long").alias("offset"),
        F.lit(None).cast("string").alias("value"))
    lines = unpack(files.filter(named), skip_damaged).union(others)
    return write_shared(lines, "archive_lines")


def unpack(archives: DataFrame, skip_damaged: bool = False) -> DataFrame:
    """``(source, size, content)`` archives to lines; lines of one block share its offset.
    Where ``content`` is NULL the task reads the file itself.

    An archive that cannot be opened or breaks off fails the job. With ``skip_damaged`` its
    complete blocks are kept and one row with a NULL value and a negative offset names it;
    an empty member gives one row with a NULL value. Both show up among the rejects. A
    failure of the storage always fails the job.
    """
    block_bytes = BLOCK_BYTES

    # Nested, so that Spark ships the code to executors that lack this package.
    def blocks(source: str, size: int, content: pa.Buffer | None) -> Iterator[tuple]:
        stream = streams.Pieces(streams.archive_pieces(streams.open_source(source, content)))
        try:
            with tarfile.open(fileobj=stream, mode="r|") as archive:
                for member in archive:
                    if not member.isfile():
                        continue
                    name = f"{source}!{member.name}"
                    if member.size == 0:
                        yield name, 0, 0, None
                    file = archive.extractfile(member)
                    pieces = iter(lambda: file.read(min(streams.STEP, block_bytes)), b"")
                    for offset, block in streams.text_blocks(pieces, block_bytes):
                        yield name, member.size, offset, block.decode("utf-8", "replace")
            while stream.read(streams.STEP):
                pass  # to the checksums at the end
        except (tarfile.TarError, EOFError, streams.Damage) as error:
            if not skip_damaged:
                raise ValueError(f"damaged archive {source}: {error}") from error
            yield source, size, DAMAGED_AT, None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file in streams.files_of(batches):
            for row in blocks(*file):
                yield streams.block_batch(*row)

    found = archives.select("source", "size", "content").mapInArrow(read, streams.BLOCKS)
    return found.select(
        "source", "size", "offset", F.explode_outer(F.split("block", "\n")).alias("value"),
    ).withColumn("value", without_return(F.col("value")))
