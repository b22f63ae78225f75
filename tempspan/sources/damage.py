"""Compressed text files that cannot be read to their end.

Spark can pass over damage, but then it says neither which file it cut short nor that the
storage failed for another reason; of some codecs it takes a cut file for a whole one. So
files are tried first: every compressed file is decompressed once in a task, in fixed
memory, and the damaged ones are named. The others are then read by the same streams, so a
trial and the reading agree, and no list of names enters a plan or the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempspan.runtime import write_shared
from tempspan.sources import streams
from tempspan.sources.lines import scan_lines, without_return
from tempspan.sources.streams import COMPRESSED, files_to_stream


def compressed_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return files_to_stream(spark, path).filter(F.col("source").rlike(COMPRESSED))


def damaged_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(source, size)`` of the compressed files below ``path`` whose content is damaged."""
    def whole(source: str, content: pa.Buffer | None) -> bool:
        try:
            for _ in streams.text_pieces(source, streams.open_source(source, content)):
                pass
        except streams.Damage:
            return False
        return True

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("source"), batch.column("content"))
            keep = pa.array([not whole(s.as_py(), c.as_buffer()) for s, c in rows], pa.bool_())
            yield batch.select(["source", "size"]).filter(keep)

    found = compressed_files(spark, path).mapInArrow(tried, "source string, size long")
    return write_shared(found, "damaged_files")


def undamaged_lines(spark: SparkSession, path: str | list[str], damaged: DataFrame) -> DataFrame:
    """All lines below ``path``, as of ``scan_lines``, but for those of the files in ``damaged``.

    Compressed files meet the damaged ones by name, one row a file, before they are opened;
    the others are scanned by Spark, which leaves compressed files out by their suffix.
    """
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source, size, content in streams.files_of(batches):
            pieces = streams.text_pieces(source, streams.open_source(source, content))
            for offset, block in streams.text_blocks(pieces):
                # No line lies beyond the file's size, as in a scan by Spark.
                text = block.decode("utf-8", "replace")
                yield streams.block_batch(source, size, min(offset, size), text)

    files = compressed_files(spark, path).join(damaged.select("source"), "source", "left_anti")
    unpacked = files.select("source", "size", "content").mapInArrow(blocks, streams.BLOCKS).select(
        "source", "size", "offset", F.explode(F.split("block", "\n")).alias("value"))
    plain = scan_lines(spark, path).filter(~F.col("source").rlike(COMPRESSED))
    return plain.unionByName(unpacked.withColumn("value", without_return(F.col("value"))))
