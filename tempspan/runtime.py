"""Shared storage for intermediate tables.

Intermediate results that are read more than once are written as Parquet into the shared
folder that the cluster names in ``spark.checkpoint.dir``. A written table survives the
loss of executors, needs no recomputation of the text scan behind it, and has an exact
size that can be checked before it is broadcast.
"""

from __future__ import annotations

import contextlib
import functools
import re
import tempfile
import uuid

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_open_tables: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The session's shared folder; a local session without one gets its own."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tempspan-")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_folder(spark)}/tempspan/{uuid.uuid4().hex}/{name}"
    for tables in _open_tables:
        tables.append(path)
    return path


def qualified(spark: SparkSession, path: str) -> str:
    """The full URI of a path, for tasks that open it themselves."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(hadoop).makeQualified(path).toUri().toString()


def write_shared(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` once and continue from the written table."""
    spark = frame.sparkSession
    path = fresh_folder(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextlib.contextmanager
def removed_at_end(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that ``write_shared`` writes inside the block when it ends, and all other
    folders of ``fresh_folder``.

    Frames that read them are of no use afterwards, so write their results inside.
    """
    tables: list[str] = []
    _open_tables.append(tables)
    try:
        yield
    finally:
        _open_tables.remove(tables)
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for table in tables:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
            path.getFileSystem(hadoop).delete(path, True)
