"""What files an input directory holds."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str | list[str],
               pattern: str | None = None) -> DataFrame:
    """``(source, size)`` of every file below ``path``. File contents are not read.

    Spark's readers pass over files of zero bytes and names that start with ``_`` or ``.``.
    Raises FileNotFoundError when there is no such path.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        found = reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(str(path)) from error
        raise
    return found.select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_size").alias("size"),
    )


def first_files(files: DataFrame, count: int = 5) -> DataFrame:
    """``(name, size)`` of the first files by path, for a look at the input."""
    name = F.element_at(F.split("source", "/"), -1).alias("name")
    return files.orderBy("source").limit(count).select(name, "size")


def summarize_files(files: DataFrame) -> DataFrame:
    """One row ``(files, bytes)``."""
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
    )
