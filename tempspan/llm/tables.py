"""Helpers that several operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


T = TypeVar("T")
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS_PER_BATCH = 1000


_memory: tuple[Hashable, object] = (None, None)


def worker_memory(key: Hashable, make: Callable[[], T]) -> T:
    """What an operator keeps in a Python worker between tasks.

    Spark's workers serve one operator after another; only the last one's memory is kept, so
    that memories do not add up beside the executor's heap.
    """
    global _memory
    if _memory[0] != key:
        _memory = (None, None)
        _memory = (key, make())
    return _memory[1]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def given_columns(frame: DataFrame, kept: list[str], source: str) -> tuple[DataFrame, int]:
    """The columns to hand to Python and the place of ``source`` among them.

    ``source`` is handed over once even if it is also kept. Rows come in batches of at most
    ``ROWS_PER_BATCH``, so that a batch of long texts stays small beside a task's memory.
    """
    conf = frame.sparkSession.conf
    if int(conf.get(BATCH_CONF)) > ROWS_PER_BATCH or int(conf.get(BATCH_CONF)) <= 0:
        conf.set(BATCH_CONF, str(ROWS_PER_BATCH))
    columns = kept if source in kept else [*kept, source]
    return frame.select(*(F.col(f"`{c}`") for c in columns)), columns.index(source)
