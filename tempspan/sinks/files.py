"""Result files and the period table.

Results are written by the executors. A CSV result is a directory; its part files in name
order hold the rows in result order, each with the heading line. Adaptive execution
merges small sorted partitions, so results of ordinary size are one part file.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempspan.functions.columns import parse_result_date
from tempspan.rules import WaveRule
from tempspan.schema import STATION

KEY_TITLES = {STATION: "Station"}


def write_results_csv(results: DataFrame, path: str, rule: WaveRule) -> None:
    """Write the rows of ``present`` with the rule's headings, replacing what is there."""
    titles = {**KEY_TITLES, **rule.result_titles()}
    (
        results.select([F.col(c).alias(titles.get(c, c)) for c in results.columns])
        .write.mode("overwrite").option("header", True).csv(path)
    )


def read_results_csv(spark: SparkSession, path: str, rule: WaveRule,
                     keys: Sequence[str] = (STATION,)) -> DataFrame:
    """A result CSV as periods again: keys, real dates, counts, temperature.

    Headings that are not the rule's, or in another order, fail.
    """
    numbers = {"duration": T.LongType(), rule.extreme_days_column: T.LongType(),
               rule.temperature_column: T.DoubleType()}
    titles = {**{k: KEY_TITLES.get(k, k) for k in keys}, **rule.result_titles()}
    schema = T.StructType([
        T.StructField(title, numbers.get(name, T.StringType()))
        for name, title in titles.items()
    ])
    rows = spark.read.schema(schema).option("header", True).option(
        "enforceSchema", False).csv(path).toDF(*titles)
    return rows.select(
        *keys,
        parse_result_date(F.col("start_date_formatted")).alias("start_date"),
        parse_result_date(F.col("end_date_formatted")).alias("end_date"),
        *numbers,
    )


def write_periods(periods: DataFrame, path: str, rule: WaveRule) -> None:
    """Write one kind of ``detect_kinds`` as Parquet below ``path``, one directory per
    kind. Replaces an earlier run of this kind and leaves the other kinds alone."""
    (
        periods.filter(F.col("kind") == rule.kind).drop("kind")
        .write.mode("overwrite").parquet(f"{path}/kind={rule.kind}")
    )


def read_periods(spark: SparkSession, path: str, keys: Mapping[str, str] | None = None) -> DataFrame:
    """The periods of all kinds. A filter on ``kind`` only reads that kind's directory.

    ``keys`` are the key columns and their types; the schema is given and not inferred,
    because a kind may have no periods at all.
    """
    key_fields = {STATION: "string"} if keys is None else keys
    columns = {**key_fields, "start_date": "date", "end_date": "date", "duration": "long",
               "extreme_days": "long", "extreme_temperature": "double", "kind": "string"}
    schema = ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
    return spark.read.schema(schema).parquet(path)
