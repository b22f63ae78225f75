"""Run registered queries beside their SQL: python -m checks.compare [SF_DIR] [NAME...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        connection.execute(
            f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples, with columns by name and NaN and NULL alike."""
    frame = frame[sorted(frame.columns)]
    rows = []
    for row in frame.itertuples(index=False, name=None):
        rows.append(tuple(None if pd.isna(v) else str(pd.Timestamp(v)) if hasattr(v, "year")
                          else float(v) if isinstance(v, (int, float)) else v for v in row))
    return sorted(rows, key=repr)


def difference(spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str,
               name: str) -> str | None:
    """What differs between the query and its SQL, or None when they agree."""
    ours = QUERIES[name](spark, sf_dir).toPandas()
    theirs = connection.execute(ORACLE_SQL[name]).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} against {sorted(theirs.columns)}"
    left, right = canonical(ours), canonical(theirs)
    if left != right:
        odd = [r for r in zip(left, right) if r[0] != r[1]][:2]
        return f"{len(left)} rows against {len(right)}; first differences {odd}"
    return None


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]").appName("compare")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(sf_dir), 0
    for name in names:
        start = time.perf_counter()
        rows, problem = 0, None
        try:
            if name in ORACLE_SQL:
                problem = difference(spark, connection, sf_dir, name)
                counted = f"SELECT count(*) FROM ({ORACLE_SQL[name]})"
                rows = connection.execute(counted).fetchone()[0]
            else:
                rows = QUERIES[name](spark, sf_dir).count()
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        failed += problem is not None
        state = "FAIL" if problem else "ok" if name in ORACLE_SQL else "rows only"
        print(f"{state:9} {name:24} {rows:8} rows {time.perf_counter() - start:6.2f}s "
              f"{problem or ''}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
