"""The rendered observation files: their room, and the bytes of their text."""

import datetime
from pathlib import Path

from pyspark.sql import functions as F

from checks import queries, render


def test_rendered_files_take_little_room_and_keep_every_line(spark, tmp_path):
    kinds = ["click", "view", "error", "purchase", "signup", None]
    start = datetime.datetime(2020, 1, 1)
    rows = [(i, start + datetime.timedelta(hours=i), i % 7, kinds[i % 6], float(i % 40)) for i in range(3000)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    root = Path(render.observation_files(spark, str(tmp_path)))
    text = spark.read.option("recursiveFileLookup", True).text(str(root))
    n_bytes = text.agg(F.sum(F.octet_length("value") + 1)).first()[0]
    assert n_bytes > 2 * 3000 * 300  # every event is written twice
    assert sum(f.stat().st_size for f in root.rglob("part-*")) < n_bytes / 4

    width = sum(w for _, w in render.STANDARD)
    plain = sum(width + 1 + (len(f"# remark on {i}") + 1 + 4 if v < 10 else 0) for i, *_, v in rows)
    found = queries.q_rejected_files(spark, str(tmp_path)).where(F.col("folder") == render.HEADERLESS).collect()
    assert [(r["reason"], r["bytes"]) for r in found] == [("no header", plain)]
    assert queries.q_required_keys(spark, str(tmp_path)).count() == sum(r[4] >= 2 for r in rows)
