"""Inputs with faults, made from the events table: one file for every ``CHUNK`` event numbers.

Chunks take turns in the kinds of ``KINDS``; each kind has a folder. The tasks write the
files, and each holds a bounded number of events.
"""

from __future__ import annotations

import gzip
import io
import tarfile
import zlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.render import STANDARD, header_of, line_of
from tempspan.runtime import fresh_folder, qualified
from tempspan.sources.streams import write_file

CHUNK = 500
#: Each kind of input with the reason under which it, or a member of it, is left out.
KINDS = {
    "cut-gz": "damaged", "padded-gz": None, "cut-deflate": "damaged",
    "cut-archive": "damaged", "empty-member": "empty", "headerless-member": "no header",
}


def tar_of(members: Iterable[tuple[str, bytes]], mode: str = "w:gz") -> bytes:
    buffer = io.BytesIO()
    options = {"compresslevel": 1} if mode == "w:gz" else {}
    with tarfile.open(fileobj=buffer, mode=mode, **options) as archive:
        for name, content in members:
            entry = tarfile.TarInfo(name)
            entry.size = len(content)
            archive.addfile(entry, io.BytesIO(content))
    return buffer.getvalue()


def damaged_inputs(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Write the files; the folders of the text files and of the archives."""
    root = fresh_folder(spark, "damaged")
    target, kinds, head = qualified(spark, root), list(KINDS), header_of(STANDARD)

    def write(key: tuple, rows: pa.Table) -> pa.Table:
        chunk = key[0].as_py()
        kind = kinds[chunk % len(kinds)]
        body = "".join(f"{line}\n" for line in rows.column("line").to_pylist())
        text, whole = body.encode(), f"{head}\n{body}".encode()
        if kind.endswith("gz"):
            packed = gzip.compress(whole, 1)
            packed = packed[: len(packed) // 2] if kind == "cut-gz" else packed + bytes(1000)
            name, content = f"text/{kind}/chunk-{chunk}.gz", packed
        elif kind == "cut-deflate":
            packed = zlib.compress(whole)
            name, content = f"text/{kind}/chunk-{chunk}.deflate", packed[: len(packed) // 2]
        else:
            extra = {"cut-archive": [], "empty-member": [("none", b"")],
                     "headerless-member": [("bare", text)]}[kind]
            packed = tar_of([("member", whole), *extra])
            name = f"archives/{kind}/chunk-{chunk}.tgz"
            content = packed[: len(packed) // 2] if kind == "cut-archive" else packed
        write_file(f"{target}/{name}", content)
        return pa.table({"name": [name]})

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    chunks = events.select(F.expr(f"event_id DIV {CHUNK}").alias("chunk"), line_of(STANDARD).alias("line"))
    chunks.groupBy("chunk").applyInArrow(write, "name string").count()
    for kind in ("text/padded-gz", "archives/empty-member"):  # folders exist on small tables too
        write_file(f"{target}/{kind}/.keep", b"")
    return f"{root}/text", f"{root}/archives"
