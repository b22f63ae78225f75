"""Files as byte streams inside tasks: any size, in fixed memory.

Spark hands a binary file to Python as one cell, whole and at most 2 GiB. Here a task gets the
file's name and reads it piece by piece from the cluster's file system, decompresses it
with a limit on what each step puts out, and passes on blocks of text that end where a line
ends. File systems that only Spark's readers can open still come as a cell.

Text files are decompressed by their suffix, with the formats of Hadoop's codecs; archives by their
first bytes. Several streams in one file follow one another. Zero bytes after the last gzip
stream are padding and passed over, as by gzip itself.
"""

from __future__ import annotations

import bz2
import io
import lzma
import os
import re
import struct
import sys
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Spark ships this module's code with the tasks, to executors that lack the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STEP = 1 << 20
BLOCK_BYTES = 4 << 20
#: A line that is longer fails; Spark itself holds at most 2 GiB in a value.
LINE_BYTES = 1 << 29
#: Blocks of lz4 and snappy files that claim to be larger are damaged.
CODEC_BLOCK_BYTES = 1 << 28
#: Suffixes that Hadoop's codecs go by.
COMPRESSED = r"\.(gz|deflate|bz2|zst|lz4|snappy)$"
#: Schemes that pyarrow opens; the names differ for one.
SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs",
           "abfss": "abfss"}
#: Blocks of text as a task passes them on; Spark splits them into lines.
BLOCKS = "source string, size long, offset long, block string"
BLOCK_FIELDS = [("source", pa.string()), ("size", pa.int64()), ("offset", pa.int64()),
                ("block", pa.string())]

Read = Callable[[int], bytes]


class Damage(Exception):
    """A file's content does not follow its format."""


class StorageFailure(Exception):
    """The storage failed, which says nothing about a file's content."""


# Files

def files_to_stream(spark: SparkSession, path: str | list[str],
                    pattern: str | None = None) -> DataFrame:
    """``(source, size, content)`` of the files below ``path``, packed into tasks by size.

    ``content`` is NULL where tasks can open the files, and is then not read here.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    content = F.lit(None).cast("binary") if opened_by_tasks(spark, path) else F.col("content")
    return reader.load(path).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_size").alias("size"), content.alias("content"))


def opened_by_tasks(spark: SparkSession, path: str | list[str]) -> bool:
    hadoop, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    paths = [path] if isinstance(path, str) else path
    systems = [jvm.org.apache.hadoop.fs.Path(p).getFileSystem(hadoop) for p in paths]
    return all(s.getUri().getScheme() in SCHEMES for s in systems)


def _located(uri: str) -> tuple[str | None, str]:
    """A local path, or the address that pyarrow takes."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return unquote(re.sub("^/+", "/", rest)), uri
    return None, f"{SCHEMES[scheme]}:{rest}"


def open_source(source: str, content: pa.Buffer | None) -> Read:
    """The read function of a file's raw bytes."""
    if content is not None:
        return io.BytesIO(content).read
    try:
        local, address = _located(source)
        if local is not None:
            file = open(local, "rb")
        else:
            from pyarrow import fs

            system, path = fs.FileSystem.from_uri(address)
            file = system.open_input_stream(path)
    except OSError as error:
        raise StorageFailure(f"{source}: {error}") from error

    def read(n: int) -> bytes:
        try:
            return file.read(n)
        except OSError as error:
            raise StorageFailure(f"{source}: {error}") from error

    return read


def write_file(uri: str, content: bytes) -> None:
    """Write a file of the cluster's file system from a task, whole or not at all: a local one
    under another name first; object stores show a file when it is complete."""
    local, address = _located(uri)
    if local is None:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(address)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(path) as file:
            file.write(content)
        return
    folder, name = os.path.split(local)
    os.makedirs(folder, exist_ok=True)
    unfinished = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with open(unfinished, "wb") as file:
        file.write(content)
    os.replace(unfinished, local)


# Decompression: raw bytes to pieces of at most STEP bytes

def plain(read: Read) -> Iterator[bytes]:
    while piece := read(STEP):
        yield piece


def _streams(read: Read, make: Callable[[], object], padded: bool = False) -> Iterator[bytes]:
    """The output of decompressors of the standard library, one for each stream in the file."""
    data, first = read(STEP), True
    while data:
        stream = make()
        if padded and not first:
            while data and not data.strip(b"\0"):
                data = read(STEP)
            if not data:
                return
        first = False
        while not stream.eof:
            if not data and getattr(stream, "needs_input", True):
                data = read(STEP)
                if not data:
                    raise Damage("ends early")
            try:
                piece = stream.decompress(data, STEP)
            except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError) as error:
                raise Damage(str(error)) from error
            data = getattr(stream, "unconsumed_tail", b"")
            if piece:
                yield piece
            # zlib may hold output back that needs no more input.
            while len(piece) == STEP and not (data or stream.eof or hasattr(stream, "needs_input")):
                piece = stream.decompress(b"", STEP)
                if piece:
                    yield piece
        data = stream.unused_data or read(STEP)


def gzip_pieces(read: Read) -> Iterator[bytes]:
    return _streams(read, lambda: zlib.decompressobj(31), padded=True)


def deflate_pieces(read: Read) -> Iterator[bytes]:
    return _streams(read, zlib.decompressobj)


def bzip2_pieces(read: Read) -> Iterator[bytes]:
    return _streams(read, bz2.BZ2Decompressor)


def xz_pieces(read: Read) -> Iterator[bytes]:
    return _streams(read, lzma.LZMADecompressor)


def zstd_pieces(read: Read) -> Iterator[bytes]:
    class Raw(io.RawIOBase):
        def readable(self) -> bool:
            return True

        def read(self, n: int = -1) -> bytes:
            return read(n)

    stream = pa.CompressedInputStream(pa.PythonFile(Raw(), "r"), "zstd")
    while True:
        try:
            piece = stream.read(STEP)
        except (OSError, pa.ArrowException) as error:
            raise Damage(str(error)) from error
        if not piece:
            return
        yield piece


def lz4_size(block: bytes) -> int:
    """The size that an lz4 block decompresses to."""
    at, size = 0, 0

    def length(start: int) -> int:
        nonlocal at
        total = start
        while start == 15:
            more = block[at]
            at, total = at + 1, total + more
            if more != 255:
                break
        return total

    while at < len(block):
        token = block[at]
        at += 1
        literals = length(token >> 4)
        at, size = at + literals, size + literals
        if at < len(block):
            at += 2
            size += length(token & 15) + 4
    return size


def snappy_size(block: bytes) -> int:
    size = shift = 0
    for byte in block[:5]:
        size |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return size
    raise Damage("no size")


def _blocks(read: Read, codec: str, size_of: Callable[[bytes], int]) -> Iterator[bytes]:
    """Hadoop's block format: the size of what follows, then chunks, each after its size."""
    def exactly(n: int) -> bytes:
        parts, left = [], n
        while left:
            part = read(min(left, STEP))
            if not part:
                raise Damage("ends early")
            parts.append(part)
            left -= len(part)
        return b"".join(parts)

    decoder = pa.Codec(codec)
    while head := read(1):
        (left,) = struct.unpack(">I", head + exactly(3))
        while left:
            (n,) = struct.unpack(">I", exactly(4))
            if max(n, left) > CODEC_BLOCK_BYTES:
                raise Damage("size out of bounds")
            chunk = exactly(n)
            try:
                size = size_of(chunk)
                if not 0 < size <= left:
                    raise Damage("sizes disagree")
                piece = decoder.decompress(chunk, size, asbytes=True)
            except (IndexError, OSError, pa.ArrowException) as error:
                raise Damage(str(error)) from error
            left -= size
            yield piece


def lz4_pieces(read: Read) -> Iterator[bytes]:
    return _blocks(read, "lz4_raw", lz4_size)


def snappy_pieces(read: Read) -> Iterator[bytes]:
    return _blocks(read, "snappy", snappy_size)


BY_SUFFIX = {"gz": gzip_pieces, "deflate": deflate_pieces, "bz2": bzip2_pieces,
             "zst": zstd_pieces, "lz4": lz4_pieces, "snappy": snappy_pieces}
# The first bytes of compressed files.
BY_MAGIC = {b"\x1f\x8b": gzip_pieces, b"BZh": bzip2_pieces, b"\xfd7zXZ\0": xz_pieces,
            b"\x28\xb5\x2f\xfd": zstd_pieces}


def text_pieces(source: str, read: Read) -> Iterator[bytes]:
    """The content of a text file whose suffix names its codec."""
    return BY_SUFFIX.get(source.rsplit(".", 1)[-1], plain)(read)


def archive_pieces(read: Read) -> Iterator[bytes]:
    """The content of a file whose first bytes tell its codec, if any."""
    head = b""
    while len(head) < 6 and (more := read(6 - len(head))):
        head += more

    def again(n: int) -> bytes:
        nonlocal head
        if head:
            part, head = head[:n], head[n:]
            return part
        return read(n)

    for magic, pieces in BY_MAGIC.items():
        if head.startswith(magic):
            return pieces(again)
    return plain(again)


def files_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Buffer | None]]:
    """(source, size, content) of the files in a task's batches."""
    for batch in batches:
        columns = (batch.column(c) for c in ("source", "size", "content"))
        for source, size, content in zip(*columns):
            yield source.as_py(), size.as_py(), content.as_buffer()


def block_batch(*row: object) -> pa.RecordBatch:
    """One block, in a batch of its own since blocks are large."""
    return pa.RecordBatch.from_arrays(
        [pa.array([value], kind) for value, (_, kind) in zip(row, BLOCK_FIELDS)],
        names=[name for name, _ in BLOCK_FIELDS])


class Pieces:
    """Pieces behind a ``read`` function."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.rest = pieces, b""

    def read(self, n: int) -> bytes:
        parts, left = [], n
        while left:
            if not self.rest:
                self.rest = next(self.pieces, b"")
                if not self.rest:
                    break
            parts.append(self.rest[:left])
            self.rest = self.rest[left:]
            left -= len(parts[-1])
        return b"".join(parts)


def text_blocks(pieces: Iterator[bytes],
                block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, bytes]]:
    """(offset, block) of text cut at line ends, without the last newline of each block."""
    waiting, n, offset, end = [], 0, 0, -1
    for piece in pieces:
        if (last := piece.rfind(b"\n")) >= 0:
            end = n + last
        waiting.append(piece)
        n += len(piece)
        if end < 0 and n > LINE_BYTES:
            raise Damage(f"a line of more than {LINE_BYTES} bytes")
        if end >= 0 and n >= block_bytes:
            whole = b"".join(waiting)
            yield offset, whole[:end]
            offset += end + 1
            waiting, n, end = [whole[end + 1 :]], n - end - 1, -1
    if rest := b"".join(waiting):
        yield offset, rest.removesuffix(b"\n")
