"""N-gram Jaccard join by MinHash banding, for near duplicates of any number.

1. A text becomes the set of its word n-grams (64-bit hashes), with a key of the set and one
   hash for each band of its MinHash signature. Band and row counts follow from the
   threshold and the target recall.
2. Documents with equal sets are one class of copies, represented by the smallest id.
3. Representatives meet on band hashes: each bucket links its members to its smallest one,
   and connected components of these stars hold every pair that shares a band.
4. Inside a component all pairs are compared on their full n-gram sets. A large component is
   dealt into chunks by hash and each task compares two chunks, so no task holds more than
   two chunks. Tasks return, for every representative, the number of linked documents and
   its local class root; pairs are not written out, and none is left out.
5. Classes are the connected components of the verified links.

Defined results: texts without a word (null, empty, blank) have no n-grams, no links and a
class of their own; a text of fewer words than n has one n-gram of all its words; repeated
rows count as copies; rows without an id get a null class and no links; an empty table gives
no rows; only the columns named by the caller are read, so clashing names cannot meet.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempspan.llm.components import connected_components
from tempspan.runtime import write_shared

CHUNK_SETS = 1024
CHUNK_BYTES = 24 << 20
BROADCAST_BYTES = 32 << 20
BLOCK_COLUMNS = 2048


@dataclass(frozen=True)
class JaccardRule:
    n: int = 5
    threshold: float = 0.8
    recall: float = 0.9995
    max_hashes: int = 128
    seed: int = 11

    def bands_and_rows(self) -> tuple[int, int]:
        """The most rows whose bands reach the recall at the threshold within the hashes."""
        best = (self.max_hashes, 1)
        for rows in range(1, self.max_hashes + 1):
            hit = self.threshold**rows
            bands = 1 if hit >= 1 else math.ceil(math.log(1 - self.recall) / math.log(1 - hit))
            if bands * rows <= self.max_hashes:
                best = (bands, rows)
        return best


def ngram_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a text."""
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(n, len(words))
    count = len(words) - width + 1
    grams = np.full(count, width, np.uint64)
    for k in range(width):
        grams = (grams ^ hashes[k : k + count]) * np.uint64(0x9E3779B97F4A7C15)
        grams ^= grams >> np.uint64(29)
    return np.unique(grams)


def set_key(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def band_hashes(grams: np.ndarray, rule: JaccardRule) -> np.ndarray:
    """One hash for each band of the MinHash signature."""
    bands, rows = rule.bands_and_rows()
    random = np.random.default_rng(rule.seed)
    factors = random.integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = random.integers(0, 1 << 63, bands * rows, np.uint64)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(grams), 1024):
        part = grams[start : start + 1024, None] * factors + shifts
        least = np.minimum(least, (part ^ (part >> np.uint64(31))).min(axis=0))
    mixed = np.arange(bands, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    for k in range(rows):
        mixed = (mixed ^ least[k::rows]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return mixed.view(np.int64)


def signatures(documents: DataFrame, rule: JaccardRule, key: str, text: str) -> DataFrame:
    """Rows (id, set_key, n_grams, bands); set_key is null without n-grams."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, bands = [], [], []
            for value in batch.column(1):
                grams = ngram_set(value.as_py(), rule.n)
                keys.append(set_key(grams) if len(grams) else None)
                sizes.append(len(grams))
                bands.append(band_hashes(grams, rule) if len(grams) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["id", "set_key", "n_grams", "bands"],
            )

    given = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return given.mapInArrow(sign, "id long, set_key binary, n_grams long, bands array<long>")


def common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many n-grams each left set shares with each right set (numbers into ``sets``)."""
    shared = np.zeros((len(left), len(right)), np.float64)
    used = np.union1d(left, right)
    owner = np.repeat(used, [len(sets[i]) for i in used])
    grams, column, times = np.unique(
        np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True
    )
    keep = times[column] > 1
    number = np.cumsum(times > 1) - 1
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    row = np.zeros(len(sets), np.int64)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, BLOCK_COLUMNS):
        a, b = np.searchsorted(column, [start, start + BLOCK_COLUMNS])
        sides = []
        for side in (left, right):
            row[:] = -1
            row[side] = np.arange(len(side))
            at = row[owner[a:b]]
            block = np.zeros((len(side), BLOCK_COLUMNS), np.float32)
            block[at[at >= 0], column[a:b][at >= 0] - start] = 1
            sides.append(block)
        shared += sides[0] @ sides[1].T
    return shared


def linked(
    ids: np.ndarray, copies: np.ndarray, chunk: np.ndarray, sets: list[np.ndarray], a: int, b: int, threshold: float
) -> Iterator[tuple[int, int, int]]:
    """(representative, documents it is linked with, smallest of its local class)."""
    ids, first = np.unique(ids, return_index=True)  # a repeated row comes with its copy
    copies, chunk, sets = copies[first], chunk[first], [sets[i] for i in first]
    size = np.array([len(s) for s in sets], np.float64)
    left = np.flatnonzero(chunk == a)
    right = np.flatnonzero(chunk == b)
    if not len(left) or not len(right):
        return
    shared = common(sets, left, right)
    near = shared * (1 + threshold) >= threshold * (size[left][:, None] + size[right][None, :]) - 1e-9
    if a == b:
        np.fill_diagonal(near, False)
    links = np.zeros(len(ids), np.int64)
    links[left] += near @ copies[right]
    if a != b:
        links[right] += copies[left] @ near
    label = np.arange(len(ids))
    i, j = np.nonzero(near)
    i, j = left[i], right[j]
    while True:
        least = label.copy()
        np.minimum.at(least, i, label[j])
        np.minimum.at(least, j, label[i])
        least = least[least]
        if (least == label).all():
            break
        label = least
    for k in np.flatnonzero(links):
        yield int(ids[k]), int(links[k]), int(ids[label[k]])


def _verified(members: DataFrame, rule: JaccardRule) -> DataFrame:
    """Rows (id, links, root) from members dealt by (component, a, b) and sorted by it."""
    threshold = rule.threshold

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, at, found = [], None, []

        def close() -> None:
            if group:
                columns = list(zip(*group))
                sets = [np.frombuffer(s, np.uint64) for s in columns[3]]
                arrays = [np.array(c, np.int64) for c in columns[:3]]
                found.extend(linked(*arrays, sets, at[1], at[2], threshold))
                group.clear()

        def rows() -> pa.RecordBatch:
            columns = list(zip(*found)) or [(), (), ()]
            found.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["id", "links", "root"]
            )

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for component, a, b, *row in zip(*columns):
                if (component, a, b) != at:
                    close()
                    at = (component, a, b)
                group.append(row)
            if found:
                yield rows()
        close()
        yield rows()

    return members.mapInArrow(verify, "id long, links long, root long")


def _gram_sets(frame: DataFrame, rule: JaccardRule) -> DataFrame:
    """Replace ``text`` by the n-gram set of rows whose set has the expected key."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [ngram_set(t.as_py(), rule.n) for t in batch.column(0)]
            same = [set_key(s) == k.as_py() for s, k in zip(sets, batch.column(1))]
            made = pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.array([s.tobytes() for s in sets], pa.binary())],
                names=[*batch.schema.names[2:], "grams"],
            )
            yield made.filter(pa.array(same, pa.bool_()))

    return frame.select("text", "set_key", "id", "copies", "component", "n_chunks").mapInArrow(
        make, "id long, copies long, component long, n_chunks int, grams binary"
    )


def jaccard_join(
    documents: DataFrame, key: str = "doc_id", text: str = "text", rule: JaccardRule = JaccardRule()
) -> DataFrame:
    """One row for each document: its id, class_id (the smallest id of its class), n_links.

    ``n_links`` counts the other documents whose n-gram sets have at least the threshold's
    Jaccard similarity with this one's, copies included.
    """
    signed = write_shared(signatures(documents, rule, key, text), "signatures")
    classed = signed.where("id IS NOT NULL AND set_key IS NOT NULL")
    kinds = write_shared(
        classed.groupBy("set_key").agg(
            F.min("id").alias("id"), F.count("*").alias("copies"),
            F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands"),
        ),
        "kinds",
    )
    banded = kinds.select("id", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    # Written, so that the adaptive planner can split a band that very many documents share.
    buckets = write_shared(buckets.where("least < most"), "buckets")
    stars = banded.join(buckets, "band").where("id != least")
    meeting = write_shared(
        connected_components(stars.select(F.col("id").alias("a"), F.col("least").alias("b"))), "meeting"
    )
    members = meeting.join(
        kinds.select(F.col("id").alias("node"), "set_key", "copies", "n_grams"), "node"
    )
    members = write_shared(members, "members")
    sizes = members.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_grams").alias("g"))
    sizes = sizes.select(
        "component",
        F.greatest(F.ceil(F.col("n") / CHUNK_SETS), F.ceil(8 * F.col("g") / CHUNK_BYTES)).cast("int").alias("n_chunks"),
    )
    members = members.join(sizes, "component").select(
        F.col("node").alias("id"), "set_key", "copies", "component", "n_chunks"
    )
    members = write_shared(members, "chunked")
    n_members, split = members.agg(F.count("*"), F.max("n_chunks")).first()
    wanted = F.broadcast(members) if 80 * n_members <= BROADCAST_BYTES else members
    texts = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    sets = _gram_sets(texts.join(wanted, "id"), rule)
    chunk = F.pmod(F.xxhash64("id"), F.col("n_chunks")).cast("int")
    dealt = sets.withColumn("chunk", chunk).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1))
    )
    dealt = dealt.select(
        "component", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"),
        "id", "copies", "chunk", "grams",
    )
    dealt = dealt.repartition("component", "a", "b").sortWithinPartitions("component", "a", "b")
    links = write_shared(_verified(dealt, rule), "links")
    if (split or 1) > 1:
        classes = connected_components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    else:
        classes = links.select(F.col("id").alias("node"), F.col("root").alias("component"))
    counted = links.groupBy("id").agg(F.sum("links").alias("links"))
    known = (
        kinds.select("set_key", "id", "copies")
        .join(counted, "id", "left")
        .join(classes.select(F.col("node").alias("id"), "component").distinct(), "id", "left")
        .select(
            "set_key",
            F.coalesce("component", "id").alias("class_id"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    alone = F.col("id").isNull() | F.col("set_key").isNull()
    result = signed.select("id", "set_key").join(known, "set_key", "left")
    return result.select(
        F.col("id").alias(key),
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(0).cast("long")).otherwise(F.col("n_links")).alias("n_links"),
    )
