"""Merkle manifest of a dataset: a postorder append log, and proofs read from it.

The rows of a key (a language) are leaves in the order of their ids. Every ``ARITY``
consecutive nodes, fewer in the last run, become the hash of their digests until one is left,
the key's subroot; the subroots in the order of the keys become the root in the same way.

Builders work on aligned spans of ``SPAN`` leaves. Each appends its nodes to its segment of
the log in the order in which they are completed: a leaf when it is read, an inner node
right after its last child. So a node's place in the segment follows from its level, its
number and the sizes of the subtrees before it, and no index is kept; the siblings on the way
from a leaf to the segment's end are read at those places. The ends of all segments are
the leaves of the next tier, until a key has a single segment. Proofs go the other way: a
tier's segments learn the siblings above them from the tier above.

Leaves are numbered by a range partition by (key, order) and the row's own number as tie
break, so that neither a hot key nor a hot id lands in one task. Spans hold a fixed
number of leaves, so every later group is bounded. Documents are read once; what is written and
shuffled afterwards are digests and the kept columns.

Defined results: a null key is a key of its own before all others, a null id comes before
all others; rows of one id follow one another by their leaf, equal rows are leaves of their own;
null fields count as ``-``, empty texts and very long ones as any value; a null id is never
tampered with; an empty table gives no rows and no root; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256
from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempspan.llm.tables import given_columns
from tempspan.runtime import write_shared

ARITY = 8
SPAN_LEVELS = 3
SPAN = ARITY**SPAN_LEVELS
DIGEST = 32
PROOF = "array<struct<left: string, right: string>>"


class Manifest(NamedTuple):
    """Segments (key, chunk, n, log, members) of every tier, the lowest first; ``keys``: the
    segments of the tree over the subroots; ``root``: its hex digest, None for no rows."""

    tiers: list[DataFrame]
    keys: list[DataFrame]
    root: str | None


def field(value: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def in_key_order(key: Column) -> Column:
    """A string without nulls that sorts as the key does, null first."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("-"))


def levels_of(n: int) -> int:
    """Levels above the leaves of a segment, in a tree of ``n`` leaves."""
    levels = 0
    while levels < SPAN_LEVELS and ARITY**levels < n:
        levels += 1
    return levels


def postorder(level: int, index: np.ndarray, n: int) -> np.ndarray:
    """Places in completion order of nodes of one level, in a tree of ``n`` leaves.

    When a node is completed, all nodes over the leaves up to its end are there on its own
    level and below, and above it only those that end before it begins.
    """
    begin = index * ARITY**level
    end = np.minimum(begin + ARITY**level, n)
    place = sum((-(-end // ARITY**k) for k in range(level + 1)), start=np.int64(-1))
    above = ARITY ** (level + 1)
    while above <= n:
        place = place + begin // above
        above *= ARITY
    return place


def append_log(leaves: list[str], levels: int) -> list[str]:
    """All nodes over the leaves up to the given level, in the order of their completion."""
    log: list[str] = []
    open_runs: list[list[str]] = [[] for _ in range(levels + 1)]

    def add(digest: str, level: int) -> None:
        log.append(digest)
        open_runs[level].append(digest)
        if level < levels and len(open_runs[level]) == ARITY:
            close(level)

    def close(level: int) -> None:
        run, open_runs[level] = open_runs[level], []
        add(sha256("".join(run).encode()).hexdigest(), level + 1)

    for leaf in leaves:
        add(leaf, 0)
    for level in range(levels):
        if open_runs[level]:
            close(level)
    return log


def siblings(log: str, n_leaves: int, levels: int) -> list[tuple[list[str], list[str]]]:
    """For each level the hex digests left and right of every node in its run."""
    result, width = [], n_leaves
    for level in range(levels):
        places = postorder(level, np.arange(width), n_leaves).tolist()
        nodes = [log[2 * DIGEST * p : 2 * DIGEST * (p + 1)] for p in places]
        left, right = [], []
        for start in range(0, width, ARITY):
            run = nodes[start : start + ARITY]
            left += ["".join(run[:i]) for i in range(len(run))]
            right += ["".join(run[i + 1 :]) for i in range(len(run))]
        result.append((left, right))
        width = -(-width // ARITY)
    return result


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``position``, the row's number within its ``key``, and ``n``, the key's rows."""
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    tied = tied.repartitionByRange("key", *order, "tie").sortWithinPartitions("key", *order, "tie")
    placed = write_shared(tied.drop("tie").withColumn("id", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("part", F.shiftright("id", 33))
    # At most a row for each part and one for each key: parts follow the order of the keys.
    parts = placed.groupBy("key", "part").agg(F.min("id").alias("first"), F.count("*").alias("rows"))
    whole = W.partitionBy("key")
    earlier = whole.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(
        "key", "part", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("n"),
    )
    return placed.join(parts, ["key", "part"]).withColumn("position", F.col("id") + F.col("shift"))


def build_segments(nodes: DataFrame, kept: list[str]) -> DataFrame:
    """Segments over (key, position, n, digest); ``members`` holds the kept columns."""

    def segment(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        n = rows.column("n")[0].as_py()
        log = append_log(rows.column("digest").to_pylist(), levels_of(n))
        members = rows.select(kept).to_struct_array() if kept else None
        if isinstance(members, pa.ChunkedArray):
            members = pa.concat_arrays(members.chunks)
        columns = [
            rows.column("key")[:1].combine_chunks(), rows.column("chunk")[:1].combine_chunks(), pa.array([n]),
            pa.array([rows.num_rows]), pa.array([bytes.fromhex("".join(log))], pa.binary()), pa.array([log[-1]]),
        ]
        columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
        if kept:
            columns.append(pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), members))
        return pa.RecordBatch.from_arrays(columns, names=names)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, last = [], None
        for batch in batches:
            spans = list(zip(batch.column("key").to_pylist(), batch.column("chunk").to_pylist()))
            start = 0
            for i in range(1, len(spans) + 1):
                if i < len(spans) and spans[i] == spans[start]:
                    continue
                if waiting and spans[start] != last:
                    yield segment(waiting)
                    waiting = []
                waiting.append(batch.slice(start, i - start))
                last, start = spans[start], i
        if waiting:
            yield segment(waiting)

    names = ["key", "chunk", "n", "leaves", "log", "end", *(["members"] if kept else [])]
    schema = "key string, chunk long, n long, leaves long, log binary, end string"
    if kept:
        member = T.StructType([nodes.schema[c] for c in kept])
        schema += f", members {T.ArrayType(member).simpleString()}"
    spans = nodes.withColumn("chunk", F.expr(f"position DIV {SPAN}"))
    spans = spans.repartition("key", "chunk").sortWithinPartitions("key", "chunk", "position")
    given, _ = given_columns(spans, ["key", "chunk", "n", "digest", *kept], "digest")
    return write_shared(given.mapInArrow(build, schema), "segments")


def build_tiers(nodes: DataFrame, kept: list[str]) -> list[DataFrame]:
    tiers = [build_segments(nodes, kept)]
    while True:
        above = tiers[-1].where(f"n > {SPAN}")
        if above.isEmpty():
            return tiers
        ends = above.select(
            "key", F.col("chunk").alias("position"), F.ceil(F.col("n") / SPAN).alias("n"), F.col("end").alias("digest")
        )
        tiers.append(build_segments(ends, []))


def tops(tiers: list[DataFrame]) -> DataFrame:
    """(key, subroot, tier) of every key."""
    found = [
        t.where(f"n <= {SPAN}").select("key", F.col("end").alias("subroot"), F.lit(i).alias("tier"))
        for i, t in enumerate(tiers)
    ]
    return reduce(DataFrame.union, found)


def build_manifest(rows: DataFrame, order: list[str], kept: list[str]) -> Manifest:
    """Write the log of rows (key, digest, ...), sorted by ``order`` within their key."""
    tiers = build_tiers(numbered(rows, [*order, "digest"]), kept)
    subroots = tops(tiers).select(F.lit("").alias("key"), F.col("key").alias("of"), F.col("subroot").alias("digest"), "tier")
    keys = build_tiers(numbered(subroots, ["of"]), ["of", "tier"])
    last = tops(keys).first()
    return Manifest(tiers, keys, last and last["subroot"])


def extract(segments: DataFrame, member: T.StructType | None) -> DataFrame:
    """The siblings of every leaf of the segments, followed by the segment's own ``path``.

    Rows (key, position, leaf, proof, subroot), and ``kept`` if the segments have members.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in ("key", "chunk", "n", "leaves", "log", "path", "subroot")}
                m, levels, log = row["leaves"].as_py(), levels_of(row["n"].as_py()), row["log"].as_py().hex()
                here = siblings(log, m, levels)
                above = row["path"].as_py() or []
                lefts, rights = [], []
                for leaf in range(m):
                    lefts += [left[leaf // ARITY**k] for k, (left, _) in enumerate(here)]
                    rights += [right[leaf // ARITY**k] for k, (_, right) in enumerate(here)]
                    lefts += [p["left"] for p in above]
                    rights += [p["right"] for p in above]
                steps = levels + len(above)
                proof = pa.StructArray.from_arrays([pa.array(lefts, pa.string()), pa.array(rights, pa.string())], ["left", "right"])
                places = postorder(0, np.arange(m), m).tolist()
                columns = [
                    pa.array([row["key"].as_py()] * m, pa.string()),
                    pa.array(row["chunk"].as_py() * SPAN + np.arange(m)),
                    pa.array([log[2 * DIGEST * p : 2 * DIGEST * (p + 1)] for p in places], pa.string()),
                    pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * steps), proof),
                    pa.array([row["subroot"].as_py()] * m, pa.string()),
                ]
                if member:
                    columns.append(batch.column("members")[i].values)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["key", "position", "leaf", "proof", "subroot", *(["kept"] if member else [])]
    schema = f"key string, position long, leaf string, proof {PROOF}, subroot string"
    if member:
        schema += f", kept {member.simpleString()}"
    wanted = ["key", "chunk", "n", "leaves", "log", "path", "subroot", *(["members"] if member else [])]
    given, _ = given_columns(segments, wanted, "log")
    return given.mapInArrow(read, schema)


def _down(tiers: list[DataFrame], above: list[DataFrame]) -> DataFrame:
    """Proofs of the lowest tier's leaves; ``above`` holds for each tier the paths (key, path,
    subroot) of the keys that end there."""
    proofs = None
    for i in range(len(tiers) - 1, -1, -1):
        paths = above[i].withColumn("chunk", F.lit(0).cast("long"))
        if proofs is not None:
            lower = proofs.select("key", F.col("proof").alias("path"), "subroot", F.col("position").alias("chunk"))
            paths = paths.unionByName(lower)
        has = "members" in tiers[i].columns
        proofs = extract(tiers[i].join(paths, ["key", "chunk"]), tiers[i].schema["members"].dataType.elementType if has else None)
    return proofs


def extract_proofs(manifest: Manifest) -> DataFrame:
    """One row for each leaf: its kept columns, key, position, leaf, subroot, root and proof.

    ``proof`` lists, from the leaf's own level up to the root's children, the concatenated
    hex digests to the left and to the right within the run; both are empty in a run of one.
    """
    no_path = F.lit(None).cast(PROOF)
    tops_of_keys = tops(manifest.keys)
    keys = _down(manifest.keys, [
        tops_of_keys.where(F.col("tier") == i).select("key", no_path.alias("path"), "subroot")
        for i in range(len(manifest.keys))
    ])
    keys = write_shared(
        keys.select(F.col("kept.of").alias("key"), F.col("kept.tier").alias("tier"), F.col("proof").alias("path"),
                    F.col("leaf").alias("subroot")), "paths",
    )
    rows = _down(manifest.tiers, [
        keys.where(F.col("tier") == i).drop("tier") for i in range(len(manifest.tiers))
    ])
    return rows.select("key", "position", "leaf", "subroot", F.lit(manifest.root).alias("root"), "proof", "kept.*")


def proof_digests(proof: Column) -> Column:
    """All sibling digests of a proof, bottom up and from left to right, as one text."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step.left, step.right)), "")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(proof, leaf, lambda digest, step: F.sha2(F.concat(step.left, digest, step.right), 256))


def tampered_text(key: Column, text: Column) -> Column:
    """The text with ASCII letters in lower case where 3 divides the checksum of the id."""
    chosen = F.crc32(key.cast("string").cast("binary")) % 3 == 0
    return F.when(chosen, F.translate(text, ascii_uppercase, ascii_lowercase)).otherwise(text)


def audited(documents: DataFrame) -> DataFrame:
    """Manifest and proofs of all documents, each folded from its text after tampering."""
    given = [F.col(f"`{c}`") for c in ("doc_id", "source", "lang", "n_chars")]
    text, changed = F.col("text"), tampered_text(F.col("doc_id"), F.col("text"))
    leaves = documents.select(
        in_key_order(F.col("lang")).alias("key"), "doc_id", leaf_digest(*given, text).alias("digest"),
        F.when(~changed.eqNullSafe(text), leaf_digest(*given, changed)).alias("tampered"),
    )
    leaves = write_shared(leaves, "leaves")
    proofs = extract_proofs(build_manifest(leaves, ["doc_id"], ["doc_id", "tampered"]))
    seen = proofs.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return seen.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof_digests(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def oracle_sql() -> str:
    """The same digests in SQL, level by level."""
    fields = " || ".join(
        f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars")
    )
    bits = "[xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]"
    crc = (
        "xor(4294967295, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT),"
        f" lambda c, b: list_reduce({bits}, lambda x, i: xor(x >> 1, 3988292384 * (x & 1))), 4294967295::BIGINT))"
    )
    return f"""
        WITH RECURSIVE given AS (
            SELECT row_number() OVER () AS row, doc_id, lang, {fields} AS head, text,
                   CASE WHEN {crc} % 3 = 0 THEN
                       translate(text, '{ascii_uppercase}', '{ascii_lowercase}') ELSE text END AS changed
            FROM documents
        ), hashed AS (
            SELECT row, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS candidate
            FROM given
        ), leaves AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS pos FROM hashed
        ), nodes AS (
            SELECT lang, 0 AS level, pos, leaf AS digest FROM leaves
            UNION ALL
            SELECT lang, level + 1, pos // {ARITY}, sha256(string_agg(digest, '' ORDER BY pos))
            FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS width FROM nodes) WHERE width > 1
            GROUP BY lang, level, pos // {ARITY}
        ), subroots AS (
            SELECT lang, arg_max(digest, level) AS digest,
                   row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM nodes GROUP BY lang
        ), upper_nodes AS (
            SELECT 0 AS level, pos, digest FROM subroots
            UNION ALL
            SELECT level + 1, pos // {ARITY}, sha256(string_agg(digest, '' ORDER BY pos))
            FROM (SELECT *, count(*) OVER () AS width FROM upper_nodes) WHERE width > 1
            GROUP BY level, pos // {ARITY}
        ), way AS (
            SELECT row, lang, 0 AS level, pos, candidate AS digest, '' AS proof FROM leaves
            UNION ALL
            SELECT w.row, w.lang, w.level + 1, w.pos // {ARITY},
                   sha256(string_agg(CASE WHEN n.pos = w.pos THEN w.digest ELSE n.digest END, '' ORDER BY n.pos)),
                   any_value(w.proof) || coalesce(string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos != w.pos), '')
            FROM way w JOIN nodes n ON n.lang IS NOT DISTINCT FROM w.lang AND n.level = w.level
                 AND n.pos // {ARITY} = w.pos // {ARITY}
            WHERE w.level < (SELECT max(level) FROM nodes m WHERE m.lang IS NOT DISTINCT FROM w.lang)
            GROUP BY w.row, w.lang, w.level, w.pos, w.digest
        ), entered AS (
            SELECT w.row, arg_max(w.digest, w.level) AS digest, arg_max(w.proof, w.level) AS proof, any_value(s.pos) AS pos
            FROM way w JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang GROUP BY w.row
        ), upper_way AS (
            SELECT row, 0 AS level, pos, digest, proof FROM entered
            UNION ALL
            SELECT w.row, w.level + 1, w.pos // {ARITY},
                   sha256(string_agg(CASE WHEN n.pos = w.pos THEN w.digest ELSE n.digest END, '' ORDER BY n.pos)),
                   any_value(w.proof) || coalesce(string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos != w.pos), '')
            FROM upper_way w JOIN upper_nodes n ON n.level = w.level AND n.pos // {ARITY} = w.pos // {ARITY}
            WHERE w.level < (SELECT max(level) FROM upper_nodes)
            GROUP BY w.row, w.level, w.pos, w.digest
        ), folded AS (
            SELECT row, arg_max(digest, level) AS folded_root, arg_max(proof, level) AS proof FROM upper_way GROUP BY row
        )
        SELECT doc_id, leaf, s.digest AS subroot, (SELECT arg_max(digest, level) FROM upper_nodes) AS root,
               sha256(proof) AS proof_sha256, folded_root,
               folded_root = (SELECT arg_max(digest, level) FROM upper_nodes) AS verified
        FROM leaves l JOIN folded USING (row) JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
    """
