"""Source divergence audit: how far the vocabulary of each source is from its language's.

Terms are runs of letters (ASCII letters, lower-cased, and everything beyond ASCII). For each
language the terms of at least ``min_documents`` of its documents are kept; smoothed shares
per source and per language are compared by an integer form of the chi-square divergence,
source against source over all kept terms, and term by term against the language.

Terms are counted in length buckets. A task cuts a portion of its documents, in the order of
their groups, into terms; those of up to 8 bytes become one big-endian unsigned 64-bit word
and those of up to 16 bytes two, each bucket of two more bytes is sorted by that many 16-bit
radix passes, and runs are counted in numpy. The sort is stable, so a run of equal terms holds its
groups, and a group its documents, one after the other. Longer terms are sorted as bytes in
buckets of twice the width. What leaves a task is a row for each group and term of a
portion; one shuffle by (language, term) brings the portions together, and a frequent term
sends at most one row for each portion and group.

The divergence of two sources is a sum over all kept terms, but only terms that both use are
met term by term: those that one of them or neither uses have one value for each count of
occurrences, so they are summed from the number of terms of each count. A term's array holds at most one
entry for each source of the language, and the result a row for each pair of sources; the
sizes of all groups, which the tasks get, are 24 bytes for each source.

All arithmetic is in whole numbers. Groups meet under 64-bit hashes of their names, with a seed
under which no two of the names at hand collide.

Defined results: null text, language and source count as empty; every row is a document,
repeated rows and documents without id too; a group without terms takes part with no
occurrences; a language without kept terms has pairs of value 0 and no terms; one with a
single source has no pairs; ties are ordered by the item's bytes; a text without a separator
is one long term; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tempspan.llm.tables import given_columns
from tempspan.runtime import write_shared

MIN_DOCUMENTS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
#: Bytes of text that a task sorts at once.
PORTION_BYTES = 4 << 20
#: Pairs of sources that a task compares at once.
PAIRS_AT_ONCE = 1 << 17
#: Counts below this stay in 64 bits when multiplied by SCALE.
PLAIN_COUNTS = 9_000_000_000
TERMS = "lid long, gid long, w1 long, w2 long, term string, n long, docs long"

_bytes = np.arange(256, dtype=np.uint8)
_upper = (_bytes >= ord("A")) & (_bytes <= ord("Z"))
_lower = (_bytes >= ord("a")) & (_bytes <= ord("z"))
#: Every byte of a term lower-cased; 0 for bytes that separate terms.
FOLD = np.where(_upper, _bytes + 32, np.where(_lower | (_bytes >= 0x80), _bytes, 0)).astype(np.uint8)
#: The first bytes of a word, by their number.
KEEP = np.array([0] + [(~0 << (64 - 8 * k)) & ((1 << 64) - 1) for k in range(1, 9)], np.uint64)


def cut_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(letters, start, length, document) of all terms; letters have zeros between terms."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    ends = offsets[1:] - offsets[0]
    letters = np.concatenate([[0], np.insert(FOLD[data], ends, 0), np.zeros(16, np.uint8)]).astype(np.uint8)
    edges = np.flatnonzero(np.diff((letters != 0).view(np.int8)))
    starts, lengths = edges[0::2] + 1, edges[1::2] - edges[0::2]
    document = np.searchsorted(ends + np.arange(1, len(ends) + 1), starts)
    return letters, starts, lengths, document


def pack(letters: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first 8 bytes of each term, fewer if it is shorter, as a big-endian word."""
    windows = np.lib.stride_tricks.sliding_window_view(letters, 8)[starts]
    words = np.ascontiguousarray(windows).view(">u8").ravel().astype(np.uint64)
    return words & KEEP[np.clip(lengths, 0, 8)]


def radix_order(words: list[np.ndarray], n_bytes: int) -> np.ndarray:
    """The stable order of words by their first bytes: one pass for every 16 bits."""
    order = None
    for digit in range((n_bytes + 1) // 2 - 1, -1, -1):
        part = (words[digit // 4] >> np.uint64(48 - 16 * (digit % 4))).astype(np.uint16)
        if order is None:
            order = np.argsort(part, kind="stable")
        else:
            order = order[np.argsort(part[order], kind="stable")]
    return order


def byte_rows(letters: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Terms as fixed-width byte strings, filled up with zeros."""
    rows = np.zeros((len(starts), width), np.uint8)
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    rows[np.arange(width) < lengths[:, None]] = letters[np.repeat(starts, lengths) + inside]
    return rows.view(f"S{width}").ravel()


def run_counts(new_term: np.ndarray, group: np.ndarray, document: np.ndarray) -> tuple:
    """(first place, occurrences, documents) of each run of one term and group."""
    new = new_term.copy()
    new[1:] |= group[1:] != group[:-1]
    first = np.flatnonzero(new)
    new[1:] |= document[1:] != document[:-1]
    n = np.diff(np.append(first, len(new)))
    return first, n, np.add.reduceat(new.astype(np.int64), first)


def count_terms(lids: np.ndarray, gids: np.ndarray, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    """Rows of ``TERMS`` for documents that are sorted by their group."""
    letters, starts, lengths, document = cut_terms(texts)

    def rows(at: np.ndarray, first: np.ndarray, n, docs, w1, w2, term) -> pa.RecordBatch:
        doc = document[at[first]]
        return pa.RecordBatch.from_arrays(
            [pa.array(lids[doc]), pa.array(gids[doc]), pa.array(w1.view(np.int64)),
             pa.array(w2.view(np.int64)), term, pa.array(n), pa.array(docs)],
            names=["lid", "gid", "w1", "w2", "term", "n", "docs"],
        )

    def counted(at: np.ndarray, order: np.ndarray, keys: list[np.ndarray]) -> tuple:
        at = at[order]
        new = np.zeros(len(at), bool)
        new[0] = True
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
        return at, *run_counts(new, gids[document[at]], document[at])

    bucket = np.where(lengths <= 16, (lengths + 1) // 2 * 2, 1 << np.ceil(np.log2(lengths)).astype(np.int64))
    for width in np.unique(bucket).tolist():
        at = np.flatnonzero(bucket == width)
        if width <= 16:
            words = [pack(letters, starts[at], lengths[at])]
            if width > 8:
                words.append(pack(letters, starts[at] + 8, lengths[at] - 8))
            order = radix_order(words, width)
            words = [w[order] for w in words]
            at, first, n, docs = counted(at, order, words)
            w1 = words[0][first]
            w2 = words[1][first] if width > 8 else np.zeros(len(first), np.uint64)
            yield rows(at, first, n, docs, w1, w2, pa.nulls(len(first), pa.string()))
        else:
            whole = byte_rows(letters, starts[at], lengths[at], width)
            order = np.argsort(whole, kind="stable")
            at, first, n, docs = counted(at, order, [whole[order]])
            none = np.zeros(len(first), np.uint64)
            yield rows(at, first, n, docs, none, none, pa.array(whole[order][first].tolist(), pa.binary()).cast(pa.string()))


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Documents of together about ``PORTION_BYTES``, sorted by group."""
    waiting, n = [], 0
    for batch in batches:
        waiting.append(batch)
        n += batch.nbytes
        if n >= PORTION_BYTES:
            yield pa.Table.from_batches(waiting).sort_by([("lid", "ascending"), ("gid", "ascending")])
            waiting, n = [], 0
    if n:
        yield pa.Table.from_batches(waiting).sort_by([("lid", "ascending"), ("gid", "ascending")])


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in portions(batches):
        lids, gids = table.column("lid").to_numpy(), table.column("gid").to_numpy()
        texts = table.column("text").cast(pa.large_string()).combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks)
        yield from count_terms(lids, gids, texts)


def kept_terms(named: DataFrame, min_documents: int) -> DataFrame:
    """Rows (lid, term, n, cells): cells hold (gid, n) for every group that has the term."""
    given, _ = given_columns(named, ["lid", "gid", "text"], "text")
    key = ("lid", "w1", "w2", "term")
    cells = (
        given.mapInArrow(_terms, TERMS).repartition(*key)
        .groupBy(*key, "gid").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    terms = cells.groupBy(*key).agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("gid", "n")).alias("cells")
    )
    packed = F.concat(F.hex("w1"), F.when(F.col("w2") == 0, "").otherwise(F.hex("w2")))
    short = F.rtrim(F.decode(F.unhex(packed), "UTF-8"), F.lit("\0"))
    kept = terms.where(F.col("docs") >= min_documents)
    return kept.select("lid", F.coalesce("term", short).alias("term"), "n", "cells")


def share(n: str, total: str, terms: str) -> Column:
    """p of a count: 1 + floor(SCALE * (n + 1) / (total + terms)), exact at every size."""
    below = f"({total} + {terms})"
    return F.expr(
        f"1 + CASE WHEN {n} < {PLAIN_COUNTS} THEN {SCALE} * ({n} + 1) DIV {below}"
        f" ELSE {SCALE}BD * (CAST({n} AS DECIMAL(20,0)) + 1) DIV CAST({below} AS DECIMAL(20,0)) END"
    )


def divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) DIV ({q})")


def _exact_sum(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.sum(column.cast("decimal(38,0)"))


def common_terms(kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows (gid, other, v): sums over the terms that both groups have, of what the sums over
    each group's own terms do not hold yet."""
    known = sorted((r.gid, r.total, r.terms) for r in sizes.select("gid", "total", "terms").collect())
    columns = (np.array([k[i] for k in known], np.int64) for i in range(3))
    shared = kept.sparkSession.sparkContext.broadcast(tuple(columns))

    def shares(n: np.ndarray, below: np.ndarray) -> np.ndarray:
        p = 1 + SCALE * (np.minimum(n, PLAIN_COUNTS) + 1) // below
        for i in np.flatnonzero(n >= PLAIN_COUNTS):
            p[i] = 1 + SCALE * (int(n[i]) + 1) // int(below[i])
        return p

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) * (p - q) // q

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, total, terms = shared.value
        rest = SCALE // (total + np.maximum(terms, 1)) + 1  # of a term that the group lacks
        for batch in batches:
            cells = batch.column("cells")
            length = cells.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = cells.flatten()
            group = np.searchsorted(ids, flat.field("gid").to_numpy())
            p = shares(flat.field("n").to_numpy(), (total + terms)[group])
            begin = np.cumsum(length) - length
            entry_row = np.repeat(np.arange(len(length)), length)
            upto = np.cumsum(length[entry_row])  # pairs up to each entry
            low = 0
            while low < len(upto):
                done = upto[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(upto, done + PAIRS_AT_ONCE, "right")))
                of = length[entry_row[low:high]]
                left = np.repeat(np.arange(low, high), of)
                right = begin[entry_row[left]] + np.arange(len(left)) - np.repeat(np.cumsum(of) - of, of)
                left, right = left[left != right], right[left != right]
                low = high
                g, h = group[left], group[right]
                v = f(p[left], p[right]) - f(p[left], rest[h]) - f(rest[g], p[right]) + f(rest[g], rest[h])
                pairs, at = np.unique(g * len(ids) + h, return_inverse=True)
                sums = np.zeros(len(pairs), np.int64)
                np.add.at(sums, at, v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[pairs // len(ids)]), pa.array(ids[pairs % len(ids)]), pa.array(sums)],
                    names=["gid", "other", "v"],
                )

    return kept.select("cells").mapInArrow(compare, "gid long, other long, v long")


def source_divergence(
    documents: DataFrame, language: str = "lang", source: str = "source", text: str = "text",
    min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) as the module describes."""
    named = documents.select(
        *(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(a)
          for c, a in ((language, "lang"), (source, "source"), (text, "text")))
    )
    names = write_shared(named.select("lang", "source").distinct(), "groups")
    for seed in itertools.count():
        lid, gid = F.xxhash64("lang", F.lit(seed)), F.xxhash64("lang", "source", F.lit(seed))
        groups = names.withColumns({"lid": lid, "gid": gid})
        n, n_gids, n_langs, n_lids = groups.agg(
            F.count("*"), F.count_distinct("gid"), F.count_distinct("lang"), F.count_distinct("lid")
        ).first()
        if n == n_gids and n_langs == n_lids:
            break
    kept = write_shared(kept_terms(named.select(lid.alias("lid"), gid.alias("gid"), "text"), min_documents), "kept")

    languages = kept.groupBy("lid").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total"))
    cells = kept.select("lid", "term", F.col("n").alias("lang_n"), F.inline("cells"))
    # How many terms of each group have each number of occurrences.
    times = write_shared(cells.groupBy("lid", "gid", "n").agg(F.count("*").alias("times")), "times")
    totals = times.groupBy("gid").agg(
        _exact_sum(F.col("n") * F.col("times")).cast("long").alias("total"), F.sum("times").alias("own")
    )
    sizes = groups.join(languages, "lid", "left").join(totals, "gid", "left")
    sizes = write_shared(sizes.na.fill(0), "sizes").withColumn(
        "rest", F.when(F.col("terms") > 0, share("0", "total", "terms"))
    )

    weighed = times.join(sizes.select("gid", "total", "terms"), "gid").select(
        "lid", "gid", "times", share("n", "total", "terms").alias("p")
    )
    other = sizes.select("lid", F.col("gid").alias("other"), F.col("rest").alias("q"))
    own = weighed.join(other, "lid").where("gid != other")
    left = own.select("gid", "other", (F.col("times") * divergence("p", "q")).alias("v"))
    right = own.select(
        F.col("other").alias("gid"), F.col("gid").alias("other"), (F.col("times") * divergence("q", "p")).alias("v")
    )
    sums = common_terms(kept, sizes).union(left).union(right)
    sums = sums.groupBy("gid", "other").agg(_exact_sum("v").alias("v"))
    pairs = sizes.select("lid", "gid", "lang", "source", "rest", "terms", "own").join(
        sizes.select(
            "lid", F.col("gid").alias("other"), F.col("source").alias("item"), F.col("rest").alias("q"),
            F.col("own").alias("other_own"),
        ), "lid",
    ).where("gid != other").join(sums, ["gid", "other"], "left")
    none = F.expr("CAST(terms - own - other_own AS DECIMAL(20,0))") * divergence("rest", "q")
    value = F.coalesce(F.col("v"), F.lit(0)) + F.coalesce(none, F.lit(0))
    of_pair = pairs.select("gid", "lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value"))

    # With the languages' totals per group, a term needs one join.
    compared = cells.join(sizes.select("gid", "lang", "source", "total", "terms", "lang_total"), "gid")
    compared = compared.select(
        "gid", "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q"),
    ).where("p > q")
    of_term = compared.select("gid", "lang", "source", "part", "item", divergence("p", "q").alias("value"))
    ranked = W.partitionBy("gid").orderBy(F.desc("value"), "item")
    best = of_term.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top_terms)
    all_pairs = of_pair.withColumn("rank", F.row_number().over(ranked))
    return all_pairs.unionByName(best).drop("gid")


def oracle_sql(min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> str:
    """The same audit in SQL, every pair of sources over every kept term."""
    return rf"""
        WITH named AS (
            SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   row_number() OVER () AS doc,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ), terms AS (
            SELECT lang, source, doc,
                   unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM named
        ), kept AS (
            SELECT lang, term, count(*)::HUGEINT AS n FROM terms GROUP BY ALL
            HAVING count(DISTINCT doc) >= {min_documents}
        ), counted AS (
            SELECT lang, source, term, count(*)::HUGEINT AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ), languages AS (
            SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang
        ), sizes AS (
            SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total
            FROM (SELECT DISTINCT lang, source FROM named) LEFT JOIN counted USING (lang, source) GROUP BY ALL
        ), shares AS (
            SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
                   1 + {SCALE}::HUGEINT * (coalesce(c.n, 0) + 1) // (s.total + l.v) AS p,
                   1 + {SCALE}::HUGEINT * (k.n + 1) // (l.total + l.v) AS q
            FROM sizes s JOIN languages l USING (lang) JOIN kept k ON k.lang = s.lang
            LEFT JOIN counted c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
        ), sums AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL
        ), both_parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
            FROM sizes a JOIN sizes b ON a.lang = b.lang AND a.source != b.source
            LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, value::BIGINT AS value,
               (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
        FROM both_parts QUALIFY part = 'pair' OR rank <= {top_terms}
    """
