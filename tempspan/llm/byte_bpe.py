"""Byte-level BPE: encoding by recursive queries in each partition, decoding by ordered
aggregation.

Inside a task an in-process DuckDB holds the merge table (left symbol, right symbol, joined
symbol) and the vocabulary. The pre-tokens of the texts that the task has not seen yet are
rows (word, its symbols, the ranks of its neighbouring pairs) with a mark at both ends; a
recursive query contracts every word's leftmost pair of minimum rank and looks up the two
pairs that the new symbol makes with its neighbours, round by round, until no pair is left.
A pre-token that is itself in the vocabulary is one token, as in the usual library. Decoding
puts the bytes of each document's tokens together by an aggregation ordered by position, in
stretches of a bounded number of tokens.

Texts never leave their rows, so hot sources do not matter; each task works through its
Arrow batches in portions of bounded bytes. Encoded pre-tokens are remembered up to a fixed
number, which changes speed only. A pre-token above ``RECURSIVE_BYTES`` bytes has too many
rounds for the recursion and is merged by the heap of :mod:`tempspan.llm.token_counts`, with
equal results.

Defined results: null and empty texts have no ids and decode to nothing; repeated rows give
repeated results; an empty table gives no rows; other columns stay, clashing ones are
replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from itertools import islice

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tempspan.llm.tables import given_columns, worker_memory
from tempspan.llm.token_counts import cut_words, merge_count, pretoken_pattern

RECURSIVE_BYTES = 128
#: Words that a Python worker remembers, and the longest that it does.
REMEMBERED = 500_000
REMEMBERED_BYTES = 128
#: Text that is worked on at once, and symbols that one DuckDB query gets.
PORTION_BYTES = 4_000_000
QUERY_SYMBOLS = 200_000
#: Bytes of ids that one query decodes, and that are put together as one piece.
QUERY_IDS = 2_000_000
STRETCH = 400_000
#: The rank of a pair that has none, and the symbol before and after every word.
NONE = (1 << 31) - 1

# A joined symbol is the rank of its pair.
MERGE = f"""
WITH RECURSIVE merged(word, symbols, ranks, best) AS (
    SELECT word, symbols, ranks, list_min(ranks) FROM words
    UNION ALL
    SELECT word, symbols[1:i - 1] || [best] || list_slice(symbols, i + 2, len(symbols)),
           made, list_min(made)
    FROM (
        SELECT word, symbols, best, i,
               ranks[1:i - 2] || [coalesce(l.joined, {NONE}), coalesce(r.joined, {NONE})]
                   || list_slice(ranks, i + 2, len(ranks)) AS made
        FROM (SELECT *, list_position(ranks, best) AS i FROM merged WHERE best < {NONE})
        LEFT JOIN merge_table l ON l.pair = (symbols[i - 1]::BIGINT << 32) | best
        LEFT JOIN merge_table r ON r.pair = (best::BIGINT << 32) | symbols[i + 2]
    )
)
SELECT word, list_slice(symbols, 2, len(symbols) - 1) AS ids FROM merged WHERE best = {NONE}
"""

DECODE = """
SELECT piece, unhex(array_to_string(list(hex ORDER BY pos), '')) AS bytes
FROM tokens JOIN vocabulary USING (id) GROUP BY piece
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}


class Codec:
    """The tables of one rank file in an in-process database, and what was seen so far."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.pretoken = pretoken_pattern(pattern)
        self.of_byte = [self.ranks[bytes([b])] for b in range(256)]
        self.symbols = np.array(self.of_byte, np.int32)
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        self.pairs: dict[int, int] = {}
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << 32 | right] = rank
        first = [self.pairs.get(a << 32 | b, NONE) for a in self.of_byte for b in self.of_byte]
        self.rank_of_bytes = np.array(first, np.int32)
        self.ids_by_word: dict[str, bytes] = {}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        self._table(
            "merge_table",
            pair=pa.array(list(self.pairs), pa.int64()),
            joined=pa.array(list(self.pairs.values()), pa.int32()),
        )
        self._table(
            "vocabulary",
            id=pa.array(range(len(self.bytes_of)), pa.int32()),
            hex=pa.array([t.hex() for t in self.bytes_of]),
        )

    def _table(self, name: str, **columns: pa.Array) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _ask(self, name: str, sql: str, **columns: pa.Array) -> pa.Table:
        self.db.register(name, pa.table(columns))
        result = self.db.sql(sql).to_arrow_table()
        self.db.unregister(name)
        return result

    def _merge(self, words: list[bytes]) -> Iterator[tuple[int, bytes]]:
        """Ids of words by the recursive query: (number of the word, ids)."""
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 2)
        starts = np.append(0, ends[:-1])
        # Every word stands between two bytes, which then become the marks.
        data = np.frombuffer(b"\0" + b"\0\0".join(words) + b"\0", np.uint8)
        symbols = self.symbols[data]
        symbols[starts] = symbols[ends - 1] = NONE
        ranks = self.rank_of_bytes[data[:-1].astype(np.int32) << 8 | data[1:]]
        ranks[starts] = ranks[ends - 2] = NONE
        ranks = np.delete(ranks, ends[:-1] - 1)  # from one word's end to the next one's start
        numbers = np.arange(len(words) + 1, dtype=np.int32)
        offsets = np.append(0, ends).astype(np.int32)
        result = self._ask(
            "words", MERGE,
            word=pa.array(numbers[:-1]),
            symbols=pa.ListArray.from_arrays(pa.array(offsets), pa.array(symbols)),
            ranks=pa.ListArray.from_arrays(pa.array(offsets - numbers), pa.array(ranks)),
        )
        ids = result.column("ids").combine_chunks()
        flat = ids.flatten().to_numpy().astype("<u4").tobytes()
        ends = 4 * np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))
        starts = [0, *ends[:-1].tolist()] if len(ends) else []
        for word, a, b in zip(result.column("word").to_pylist(), starts, ends.tolist()):
            yield word, flat[a:b]

    def _learn_words(self, words: Iterable[str]) -> dict[str, bytes]:
        found, waiting, waiting_bytes, n = {}, [], [], 0

        def ask() -> None:
            found.update((waiting[i], ids) for i, ids in self._merge(waiting_bytes))

        for word in words:
            data = word.encode("utf-8")
            rank = self.ranks.get(data)
            if rank is not None:
                found[word] = rank.to_bytes(4, "little")
            elif len(data) > RECURSIVE_BYTES:
                symbols = [self.of_byte[b] for b in data]
                merge_count(symbols, self.pairs, range(len(self.bytes_of)))
                found[word] = np.array([s for s in symbols if s >= 0], "<u4").tobytes()
            else:
                waiting.append(word)
                waiting_bytes.append(data)
                n += len(data)
                if n >= QUERY_SYMBOLS:
                    ask()
                    waiting, waiting_bytes, n = [], [], 0
        if waiting:
            ask()
        return found

    def _join(self, pieces: list[bytes]) -> list[bytes]:
        """The bytes of pieces, each some ids, by the aggregation."""
        lengths = np.fromiter((len(p) // 4 for p in pieces), np.int64, len(pieces))
        result = self._ask(
            "tokens", DECODE,
            piece=pa.array(np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)),
            pos=pa.array(np.arange(lengths.sum(), dtype=np.int32)),
            id=pa.array(np.frombuffer(b"".join(pieces), "<u4").astype(np.int32)),
        )
        found = dict(zip(result.column(0).to_pylist(), result.column(1).to_pylist()))
        return [found[i] for i in range(len(pieces))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [cut_words(self.pretoken, t) for t in texts]
        known = self.ids_by_word
        used = set().union(*cut)
        new = used.difference(known)
        if new and len(known) + len(new) > REMEMBERED:
            kept = {w: known[w] for w in used - new}
            known.clear()
            known.update(kept)
        known.update(self._learn_words(new))
        result = [b"".join(map(known.__getitem__, words)) for words in cut]
        for word in new:
            if len(word) > REMEMBERED_BYTES:
                del known[word]
        return result

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each list of ids."""
        pieces = [data[a : a + STRETCH] for data in ids for a in range(0, len(data), STRETCH)]
        joined = (d for part in portions(pieces, QUERY_IDS) for d in self._join(part))
        return [b"".join(islice(joined, -(-len(data) // STRETCH))) for data in ids]


def codec(path: str, pattern: str) -> Codec:
    """The Python worker's codec."""
    return worker_memory(("byte bpe", path, pattern), lambda: Codec(path, pattern))


def portions(values: list, limit: int) -> Iterator[list]:
    """Consecutive values of together about ``limit`` characters or bytes."""
    part, n = [], 0
    for value in values:
        if part and n + len(value) > limit:
            yield part
            part, n = [], 0
        part.append(value)
        n += len(value)
    if part:
        yield part


def _mapped(frame: DataFrame, source: str, added: dict[str, T.DataType], work) -> DataFrame:
    """Add the columns that ``work`` makes from the column ``source``, batch by batch."""
    kept = [f for f in frame.schema.fields if f.name not in added]
    schema = T.StructType([*kept, *(T.StructField(k, v) for k, v in added.items())])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work([x.as_py() for x in batch.column(at)])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *made], names=[*names, *added])

    given, at = given_columns(frame, names, source)
    return given.mapInArrow(run, schema)


def _encoded(texts: list[str | None], path: str, pattern: str) -> list[bytes]:
    given = [t or "" for t in texts]
    return [ids for part in portions(given, PORTION_BYTES) for ids in codec(path, pattern).encode(part)]


def _decoded(ids: list[bytes | None], path: str, pattern: str) -> list[bytes]:
    return codec(path, pattern).decode([i or b"" for i in ids])


def _count(ids: list[bytes]) -> pa.Array:
    return pa.array([len(i) // 4 for i in ids], pa.int64())


def encode(documents: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Add ``n_tokens`` and ``token_ids`` (little-endian unsigned 32-bit integers)."""

    def work(texts: list[str | None]) -> list[pa.Array]:
        ids = _encoded(texts, path, pattern)
        return [_count(ids), pa.array(ids, pa.binary())]

    return _mapped(documents, text, {"n_tokens": T.LongType(), "token_ids": T.BinaryType()}, work)


def decode(encoded: DataFrame, path: str, pattern: str, token_ids: str = "token_ids") -> DataFrame:
    """Add ``decoded``, the bytes that the ids stand for."""

    def work(ids: list[bytes | None]) -> list[pa.Array]:
        return [pa.array(_decoded(ids, path, pattern), pa.binary())]

    return _mapped(encoded, token_ids, {"decoded": T.BinaryType()}, work)


def encode_and_decode(documents: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """:func:`encode` and :func:`decode` in one pass of the same Python workers."""

    def work(texts: list[str | None]) -> list[pa.Array]:
        ids = _encoded(texts, path, pattern)
        return [_count(ids), pa.array(ids, pa.binary()), pa.array(_decoded(ids, path, pattern), pa.binary())]

    added = {"n_tokens": T.LongType(), "token_ids": T.BinaryType(), "decoded": T.BinaryType()}
    return _mapped(documents, text, added, work)
