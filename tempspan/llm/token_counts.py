"""Token counts: byte-pair merging with a heap and a linked list, without identifiers.

A text is cut at special strings and by the pre-token pattern; the symbols of a pre-token
form a linked list, and the adjacent pair of lowest rank (the leftmost among equals) is
popped from a heap and merged until no pair has a rank. The count of a pre-token is its
number of initial symbols less its number of merges. No identifier is ever produced: symbols
are known by the strings that the merge list joins.

Texts stay in their rows and are read in Arrow batches; pre-tokens seen before are counted
from a memory that is emptied when it reaches a fixed number of entries, which changes
speed only. A pre-token of n bytes takes O(n log n).

Defined results: null and empty texts have no tokens; repeated rows give repeated results;
an empty table gives no rows; other columns stay, clashing ones are replaced.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tempspan.llm.tables import given_columns, worker_memory

#: Pre-tokens that one Python worker remembers, and the longest that it does.
REMEMBERED = 1_000_000
REMEMBERED_CHARS = 64


def merge_count(symbols: list[int], rank: dict[int, int], joined: list[int]) -> int:
    """How many merges the byte-pair rule makes on a list of symbol numbers.

    ``rank`` holds the rank of a pair under ``left << 32 | right``, ``joined`` the symbol
    that a rank makes. A heap entry is one number, rank first and then the place.
    """
    n = len(symbols)
    look = rank.get
    heap = [
        found * n + i
        for i, (a, b) in enumerate(zip(symbols, symbols[1:]))
        if (found := look(a << 32 | b)) is not None
    ]
    if not heap:
        return 0
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    merges = 0
    while heap:
        at, i = divmod(pop(heap), n)
        left, j = symbols[i], after[i]
        if left < 0 or j >= n or look(left << 32 | symbols[j]) != at:
            continue  # one of the two symbols has been merged since
        symbols[i] = made = joined[at]
        symbols[j] = -1
        after[i] = j = after[j]
        if j < n:
            before[j] = i
            if (found := look(made << 32 | symbols[j])) is not None:
                push(heap, found * n + i)
        if (j := before[i]) >= 0 and (found := look(symbols[j] << 32 | made)) is not None:
            push(heap, found * n + j)
        merges += 1
    return merges


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


@dataclass(frozen=True)
class CountRule:
    """What a tokenizer file says that matters for counting."""

    rank: dict[int, int]
    joined: list[int]
    bytes_as: list[int]
    pretoken: regex.Pattern
    special: regex.Pattern | None


def pretoken_pattern(pattern: str) -> regex.Pattern:
    r"""The pattern with ``\s`` as Unicode's White_Space, as the tokenizer library reads it."""
    return regex.compile(
        pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    )


@functools.cache
def unknown_letters() -> frozenset[str]:
    """Letters and digits that ``regex`` knows and the tokenizer libraries do not yet."""
    from tokenizers import Regex, pre_tokenizers

    known = regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000)))))
    rest = pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]"), "removed").pre_tokenize_str("".join(known))
    return frozenset("".join(part for part, _ in rest))


#: A character that belongs to no class in any version.
NO_CLASS = "\u0378"


def cut_words(pretoken: regex.Pattern, text: str) -> list[str]:
    """The pattern's matches in a text, by the classes of the libraries' Unicode version."""
    if text.isascii() or (unknown := unknown_letters()).isdisjoint(text):
        return pretoken.findall(text)
    masked = "".join(NO_CLASS if c in unknown else c for c in text)
    return [text[m.start() : m.end()] for m in pretoken.finditer(masked)]


def load_rule(path: str, pattern: str) -> CountRule:
    """Read a byte-level tokenizer file."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    number: dict[str, int] = {}
    bytes_as = [number.setdefault(letter, len(number)) for letter in byte_letters()]
    rank, joined = {}, []
    for i, pair in enumerate(content["model"]["merges"]):
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        rank.setdefault(number[left] << 32 | number[right], i)
        joined.append(number.setdefault(left + right, len(number)))
    special = [t["content"] for t in content["added_tokens"]]
    either = "|".join(map(regex.escape, sorted(special, key=len, reverse=True)))
    return CountRule(
        rank, joined, bytes_as, pretoken_pattern(pattern), regex.compile(either) if special else None
    )


class Counts(dict):
    """Tokens by pre-token, counted when first asked for."""

    def __init__(self, rule: CountRule):
        super().__init__()
        self.rule = rule

    def __missing__(self, pretoken: str) -> int:
        rule = self.rule
        symbols = [rule.bytes_as[b] for b in pretoken.encode("utf-8")]
        count = len(symbols) - merge_count(symbols, rule.rank, rule.joined)
        if len(pretoken) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[pretoken] = count
        return count


def _counts(path: str, pattern: str) -> Counts:
    return worker_memory(("counts", path, pattern), lambda: Counts(load_rule(path, pattern)))


def count_text(text: str | None, path: str, pattern: str) -> int:
    """Tokens of one text."""
    if not text:
        return 0
    counts = _counts(path, pattern)
    rule = counts.rule
    if rule.special is None or not rule.special.search(text):
        return sum(map(counts.__getitem__, cut_words(rule.pretoken, text)))
    parts = rule.special.split(text)
    return len(parts) - 1 + sum(
        sum(map(counts.__getitem__, cut_words(rule.pretoken, part))) for part in parts if part
    )


def with_token_counts(
    documents: DataFrame, path: str, pattern: str, text: str = "text", limit: int = 512
) -> DataFrame:
    """Add n_bytes, n_tokens and over_limit (more than ``limit`` tokens) to every document."""
    added = {
        "n_bytes": T.LongType(), "n_tokens": T.LongType(), "over_limit": T.BooleanType(),
    }
    kept = [f for f in documents.schema.fields if f.name not in added]
    schema = T.StructType([*kept, *(T.StructField(k, v) for k, v in added.items())])
    names = [f.name for f in kept]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py() or "" for x in batch.column(at)]
            tokens = [count_text(x, path, pattern) for x in texts]
            counted = [
                pa.array([len(x.encode("utf-8")) for x in texts], pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array([n > limit for n in tokens], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *counted], names=[*names, *added])

    given, at = given_columns(documents, names, text)
    return given.mapInArrow(count, schema)
