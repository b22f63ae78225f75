"""Benchmark decontamination: q-gram lemma filtering and banded alignment.

Benchmark items and documents are folded to lower-case letters and digits with single
spaces. Every stretch of m = 100 characters of an item is a window; a shorter item is one
itself. A window within k edits of a stretch of a document shares at least m - q + 1 - k * q
of its q-grams with it, and these lie on k + 1 neighbouring diagonals (document position
minus item position). So shared q-grams are counted in overlapping bands of 2 * (k + 1)
diagonals, windows that reach the bound in a band are retained, and a banded alignment
decides whether the distance is within k.

The shortest quotation that is surely found has m folded characters, wherever in the item it
begins, or is all of a shorter item; it may have k edits (6 in 100 characters). Shorter
quotations are found if k edits complete them to a window, that is from m - k characters on.

The benchmark is the stated query set: its items are broadcast in blocks of a fixed number
of q-grams and every document is read against every block in its own task; no document meets
another. With more blocks than one, a pass over the documents for each leaves what it finds in
the shared folder, so that one block is alive at a time. Inside a task, shared q-grams are
counted for overlapping stretches of a document, a bounded number at a time, so a text and an item that
repeat one word take time but no more memory than others.

Defined results: null and empty texts have no regions; an item shorter than q characters
after folding is never found; items without an id are searched like others, their regions
have a null id and ``item_ids`` leaves them out; repeated rows give repeated results; empty
tables give no rows or no regions; other columns stay, clashing ones are replaced.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempspan.llm.tables import given_columns, worker_memory
from tempspan.runtime import write_shared

REGIONS = "array<struct<item_id:bigint,start:bigint,end:bigint,edits:int>>"
ARROW_REGIONS = pa.list_(
    pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())])
)
FILTER_BITS = 22
OUTSIDE = np.uint32(0xFFFFFFFF)
#: Windows aligned at once.
ALIGNED = 1024
#: Shared q-grams that are held at once, and regions before overlapping ones are merged.
POSTINGS = 1 << 19
MERGED = 20_000
#: Longer items are searched in pieces that overlap by a window.
ITEM_PIECE = 1024


@dataclass(frozen=True)
class MatchRule:
    q: int = 10
    window: int = 100
    edit_share: float = 0.06
    #: q-grams of one broadcast block (16 bytes each).
    block_grams: int = 2_000_000

    def budget(self, m: int) -> int:
        """Edits allowed in a window of m characters, so that the lemma's bound is positive."""
        return max(0, min(int(self.edit_share * m), (m - self.q) // self.q))


def fold_table() -> np.ndarray:
    return worker_memory("letters and digits", _fold_table)


def _fold_table() -> np.ndarray:
    """For each code point its lower-case letter or digit, or a space."""
    table = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        letter = chr(code)
        if letter.isalnum():
            lower = letter.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def folded(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The folded characters and which characters of the text they are (a mask)."""
    plain = fold_table()[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    blank = plain == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    return plain[keep], keep


def qgrams(plain: np.ndarray, q: int) -> np.ndarray:
    n = len(plain) - q + 1
    if n < 1:
        return np.empty(0, np.uint64)
    gram = np.full(n, q, np.uint64)
    for k in range(q):
        gram ^= plain[k : k + n]
        gram *= np.uint64(0x9E3779B97F4A7C15)
    return gram ^ (gram >> np.uint64(29))


class Block:
    """Some benchmark items, their q-grams sorted, and a filter over them."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]], rule: MatchRule):
        self.rule = rule
        self.ids = list(dict.fromkeys(item for item, _ in items))
        number = {item: k for k, item in enumerate(self.ids)}
        self.items = [number[item] for item, _ in items]
        self.texts = [text for _, text in items]
        grams = [qgrams(text, rule.q) for text in self.texts]
        flat = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.grams = flat[order]
        self.owner = np.repeat(np.arange(len(grams), dtype=np.int32), [len(g) for g in grams])[order]
        self.place = np.concatenate([np.arange(len(g), dtype=np.int32) for g in grams] or [np.empty(0, np.int32)])[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.grams >> np.uint64(64 - FILTER_BITS)] = True
        self.sizes = np.array([min(len(t), rule.window) for t in self.texts], np.int64)
        self.budget = np.array([rule.budget(int(m)) for m in self.sizes], np.int64)
        self.bound = np.maximum(self.sizes - rule.q + 1 - self.budget * rule.q, 1)

    def matches(self, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, first posting, postings) of the document's q-grams that some item has."""
        found, n = [], len(plain)
        for start in range(0, n, 1 << 18):
            grams = qgrams(plain[start : start + (1 << 18) + self.rule.q - 1], self.rule.q)
            at = np.flatnonzero(self.filter[grams >> np.uint64(64 - FILTER_BITS)])
            first = np.searchsorted(self.grams, grams[at], "left")
            times = np.searchsorted(self.grams, grams[at], "right") - first
            at, first, times = at[times > 0], first[times > 0], times[times > 0]
            if len(at):
                found.append((at + start, first, times))
        if not found:
            return (np.empty(0, np.int64),) * 3
        return tuple(np.concatenate(part) for part in zip(*found))

    def hits(self, at: np.ndarray, first: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, place in it, diagonal) of every posting of some matches."""
        offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        posting = np.repeat(first, times) + offset
        place = self.place[posting].astype(np.int64)
        return self.owner[posting].astype(np.int64), place, np.repeat(at, times) - place

    def parts(self, at: np.ndarray, first: np.ndarray, times: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """The matches with about ``POSTINGS`` postings at once: stretches of the document that
        overlap by more than any window's reach, so that each window is whole in one."""
        upto, i = np.cumsum(times), 0
        reach = int(self.sizes.max(initial=0) + 2 * (self.budget.max(initial=0) + 1) + self.rule.q)
        while i < len(at):
            done = upto[i - 1] if i else 0
            j = max(int(np.searchsorted(upto, done + POSTINGS, "right")), int(np.searchsorted(at, at[i] + 2 * reach)))
            yield from self.by_owner(at[i:j], first[i:j], times[i:j])
            if j >= len(at):
                return
            i = int(np.searchsorted(at, max(at[j - 1] + 1 - reach, at[i] + reach)))

    def by_owner(self, at: np.ndarray, first: np.ndarray, times: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """A stretch's matches, some texts at a time where they are too many at once. A text
        and a stretch are short, so those of one text are not."""
        if times.sum() <= 2 * POSTINGS:
            yield at, first, times
            return
        grams, column, count = np.unique(first, return_inverse=True, return_counts=True)
        length = np.zeros(len(grams), np.int64)
        length[column] = times
        gram = np.repeat(np.arange(len(grams)), length)
        posting = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + grams[gram]
        owner = self.owner[posting]
        load = np.cumsum(np.bincount(owner, weights=count[gram]))
        low = 0
        while low < len(load):
            done = load[low - 1] if low else 0
            high = max(int(np.searchsorted(load, done + POSTINGS, "right")), low + 1)
            mine = (owner >= low) & (owner < high)
            low = high
            some = np.bincount(gram[mine], minlength=len(grams))
            begin = np.zeros(len(grams), np.int64)
            kinds, where = np.unique(gram[mine], return_index=True)
            begin[kinds] = posting[mine][where]  # a gram's postings are in the order of texts
            keep = some[column] > 0
            if keep.any():
                yield at[keep], begin[column][keep], some[column][keep]

    def regions(self, plain: np.ndarray) -> list[tuple[int | None, int, int, int]]:
        """(item, start, end, edits) in folded positions, overlapping ones merged."""
        at, first, times = self.matches(plain)
        found: list[tuple[int, int, int, int]] = []
        covered: dict[int, tuple[int, int]] = {}
        for part in self.parts(at, first, times):
            for some in self.windows(plain, *self.hits(*part), covered):
                found.extend(some)
                if len(found) > MERGED:
                    found = merged(found)
        return [(self.ids[item], start, end, edits) for item, start, end, edits in merged(found)]

    def windows(
        self, plain: np.ndarray, text: np.ndarray, place: np.ndarray, diagonal: np.ndarray, covered: dict
    ) -> Iterator[list[tuple[int, int, int, int]]]:
        """Alignments of the windows that reach the bound in a band, but of those in a stretch
        that is ``covered``, that is known to be a quotation of the item without edits."""
        if not len(text):
            return
        band = diagonal // (self.budget[text] + 1)
        # band b holds the diagonals of steps b and b + 1
        text, place, band = np.tile(text, 2), np.tile(place, 2), np.append(band, band - 1)
        order = np.lexsort((place, band, text))
        text, place, band = text[order], place[order], band[order]
        # the hits i and i + bound - 1 of a band lie in a window
        last = np.arange(len(text)) + self.bound[text] - 1
        first = np.flatnonzero(last < len(text))
        last = last[first]
        near = (text[first] == text[last]) & (band[first] == band[last])
        near &= place[last] - place[first] <= self.sizes[text[first]] - self.rule.q
        first, last = first[near], last[near]
        if not len(first):
            return
        text, band, low, high = text[first], band[first], place[last], place[first]
        low = low + self.rule.q - self.sizes[text]
        new = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (band[1:] != band[:-1])))
        for a, b in zip(new, np.append(new[1:], len(text))):
            t = int(text[a])
            change = np.zeros(len(self.texts[t]) - self.sizes[t] + 2, np.int64)
            np.add.at(change, np.maximum(low[a:b], 0), 1)
            np.add.at(change, np.minimum(high[a:b], len(change) - 2) + 1, -1)
            starts = np.flatnonzero(np.cumsum(change)[:-1] > 0)
            item, k, m = self.items[t], int(self.budget[t]), int(self.sizes[t])
            known = covered.get(item, (0, 0))
            begin = int(band[a]) * (k + 1) - k + starts
            starts = starts[(begin < known[0]) | (begin + m + 4 * k + 2 > known[1])]
            for i in range(0, len(starts), ALIGNED):
                found = self.align(plain, t, int(band[a]), starts[i : i + ALIGNED])
                for _, start, end, edits in found:
                    if edits == 0:
                        touch = start <= known[1] and known[0] <= end
                        known = (min(start, known[0]), max(end, known[1])) if touch else (start, end)
                covered[item] = known
                yield found

    def align(self, plain: np.ndarray, t: int, band: int, starts: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item number, start, end, edits) of the best alignment in a band of each of a text's
        windows that is within the budget."""
        text, m, k = self.texts[t], int(self.sizes[t]), int(self.budget[t])
        low, width = band * (k + 1) - k, 2 * (k + 1) + 2 * k
        # the document around the band, from the first window on
        begin = low + int(starts[0])
        padded = np.full(int(starts[-1] - starts[0]) + m + width - 1, OUTSIDE)
        a, b = max(begin, 0), min(begin + len(padded), len(plain))
        if a >= b:
            return []
        padded[a - begin : b - begin] = plain[a:b]
        around = np.lib.stride_tricks.sliding_window_view(padded, width)
        base = int(starts[0])
        # windows that some diagonal holds without an edit
        same = np.zeros((len(around) + 1, width), np.int32)
        np.cumsum(around == text[base : base + len(around), None], axis=0, out=same[1:])
        exact = same[starts - base + m] - same[starts - base] == m
        held = exact.any(axis=1)
        at = np.sort(low + starts[held] + exact[held].argmax(axis=1))
        cut = np.flatnonzero(np.append(True, np.diff(at) > m)) if len(at) else at
        found = [(self.items[t], int(part[0]), int(part[-1]) + m, 0) for part in np.split(at, cut[1:]) if len(part)]
        starts = starts[~held]
        if not len(starts):
            return found
        steps = np.arange(width, dtype=np.int32)
        rows = np.zeros((len(starts), width), np.int32)
        for j in range(m):
            up = np.empty_like(rows)
            up[:, :-1], up[:, -1] = rows[:, 1:] + 1, m + 1
            other = around[starts - base + j] != text[starts + j][:, None]
            rows = np.minimum(rows + other, up)
            rows = np.minimum.accumulate(rows - steps, axis=1) + steps
        edits, shift = rows.min(axis=1), rows.argmin(axis=1)
        for i in np.flatnonzero(edits <= k):
            end = min(low + int(starts[i]) + m + int(shift[i]), len(plain))
            found.append((self.items[t], max(end - m, 0), end, int(edits[i])))
        return found


def merged(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Overlapping regions of the same item as one; edits are the most of any part."""
    result: list[list[int]] = []
    for item, start, end, edits in sorted(found):
        if result and result[-1][0] == item and start <= result[-1][2]:
            result[-1][2] = max(result[-1][2], end)
            result[-1][3] = max(result[-1][3], edits)
        else:
            result.append([item, start, end, edits])
    return [tuple(r) for r in result]


def item_windows(item: int | None, text: str | None, rule: MatchRule) -> list[tuple[int | None, np.ndarray]]:
    """An item's folded text, in pieces that hold every window of it if it is very long."""
    plain = folded((text or "").strip())[0]
    inner = np.flatnonzero(plain != 32)
    plain = plain[inner[0] : inner[-1] + 1] if len(inner) else plain[:0]
    if len(plain) < rule.q:
        return []
    size = max(min(rule.block_grams, ITEM_PIECE), 2 * rule.window)
    starts = range(0, max(len(plain) - rule.window, 0) + 1, size - rule.window + 1)
    return [(item, plain[s : s + size]) for s in starts]


def blocks(benchmark: DataFrame, key: str, text: str, rule: MatchRule) -> Iterator[Block]:
    """The benchmark's items, a bounded number of q-grams at a time."""
    waiting, n = [], 0
    for row in benchmark.select(key, text).toLocalIterator():
        for piece in item_windows(row[0], row[1], rule):
            waiting.append(piece)
            n += len(piece[1])
            if n >= rule.block_grams:
                yield Block(waiting, rule)
                waiting, n = [], 0
    if waiting:
        yield Block(waiting, rule)


def with_regions(
    documents: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
    item_text: str = "text", rule: MatchRule = MatchRule(),
) -> DataFrame:
    """Add ``regions``: item_id, start and end (characters of the text), edits.

    A start is exact where there are no edits and otherwise within the edit budget.
    """
    kept = [c for c in documents.columns if c != "regions"]
    found = blocks(benchmark, item, item_text, rule)
    first, second = next(found, None), next(found, None)
    given, at = given_columns(documents, kept, text)
    if first is None:
        return documents.select(*kept).withColumn("regions", F.array().cast(REGIONS))
    if second is None:
        return searched(given, at, kept, first)
    # One block after the other: each reads the texts and leaves only what it finds.
    numbered = write_shared(documents.select(F.monotonically_increasing_id().alias("_row"), *kept), "numbered")
    texts = numbered.select("_row", text)
    passes = []
    for block in itertools.chain([first, second], found):
        hits = searched(texts, 1, ["_row"], block).where(F.size("regions") > 0)
        passes.append(write_shared(hits, "regions"))
    union = functools.reduce(DataFrame.union, passes)
    regions = union.groupBy("_row").agg(F.flatten(F.collect_list("regions")).alias("regions"))
    met = numbered.join(regions, "_row", "left")
    return met.select(*kept, F.coalesce("regions", F.array().cast(REGIONS)).alias("regions"))


def searched(given: DataFrame, at: int, kept: list[str], block: Block) -> DataFrame:
    """The kept columns and the regions of one block in the texts of column ``at``."""
    shared = given.sparkSession.sparkContext.broadcast(block)
    schema = given.select(*kept, F.array().cast(REGIONS).alias("regions")).schema

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regions = [text_regions(value.as_py(), shared.value) for value in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(regions, ARROW_REGIONS)], names=[*kept, "regions"]
            )

    return given.mapInArrow(search, schema)


def text_regions(text: str | None, block: Block) -> list[dict]:
    if not text:
        return []
    plain, keep = folded(text)
    found = block.regions(plain)
    if not found:
        return []
    place = np.flatnonzero(keep)
    return [
        {"item_id": item, "start": int(place[start]), "end": int(place[end - 1]) + 1, "edits": edits}
        for item, start, end, edits in found
    ]


def decontaminate(documents: DataFrame, benchmark: DataFrame, rule: MatchRule = MatchRule()) -> DataFrame:
    """Add regions, n_regions, item_ids and contaminated to every document."""
    found = with_regions(documents, benchmark, rule=rule)
    return found.withColumns({
        "n_regions": F.size("regions").cast("long"),
        "item_ids": F.array_sort(F.array_distinct(F.array_compact(F.col("regions.item_id")))),
        "contaminated": F.size("regions") > 0,
    })
