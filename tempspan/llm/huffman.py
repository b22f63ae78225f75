"""Canonical length-limited Huffman codes over token ids, on numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

MAX_BITS = 18
#: Tokens between two checkpoints, each of which is the place of a bit.
STRIDE = 512
LENGTH_BITS = 5


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Bits of each symbol's code, 0 for symbols that do not occur, by package-merge."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} symbols do not fit into codes of {max_bits} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    is_leaf, packages = [], np.empty(0)
    for _ in range(max_bits):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        is_leaf.append(order < len(weights))
        merged = merged[order]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    taken = 2 * len(used) - 2
    for leaf in reversed(is_leaf):
        n_leaves = int(leaf[:taken].sum())
        lengths[used[:n_leaves]] += 1
        taken = 2 * (taken - n_leaves)
    return lengths


@dataclass(frozen=True)
class Code:
    """Canonical codes by symbol, from the top of 64 bits, and the decoding table by the next
    bits: symbol << LENGTH_BITS | length."""

    lengths: np.ndarray
    codes: np.ndarray
    bits: int
    entry_at: np.ndarray

    @classmethod
    def of(cls, lengths: np.ndarray) -> Code:
        """The code that the lengths alone define: by length, then by symbol."""
        bits = max(int(lengths.max(initial=0)), 1)
        used = np.flatnonzero(lengths)
        used = used[np.argsort(lengths[used], kind="stable")]
        span = np.left_shift(1, bits - lengths[used].astype(np.int64))
        first = np.cumsum(span) - span  # the code, filled up to `bits` bits
        codes = np.zeros(len(lengths), np.uint64)
        codes[used] = first.astype(np.uint64) << np.uint64(64 - bits)
        entry_at = np.ones(1 << bits, np.int64)
        entry_at[: span.sum()] = np.repeat(used << LENGTH_BITS | lengths[used], span)
        return cls(lengths, codes, bits, entry_at)


def encode_block(ids: np.ndarray, code: Code) -> tuple[bytes, np.ndarray]:
    """The bits of ids, and the bit offset of every STRIDE-th id."""
    if not len(ids):
        return bytes(8), np.zeros(0, np.int64)
    ends = np.cumsum(code.lengths[ids], dtype=np.int64)
    offset = np.append(0, ends[:-1])
    word = offset >> 5
    placed = code.codes[ids] >> (offset & 31).view(np.uint64)
    # bits of different ids never meet, so that adding them up joins them; a code starts in every word
    joined = np.add.reduceat(placed, np.append(0, np.flatnonzero(np.diff(word)) + 1))
    words = np.zeros((int(ends[-1]) >> 5) + 2, np.uint64)
    words[: len(joined)] = joined >> np.uint64(32)
    words[1 : len(joined) + 1] |= joined & np.uint64(0xFFFFFFFF)
    return words.astype(">u4").tobytes(), offset[::STRIDE]


def decode_block(data: bytes, checkpoints: np.ndarray, n_ids: int, code: Code) -> np.ndarray:
    """The ids of a block; all stretches between checkpoints advance together."""
    words = np.append(np.frombuffer(data, ">u4").astype(np.uint64), np.uint64(0))
    windows = (words[:-1] << np.uint64(32) | words[1:]).view(np.int64)
    at = np.array(checkpoints, np.int64)
    out = np.zeros((STRIDE, len(at)), np.int32)
    n_last = n_ids - (len(at) - 1) * STRIDE  # the last stretch may be shorter
    mask, top, length = (1 << code.bits) - 1, 64 - code.bits, (1 << LENGTH_BITS) - 1
    for step in range(min(STRIDE, n_ids)):
        if step == n_last:
            at = at[:-1]
        entry = code.entry_at[(windows[at >> 5] >> (top - (at & 31))) & mask]
        out[step, : len(at)] = entry >> LENGTH_BITS
        at = at + (entry & length)
    return out.T.reshape(-1)[:n_ids]
