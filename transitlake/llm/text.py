"""Whole Arrow batches of texts as byte arrays: words, lines and their hashes.

White space is ASCII here (``[\\x20\\x09-\\x0D]``), so words are found on UTF-8 bytes.
A batch is cut into blocks of documents, so that the arrays beside it stay small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BYTE_VALUES = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64)

_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        size = max(n, BLOCK_BYTES + 1)
        steps = np.full(size, BASE if kind == "up" else INVERSE, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps, dtype=np.uint64)
        if size > 8 * BLOCK_BYTES:  # do not hold on to what one very long text needed
            kept, _powers[kind] = _powers[kind], np.ones(1, np.uint64)
            return kept[:n]
    return _powers[kind][:n]


class Block:
    """The bytes of some documents, with word positions found once."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first
        self.n = len(offsets) - 1
        inside = ~SPACE[data]
        head = np.zeros(len(data) + 1, dtype=bool)
        head[offsets] = True  # a document begins or ends here
        before = np.empty(len(data), dtype=bool)
        if len(data):
            before[0] = False
            before[1:] = inside[:-1]
        self.starts = np.flatnonzero(inside & (~before | head[:-1]))
        after = np.empty(len(data), dtype=bool)
        if len(data):
            after[-1] = False
            after[:-1] = inside[1:]
        self.ends = np.flatnonzero(inside & (~after | head[1:])) + 1
        # words of document i: starts[word_offsets[i]:word_offsets[i + 1]]
        self.word_offsets = np.searchsorted(self.starts, offsets)
        self._prefix: np.ndarray | None = None

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def range_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges; equal bytes have equal hashes wherever they lie."""
        if self._prefix is None:
            values = BYTE_VALUES[self.data] * _power("up", len(self.data))
            self._prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        spans = self._prefix[ends] - self._prefix[starts]
        return mix(spans * _power("down", len(self.data) + 1)[starts] + (ends - starts).astype(np.uint64))

    def word_hashes(self) -> np.ndarray:
        return self.range_hashes(self.starts, self.ends)

    def words_by_document(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.word_offsets))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` values; one hash of all for a shorter sequence."""
    width = min(width, len(hashes))
    if not width:
        return np.zeros(0, np.uint64)
    count = len(hashes) - width + 1
    total = np.zeros(count, np.uint64)
    for k in range(width):
        total = mix(total + hashes[k:k + count] + np.uint64(k + 1))
    return total


def occurrences(values: np.ndarray) -> np.ndarray:
    """For each value how many equal ones lie before it."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    index = np.arange(len(values))
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    out = np.empty(len(values), np.int64)
    out[order] = index - np.maximum.accumulate(np.where(fresh, index, 0))
    return out


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of consecutive documents; a null text counts as an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        low, high = offsets[first], offsets[last]
        yield Block(data[low:high], offsets[first:last + 1] - low, first)
        first = last
