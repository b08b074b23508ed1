"""Words and word hashes of Arrow text columns, computed with numpy over the raw UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# A slice of a batch holds about this many bytes (or one text, if that is longer).
SLICE_BYTES = 1 << 20

_MULT = 0x9E3779B97F4A7C15
_GRAM = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1


def byte_table(separators: str) -> np.ndarray:
    """A truth value per byte: True for bytes of a word."""
    table = np.ones(256, dtype=bool)
    table[list(separators.encode("latin-1"))] = False
    return table


# Words are runs of anything but ASCII white space.
SPACED = byte_table("\x20\x09\x0a\x0b\x0c\x0d")
# Words are runs of digits, letters and everything beyond ASCII.
ALNUM = np.ones(256, dtype=bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    ALNUM[_low:_high + 1] = False
# Lower-cases A-Z and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive slices; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    rows = len(column)
    if not rows:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + rows + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), rows)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


class Words:
    """The words of one slice: byte spans, the first word of each row, and 64-bit hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, fold: np.ndarray | None = None):
        self.data = data if fold is None else fold[data]
        inside = table[self.data]
        begin, finish = inside.copy(), inside.copy()
        if len(data):
            begin[1:] &= ~inside[:-1]
            finish[:-1] &= ~inside[1:]
            full = offsets[:-1] < offsets[1:]
            first, last = offsets[:-1][full], offsets[1:][full] - 1
            begin[first] = inside[first]
            finish[last] = inside[last]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(finish) + 1
        self.row_first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.row_first)

    def hashes(self) -> np.ndarray:
        """A polynomial hash of each word's bytes, from running sums over the slice."""
        n = len(self.data)
        if not len(self.start):
            return np.zeros(0, np.uint64)
        powers = np.full(n + 1, _MULT, dtype=np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
        value = sums[self.end] - sums[self.start]
        powers[:] = pow(_MULT, -1, 1 << 64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        return mix(value * powers[self.start] + (self.end - self.start).astype(np.uint64))

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def text(self, word: int) -> bytes:
        return self.data[self.start[word]:self.end[word]].tobytes()


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k consecutive words, rows not regarded."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    value = hashes[:n].copy()
    for j in range(1, k):
        value *= np.uint64(_GRAM)
        value += hashes[j:j + n]
    return mix(value)


def gram_starts(row_first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start words of the k-grams that lie inside one row, and how many each row has."""
    counts = np.maximum(np.diff(row_first) - k + 1, 0)
    return ranges(row_first[:-1], counts), counts


def ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... for counts[i] values, one range after another."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(first - (np.cumsum(counts) - counts), counts)
    return np.arange(total) + shift


def covered(total: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """True for each of ``total`` words inside any of the spans [start, end)."""
    depth = np.zeros(total + 1, np.int64)
    np.add.at(depth, start, 1)
    np.add.at(depth, end, -1)
    return np.cumsum(depth)[:total] > 0


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)
