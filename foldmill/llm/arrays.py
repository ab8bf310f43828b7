"""NumPy over the text buffers of Arrow batches: words, rolling hashes, windows.

Everything here works on many documents side by side. A chunk of documents is one
byte array with offsets; no Python object is made for a word or a byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text worked on at a time; temporary arrays take some 50 times as much.
CHUNK_BYTES = 2_000_000
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)
    bounds = bounds[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, text: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes of text; a longer row stands alone."""
    _, bounds = texts(batch.column(text))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(bounds, bounds[start] + limit, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 output bits."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, size: int) -> np.ndarray:
    """1, base, base squared, ...; kept for the next chunk."""
    known = _POWERS.get(base)
    if known is None or len(known) < size:
        known = np.full(max(size, CHUNK_BYTES + 1), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if size <= 2 * CHUNK_BYTES:
            _POWERS[base] = known
    return known[:size]


def byte_symbols(lane: int) -> np.ndarray:
    """One random-looking 64-bit value per byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F + 2 * lane))


class Rolling:
    """Rolling hash over a sequence of 64-bit symbols: any span hashed from two prefix sums."""

    def __init__(self, symbols: np.ndarray, lane: int = 0):
        base = _BASES[lane]
        self.inverse = _powers(pow(base, -1, 1 << 64), len(symbols) + 1)
        self.prefix = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * _powers(base, len(symbols)), out=self.prefix[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        found = (self.prefix[ends] - self.prefix[starts]) * self.inverse[starts]
        return mix(found + (ends - starts).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        """Hash of the ``size`` symbols from each place on. Only its high half is well mixed."""
        if len(self.prefix) <= size:
            return np.zeros(0, np.uint64)
        found = self.prefix[size:] - self.prefix[:-size]
        found *= self.inverse[:len(found)]
        return found


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and word offsets per row."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` neighbouring values, from each place on."""
    if len(values) < width:
        return np.zeros(0, values.dtype)
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[:len(values) - (width - span)], values[width - span:])


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range after the other."""
    total = int(counts.sum())
    first = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return first + np.arange(total)


def list_values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column of longs and the row each belongs to. A null list is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values, np.repeat(np.arange(len(column)), lengths)


def longs(column: pa.Array) -> np.ndarray:
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
