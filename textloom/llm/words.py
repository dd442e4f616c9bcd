"""Words and 64-bit hashes of Arrow text columns, as flat numpy arrays.

Texts are handled as UTF-8 bytes in pieces of bounded size, so that memory does not follow the
number of rows; one text is never cut.  Hashes are sums of byte values times powers of an odd
number, modulo 2**64, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 18
# Rows of an Arrow batch: whole texts are long, and both sides hold a batch in memory.
BATCH_ROWS = 1_000

_RANDOM = np.random.default_rng(20240229)
BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[65:91] = BYTE_VALUES[97:123]
BASE = np.uint64(0x9E3779B97F4A7C15 | 2)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
STEPS = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

# Space, tab, line feed, vertical tab, form feed and carriage return.
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[32, 9, 10, 11, 12, 13]] = False


def bounded_batches(spark) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` rows, if they are larger or unbounded."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """``(first row, rows)``: runs of rows of at most ``limit`` bytes, or one longer row."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield at, column.slice(at, stop - at)
        at = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and the offsets; null counts as empty."""
    whole = pc.fill_null(column, "").cast(pa.large_string())
    whole = pa.concat_arrays([whole])
    offsets = np.frombuffer(whole.buffers()[1], dtype=np.int64)[
        whole.offset : whole.offset + len(whole) + 1
    ]
    values = whole.buffers()[2]
    data = np.frombuffer(values, dtype=np.uint8) if values else np.zeros(0, np.uint8)
    if not len(whole):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(
    inside: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside`` within each text, and the first run of each text."""
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    edge = offsets[:-1][full]
    begins[edge] = inside[edge]
    edge = offsets[1:][full] - 1
    ends[edge] = inside[edge]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


class Hasher:
    """Hashes of byte ranges; the powers are kept for the next piece."""

    def __init__(self, values: np.ndarray = FOLDED_VALUES):
        self.values = values
        self._grow(1 << 16)

    def _grow(self, size: int) -> None:
        self.powers = np.full(size, BASE)
        self.powers[0] = 1
        np.cumprod(self.powers, out=self.powers)
        self.inverse = np.full(size, BASE_INVERSE)
        self.inverse[0] = 1
        np.cumprod(self.inverse, out=self.inverse)

    def totals(self, data: np.ndarray) -> np.ndarray:
        """Running sums, one longer than the data."""
        if len(data) + 1 > len(self.powers):
            self._grow(max(len(data) + 1, 2 * len(self.powers)))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
        return sums

    def ranges(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (sums[ends] - sums[starts]) * self.inverse[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * STEPS[63])


def words(column: pa.Array, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words between white space, A-Z folded, and the first word of each text."""
    data, offsets = flat(column)
    starts, ends, first = word_bounds(IS_WORD[data], offsets)
    return hasher.ranges(hasher.totals(data), starts, ends), first


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words, and the first window of each text.

    A text with fewer words, but at least one, has its whole sequence as its only window.
    """
    counts = np.diff(first)
    windows = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    into = np.concatenate(([0], np.cumsum(windows)))
    at = np.arange(into[-1]) + np.repeat(first[:-1] - into[:-1], windows)
    length = np.repeat(np.minimum(counts, size), windows)
    total = length.astype(np.uint64) * STEPS[size]
    last = len(hashes) - 1
    for step in range(size):
        part = hashes[np.minimum(at + step, last)] * STEPS[step] if len(hashes) else total[:0]
        total += part if step == 0 else np.where(length > step, part, np.uint64(0))
    return mix(total), into
