"""Texts of an Arrow batch as flat numpy arrays: bytes, words, and hashes of runs of them.

Words are runs of bytes other than ASCII white space, so they can be found in UTF-8 without decoding it. A null
text is an empty one. Hashes depend on content alone: every task gives equal content the same hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20  # of text that is worked on at once; one longer text is a slice of its own

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_random = np.random.default_rng(20240229)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def map_slices(
    df: DataFrame, work: Callable[[pa.Table], pa.RecordBatch | None], schema: str, text: str = "text", size: int = SLICE_BYTES
) -> DataFrame:
    """`work` on slices of the rows, each of about `size` bytes of text, as a narrow step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, size):
                made = work(part)
                if made is not None and made.num_rows:
                    yield made

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    if not len(lengths):
        return
    block = (np.cumsum(lengths) - lengths) // size
    edges = np.flatnonzero(np.diff(block)) + 1
    for start, end in zip([0, *edges], [*edges, len(lengths)], strict=True):
        yield batch.slice(start, end - start)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (one more than there are texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and where the words of each text begin (one more than there are texts)."""
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    edges = offsets[(offsets < len(data))]
    first[edges] = word[edges]
    last = word.copy()
    last[:-1] &= ~word[1:]
    edges = offsets[offsets > 0] - 1
    last[edges] = word[edges]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over all of them (the finaliser of a well-known generator)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base to the power 0 to n - 1, and the inverses; kept for the next slice unless very long."""
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    made = []
    for base in (_BASE, _INVERSE):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    if n <= 4 * SLICE_BYTES:
        _powers[:] = made
    return made[0], made[1]


class Rolling:
    """Hashes of any runs of one sequence of numbers."""

    def __init__(self, values: np.ndarray):
        power, self._inverse = _power(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[:-1], out=self._sums[1:])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self._sums[ends] - self._sums[starts]) * self._inverse[starts] + (ends - starts).astype(np.uint64))

    def windows(self, length: int) -> np.ndarray:
        """Of every run of `length`, by its start."""
        if len(self._sums) <= length:
            return np.zeros(0, np.uint64)
        raw = self._sums[length:] - self._sums[:-length]
        raw *= self._inverse[: len(raw)]
        raw += np.uint64(length)
        return mixed(raw)


def byte_rolling(data: np.ndarray) -> Rolling:
    return Rolling(_BYTE[data])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return byte_rolling(data).runs(starts, ends)


def first_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` values, by its start, the place of its least value, the first of equals."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low = np.uint64(0xFFFFFFFF)
    keyed = (values & ~low) | np.arange(len(values), dtype=np.uint64)
    blocks = -(-len(keyed) // width)
    padded = np.full(blocks * width, np.uint64(2**64 - 1), np.uint64)
    padded[: len(keyed)] = keyed
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(back[:n], ahead[width - 1 : width - 1 + n]) & low).astype(np.int64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    total = int(lengths.sum())
    begin = np.cumsum(lengths) - lengths
    return np.repeat(starts - begin, lengths) + np.arange(total)


def signed(hashes: np.ndarray) -> np.ndarray:
    """As Spark's long."""
    return hashes.view(np.int64)


def dealt_anew(column: str, name: str | None = None) -> Column:
    """The same number, but for the optimizer a new one. An aggregate on it is then exchanged again before a join (it is
    small by then), and adaptive execution can split hot keys of the other side, which it does only between two exchanges."""
    return F.col(column).bitwiseXOR(F.lit(0).cast("long")).alias(name or column)
