"""Words of whole texts as numpy arrays, for Arrow batches inside tasks.

A word is a run of bytes other than ASCII white space, with A-Z in lower case. Texts are
taken in slices of some megabytes (never cutting a text), so a task holds one slice at a
time; a text longer than that is a slice of its own.

Hashes are polynomials over the bytes modulo 2^64, taken from running sums, so the hash of
any range of bytes costs three operations, and are mixed before use.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE = 500_000

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_random = np.random.default_rng(20)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_ODD = _random.integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)
_BASE = int(_ODD[-1])
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (constants of a public generator)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        size = max(n, SLICE + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            table = np.full(size, U(base))
            table[0] = U(1)
            _powers[k] = np.cumprod(table)
    return _powers


@dataclass
class Slice:
    """Consecutive texts: ``data`` is their bytes, text k is data[bounds[k] : bounds[k + 1]]."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @cached_property
    def space(self) -> np.ndarray:
        return _SPACE[self.data]

    @cached_property
    def _sums(self) -> np.ndarray:
        powers, _ = _power_tables(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, U)
        np.cumsum(_BYTE[self.data] * powers[: len(self.data)], out=sums[1:])
        return sums

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of every range of bytes."""
        _, inverse = _power_tables(len(self.data) + 1)
        return mix((self._sums[ends] - self._sums[starts]) * inverse[starts])

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of all words."""
        inside = ~self.space
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = self.bounds[1:-1]
        edges = edges[(edges > 0) & (edges < len(self.data))]
        opens[edges] |= inside[edges]
        closes[edges - 1] |= inside[edges - 1]
        return np.flatnonzero(opens), np.flatnonzero(closes) + 1

    @cached_property
    def word_hashes(self) -> np.ndarray:
        return self.hashes(*self.words)

    @cached_property
    def word_bounds(self) -> np.ndarray:
        """Words of text k are word_bounds[k] to word_bounds[k + 1]."""
        return np.searchsorted(self.words[0], self.bounds)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words inside a text, and their bounds by text.

        A text of fewer words has its whole sequence as one, a text without words none.
        """
        hashes, bounds = self.word_hashes, self.word_bounds
        counts = np.diff(bounds)
        runs = np.where(counts >= n, counts - n + 1, (counts > 0).astype(counts.dtype))
        ends = np.cumsum(runs)
        starts = np.repeat(bounds[:-1] - (ends - runs), runs) + np.arange(ends[-1] if len(ends) else 0)
        lengths = np.repeat(np.minimum(counts, n), runs)
        total = lengths.astype(U) * _ODD[-2]
        for k in range(n):
            full = lengths > k
            total[full] += hashes[starts[full] + k] * _ODD[k]
        return mix(total), np.concatenate([[0], ends])


def slices(texts: pa.Array, size: int = SLICE, lower: bool = True) -> Iterator[Slice]:
    """The texts of an Arrow array (NULL counts as empty)."""
    texts = pc.fill_null(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts, "")
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    k = 0
    while k < len(texts):
        stop = max(k + 1, int(np.searchsorted(bounds, bounds[k] + size, "right")) - 1)
        part = data[bounds[k] : bounds[stop]]
        yield Slice(k, _LOWER[part] if lower else part, bounds[k : stop + 1] - bounds[k])
        k = stop


def sort_within(values: np.ndarray, bounds: np.ndarray) -> None:
    """Sorts every range in place."""
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            values[a:b].sort()


def distinct_within(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values of every range, and their bounds."""
    sort_within(values, bounds)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    starts = bounds[:-1]
    new[starts[starts < len(values)]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return values[new], kept[bounds]


def sum_within(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of every range along the first axis; 0 for an empty range."""
    total = np.zeros((len(bounds) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        total[full] = np.add.reduceat(values, bounds[full], axis=0)
    return total
