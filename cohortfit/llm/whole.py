"""Exact arithmetic on vectors whose components become whole numbers floor(scale * x).

Nearly all vectors have components of at most ``SMALL``; they are kept as 64-bit integers
and their squared distances are exact in 64 bits. Any finite double may occur, so wider
vectors travel as doubles and are handled as Python integers by the same code. Sums leave
a task in limbs of ``LIMB`` bits, which Spark adds up as longs; whole numbers of any size
come back together on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

SMALL = 1 << 20
LIMB = 24
LONG = (1 << 63) - 1


def usable(vector: Column, length: int | None = None) -> Column:
    """Whether no component is NULL or not finite (and there are ``length`` of them)."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sized = F.lit(True) if length is None else F.size(vector) == length
    return F.coalesce(vector.isNotNull() & sized & ~bad, F.lit(False))


def is_wide(numbers: Column, scale: int) -> Column:
    """Whether some component of an array of doubles does not become a small whole number."""
    return F.exists(numbers, lambda x: (x * scale >= float(SMALL)) | (x * scale < -float(SMALL)))


def floors(numbers: np.ndarray, scale: int) -> np.ndarray:
    """Whole numbers floor(scale * x): int64 where all are small, else Python integers."""
    with np.errstate(over="ignore"):
        scaled = numbers * scale
    if not scaled.size or (np.abs(scaled).max() <= SMALL):
        return np.floor(scaled).astype(np.int64)
    out = np.empty(numbers.shape, object)
    for at, x in np.ndenumerate(numbers):
        x = float(x)
        out[at] = int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale)
    return out


def as_matrix(rows: list[list[int]], width: int) -> np.ndarray:
    """Rows of whole numbers: int64 where all are small, else Python integers."""
    if all(-SMALL <= v <= SMALL for r in rows for v in r):
        return np.array(rows, np.int64).reshape(len(rows), width)
    out = np.empty((len(rows), width), object)
    for i, row in enumerate(rows):
        out[i] = row
    return out


def as_floats(rows: list[list[int]], width: int) -> np.ndarray:
    """The nearest doubles; infinite where there is none."""
    near = lambda v: float(v) if abs(v) < 1 << 1000 else float("inf") if v > 0 else -float("inf")
    return np.array([[near(v) for v in row] for row in rows], float).reshape(len(rows), width)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` to all rows of ``c``, exact."""
    if x.dtype == object or c.dtype == object:
        out = np.empty((len(x), len(c)), object)
        for k in range(len(c)):
            gap = x.astype(object) - c[k].astype(object)
            out[:, k] = [sum(v * v for v in row) for row in gap]
        return out
    if x.shape[1] <= 2048:  # every term is below 2^53, so doubles are exact
        a, b = x.astype(float), c.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], axis=1)


def limbs(total: Iterable[int]) -> list[list[int]]:
    """Signed limbs of whole numbers, lowest first: sum(limb << (LIMB * k)) gives them back."""
    values, out = [int(v) for v in total], []
    while not out or any(values):
        signs = [1 if v >= 0 else -1 for v in values]
        out.append([s * (s * v & ((1 << LIMB) - 1)) for s, v in zip(signs, values)])
        values = [s * (s * v >> LIMB) for s, v in zip(signs, values)]
    return out


def longs(values: Iterable) -> list[int | None]:
    """Whole numbers as longs; NULL for those that no long can hold."""
    return [int(v) if v <= LONG else None for v in values]


def floor_mean(sums: list[int], count: int) -> list[int]:
    return [s // count for s in sums]
