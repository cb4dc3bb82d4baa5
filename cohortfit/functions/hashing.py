"""Repeatable pseudo-random numbers.

``hash01`` is built on md5 so that any SQL engine can recompute it. ``mixed01``
is a cheap integer generator with the same value as a Column and as numpy; it
decides row and column sampling inside tree growth, where md5 per round would
cost too much.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Modulus and multipliers of the integer generator.
MODULUS = 2147483647
SPREAD = 48271
SEED_STEP = 40014
ROUND_STEP = 40692
FEATURE_STEP = 69621


def _text(part) -> Column:
    return part.cast("string") if isinstance(part, Column) else F.lit(str(part))


def digest(*parts) -> Column:
    """md5 of the parts joined by ':'."""
    return F.md5(F.concat_ws(":", *[_text(p) for p in parts]))


def hash01(*parts) -> Column:
    """Uniform in [0, 1) from the first six hex digits of the digest."""
    return F.conv(F.substring(digest(*parts), 1, 6), 16, 10).cast("double") / F.lit(16777216.0)


def row_hash(seed: int, id_col: Column) -> Column:
    """28-bit integer per row, the input of row sampling."""
    return F.conv(F.substring(digest(seed, "row", id_col), 1, 7), 16, 10).cast("long")


def round_key(seed, round_no):
    """Works on Columns, numpy arrays and plain integers alike."""
    return (seed * SEED_STEP + round_no * ROUND_STEP + 1) % MODULUS


def mixed(value, key):
    """Nonlinear mix of two integers below the modulus; same operand kinds as round_key."""
    v = (value + key) % MODULUS
    v = (v * v + key) % MODULUS
    v = (v * v + value) % MODULUS
    return (v * SPREAD) % MODULUS


def feature_hash(feature, key):
    return mixed(feature * FEATURE_STEP + 1, key)


def sampled_rows(hashes: np.ndarray, key: int, share: float) -> np.ndarray:
    return mixed(hashes, key) / float(MODULUS) < share


def is_sampled(hash_col: Column, key: Column, share: Column) -> Column:
    return mixed(hash_col, key).cast("double") / F.lit(float(MODULUS)) < share
