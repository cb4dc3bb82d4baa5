"""Small helpers for building column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    An expression used inside a lambda is otherwise evaluated at every step of it,
    also when the optimizer inlines a column from a lower projection there.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def present(column: str) -> Column:
    """The column with NaN as NULL: both are missing values."""
    return F.when(~F.isnan(F.col(column)), F.col(column))
