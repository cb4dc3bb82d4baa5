"""Missing-value injection, median imputation, one-hot encoding and assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortfit.functions.hashing import hash01
from cohortfit.functions.expressions import present
from cohortfit.operators.groups import Sizes, attach, measure
from cohortfit.operators.quantiles import BUFFER_CELLS, group_medians
from cohortfit.schemas import Roles

# Fixed value: the text that stands for a missing category.
MISSING = "~null"


def inject_missing(
    df: DataFrame, columns: list[str], id_col: str, *, share: float = 0.05, seed: int = 7
) -> DataFrame:
    """Blank each cell of ``columns`` independently with probability ``share``."""
    return df.withColumns(
        {c: F.when(hash01(seed, c, F.col(id_col)) >= share, F.col(c)) for c in columns}
    )


def category_text(column: str) -> Column:
    """Categories compare as text; a missing value is a category of its own."""
    return F.coalesce(F.col(column).cast("string"), F.lit(MISSING))


def encoder_stats(
    df: DataFrame,
    roles: Roles,
    *,
    sizes: Sizes | None = None,
    cells: int = BUFFER_CELLS,
) -> DataFrame:
    """One row per group: medians of the numerics and sorted categories.

    Fit on train rows for evaluation and on all rows for the final model; the
    caller filters. Distinct categories are reduced before they are collected,
    so a collected list is as long as the one-hot block it defines.
    """
    sizes = sizes or measure(df, roles.group)
    g, numerics = roles.group, list(roles.numeric)
    cats = [F.sort_array(F.collect_set(category_text(c))).alias(f"cats_{c}") for c in roles.categorical]
    cats.append(F.count("*").alias("fit_rows"))
    if sizes.largest * max(1, len(numerics)) <= cells:
        medians = F.array(*[F.median(present(c)).cast("double") for c in numerics]).cast("array<double>")
        return df.groupBy(g).agg(*cats, medians.alias("medians"))
    numbers = df.withColumns({c: present(c) for c in numerics})
    found = group_medians(numbers, g, numerics, sizes=sizes, cells=cells)
    found = found.select(g, F.array(*[F.col(c).cast("double") for c in numerics]).alias("medians"))
    return attach(
        df.groupBy(g).agg(*cats), found, [g], stats_rows=sizes.groups, row_bytes=64 + 8 * len(numerics)
    )


def impute(df: DataFrame, roles: Roles) -> DataFrame:
    """Fill the numerics of a frame that carries a ``medians`` array."""
    return df.withColumns(
        {
            c: F.coalesce(present(c).cast("double"), F.get("medians", F.lit(i)))
            for i, c in enumerate(roles.numeric)
        }
    )


def one_hot(column: str) -> Column:
    """0/1 per known category; a category not seen in the fit gives all zeros."""
    text = category_text(column)
    return F.transform(F.col(f"cats_{column}"), lambda known: (known == text).cast("double"))


def feature_vector(roles: Roles) -> Column:
    """One-hot blocks first, then imputed numerics; nothing else passes.

    A column without any value in the fit has no median; it becomes constant 0. A
    group the encoder was never fitted on has no features at all.
    """
    numerics = [
        F.coalesce(present(c).cast("double"), F.get("medians", F.lit(i)), F.lit(0.0))
        for i, c in enumerate(roles.numeric)
    ]
    blocks = [one_hot(c) for c in roles.categorical]
    if numerics:
        blocks.append(F.array(*numerics))
    return F.coalesce(F.concat(*blocks), F.array().cast("array<double>"))


def encode(
    df: DataFrame,
    stats: DataFrame,
    roles: Roles,
    *,
    groups: int,
    keep: list[str] | None = None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Attach the group's encoder and project to ``features``; rows stay in place."""
    keep = [roles.id, roles.label] if keep is None else keep
    picked = df.select(roles.group, *keep, *roles.features)
    joined = attach(
        picked,
        stats.drop("fit_rows"),
        [roles.group],
        stats_rows=groups,
        row_bytes=256 + 8 * len(roles.numeric) + 512 * len(roles.categorical),
        broadcast_bytes=broadcast_bytes,
    )
    return joined.select(roles.group, *keep, feature_vector(roles).alias("features"))
