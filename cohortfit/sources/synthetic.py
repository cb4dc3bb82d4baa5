"""Synthetic binary-classification features, generated by expressions only.

Every cell is a function of (seed, group, row), so any part can be recomputed
after a lost task and any number of rows is generated in parallel.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortfit.functions.hashing import hash01
from cohortfit.operators.encode import inject_missing
from cohortfit.operators.groups import Sizes, attach, numbered
from cohortfit.operators.quantiles import BUFFER_CELLS, quartile_bins

# Workload of the default feature table.
N_GROUPS = 10
ROWS_PER_GROUP = 10_000
N_FEATURES = 20
N_INFORMATIVE = 10
FLIP_SHARE = 0.4
MISSING_SHARE = 0.05


def feature_name(number: int) -> str:
    return f"numeric_feature_{number:02d}"


def group_list(spark: SparkSession, n: int = N_GROUPS) -> DataFrame:
    """``group_01 .. group_n``, zero-padded."""
    return spark.range(1, n + 1).select(F.format_string("group_%02d", "id").alias("group_name"))


def name_groups(df: DataFrame, key: str) -> DataFrame:
    """Give each distinct key of a table its zero-padded group name, in key order.

    The distinct keys are the summary of a table; only they are ordered.
    """
    keys = numbered(df.select(key).distinct(), key, "_n")
    return keys.select(key, F.format_string("group_%02d", F.col("_n") + 1).alias("group_name"))


def base_rows(groups: DataFrame, rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Row numbers for every group; ``id`` is unique over all of them.

    The ids are one range, cut evenly over the cluster's tasks, so a few large groups fill
    as many tasks as many small ones; each id names its group by its place.
    """
    spark = groups.sparkSession
    places = numbered(groups.select("group_name"), "group_name", "_n")
    n = groups.count()
    ids = spark.range(0, n * rows_per_group).withColumn("_n", F.floor(F.col("id") / rows_per_group))
    return attach(ids, places, ["_n"], stats_rows=n, row_bytes=128, how="inner").select("group_name", "id")


def unflipped_class(seed: int, group: Column, row: Column) -> Column:
    return F.when(hash01(seed, "class", group, row) < 0.5, 0).otherwise(1)


def label_column(seed: int, group: Column, row: Column, flip_share: float = FLIP_SHARE) -> Column:
    """The class, except that ``flip_share`` of the rows get a fresh random label."""
    redrawn = F.when(hash01(seed, "redraw", group, row) < 0.5, 0).otherwise(1)
    return F.when(hash01(seed, "flip", group, row) < flip_share, redrawn).otherwise(
        unflipped_class(seed, group, row)
    )


def _normal(seed: int, feature: int, group: Column, row: Column) -> Column:
    radius = F.sqrt(-2.0 * F.log(1.0 - hash01(seed, f"r{feature}", group, row)))
    return radius * F.cos(F.lit(2.0 * math.pi) * hash01(seed, f"a{feature}", group, row))


def raw_features(
    rows: DataFrame,
    seed: int = 11,
    *,
    group: str = "group_name",
    id_col: str = "id",
    n_features: int = N_FEATURES,
    n_informative: int = N_INFORMATIVE,
    flip_share: float = FLIP_SHARE,
) -> DataFrame:
    """Label and numeric features for each given row.

    Informative features are normal around a centre per (group, class); the rest
    is plain noise. Every group has its own centres, hence its own best model.
    """
    g, i = F.col(group), F.col(id_col)
    true_class = unflipped_class(seed, g, i)
    columns = []
    for k in range(1, n_features + 1):
        value = _normal(seed, k, g, i)
        if k <= n_informative:
            centre = 2.0 * hash01(seed, f"centre{k}", g, true_class) - 1.0
            value = value + centre
        columns.append(value.alias(feature_name(k)))
    return rows.select(group, label_column(seed, g, i, flip_share).alias("label"), *columns, id_col)


def feature_table(
    rows: DataFrame,
    seed: int = 11,
    *,
    group: str = "group_name",
    id_col: str = "id",
    sizes: Sizes | None = None,
    cells: int = BUFFER_CELLS,
    missing_share: float = MISSING_SHARE,
    **shape,
) -> DataFrame:
    """The full feature table: the first numeric becomes a quartile category, cells
    go missing at random, columns end up as group, label, categories, numerics, id."""
    raw = raw_features(rows, seed, group=group, id_col=id_col, **shape)
    numerics = [c for c in raw.columns if c.startswith("numeric_feature_")]
    binned = quartile_bins(raw, group, numerics[0], "categorical_feature_01", sizes=sizes, cells=cells)
    features = ["categorical_feature_01", *numerics[1:]]
    masked = inject_missing(binned.drop(numerics[0]), features, id_col, share=missing_share, seed=seed)
    return masked.select(group, "label", *features, id_col)
