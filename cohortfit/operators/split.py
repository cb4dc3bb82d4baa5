"""Random train/test split with an exact share inside every group."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortfit.functions.hashing import digest
from cohortfit.operators.groups import TASK_ROWS, Sizes, attach, measure
from cohortfit.session import materialize

TEST_SHARE = 0.33
SPLIT_SEED = 123
# Above this many rows in all, comparing with a cut beats shuffling every row.
SHUFFLE_ROWS = 1_000_000
EDGE_ROWS = 100_000


def train_test_split(
    df: DataFrame,
    group: str,
    id_col: str,
    *,
    test_share: float = TEST_SHARE,
    seed: int = SPLIT_SEED,
    name: str = "split",
    sizes: Sizes | None = None,
    task_rows: int = TASK_ROWS,
    shuffle_rows: int = SHUFFLE_ROWS,
) -> DataFrame:
    """Mark ceil(share * n) rows of each group 'test', in order of a seeded hash.

    The order is total (hash, then id, then the other columns where an id repeats), so
    the marks depend neither on the row order nor on the partitioning. Small tables are ranked by one window. With hot
    groups or very many rows nothing is ranked row by row: counts per hash prefix
    locate the cut, only the rows sharing that prefix are ranked, and every row is
    then compared with the cut. The data itself never shuffles, except the rows of an
    id at the cut that repeats: these are ranked, and only the missing number is taken.
    """
    sizes = sizes or measure(df, group)
    hashed = df.withColumn("_h", digest(seed, F.col(id_col)))
    if sizes.largest <= task_rows and sizes.rows <= shuffle_rows:
        order = W.partitionBy(group).orderBy("_h", id_col, *_others(df, group, id_col))
        place = F.row_number().over(order)
        size = F.count("*").over(W.partitionBy(group))
        return hashed.withColumn(
            name, F.when(place <= F.ceil(size * F.lit(test_share)), "test").otherwise("train")
        ).drop("_h")

    # As many digits as leave a bounded number of rows to rank next to the cut.
    digits = max(1, math.ceil(math.log(max(1.0, sizes.largest / min(task_rows, EDGE_ROWS)), 16)))
    keyed = hashed.withColumn("_p", F.substring("_h", 1, digits))
    per_prefix = keyed.groupBy(group, "_p").agg(F.count("*").alias("c"))
    upto = W.partitionBy(group).orderBy("_p").rowsBetween(W.unboundedPreceding, 0)
    located = per_prefix.select(
        group,
        "_p",
        "c",
        F.sum("c").over(upto).alias("upto"),
        F.ceil(F.sum("c").over(W.partitionBy(group)) * F.lit(test_share)).alias("wanted"),
    )
    edge = located.where((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("c") < F.col("wanted")))
    edge = edge.select(
        group, F.col("_p").alias("_edge"), (F.col("wanted") - F.col("upto") + F.col("c")).alias("_take")
    )
    near = attach(
        keyed.select(group, id_col, "_h", "_p"), edge, [group], stats_rows=sizes.groups, row_bytes=96
    ).where(F.col("_p") == F.col("_edge"))
    per_id = near.groupBy(group, "_h", id_col, "_take").agg(F.count("*").alias("_c"))
    upto_id = W.partitionBy(group).orderBy("_h", id_col).rowsBetween(W.unboundedPreceding, 0)
    per_id = per_id.withColumn("_upto", F.sum("_c").over(upto_id))
    cut = per_id.where((F.col("_upto") >= F.col("_take")) & (F.col("_upto") - F.col("_c") < F.col("_take"))).select(
        group,
        F.struct(F.col("_h").alias("h"), F.col(id_col).alias("i")).alias("_cut"),
        (F.col("_take") - F.col("_upto") + F.col("_c")).alias("_left"),
        "_c",
    )
    cut = materialize(cut, "split-cut")
    marked = attach(hashed, cut, [group], stats_rows=sizes.groups, row_bytes=144)
    here = F.struct(F.col("_h").alias("h"), F.col(id_col).alias("i"))
    mark = F.when(here <= F.col("_cut"), "test").otherwise("train")
    if cut.where(F.col("_left") < F.col("_c")).isEmpty():
        return marked.withColumn(name, mark).drop("_h", "_cut", "_left", "_c")
    shared = here.eqNullSafe(F.col("_cut")) & (F.col("_left") < F.col("_c"))
    place = F.row_number().over(W.partitionBy(group).orderBy(*_others(df, group, id_col)))
    at_cut = marked.where(shared).withColumn("_r", place)
    at_cut = at_cut.withColumn(name, F.when(F.col("_r") <= F.col("_left"), "test").otherwise("train")).drop("_r")
    apart = marked.where(~F.coalesce(shared, F.lit(False))).withColumn(name, mark)
    return apart.unionByName(at_cut).drop("_h", "_cut", "_left", "_c")


def _others(df: DataFrame, group: str, id_col: str) -> list:
    """What tells rows of one id apart; rows equal in all of it are interchangeable."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name not in (group, id_col)}
    unordered = ("map<", "variant")
    keys = [F.to_json(F.struct(c)) if any(u in kind for u in unordered) else F.col(c) for c, kind in kinds.items()]
    return keys or [F.lit(0)]
