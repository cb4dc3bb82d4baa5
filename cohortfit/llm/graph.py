"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortfit.llm.batches import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` of every node in ``edges(a, b)``: the smallest node it is connected with.

    Alternating large-star and small-star steps: every node hooks its neighbours onto the
    smallest one it knows. The number of rounds grows with the logarithm of the size, each
    is written, and only a count and a checksum reach the driver.
    """
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state = materialize(both, "edges")
    mark = _mark(state)
    while True:
        around = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        state = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        new = _mark(state)
        if new == mark:
            break
        mark = new
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("label"))
    return state.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
