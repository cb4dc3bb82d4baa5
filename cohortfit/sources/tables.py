"""Reading and writing the tables of a project, and the per-group exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortfit.operators.evaluate import metric_columns
from cohortfit.schemas import METRICS


def read_table(spark: SparkSession, folder: str, name: str, *, heavy: bool = False) -> DataFrame:
    """Scan a Parquet table.

    ``heavy`` says that costly per-row expressions follow. Then a table of fewer
    file splits than cores is spread over them first; a large one has more splits
    than that and is read as it is.
    """
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if heavy and table.rdd.getNumPartitions() < cores:
        return table.repartition(cores)
    return table


def write_table(
    df: DataFrame, name: str, *, mode: str = "overwrite", partition_by: tuple[str, ...] = (), path: str | None = None
) -> DataFrame:
    """Save as a catalog table and read it back, which fixes the rows and the plan."""
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def with_row_ids(df: DataFrame, name: str = "id") -> DataFrame:
    """A unique 64-bit number per row for tables without a key.

    The numbers depend on the partitioning: write the table before using it twice.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def params_long(df: DataFrame, group: str, params: str = "params") -> DataFrame:
    """``group, parameter, value`` from a params map."""
    return df.select(group, F.explode(params).alias("parameter", "value"))


def metrics_long(df: DataFrame, group: str) -> DataFrame:
    """``group, metric, value`` for the eight metrics and the best iteration."""
    pairs = [(m, F.col(m)) for m in METRICS] + [("best_iteration", F.col("best_iteration").cast("double"))]
    entries = F.array(*[F.struct(F.lit(n).alias("metric"), v.alias("value")) for n, v in pairs])
    return df.select(group, F.explode(entries).alias("e")).select(group, "e.metric", "e.value")


def export_csv(long_table: DataFrame, path: str, group: str) -> None:
    """One folder per group with a header row; written by the executors, no shared file."""
    long_table.write.mode("overwrite").option("header", "true").partitionBy(group).csv(path)


def model_stats(fitted: DataFrame, group: str, *, run_id: str | None = None) -> DataFrame:
    """The result row per group: execution record, rounded metrics, best iteration."""
    run = [F.lit(run_id).alias("run_id")] if run_id else []
    return fitted.select(
        F.col(group).alias("group"),
        *run,
        "stage_id",
        "task_attempt_id",
        "start_time",
        "end_time",
        "elapsed_seconds",
        *metric_columns(),
        "best_iteration",
    )
