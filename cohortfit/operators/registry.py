"""Experiments, runs, model versions and stages as append-only tables.

"Current" is always computed from the events, so nothing is updated in place and
two writers cannot overwrite each other's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortfit.functions.hashing import digest
from cohortfit.operators.groups import TASK_ROWS, Sizes, measure, meet, ranked_within

PRODUCTION, ARCHIVED, NONE = "Production", "Archived", "None"


def missing_rows(wanted: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``wanted`` whose key is not there yet, one per key."""
    return wanted.dropDuplicates([key]).join(existing.select(key), key, "left_anti")


def get_or_create(wanted: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """The table after creating what was missing."""
    return existing.unionByName(missing_rows(wanted, existing, key))


def open_runs(experiments: DataFrame, run_name: str, token: str) -> DataFrame:
    """One run per experiment with an id that depends only on its inputs."""
    return experiments.select(
        digest(F.col("experiment"), run_name, token).alias("run_id"),
        "experiment",
        F.lit(run_name).alias("run_name"),
    )


def next_versions(
    versions: DataFrame,
    requests: DataFrame,
    *,
    sizes: Sizes | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Number new ``requests (seq, name, run_id, source)`` after each name's last version.

    Requests of one name are numbered in order of ``seq``; a name with very many
    of them is numbered range by range.
    """
    sizes = sizes or measure(requests, "name")
    last = versions.groupBy("name").agg(F.max("version").alias("_last"))
    counted = ranked_within(
        requests.withColumn("_one", F.lit(1).cast("bigint")), ["name"], "seq", {"_earlier": "_one"}, sizes, task_rows
    )
    numbered = meet(counted, last, ["name"])
    version = F.coalesce("_last", F.lit(0)) + F.col("_earlier") + 1
    return numbered.select("seq", "name", version.cast("int").alias("version"), "run_id", "source")


def current_stages(versions: DataFrame, transitions: DataFrame) -> DataFrame:
    """Each version with its present stage.

    ``transitions (seq, name, version, stage)`` say what was asked for. A promotion
    to Production archives the version that was there, so of a name's versions
    whose own latest wish is Production only the latest promoted one holds it.
    Two plain aggregates; no name is ever sorted as a whole.
    """
    wish = transitions.groupBy("name", "version").agg(
        F.max("seq").alias("_at"), F.max_by("stage", "seq").alias("_stage")
    )
    latest = (
        transitions.where(F.col("stage") == PRODUCTION).groupBy("name").agg(F.max("seq").alias("_latest"))
    )
    held = meet(meet(versions, wish, ["name", "version"]), latest, ["name"])
    stage = (
        F.when(F.col("_stage").isNull(), NONE)
        .when((F.col("_stage") == PRODUCTION) & (F.col("_at") < F.col("_latest")), ARCHIVED)
        .otherwise(F.col("_stage"))
    )
    return held.select("name", "version", "run_id", "source", stage.alias("stage"))


def resolve(current: DataFrame, stage: str = PRODUCTION) -> DataFrame:
    """Per name the highest version in the stage, with its run and source."""
    return (
        current.where(F.col("stage") == stage)
        .groupBy("name")
        .agg(F.max(F.struct("version", "run_id", "source")).alias("top"))
        .select("name", "top.version", "top.run_id", "top.source")
    )


def resolve_one(current: DataFrame, name: str, stage: str = PRODUCTION) -> tuple[int, str, str]:
    """Version, run id and source for one name; an error says what is missing."""
    row = resolve(current.where(F.col("name") == name), stage).first()
    if row is None:
        raise LookupError(f"no version of model {name!r} is in stage {stage!r}")
    return row["version"], row["run_id"], row["source"]
