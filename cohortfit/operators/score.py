"""Scoring: every row meets the model of its group, in Arrow batches.

Encoding and the logistic function are column expressions; only the walk through the trees
is numpy, for all rows of a batch and all trees of a model at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortfit.functions.trees import FlatTrees, feature_matrix, probability
from cohortfit.operators.encode import feature_vector
from cohortfit.operators.groups import BROADCAST_BYTES, attach, salted
from cohortfit.schemas import TREE_FIELDS, Roles

TREE_COLUMNS = [name for name, _ in TREE_FIELDS]
#: Rows of one group that meet their model in one task when models are shuffled.
SCORE_ROWS = 200_000


def model_size(models: DataFrame) -> tuple[int, int]:
    """Number of models and bytes of the largest one, read from the model table."""
    row = models.agg(F.count("*"), F.max(F.size("node_value"))).first()
    return row[0], 512 + 36 * (row[1] or 0)


def tree_margins(
    rows: DataFrame,
    models: DataFrame,
    group: str,
    *,
    broadcast_bytes: int | None = None,
    score_rows: int = SCORE_ROWS,
) -> DataFrame:
    """Replaces ``features`` by ``margin``; NULL where the group has no model.

    Models that are small together are sent to every task once and the rows stay where
    they are. Otherwise models and rows meet by (group, salt): a group with more than
    ``score_rows`` rows is dealt over several tasks, each with a copy of its model.
    """
    count, largest = model_size(models)
    trees = models.select(group, *TREE_COLUMNS)
    kept = [c for c in rows.columns if c != "features"]
    schema = T.StructType([rows.schema[c] for c in kept]).add("margin", T.DoubleType())
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    ordered = rows.select(*kept, "features")
    if count * largest <= limit:
        known = {m[group]: FlatTrees.of(m) for m in trees.toArrow().to_pylist()}
        sent = rows.sparkSession.sparkContext.broadcast(known)

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                margin = _margins(batch[group], batch["features"], sent.value)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], margin], [*kept, "margin"])

        return ordered.mapInArrow(walk, schema)

    left, right, salt = salted(ordered, trees, [group], hot_rows=score_rows)

    def meet(mine: pa.Table, model: pa.Table) -> pa.Table:
        known = {m[group]: FlatTrees.of(m) for m in model.to_pylist()}
        margin = _margins(mine[group].combine_chunks(), mine["features"], known)
        return mine.select(kept).append_column("margin", margin)

    return left.groupBy(group, salt).cogroup(right.groupBy(group, salt)).applyInArrow(meet, schema)


def _margins(keys: pa.Array, lists: pa.Array, known: dict) -> pa.Array:
    """The margin of every row by the model of its key."""
    coded = keys.dictionary_encode()
    place = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    names = [*coded.dictionary.to_pylist(), None]  # place -1 is the NULL key
    out, missing = np.zeros(len(place)), np.ones(len(place), bool)
    x = None
    for code in np.unique(place).tolist():
        model = known.get(names[code])
        if model is not None:
            if x is None:
                width = 1 + max((int(m.feature.max(initial=0)) for m in known.values() if m is not None), default=0)
                x = feature_matrix(lists, width)
            at = np.flatnonzero(place == code)
            out[at], missing[at] = model.margins(x[at]), False
    return pa.array(out, mask=missing)


def score(
    encoded: DataFrame,
    models: DataFrame,
    group: str,
    *,
    keep: list[str],
    n_trees: Column | None = None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Class-1 probability per row; rows of a group without a model keep a NULL.

    ``n_trees``, an expression over the model table, uses only the first trees of a model.
    """
    if n_trees is not None:
        models = models.withColumn("roots", F.slice("roots", F.lit(1), n_trees))
    walked = tree_margins(encoded.select(group, *keep, "features"), models, group, broadcast_bytes=broadcast_bytes)
    return walked.select(group, *keep, probability(F.col("margin")).alias("probability"))


def class_probabilities(p: Column) -> Column:
    """``[p0, p1]``, or NULL where there is no model."""
    return F.when(p.isNotNull(), F.array(1.0 - p, p))


def group_predictions(
    features: DataFrame,
    models: DataFrame,
    roles: Roles,
    *,
    id_cols: list[str] | None = None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Raw rows in; group, ids and the probability pair out.

    ``models`` carries each group's encoder (medians and categories) next to its
    trees, so imputation, one-hot and prediction are one pass over the rows.
    """
    ids = [roles.id] if id_cols is None else id_cols
    scored = score_raw(features, models, roles, keep=ids, broadcast_bytes=broadcast_bytes)
    return scored.select(roles.group, *ids, class_probabilities(F.col("probability")).alias("probabilities"))


def score_raw(
    features: DataFrame,
    models: DataFrame,
    roles: Roles,
    *,
    keep: list[str],
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Encode with the model's own encoder and score, in one pass over the rows."""
    encoder = ["medians", *[f"cats_{c}" for c in roles.categorical]]
    renamed = {c: f"_keep_{c}" for c in keep}
    widths = [F.size(F.coalesce(F.col(f"cats_{c}"), F.array())) for c in roles.categorical]
    texts = [F.aggregate(F.col(f"cats_{c}"), F.lit(0), lambda a, x: a + F.length(x) + 24) for c in roles.categorical]
    bytes_ = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(0)) + sum(widths, F.lit(0))
    count, largest = models.agg(F.count("*"), F.max(bytes_)).first()
    joined = attach(
        features.select(roles.group, *[F.col(c).alias(a) for c, a in renamed.items()], *roles.features),
        models.select(roles.group, *encoder),
        [roles.group],
        stats_rows=count,
        row_bytes=64 + (largest or 0) + 8 * len(roles.numeric),
        broadcast_bytes=broadcast_bytes,
    )
    ready = joined.select(roles.group, *renamed.values(), feature_vector(roles).alias("features"))
    walked = tree_margins(ready, models, roles.group, broadcast_bytes=broadcast_bytes)
    return walked.select(
        roles.group,
        *[F.col(a).alias(c) for c, a in renamed.items()],
        probability(F.col("margin")).alias("probability"),
    )


def unscored_groups(predictions: DataFrame, group: str) -> DataFrame:
    """Groups without a model and how many rows each of them has."""
    return (
        predictions.where(F.col("probabilities").isNull())
        .groupBy(group)
        .agg(F.count("*").alias("rows_without_model"))
    )


def with_label_probability(df: DataFrame, probabilities: str = "probabilities") -> DataFrame:
    """Put the class-1 probability in front of the row's own columns."""
    rest = [c for c in df.columns if c != probabilities]
    return df.select(F.get(probabilities, F.lit(1)).alias("label_probability"), *rest)
