"""Column roles and the fixed schemas that cross a Python boundary."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def struct_of(*fields: tuple[str, T.DataType]) -> T.StructType:
    """Build a schema from ``(name, type)`` pairs."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


@dataclass(frozen=True)
class Roles:
    """Which column plays which part in a feature table."""

    group: str = "group_name"
    id: str = "id"
    label: str = "label"
    categorical: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()

    @classmethod
    def from_names(cls, df: DataFrame, **fixed: str) -> "Roles":
        """Pick feature columns by the substrings 'categorical' and 'numeric'."""
        return cls(
            categorical=tuple(feature_columns(df, "categorical")),
            numeric=tuple(feature_columns(df, "numeric")),
            **fixed,
        )

    @property
    def features(self) -> tuple[str, ...]:
        return self.categorical + self.numeric

    def with_(self, **changes) -> "Roles":
        return replace(self, **changes)


def feature_columns(df: DataFrame, contains: str) -> list[str]:
    return [name for name in df.columns if contains in name]


EXEC_FIELDS = (
    ("stage_id", T.IntegerType()),
    ("task_attempt_id", T.LongType()),
    ("partition_id", T.IntegerType()),
    ("start_time", T.TimestampType()),
    ("end_time", T.TimestampType()),
    ("elapsed_seconds", T.DoubleType()),
)

# Flat trees: a node's children are positions in the same arrays, -1 marks a leaf.
TREE_FIELDS = (
    ("roots", T.ArrayType(T.IntegerType())),
    ("node_feature", T.ArrayType(T.IntegerType())),
    ("node_threshold", T.ArrayType(T.DoubleType())),
    ("node_left", T.ArrayType(T.IntegerType())),
    ("node_right", T.ArrayType(T.IntegerType())),
    ("node_value", T.ArrayType(T.DoubleType())),
    ("tree_depth", T.IntegerType()),
)

# Everything the metric formulas need; one set per split.
COUNT_FIELDS = tuple(
    (f"{split}_{name}", kind)
    for split in ("train", "test")
    for name, kind in (
        ("tp", T.LongType()),
        ("fp", T.LongType()),
        ("tn", T.LongType()),
        ("fn", T.LongType()),
        ("auc", T.DoubleType()),
    )
)

FIT_FIELDS = (
    ("trial_id", T.IntegerType()),
    ("status", T.StringType()),
    ("best_iteration", T.IntegerType()),
    ("n_rounds", T.IntegerType()),
    ("round_auc", T.ArrayType(T.DoubleType())),
    *COUNT_FIELDS,
    *TREE_FIELDS,
    *EXEC_FIELDS,
)


def fit_schema(group: str, group_type: T.DataType) -> T.StructType:
    return struct_of((group, group_type), *FIT_FIELDS)


METRICS = (
    "train_precision",
    "train_recall",
    "train_f1",
    "train_auc",
    "test_precision",
    "test_recall",
    "test_f1",
    "test_auc",
)
