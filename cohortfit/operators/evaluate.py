"""Classification metrics per group as plain aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortfit.operators.groups import TASK_ROWS, Sizes, measure, ranked_within

EXACT = "decimal(38,0)"


def ratio(top: Column, bottom: Column) -> Column:
    """Division that gives 0 where there is nothing to divide by."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / F.nullif(bottom, F.lit(0)))


def hard_class(p: Column) -> Column:
    return F.when(p > 0.5, 1).when(p.isNotNull(), 0)


def confusion(label: Column, predicted: Column, prefix: str = "", where: Column | None = None) -> list[Column]:
    """The four counts of a binary confusion matrix, as aggregate columns."""
    cells = {
        "tp": (label == 1) & (predicted == 1),
        "fp": (label == 0) & (predicted == 1),
        "tn": (label == 0) & (predicted == 0),
        "fn": (label == 1) & (predicted == 0),
    }
    return [
        F.count_if(test if where is None else test & where).alias(f"{prefix}{name}")
        for name, test in cells.items()
    ]


def weighted_scores(prefix: str = "") -> dict[str, Column]:
    """Support-weighted precision, recall and F1 from confusion counts."""
    tp, fp, tn, fn = (F.col(f"{prefix}{n}").cast("double") for n in ("tp", "fp", "tn", "fn"))
    pos, neg = tp + fn, tn + fp
    total = F.nullif(pos + neg, F.lit(0.0))
    precision = (ratio(tp, tp + fp) * pos + ratio(tn, tn + fn) * neg) / total
    recall = (tp + tn) / total
    f1 = (ratio(2 * tp, 2 * tp + fp + fn) * pos + ratio(2 * tn, 2 * tn + fp + fn) * neg) / total
    return {"precision": precision, "recall": recall, "f1": f1}


def group_weighted_prf(df: DataFrame, group: str, label: str, predicted: str) -> DataFrame:
    counts = df.groupBy(group).agg(*confusion(F.col(label), F.col(predicted)))
    return counts.select(group, *[c.alias(n) for n, c in weighted_scores().items()])


def class_counts(df: DataFrame, keys: list[str], label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score: what every metric here needs.

    One map-side combined aggregate; a hot group is spread over its scores.
    """
    positive = (F.col(label) == 1).cast("long")
    # 0.0 folds a negative zero into a plain one, which some engines sort apart.
    return (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*keys, (F.col(score).cast("double") + F.lit(0.0)).alias("_s"))
        .agg(F.sum(positive).alias("_pos"), F.sum(1 - positive).alias("_neg"))
    )


def with_pairs_won(counts: DataFrame, keys: list[str], sizes: Sizes, task_rows: int) -> DataFrame:
    """Add twice the pairs each score's positives win, ties counted half.

    Whole numbers of any size, so sums do not depend on their order.
    """
    ranked = ranked_within(counts, keys, "_s", {"_below": "_neg"}, sizes, task_rows)
    twice = F.col("_pos").cast("decimal(19,0)") * (2 * F.col("_below") + F.col("_neg")).cast("decimal(19,0)")
    return ranked.withColumn("_won", twice.cast(EXACT))


def auc_from_sums(won: Column, positives: Column, negatives: Column) -> Column:
    pairs = F.nullif(positives.cast("double") * negatives.cast("double"), F.lit(0.0))
    return won.cast("double") / (2 * pairs)


def group_auc(
    df: DataFrame,
    group: list[str] | str,
    label: str,
    score: str,
    *,
    name: str = "auc",
    sizes: Sizes | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Exact ROC AUC per group; NULL when a class is absent.

    Rows are reduced to class counts per distinct score, then each score's
    positives meet the negatives below it.
    """
    group = [group] if isinstance(group, str) else list(group)
    sizes = sizes or measure(df, *group)
    ranked = with_pairs_won(class_counts(df, group, label, score), group, sizes, task_rows)
    sums = ranked.groupBy(*group).agg(*[F.sum(c).alias(c) for c in ("_won", "_pos", "_neg")])
    return sums.select(*group, auc_from_sums(F.col("_won"), F.col("_pos"), F.col("_neg")).alias(name))


def split_counts(
    df: DataFrame,
    keys: list[str],
    label: str,
    score: str,
    split: str,
    *,
    threshold: float = 0.5,
    sizes: Sizes,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Confusion counts and AUC per key for the train and test rows, in one pass.

    The counts at ``threshold`` come out of the same per-score table as the AUC.
    """
    ranked = with_pairs_won(class_counts(df, [*keys, split], label, score), [*keys, split], sizes, task_rows)
    high = F.col("_s") > threshold
    columns = []
    for side in ("train", "test"):
        def total(value, where=None, side=side):
            here = F.col(split) == side
            return F.coalesce(F.sum(F.when(here if where is None else here & where, F.col(value))), F.lit(0))

        columns += [
            total("_pos", high).alias(f"{side}_tp"),
            total("_neg", high).alias(f"{side}_fp"),
            total("_neg", ~high).alias(f"{side}_tn"),
            total("_pos", ~high).alias(f"{side}_fn"),
            auc_from_sums(total("_won"), total("_pos"), total("_neg")).alias(f"{side}_auc"),
        ]
    return ranked.groupBy(*keys).agg(*columns)


def metric_columns(digits: int = 3) -> list[Column]:
    """The eight rounded metrics of a frame holding per-split counts and AUCs."""
    columns = []
    for split in ("train", "test"):
        for name, value in weighted_scores(f"{split}_").items():
            columns.append(F.round(value, digits).alias(f"{split}_{name}"))
        columns.append(F.round(F.col(f"{split}_auc"), digits).alias(f"{split}_auc"))
    return columns


def metric_row(
    df: DataFrame,
    group: str,
    label: str,
    score: str,
    split: str,
    *,
    sizes: Sizes | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Eight metrics and the loss per group from scored rows marked train/test."""
    sizes = sizes or measure(df, group)
    found = split_counts(df, [group], label, score, split, sizes=sizes, task_rows=task_rows)
    return found.select(group, *metric_columns(), trial_loss(F.col("test_auc")).alias("loss"))


def trial_loss(auc: Column) -> Column:
    return F.lit(1.0) - auc
