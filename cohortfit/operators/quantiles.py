"""Exact per-group quantiles (linear interpolation), also for groups of any size."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortfit.functions.expressions import present
from cohortfit.operators.groups import Sizes, attach, measure
from cohortfit.session import materialize

# Cells (rows times columns) of one group that may sit in one aggregation buffer;
# a task holds the buffers of up to 128 groups before it falls back to sorting.
BUFFER_CELLS = 200_000


def group_quantiles(
    df: DataFrame,
    group: str,
    columns: list[str],
    probs: list[float],
    *,
    sizes: Sizes | None = None,
    cells: int = BUFFER_CELLS,
) -> DataFrame:
    """One row per group; each column becomes an array with one value per prob.

    ``percentile`` keeps every distinct value of a group in one buffer, so it is
    used only while the largest group fits a task. Otherwise only the groups that
    fit go that way and the hot ones are answered by bracketing.
    """
    sizes = sizes or measure(df, group)
    df = df.select(group, *columns)
    limit = max(1, cells // max(1, len(columns)))
    if sizes.largest <= limit:
        return _one_pass(df, group, columns, probs)
    counts = materialize(df.groupBy(group).agg(F.count("*").alias("_n")), "quantile-sizes")
    if counts.where(F.col("_n") <= limit).isEmpty():
        return _bracketed(df, group, columns, probs, sizes)
    marked = attach(df, counts, [group], stats_rows=sizes.groups, row_bytes=64)
    small = marked.where(F.col("_n") <= limit).drop("_n")
    hot = marked.where(F.col("_n") > limit).drop("_n")
    return _one_pass(small, group, columns, probs).unionByName(
        _bracketed(hot, group, columns, probs, sizes)
    )


def _one_pass(df: DataFrame, group: str, columns: list[str], probs: list[float]) -> DataFrame:
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    return df.groupBy(group).agg(*[F.percentile(c, wanted).alias(c) for c in columns])


def _bracketed(
    df: DataFrame, group: str, columns: list[str], probs: list[float], sizes: Sizes
) -> DataFrame:
    """Sketch a bracket around each quantile, then rank exactly inside it.

    The sketch proposes two values around the wanted rank. One scan counts the
    rows below each bracket, another gathers the few distinct values inside it; the
    counts prove whether the rank lies inside. Brackets that missed are widened
    until they hold it, so the result never depends on the sketch's accuracy.
    """
    accuracy, width, answers = 10_000, 2e-4, []
    # A reserved name keeps the caller's key apart from the working columns.
    name, group = group, "_group"
    df = df.withColumnRenamed(name, group)
    # (column, prob) in long form: rows multiply only by the brackets they fall into.
    pending = df.groupBy(group).agg(*[F.count(c).alias(f"_n_{c}") for c in columns])
    pending = pending.select(
        group,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.lit(i).alias("slot"), F.col(f"_n_{c}").alias("n"))
                    for c in columns
                    for i in range(len(probs))
                ]
            )
        ).alias("want"),
    ).select(group, "want.*")
    prob_of = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("slot") + 1)
    pending = (
        pending.withColumn("position", prob_of * (F.col("n") - 1))
        .withColumn("low_rank", F.floor("position"))
        .withColumn("high_rank", F.ceil("position"))
    )
    pending = materialize(pending, "quantile-want")
    wants = sizes.groups * len(columns) * len(probs)

    while True:
        def edges(sign):
            return [min(1.0, max(0.0, p + sign * width)) for p in probs]

        # One sketch a column answers for both ends of its brackets.
        both, ends = edges(-1) + edges(1), len(probs)
        sketch = df.groupBy(group).agg(
            *[F.percentile_approx(c, both, accuracy).alias(f"ends_{c}") for c in columns],
            *[F.min(c).alias(f"min_{c}") for c in columns],
            *[F.max(c).alias(f"max_{c}") for c in columns],
        )
        sketch = sketch.withColumns(
            {f"lo_{c}": F.slice(f"ends_{c}", 1, ends) for c in columns}
            | {f"hi_{c}": F.slice(f"ends_{c}", ends + 1, ends) for c in columns}
        )
        brackets = sketch.select(
            group,
            *[
                F.transform(
                    F.sequence(F.lit(0), F.lit(len(probs) - 1)),
                    functools.partial(_bracket, c, [e <= 0 for e in edges(-1)], [e >= 1 for e in edges(1)]),
                ).alias(f"_b_{c}")
                for c in columns
            ],
        )
        brackets = materialize(brackets, "quantile-brackets")
        rows = attach(
            df, brackets, [group], stats_rows=sizes.groups, row_bytes=32 + 24 * len(columns) * len(probs)
        )
        below = rows.groupBy(group).agg(*[_below(c, i).alias(f"{c}_{i}") for c in columns for i in range(len(probs))])
        counts = [
            F.struct(F.lit(c).alias("column"), F.lit(i).alias("slot"), F.col(f"{c}_{i}").alias("below"))
            for c in columns
            for i in range(len(probs))
        ]
        below = below.select(group, F.explode(F.array(*counts)).alias("b")).select(group, "b.*")
        # Few rows are in a bracket; the others go before any array is built for them.
        near = functools.reduce(lambda a, b: a | b, [_is_inside(c, i) for c in columns for i in range(len(probs))])
        hits = rows.where(near).select(group, F.explode(F.concat(*[_inside(c) for c in columns])).alias("hit"))
        inside = hits.select(group, "hit.*").groupBy(group, "column", "slot", "value").agg(F.count("*").alias("c"))
        run = W.partitionBy(group, "column", "slot").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
        ranked = inside.withColumn("upto", F.sum("c").over(run))
        keys = [group, "column", "slot"]
        joined = attach(pending, below, keys, stats_rows=wants, row_bytes=96).withColumn(
            "below", F.coalesce("below", F.lit(0))
        )
        found = attach(ranked, joined, keys, stats_rows=wants, row_bytes=128, how="inner")
        last = F.col("below") + F.col("upto")
        first = last - F.col("c")

        def at(rank):
            return F.max(F.when((F.col(rank) >= first) & (F.col(rank) < last), F.col("value")))

        found = found.groupBy(*keys).agg(at("low_rank").alias("low"), at("high_rank").alias("high"))
        result = attach(pending, found, keys, stats_rows=wants, row_bytes=128)
        result = materialize(result, "quantile-round")
        missed = F.col("n") > 0
        missed = missed & (F.col("low").isNull() | F.col("high").isNull())
        answers.append(result.where(~missed))
        pending = result.where(missed).drop("low", "high")
        if pending.isEmpty():
            break
        width *= 16

    done = functools.reduce(DataFrame.unionByName, answers)
    share = F.col("position") - F.col("low_rank")
    value = F.when(F.col("low") == F.col("high"), F.col("low").cast("double")).otherwise(
        (F.col("high_rank") - F.col("position")) * F.col("low") + share * F.col("high")
    )
    done = done.select(group, "column", F.struct("slot", value.alias("value")).alias("q"))
    return done.groupBy(F.col(group).alias(name)).agg(
        *[
            _array_or_null(F.when(F.col("column") == c, F.col("q"))).alias(c)
            for c in columns
        ]
    )


def _array_or_null(q):
    """Values by slot; NULL instead of an array when the column has no values at all."""
    values = F.transform(F.sort_array(F.collect_list(q)), lambda s: s["value"])
    return F.when(F.exists(values, lambda v: v.isNotNull()), values)


def _bracket(column, open_low, open_high, i):
    def pick(flags, bound, sketch):
        flag = F.element_at(F.array(*[F.lit(f) for f in flags]), i + 1)
        return F.when(flag, F.col(f"{bound}_{column}")).otherwise(F.get(F.col(f"{sketch}_{column}"), i))

    return F.struct(
        F.lit(column).alias("column"),
        i.alias("slot"),
        pick(open_low, "min", "lo").alias("lo"),
        pick(open_high, "max", "hi").alias("hi"),
    )


def _edge(column, i, end):
    return F.get(F.col(f"_b_{column}"), F.lit(i))[end]


def _below(column, i):
    """Rows below a bracket."""
    return F.count_if(F.col(column) < _edge(column, i, "lo"))


def _is_inside(column, i):
    x = F.col(column)
    return F.coalesce((x >= _edge(column, i, "lo")) & (x <= _edge(column, i, "hi")), F.lit(False))


def _inside(column):
    """The brackets of a column that a row's value is in, each with the value."""
    x = F.col(column)
    return F.transform(
        F.filter(F.coalesce(F.col(f"_b_{column}"), F.array()), lambda b: (x >= b["lo"]) & (x <= b["hi"])),
        lambda b: F.struct(b["column"].alias("column"), b["slot"].alias("slot"), x.alias("value")),
    )


def quartile_bins(
    df: DataFrame,
    group: str,
    column: str,
    name: str,
    *,
    sizes: Sizes | None = None,
    cells: int = BUFFER_CELLS,
) -> DataFrame:
    """Add the per-group quartile code 0..3 of ``column`` (bins closed on the right).

    NaN is a missing value like NULL: it moves no cut and gets no code.
    """
    sizes = sizes or measure(df, group)
    values = df.select(group, present(column).alias(column))
    cuts = group_quantiles(values, group, [column], [0.25, 0.5, 0.75], sizes=sizes, cells=cells)
    joined = attach(
        df,
        cuts.withColumnRenamed(column, "_cuts"),
        [group],
        stats_rows=sizes.groups,
        row_bytes=96,
    )
    x, cut = present(column), F.col("_cuts")
    code = (
        F.when(x <= cut[0], 0)
        .when(x <= cut[1], 1)
        .when(x <= cut[2], 2)
        .when(x.isNotNull(), 3)
    )
    return joined.withColumn(name, code).drop("_cuts")


def group_medians(
    df: DataFrame,
    group: str,
    columns: list[str],
    *,
    sizes: Sizes | None = None,
    cells: int = BUFFER_CELLS,
) -> DataFrame:
    """Exact median of each column per group."""
    halves = group_quantiles(df, group, columns, [0.5], sizes=sizes, cells=cells)
    return halves.select(group, *[F.get(F.col(c), F.lit(0)).alias(c) for c in columns])
