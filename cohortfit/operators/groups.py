"""Group sizes, size-checked lookups and balanced bucketing of hot groups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
# Rows one task may hold or sort for one group.
TASK_ROWS = 2_000_000
# Rows of one group that one Python task may hold and fit, binned and packed, and their
# bytes; up to SURE_ROWS a group is not asked for its number of features.
FIT_ROWS = 12_000_000
FIT_BYTES = 1_200_000_000
SURE_ROWS = 500_000
MAX_BUCKETS = 4096


@dataclass(frozen=True)
class Sizes:
    """Three scalars that decide between one-task and split strategies."""

    groups: int
    rows: int
    largest: int


def measure(df: DataFrame, *group: str) -> Sizes:
    row = (
        df.groupBy(*group)
        .count()
        .agg(F.count("*").alias("g"), F.sum("count").alias("n"), F.max("count").alias("m"))
        .first()
    )
    return Sizes(row["g"], row["n"] or 0, row["m"] or 0)


def same(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Null-safe equality on all pairs, so that a NULL key is a group of its own."""
    condition = None
    for a, b in pairs:
        one = left[a].eqNullSafe(right[b])
        condition = one if condition is None else condition & one
    return condition


def attach(
    df: DataFrame,
    stats: DataFrame,
    on: list[str],
    *,
    stats_rows: int,
    row_bytes: int,
    how: str = "left",
    broadcast_bytes: int | None = None,
    hot_rows: int = TASK_ROWS,
) -> DataFrame:
    """Join one row of ``stats`` per key to every row of ``df``.

    ``stats`` is broadcast only while its size, bounded by ``stats_rows`` times
    ``row_bytes``, stays under the limit; then ``df`` is not shuffled at all.
    Above it both sides shuffle on the key, and a key with more than ``hot_rows``
    rows is salted over as many tasks as it needs. Other keys get no copies.
    """
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    renamed = stats.select(
        *[F.col(k).alias(f"_on_{k}") for k in on], *[c for c in stats.columns if c not in on]
    )
    keys = [(k, f"_on_{k}") for k in on]
    if stats_rows * row_bytes <= limit:
        small = F.broadcast(renamed)
        joined = df.join(small, same(df, small, keys), how)
        return joined.drop(*[b for _, b in keys])
    spread, copies, salt = salted(df, renamed, on, right_on=[b for _, b in keys], hot_rows=hot_rows, broadcast_bytes=limit)
    copied = copies.withColumnRenamed(salt, f"_on{salt}")
    joined = spread.join(copied, same(spread, copied, [*keys, (salt, f"_on{salt}")]), how)
    return joined.drop(salt, f"_on{salt}", *[b for _, b in keys])


#: Bytes assumed for a key in a list of hot ones.
KEY_BYTES = 256


def salted(
    df: DataFrame,
    stats: DataFrame,
    on: list[str],
    *,
    right_on: list[str] | None = None,
    hot_rows: int = TASK_ROWS,
    broadcast_bytes: int | None = None,
) -> tuple[DataFrame, DataFrame, str]:
    """Both frames with a salt column, and its name: rows of a key with more than
    ``hot_rows`` rows are dealt over as many salts as it needs, and its row of ``stats``
    is copied to each. Other keys have salt 0.

    Rows are dealt by their values and the partition they come from, so equal rows
    spread too and a repeated task deals its rows as before. There is at most one hot
    key per ``hot_rows`` rows; the list is broadcast only while it is small.
    """
    from cohortfit.session import materialize

    right_on = on if right_on is None else right_on
    names = [f"_hot_{k}" for k in on]
    hot = (
        df.groupBy(*[F.col(k).alias(n) for k, n in zip(on, names)])
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > hot_rows)
        .withColumn("_parts", F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int"))
        .drop("_n")
    )
    hot = materialize(hot, "hot-keys")
    if hot.count() * KEY_BYTES <= (BROADCAST_BYTES if broadcast_bytes is None else max(broadcast_bytes, 1 << 20)):
        hot = F.broadcast(hot)
    parts = F.coalesce("_parts", F.lit(1))
    marked = df.withColumn("_from", F.spark_partition_id())
    spread = marked.join(hot, same(marked, hot, list(zip(on, names))), "left")
    dealt = F.pmod(F.xxhash64(*_hashable(df), F.col("_from")), parts).cast("int")
    spread = spread.withColumn("_salt", dealt).drop("_parts", "_from", *names)
    copies = stats.join(hot, same(stats, hot, list(zip(right_on, names))), "left")
    copies = copies.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts", *names)
    return spread, copies, "_salt"


def numbered(df: DataFrame, key: str, name: str) -> DataFrame:
    """Adds the 0-based place of every row in the order of ``key``, without one task for all.

    Rows are sorted in ranges; a range starts after the rows of those before it.
    """
    from pyspark.sql import Window as W

    from cohortfit.session import materialize

    dealt = materialize(df.repartitionByRange(F.col(key)).withColumn("_range", F.spark_partition_id()), "ranges")
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    starts = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    starts = starts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(W.partitionBy("_range").orderBy(key)) - 1
    placed = dealt.withColumn("_inside", inside).join(F.broadcast(starts), "_range")
    return placed.withColumn(name, F.col("_start") + F.col("_inside")).drop("_range", "_start", "_inside")


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]


def meet(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Null-safe equi-join of two summary tables; the engine picks the strategy."""
    renamed = right.select(*[F.col(k).alias(f"_on_{k}") for k in on], *[c for c in right.columns if c not in on])
    joined = left.join(renamed, same(left, renamed, [(k, f"_on_{k}") for k in on]), how)
    return joined.drop(*[f"_on_{k}" for k in on])


def search_sorted(cuts: Column, value: Column, max_length: int) -> Column:
    """Number of ``cuts`` below ``value``: a binary search inside one expression."""
    steps, step = [], 1
    while step <= max_length:
        steps.append(step)
        step *= 2
    length = F.size(cuts)
    return F.aggregate(
        F.array(*[F.lit(s) for s in reversed(steps)]),
        F.lit(0),
        lambda pos, s: F.when(
            (pos + s <= length) & (F.get(cuts, pos + s - 1) < value), pos + s
        ).otherwise(pos),
    )


def even_probs(parts: int) -> list[float]:
    return [i / parts for i in range(1, parts)]


def bucket_cuts(df: DataFrame, group: list[str], value: str, sizes: Sizes, task_rows: int) -> DataFrame:
    """Per-group cut points that leave about ``task_rows`` rows between neighbours.

    The sketch only balances work: whatever cuts it returns, results that add up
    bucket totals and ranks inside buckets stay exact.
    """
    parts = min(MAX_BUCKETS, max(2, -(-sizes.largest // task_rows)))
    cuts = df.groupBy(*group).agg(
        F.array_distinct(F.percentile_approx(value, even_probs(parts), max(10_000, parts * 20))).alias("_cuts")
    )
    return cuts


def ranked_within(
    df: DataFrame, group: list[str], value: str, weights: dict[str, str], sizes: Sizes, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Add, for each ``new: column`` in ``weights``, the sum of that column over the
    group's rows with a smaller ``value``.

    ``(group, value)`` must be unique. Groups that fit one task are one ordered
    window. Larger ones are cut into value ranges: a window per range plus a
    prefix sum over range totals, so no task sorts a whole hot group.
    """
    from pyspark.sql import Window as W

    from cohortfit.session import materialize

    if sizes.largest <= task_rows:
        before = W.partitionBy(*group).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
        return df.select(
            "*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(n) for n, c in weights.items()]
        )
    # Read three times below, and sketches must not differ between the reads.
    df = materialize(df, "to-rank")
    cuts = materialize(bucket_cuts(df, group, value, sizes, task_rows), "cuts")
    parts = MAX_BUCKETS
    spread = attach(df, cuts, group, stats_rows=sizes.groups, row_bytes=64 + 8 * parts)
    spread = spread.withColumn("_bucket", search_sorted(F.col("_cuts"), F.col(value), parts)).drop("_cuts")
    earlier = W.partitionBy(*group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    totals = (
        spread.groupBy(*group, "_bucket")
        .agg(*[F.sum(c).alias(f"_t_{n}") for n, c in weights.items()])
        .select(
            *group,
            "_bucket",
            *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_p_{n}") for n in weights],
        )
    )
    inside = W.partitionBy(*group, "_bucket").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    both = attach(
        spread,
        totals,
        [*group, "_bucket"],
        stats_rows=sizes.groups * parts,
        row_bytes=32 + 8 * len(weights),
    )
    return both.select(
        *df.columns,
        *[
            (F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_p_{n}")).alias(n)
            for n, c in weights.items()
        ],
    )
