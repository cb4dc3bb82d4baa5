"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted per cell (source, language, topic). The cells' weights are raked to
the target shares of one dimension after the other until all three marginals hold; the
ratio of a cell's weight to its tokens is the factor by which its documents should count
more or less. Documents are then sampled with probability ``min(1, lambda * factor)``,
where lambda is calibrated so that the expected tokens are the wanted share of all.

Everything is DataFrame functions. Values without a target share one rest bucket, so the
number of cells is bounded by the target lists, not by the data; texts are read once per
use and documents never move.

Defined results: NULL is a value without a target; the rest bucket takes what the targets
leave of 1; targets of values without tokens go to the other values in proportion; if
targets contradict each other (empty cells) the last dimension holds after the last
round; a NULL or empty text has no tokens and counts in no marginal, but is sampled like
its cell (never, if the whole cell is empty); rows that repeat an id are sampled
together; rows without an id are left out.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortfit.functions.hashing import digest
from cohortfit.session import materialize

REST = "(rest)"
ROUNDS = 12
#: Rounds per Spark job; the weights are written between jobs, so plans do not grow.
ROUNDS_PER_JOB = 4


@dataclass(frozen=True)
class Targets:
    """Token shares by value for every dimension; what they leave of 1 is for the rest."""

    shares: dict[str, dict[str, float]]
    keep: float = 0.4
    seed: int = 8
    rounds: int = ROUNDS

    def bucket(self, dimension: str, value: Column) -> Column:
        return F.when(value.isin(*self.shares[dimension]), value).otherwise(F.lit(REST))

    def share(self, dimension: str) -> Column:
        """The target of a bucket."""
        known = self.shares[dimension]
        out = F.lit(max(0.0, 1 - sum(known.values())))
        for value, share in known.items():
            out = F.when(F.col(dimension) == value, share).otherwise(out)
        return out


def tokens(text: Column) -> Column:
    """Words, counted by their white space: 0 for an empty text."""
    blanks = F.length(text) - F.length(F.translate(text, " \n\t\r", ""))
    return F.when(F.length(text) > 0, blanks + 1).otherwise(0).cast("bigint")


def text_form(text: Column) -> Column:
    """A coarse topic: what kind of text this is."""
    lines = F.length(text) - F.length(F.translate(text, "\n", ""))
    return (
        F.when(text.contains("|"), "table")
        .when(text.contains("=") | text.contains("{"), "code")
        .when(lines * 250 >= F.length(text), "lines")
        .otherwise("prose")
    )


#: Targets of the registered query.
DEFAULT = Targets(
    {
        "source": {f"src{k}": 0.045 for k in range(20)},
        "lang": {"en": 0.4, "de": 0.2, "es": 0.18, "fr": 0.2},
        "topic": {"prose": 0.65, "lines": 0.25, "code": 0.04},
    }
)

DIMENSIONS = ("source", "lang", "topic")


def described(docs: DataFrame, targets: Targets, columns: dict[str, Column], text: Column) -> DataFrame:
    """``docs`` with ``__source, __lang, __topic`` buckets and ``__tokens``."""
    clean = F.coalesce(text.cast("string"), F.lit(""))
    return docs.withColumns(
        {f"__{d}": targets.bucket(d, columns[d].cast("string")) for d in DIMENSIONS} | {"__tokens": tokens(clean)}
    )


def cell_tokens(rows: DataFrame) -> DataFrame:
    cells = rows.groupBy(*[F.col(f"__{d}").alias(d) for d in DIMENSIONS])
    return cells.agg(F.sum("__tokens").alias("tokens")).where("tokens > 0")


def rake(cells: DataFrame, targets: Targets) -> DataFrame:
    """Adds ``weight``: the cells' token shares fitted to the targets."""
    whole = Window.partitionBy()
    fitted = cells.withColumn("weight", F.col("tokens") / F.sum("tokens").over(whole))
    for d in DIMENSIONS:  # targets of present values, scaled to 1
        one = F.when(F.row_number().over(Window.partitionBy(d).orderBy(*DIMENSIONS)) == 1, targets.share(d))
        fitted = fitted.withColumn("__first", one)
        fitted = fitted.withColumn(f"__{d}", targets.share(d) / F.sum("__first").over(whole)).drop("__first")
    fitted = materialize(fitted, "cells")
    for done in range(0, targets.rounds, ROUNDS_PER_JOB):
        for _ in range(min(ROUNDS_PER_JOB, targets.rounds - done)):
            for d in DIMENSIONS:
                total = F.sum("weight").over(Window.partitionBy(d))
                fitted = fitted.withColumn("weight", F.when(total > 0, F.col("weight") * F.col(f"__{d}") / total).otherwise(0.0))
        fitted = materialize(fitted, "cells")
    return fitted.drop(*[f"__{d}" for d in DIMENSIONS])


def calibrate(fitted: DataFrame, targets: Targets) -> DataFrame:
    """Adds ``factor`` and the sampling probability ``p`` of every cell.

    With cells in falling order of their factor, the first k are kept whole; k is the
    least for which the others need no probability above 1.
    """
    whole = Window.partitionBy()
    rows = fitted.withColumn("factor", F.col("weight") / (F.col("tokens") / F.sum("tokens").over(whole)))
    ordered = Window.orderBy(F.col("factor").desc(), *DIMENSIONS)
    above = F.coalesce(F.sum("tokens").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    below = F.sum(F.col("tokens") * F.col("factor")).over(ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    wanted = F.sum("tokens").over(whole) * targets.keep
    rows = rows.withColumn("__lambda", F.when(below > 0, (wanted - above) / below))
    fits = F.col("__lambda") * F.col("factor") <= 1
    rows = rows.withColumn("__lambda", F.max(F.when(fits, F.col("__lambda"))).over(whole))
    p = F.when(F.col("factor") > 0, F.least(F.lit(1.0), F.coalesce("__lambda", F.lit(float("inf"))) * F.col("factor")))
    return rows.withColumn("p", F.coalesce(p, F.lit(0.0))).drop("__lambda")


def uniform(targets: Targets, id_value: Column) -> Column:
    """A number in [0, 1) per document, from 52 bits of its digest."""
    bits = F.conv(F.substring(digest(targets.seed, "mix", id_value), 1, 13), 16, 10).cast("bigint")
    return bits.cast("double") / F.lit(float(1 << 52))


def _with_cells(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """One row per cell joined to documents; the cells are bounded by the target lists."""
    keyed = cells.select(*[F.col(d).alias(f"__{d}") for d in DIMENSIONS], "weight", "factor", "p")
    keyed = keyed.select([F.col(c).alias(c if c.startswith("__") else f"__{c}") for c in keyed.columns])
    return rows.join(F.broadcast(keyed), [f"__{d}" for d in DIMENSIONS], "left")


def mix(
    docs: DataFrame,
    columns: dict[str, Column],
    targets: Targets = DEFAULT,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: buckets, tokens, factor, probability and whether it is sampled."""
    named = docs.where(F.col(id_col).isNotNull())
    rows = described(named, targets, columns, F.col(text_col)).select(
        F.col(id_col).cast("long").alias("doc_id"), *[f"__{d}" for d in DIMENSIONS], "__tokens"
    )
    rows = materialize(rows, "mix-documents")
    cells = calibrate(rake(cell_tokens(rows), targets), targets)
    p = F.coalesce("__p", F.lit(0.0))
    return _with_cells(rows, cells).select(
        "doc_id",
        *[F.col(f"__{d}").alias(d) for d in DIMENSIONS],
        F.col("__tokens").alias("tokens"),
        F.coalesce("__factor", F.lit(0.0)).alias("factor"),
        p.alias("p"),
        (uniform(targets, F.col("doc_id")) < p).alias("sampled"),
    )


def sample(
    docs: DataFrame,
    columns: dict[str, Column],
    targets: Targets = DEFAULT,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The sampled rows of ``docs`` with all their columns, whatever their names."""
    named = docs.where(F.col(id_col).isNotNull())
    row, text = F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text")
    whole = named.select(row, F.col(id_col).cast("long").alias("id"), text, *[columns[d].alias(d) for d in DIMENSIONS])
    rows = described(whole, targets, {d: F.col(d) for d in DIMENSIONS}, F.col("text"))
    cells = materialize(calibrate(rake(cell_tokens(rows), targets), targets), "mix-cells")
    chosen = uniform(targets, F.col("id")) < F.col("__p")
    return _with_cells(rows, cells).where(chosen).select("row.*")
