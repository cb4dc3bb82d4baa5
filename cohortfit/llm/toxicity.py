"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another; the log-odds of the earlier ones are features
of the later. In training those features are out-of-fold predictions, so a later model
sees earlier ones as reliable as they will be on new texts. A model is a logistic
regression on the presence of hashed words and word beginnings, chosen by their
association with the category.

The fit uses at most ``TRAIN_ROWS`` labelled documents: those of smallest hash, half of
them of the last category where there are enough, weighted back to the true shares. Spark
tasks make the features of these documents, count them by category and fold and select the
best; only those reach the driver, where the fit itself is numpy. Prediction is one Arrow function over whole texts, without a shuffle.

Defined results: a NULL or empty text has only the bias; texts of any length are read whole; a label that is NULL or belongs
to no document is not used; of repeated labels of a document the largest counts; without
labels of both kinds a category has its constant share (0 without any), and a document is
flagged only by a model that was trained on both.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortfit.llm.batches import materialize
from cohortfit.llm.words import Slice, distinct_within, slices, sum_within

#: Bound of the sample that the classifier is fitted on.
TRAIN_ROWS = 8_000
#: Hashed features, and those kept by a category's model.
BUCKETS = 1 << 18
KEPT = 4_096
FOLDS = 3
#: Bytes of the word beginnings used besides whole words.
BEGINNINGS = (4, 5, 6)


def features(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct features of every text, and their bounds."""
    starts, ends = part.words
    kinds = [part.word_hashes]
    kinds += [part.hashes(starts, np.minimum(starts + n, ends)) + np.uint64(n) for n in BEGINNINGS]
    found = np.stack([k % np.uint64(BUCKETS) for k in kinds], axis=1).astype(np.uint32).ravel()
    return distinct_within(found, part.word_bounds * len(kinds))


@dataclass
class Linear:
    """Log-odds = bias + weights of present features + rest · earlier log-odds, then a linear calibration."""

    bias: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    rest: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: float = 1.0
    shift: float = 0.0
    trained: bool = False

    def margin(self, found: np.ndarray, bounds: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        raw = self.bias + sum_within(self.weights[found], bounds).astype(float)
        if len(self.rest):
            raw += earlier @ self.rest
        return np.clip(self.scale * raw + self.shift, -30, 30)


@dataclass
class Chain:
    names: list[str]
    models: list[Linear]
    threshold: float

    def margins(self, found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        out = np.zeros((len(bounds) - 1, len(self.models)))
        for k, model in enumerate(self.models):
            out[:, k] = model.margin(found, bounds, out[:, :k])
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Sample:
    """Labelled texts: the selected features of each (sorted), labels (NaN where unknown), weights, folds.

    ``chosen[k, f]`` are the features for category k that were selected without fold f, and
    with f = FOLDS those selected on all rows.
    """

    found: np.ndarray
    bounds: np.ndarray
    labels: np.ndarray
    weight: np.ndarray
    fold: np.ndarray
    chosen: dict[tuple[int, int], np.ndarray]

    def features(self, keep: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and column of every feature of the rows in ``keep`` that has a place."""
        counts = np.diff(self.bounds)
        column = place[self.found[np.repeat(keep, counts)]]
        row = np.repeat(np.arange(int(keep.sum()), dtype=np.int32), counts[keep])
        used = column >= 0
        return row[used], column[used]

    def margin(self, model: Linear, keep: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        counts = np.diff(self.bounds)
        found = self.found[np.repeat(keep, counts)]
        return model.margin(found, np.concatenate([[0], np.cumsum(counts[keep])]), earlier)


def fit_linear(sample: Sample, keep: np.ndarray, chosen: np.ndarray, earlier: np.ndarray, y: np.ndarray, steps: int = 150) -> Linear:
    """Logistic regression by gradient steps of decreasing size per feature (Adagrad), on the rows in ``keep``."""
    y, weight, earlier = y[keep], sample.weight[keep], earlier[keep]
    total = weight.sum()
    share = (weight * y).sum() / total if total else 0.0
    model = Linear(rest=np.zeros(earlier.shape[1]))
    if share in (0.0, 1.0):
        model.bias = -30.0 if share == 0 else 30.0
        return model
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    row, column = sample.features(keep, place)
    n, m = len(y), len(chosen)
    w, b, rest = np.zeros(m), float(np.log(share / (1 - share))), np.zeros(earlier.shape[1])
    gw, gb, gr = np.full(m, 1e-8), 1e-8, np.full(earlier.shape[1], 1e-8)
    for _ in range(steps):
        margin = b + np.bincount(row, weights=w[column], minlength=n) + earlier @ rest
        error = weight / total * (_sigmoid(margin) - y)
        dw = np.bincount(column, weights=error[row], minlength=m) + 1e-5 * w
        db, dr = error.sum(), earlier.T @ error + 1e-5 * rest
        gw, gb, gr = gw + dw**2, gb + db**2, gr + dr**2
        w, b, rest = w - 0.3 * dw / np.sqrt(gw), b - 0.3 * db / np.sqrt(gb), rest - 0.05 * dr / np.sqrt(gr)
    model.weights[chosen] = w
    model.bias, model.rest, model.trained = b, rest, True
    return model


def _calibrate(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the log-odds, fitted on out-of-fold margins by Newton steps."""
    a, c = 1.0, 0.0
    w = weight / weight.sum()
    for _ in range(25):
        p = _sigmoid(a * margin + c)
        g = np.array([(w * (p - y) * margin).sum() + 1e-4 * (a - 1), (w * (p - y)).sum() + 1e-4 * c])
        h = w * p * (1 - p)
        hessian = np.array([[(h * margin**2).sum(), (h * margin).sum()], [(h * margin).sum(), h.sum()]])
        step = np.linalg.solve(hessian + 1e-3 * np.eye(2), g)
        a, c = float(np.clip(a - step[0], 0.05, 5)), float(np.clip(c - step[1], -10, 10))
    return a, c


def fit_chain(names: list[str], sample: Sample) -> Chain:
    """Fits the categories in order, each on the out-of-fold log-odds of those before it."""
    models, earlier = [], np.zeros((len(sample.weight), 0))
    threshold = 0.5
    for k in range(len(names)):
        known = ~np.isnan(sample.labels[:, k])
        y, weight = np.nan_to_num(sample.labels[:, k]), sample.weight
        margin = np.zeros(len(weight))
        for f in range(FOLDS):
            part = fit_linear(sample, known & (sample.fold != f), sample.chosen[k, f], earlier, y)
            held = sample.fold == f
            margin[held] = sample.margin(part, held, earlier[held])
        model = fit_linear(sample, known, sample.chosen[k, FOLDS], earlier, y)
        if model.trained:
            model.scale, model.shift = _calibrate(margin[known], y[known], weight[known])
            margin = np.clip(model.scale * margin + model.shift, -30, 30)
            threshold = _best_threshold(_sigmoid(margin[known]), y[known], weight[known])
        else:
            threshold = 2.0
        models.append(model)
        earlier = np.column_stack([earlier, margin])
    return Chain(names, models, threshold)


def _best_threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The cut of best F1 out of fold, in the middle of the gap below it; ties take the higher cut."""
    order = np.argsort(-p, kind="stable")
    hit, flagged = np.cumsum((weight * y)[order]), np.cumsum(weight[order])
    score = 2 * hit / (flagged + (weight * y).sum())
    last = np.append(p[order][1:] != p[order][:-1], True)
    k = int(np.argmax(np.where(last, score, -1)))
    below = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float((p[order][k] + below) / 2)


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: list[str],
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    train_rows: int = TRAIN_ROWS,
) -> Chain:
    """``labels`` holds the id and a 0/1 column per category, in the order of the chain."""
    target = categories[-1]
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id"))
    known = known.agg(*[F.max(F.col(c).cast("int")).alias(c) for c in categories])
    known = known.where(F.col(target).isNotNull())
    sizes = {r[target]: r["n"] for r in known.groupBy(target).agg(F.count("*").alias("n")).collect()}
    ordered = known.withColumn("h", F.xxhash64("doc_id"))
    half = min(train_rows // 2, sizes.get(1, 0))
    parts = [ordered.where(F.col(target) == c).orderBy("h", "doc_id").limit(n) for c, n in ((1, half), (0, train_rows - half))]
    sample = F.broadcast(parts[0].unionByName(parts[1]))  # at most train_rows rows

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(pc.utf8_lower(pc.fill_null(batch.column(0), ""))):
                found, bounds = features(part)
                rows = batch.slice(part.first, len(part))
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(found.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*rows.columns[1:], lists], [*rows.schema.names[1:], "found"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chosen = texts.join(sample, "doc_id").select("text", "doc_id", "h", *categories)
    schema = "doc_id long, h long, " + ", ".join(f"{c} int" for c in categories) + ", found array<int>"
    rows = materialize(chosen.mapInArrow(featured, schema), "toxicity-features")
    rows = rows.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int"))
    return fit_chain(categories, _collected(rows.select("doc_id", "h", "fold", *categories, "found"), categories, sizes))


def select_features(rows: DataFrame, categories: list[str]) -> dict[tuple[int, int], np.ndarray]:
    """The features that go best with each category, without each fold and over all rows.

    Counted and ranked in Spark; at most KEPT a category and fold reach the driver.
    """
    cells = [(k, c, f) for k, c in enumerate(categories) for f in range(FOLDS)]
    names = [f"{s}_{k}_{f}" for k, _, f in cells for s in "np"]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(names), BUCKETS), np.int32)
        for batch in batches:
            lists, fold = batch["found"], batch["fold"].to_numpy()
            flat, lengths = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
            for i, (_, c, f) in enumerate(cells):
                y = pc.fill_null(batch[c], -1).to_numpy(zero_copy_only=False)
                for j, chosen in enumerate(((fold == f) & (y >= 0), (fold == f) & (y == 1))):
                    counts[2 * i + j] += np.bincount(flat[np.repeat(chosen, lengths)], minlength=BUCKETS).astype(np.int32)
        bucket = np.flatnonzero(counts.any(0))
        values = [pa.array(counts[i, bucket].astype(np.int64)) for i in range(len(names))]
        yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), *values], ["bucket", *names])

    # Per task at most BUCKETS rows; so many in all after the sum.
    each = rows.mapInArrow(counted, "bucket int, " + ", ".join(f"{n} long" for n in names))
    counts = materialize(each.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]), "toxicity-counts")
    inside = [(f"n_{k}_{f}", (F.col("fold") == f) & F.col(c).isNotNull()) for k, c, f in cells]
    inside += [(f"p_{k}_{f}", (F.col("fold") == f) & (F.col(c) == 1)) for k, c, f in cells]
    total = rows.agg(*[F.count_if(condition).alias(n) for n, condition in inside]).first()
    best = []
    out = {}
    for k, f in [(k, f) for k in range(len(categories)) for f in range(FOLDS + 1)]:
        out[k, f] = np.empty(0, np.int64)
        others = [g for g in range(FOLDS) if g != f]
        n, p = (sum(total[f"{s}_{k}_{g}"] for g in others) for s in "np")
        if p in (0, n):
            continue
        present, positive = (reduce(Column.__add__, [F.col(f"{s}_{k}_{g}") for g in others]) for s in "np")
        expected = present * (p / n)
        spread = expected * (1 - p / n) * (1 - present / n) + 1e-9
        strength = F.when(present >= 4, (positive - expected) ** 2 / spread).otherwise(0.0)
        ranked = counts.select("bucket", strength.alias("s")).where("s > 8").orderBy(F.col("s").desc(), "bucket").limit(KEPT)
        best.append(ranked.select(F.lit(k).alias("k"), F.lit(f).alias("f"), "bucket"))
    found: dict[tuple[int, int], list[int]] = {}
    if best:
        for r in reduce(DataFrame.unionByName, best).collect():
            found.setdefault((r["k"], r["f"]), []).append(r["bucket"])
    return out | {key: np.array(sorted(values), np.int64) for key, values in found.items()}


def _collected(rows: DataFrame, categories: list[str], sizes: dict[int, int]) -> Sample:
    """The sample with its selected features only: at most ``train_rows`` rows."""
    chosen = select_features(rows, categories)
    used = np.zeros(BUCKETS, bool)
    for buckets in chosen.values():
        used[buckets] = True

    def narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["found"]
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            kept = np.concatenate([[0], np.cumsum(used[flat])])
            bounds = kept[np.concatenate([[0], ends])].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat[used[flat]], pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], batch.schema.names)

    table = rows.mapInArrow(narrowed, rows.schema).toArrow().sort_by([("h", "ascending"), ("doc_id", "ascending")])
    lists = table.column("found").combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.array([], pa.list_(pa.int32()))
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    y = np.column_stack([table.column(c).to_numpy().astype(float) for c in categories]).reshape(-1, len(categories))
    last = y[:, -1] if len(y) else np.zeros(0)
    weight = np.array([sizes.get(c, 0) / max(1, (last == c).sum()) for c in (0, 1)])[last.astype(int)]
    found = lists.flatten().to_numpy(zero_copy_only=False)
    return Sample(found, bounds, y, weight, table.column("fold").to_numpy(), chosen)


def predict(text: Column, chain: Chain) -> Column:
    """An array of the categories' probabilities, in the order of the chain."""

    @F.arrow_udf("array<double>")
    def chained(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [np.zeros((0, len(chain.models)))]
            for part in slices(pc.utf8_lower(pc.fill_null(batch, ""))):
                parts.append(_sigmoid(chain.margins(*features(part))))
            values = np.concatenate(parts)
            ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))

    return chained(text)


def classify(docs: DataFrame, chain: Chain, *, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """Adds the struct ``out`` with a probability per category and ``flagged``."""
    rows = docs.withColumn(out, predict(F.col(text_col), chain))
    values = [F.col(out)[k].alias(f"p_{c}") for k, c in enumerate(chain.names)]
    return rows.withColumn(out, F.struct(*values, (F.col(out)[len(values) - 1] >= chain.threshold).alias("flagged")))
