"""Language identification by averaged hashed subword embeddings.

A text is the mean of the vectors of its byte n-grams (2 to 4 bytes, within a word and
its two neighbouring characters), a linear softmax reads the language off that mean. Both
are trained by stochastic gradient descent in numpy on at most ``PER_LANGUAGE`` documents
of each language, those of smallest hash. Probabilities are calibrated by a temperature,
and a text whose best probability lies below a calibrated threshold is marked rejected;
both come from a part of the sample that the training has not seen.

As a mean of vectors under a linear map is the mean of the mapped vectors, prediction
needs one table of scores per n-gram bucket and language, and no matrix product per text.

Defined results: a text that is NULL or has no letter is ``und`` with score 0, and so is
every text if no language was learned; ties take the language first in sorted order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortfit.llm.words import Slice, slices, sum_within

#: Bound of the training sample.
PER_LANGUAGE = 400
BITS = 15
BUCKETS = 1 << BITS
DIMENSIONS = 16
SIZES = (2, 3, 4)
#: Accuracy that accepted texts of the calibration part must reach.
ACCEPTED = 0.995


def subwords(part: Slice) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the n-grams of each size in ``SIZES``, with their bounds by text."""
    blanks = np.concatenate([[0], np.cumsum(part.space)])
    for n in SIZES:
        starts = np.arange(max(0, len(part.data) - n + 1))
        inner = blanks[starts + n - 1] == blanks[np.minimum(starts + 1, len(part.data))]
        fits = np.ones(len(starts), bool)
        for edge in part.bounds[1:-1].tolist():  # not across two texts
            fits[max(0, edge - n + 1) : edge] = False
        starts = starts[inner & fits]
        yield (part.hashes(starts, starts + n) >> np.uint64(64 - BITS)).astype(np.int64), np.searchsorted(starts, part.bounds)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def probabilities(self, part: Slice) -> np.ndarray:
        total, count = np.zeros((len(part), len(self.languages))), np.zeros(len(part))
        for buckets, bounds in subwords(part):
            total += sum_within(self.scores[buckets], bounds)
            count += np.diff(bounds)
        return softmax((total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True)) if x.shape[1] else x
    return e / e.sum(axis=1, keepdims=True)


def fit(rows: list[np.ndarray], weights: list[np.ndarray], y: np.ndarray, languages: list[str], seed: int = 7) -> Model:
    """``rows``: the buckets of every text, ``weights``: their shares of its n-grams, summing to 1."""
    random = np.random.default_rng(seed)
    vectors = random.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    head, bias = np.zeros((DIMENSIONS, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    order = random.permutation(len(y))
    held, used = order[: len(y) // 5], order[len(y) // 5 :]
    epochs, batch = 12, 32
    for epoch in range(epochs):
        rate = 1.0 * (1 - epoch / epochs)
        used = random.permutation(used)
        for k in range(0, len(used), batch):
            chosen = used[k : k + batch]
            index = np.concatenate([rows[i] for i in chosen])
            share = np.concatenate([weights[i] for i in chosen]).astype(np.float32)
            bounds = np.concatenate([[0], np.cumsum([len(rows[i]) for i in chosen])])
            mean = sum_within(vectors[index] * share[:, None], bounds)
            error = softmax(mean @ head + bias)
            error[np.arange(len(chosen)), y[chosen]] -= 1
            to_mean = np.repeat(error @ head.T, np.diff(bounds), axis=0) * share[:, None]
            head -= rate * (mean.T @ error) / len(chosen) * 20
            bias -= rate * error.mean(axis=0)
            for d in range(DIMENSIONS):
                vectors[:, d] -= 20 * rate / len(chosen) * np.bincount(index, to_mean[:, d], BUCKETS).astype(np.float32)
    model = Model(languages, (vectors @ head).astype(np.float32), bias)
    if len(held):
        logits = np.array([weights[i] @ model.scores[rows[i]] + bias for i in held])
        loss = {t: -np.log(softmax(logits / t)[np.arange(len(held)), y[held]] + 1e-12).mean() for t in 2.0 ** np.arange(-3, 4, 0.25)}
        model.temperature = float(min(loss, key=loss.get))
        p = softmax(logits / model.temperature)
        top, right = p.max(axis=1), p.argmax(axis=1) == y[held]
        order = np.argsort(-top, kind="stable")
        good = np.flatnonzero(np.cumsum(right[order]) / np.arange(1, len(held) + 1) >= ACCEPTED)
        model.reject_below = float(top[order][good[-1]]) if len(good) else 1.0
    return model


def train(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> Model:
    """Learns every language of ``docs``; rows without a language are not used."""
    known = docs.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"))
    known = known.where(F.col("lang").isNotNull())
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    chosen = known.withColumn("place", place).where(F.col("place") <= per_language)
    sample = F.broadcast(chosen.select("id", F.col("lang").alias("known_lang")).distinct())

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(pc.utf8_lower(pc.fill_null(batch.column(0), ""))):
                grams = list(subwords(part))
                for k in range(len(part)):
                    own = np.concatenate([b[bounds[k] : bounds[k + 1]] for b, bounds in grams])
                    found, n = np.unique(own, return_counts=True)
                    row = part.first + k
                    yield pa.RecordBatch.from_pydict(
                        {
                            "lang": batch.column(1).slice(row, 1),
                            "id": batch.column(2).slice(row, 1),
                            "found": pa.array([found.astype(np.int32)]),
                            "n": pa.array([n.astype(np.int32)]),
                        }
                    )

    texts = docs.select(
        F.col(id_col).cast("string").alias("id"),
        F.col(lang_col).cast("string").alias("own_lang"),
        F.col(text_col).cast("string").alias("text"),
    ).join(sample, "id")
    texts = texts.where(F.col("own_lang") == F.col("known_lang")).where(F.col("text").rlike(r"\p{L}"))
    got = texts.select("text", "known_lang", "id").mapInArrow(
        counted, "lang string, id string, found array<int>, n array<int>"
    )
    rows = got.toArrow().sort_by([("id", "ascending"), ("lang", "ascending")])
    if not rows.num_rows:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    names = rows.column("lang").to_pylist()
    languages = sorted(set(names))
    y = np.array([languages.index(x) for x in names])
    found = [np.asarray(x.values) for x in rows.column("found")]
    counts = [np.asarray(x.values) for x in rows.column("n")]
    return fit(found, [c / max(1, c.sum()) for c in counts], y, languages)


def predict(text: Column, model: Model) -> Column:
    """Struct ``lang, score, rejected`` for every text that holds a letter."""

    @F.arrow_udf("struct<lang:string, score:double, rejected:boolean>")
    def identified(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            best, score = [np.empty(0, np.int64)], [np.empty(0)]
            for part in slices(pc.utf8_lower(pc.fill_null(batch, ""))):
                p = model.probabilities(part)
                best.append(p.argmax(axis=1))
                score.append(p.max(axis=1))
            best, score = np.concatenate(best), np.concatenate(score)
            lang = pa.array(model.languages, pa.string()).take(pa.array(best))
            yield pa.StructArray.from_arrays(
                [lang, pa.array(score), pa.array(score < model.reject_below)], ["lang", "score", "rejected"]
            )

    unknown = F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    if not model.languages:
        return unknown
    return F.when(F.coalesce(text, F.lit("")).rlike(r"\p{L}"), identified(text)).otherwise(unknown)
