"""Centroid clustering with Ptolemaic pivots.

Ptolemy's inequality bounds the distance of a vector and a centroid from below by their
distances to any two pivots p, s: it is at least |d(v,p) d(c,s) - d(v,s) d(c,p)| / d(p,s).
The pivots are a few of the starting centroids that lie far apart and stay the same, so a
vector's distances to them are computed once and stored with it; a round computes those of
the centroids only. For every vector the centroid of least bound is compared first, and
then only centroids whose bound does not exceed the distance found. Bounds are rounded down
by more than their arithmetic can err and distances are exact whole numbers, so every
vector gets its true nearest centroid.

A round is one pass over the vectors, each task adding up what it assigns; centroids times
limbs rows reach the driver, however many vectors there are.

Defined results: only vectors of the wanted length without NULL or non-finite components
and with an id take part; every such row counts, repeated ones too, and rows of one id are
ordered by their vectors. Fewer vectors than centroids give as many centroids. Equal
distances go to the smaller number; a centroid that nothing is assigned to stays. Components
of any size take part; a distance that no long can hold is NULL, and so is a sum with one.
An empty table gives no rows. Only the columns named are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortfit.llm import whole
from cohortfit.llm.batches import materialize
from cohortfit.llm.vector_codes import total_of

#: More than the relative error of any bound below, which takes a few roundings of 2^-53.
SLACK = 2.0**-46
#: Vectors looked at together in a task.
ROWS = 4096


@dataclass(frozen=True)
class Spec:
    length: int = 64
    scale: int = 64
    centroids: int = 16
    rounds: int = 3
    seed: int = 1
    pivots: int = 5


def start_order(spec: Spec, id_value: Column) -> Column:
    """Vectors of the least digests are the first centroids."""
    return F.sha2(F.concat(F.lit(f"{spec.seed}:"), id_value.cast("string")), 256)


def choose_pivots(centroids: list[list[int]], most: int) -> list[list[int]]:
    """Distinct centroids, each the farthest from those before it."""
    chosen = centroids[:1]
    least = [None] * len(centroids)
    while centroids and len(chosen) < most:
        gaps = [sum((a - b) ** 2 for a, b in zip(c, chosen[-1])) for c in centroids]
        least = [g if d is None else min(d, g) for d, g in zip(least, gaps)]
        far = max(range(len(centroids)), key=lambda k: (least[k], -k))
        if least[far] == 0:
            break
        chosen = [*chosen, centroids[far]]
    return chosen


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to pivots, as doubles of the exact squares."""
    squares = whole.squared(x, pivots)
    if squares.dtype != object:
        return np.sqrt(squares.astype(float))
    roots = [[float(v) ** 0.5 if v < 1 << 1000 else np.inf for v in row] for row in squares.tolist()]
    return np.array(roots, float).reshape(squares.shape)


def ptolemaic(vectors: np.ndarray, centroids: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Lower bounds of squared distances (vectors, centroids) from distances to the pivots."""
    bound = np.zeros((len(vectors), len(centroids)))
    m = between.shape[0]
    with np.errstate(all="ignore"):
        for i in range(m):
            for j in range(i):
                if between[i, j] > 0:
                    a = vectors[:, i, None] * centroids[:, j]
                    b = vectors[:, j, None] * centroids[:, i]
                    gap = (np.abs(a - b) - SLACK * (a + b)) / between[i, j] * (1 - SLACK)
                    np.fmax(bound, gap, out=bound)
        bound = bound * bound * (1 - SLACK)
    return np.nan_to_num(bound, nan=0.0, posinf=0.0)


class Kernel:
    """Nearest centroids of vectors with known distances to the pivots."""

    def __init__(self, centroids: list[list[int]], pivots: list[list[int]], length: int):
        self.centroids = whole.as_matrix(centroids, length)
        anchors = whole.as_matrix(pivots, length)
        self.to_pivots = distances(self.centroids, anchors)
        self.between = distances(anchors, anchors)
        self.compared = 0

    def _exact(self, x: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
        self.compared += len(rows)
        centroid = self.centroids[k : k + 1]
        if centroid.dtype == object and all(abs(v) <= whole.SMALL for v in centroid[0]):
            centroid = centroid.astype(np.int64)
        return whole.squared(x[rows], centroid)[:, 0]

    def nearest(self, x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of and squared distance to the nearest centroid of every row."""
        bounds = ptolemaic(pivots, self.to_pivots, self.between)
        best = bounds.argmin(1)
        exact_type = object if x.dtype == object or self.centroids.dtype == object else np.int64
        found = np.zeros(len(x), exact_type)
        for k in np.unique(best).tolist():
            rows = np.flatnonzero(best == k)
            found[rows] = self._exact(x, rows, k)
        first = best.copy()
        for k in range(len(self.centroids)):
            rows = np.flatnonzero((first != k) & self._may_beat(bounds[:, k], found))
            if len(rows):
                d = self._exact(x, rows, k)
                held = found[rows]
                better = (d < held) | ((d == held) & (k < best[rows]))
                rows, d = rows[better.astype(bool)], d[better.astype(bool)]
                best[rows], found[rows] = k, d
        return best, found

    @staticmethod
    def _may_beat(bounds: np.ndarray, found: np.ndarray) -> np.ndarray:
        if found.dtype == object:
            return np.array([d >= 1 << 1000 or b <= float(d) * (1 + SLACK) for b, d in zip(bounds.tolist(), found)], bool)
        return bounds <= found * (1 + SLACK)


def _pieces(batch: pa.RecordBatch, spec: Spec, pivots: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row places, whole numbers and pivot distances; small and wide vectors apart."""
    wide = batch["x"].is_null().to_numpy(zero_copy_only=False)
    for flag, name, kind in ((False, "x", np.int64), (True, "far", float)):
        at = np.flatnonzero(wide == flag)
        for k in range(0, len(at), ROWS):
            rows = at[k : k + ROWS]
            part = batch.take(pa.array(rows))
            x = part[name].flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(rows), spec.length)
            away = part["pivots"].flatten().to_numpy(zero_copy_only=False).reshape(len(rows), pivots)
            yield rows, whole.floors(x, spec.scale) if flag else x, away


def _prepared(rows: DataFrame, spec: Spec, pivots: list[list[int]]) -> DataFrame:
    """Vectors as whole numbers (``far``: as they are, if too wide) with their distances to the pivots."""
    m = len(pivots)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = whole.as_matrix(pivots, spec.length)
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                x = part["x"].flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, spec.length)
                wide = part["wide"].to_numpy(zero_copy_only=False)
                for flag in (False, True):
                    at = np.flatnonzero(wide == flag)
                    if not len(at):
                        continue
                    numbers = x[at] if flag else np.floor(x[at] * spec.scale).astype(np.int64)
                    away = distances(whole.floors(x[at], spec.scale) if flag else numbers, anchors)
                    listed = lambda a, w, t: pa.ListArray.from_arrays(
                        np.arange(len(a) + 1, dtype=np.int32) * w, pa.array(a.ravel(), t)
                    )
                    held = listed(numbers, spec.length, pa.float64() if flag else pa.int32())
                    none = pa.nulls(len(at), pa.list_(pa.int32() if flag else pa.float64()))
                    yield pa.RecordBatch.from_arrays(
                        [part["vec_id"].take(pa.array(at)), *((none, held) if flag else (held, none)),
                         listed(away, m, pa.float64())], ["vec_id", "x", "far", "pivots"]
                    )

    schema = "vec_id long, x array<int>, far array<double>, pivots array<double>"
    return materialize(rows.select("vec_id", "x", "wide").mapInArrow(task, schema), "pivot-distances")


def _sums(vectors: DataFrame, centroids: list, pivots: list, spec: Spec) -> dict[int, tuple[int, list[int]]]:
    """Count and sum of the vectors assigned to each centroid."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = Kernel(centroids, pivots, spec.length)
        counts = np.zeros(len(centroids), np.int64)
        small = np.zeros((len(centroids), spec.length), np.int64)
        wide = [[0] * spec.length for _ in centroids]
        for batch in batches:
            for _, x, away in _pieces(batch, spec, len(pivots)):
                cluster, _ = kernel.nearest(x, away)
                np.add.at(counts, cluster, 1)
                if x.dtype != object:
                    for k in np.unique(cluster).tolist():
                        small[k] += x[cluster == k].sum(0)
                else:
                    for k, row in zip(cluster.tolist(), x.tolist()):
                        wide[k] = [a + b for a, b in zip(wide[k], row)]
        out = []
        for k in np.flatnonzero(counts).tolist():
            total = [a + b for a, b in zip(small[k].tolist(), wide[k])]
            out += [
                {"cluster": k, "level": level, "n": 0 if level else int(counts[k]), "s": limb}
                for level, limb in enumerate(whole.limbs(total))
            ]
        schema = pa.schema([("cluster", pa.int32()), ("level", pa.int32()), ("n", pa.int64()), ("s", pa.list_(pa.int64()))])
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    each = vectors.mapInArrow(task, "cluster int, level int, n long, s array<long>")
    added = each.groupBy("cluster", "level").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(spec.length)]).alias("s")
    )
    found: dict[int, tuple[int, list[int]]] = {}
    for r in added.collect():  # centroids x limbs rows
        n, s = found.get(r["cluster"], (0, [0] * spec.length))
        found[r["cluster"]] = n + r["n"], [a + (b << whole.LIMB * r["level"]) for a, b in zip(s, r["s"])]
    return found


def _assigned(vectors: DataFrame, centroids: list, pivots: list, spec: Spec) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = Kernel(centroids, pivots, spec.length)
        for batch in batches:
            for rows, x, away in _pieces(batch, spec, len(pivots)):
                cluster, squares = kernel.nearest(x, away)
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"].take(pa.array(rows)), pa.array(cluster.astype(np.int32)),
                     pa.array(whole.longs(squares.tolist()), pa.int64())], ["vec_id", "cluster", "distance"]
                )

    return vectors.mapInArrow(task, "vec_id long, cluster int, distance long")


def cluster(
    rows: DataFrame, spec: Spec = Spec(), *, id_col: str = "vec_id", vector_col: str = "embedding"
) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``, and the centroids."""
    chosen = rows.where(whole.usable(F.col(vector_col), spec.length) & F.col(id_col).isNotNull())
    numbers = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    named = chosen.select(F.col(id_col).cast("long").alias("vec_id"), numbers.alias("x"))
    first = named.orderBy(start_order(spec, F.col("vec_id")), "x").limit(spec.centroids).select("x").collect()
    centroids = [[int(v) for v in whole.floors(np.array(r["x"], float), spec.scale)] for r in first]
    pivots = choose_pivots(centroids, spec.pivots)
    wide = named.withColumn("wide", whole.is_wide(F.col("x"), spec.scale))
    vectors = _prepared(wide, spec, pivots)
    for _ in range(spec.rounds if centroids else 0):
        for k, (n, s) in _sums(vectors, centroids, pivots, spec).items():
            centroids[k] = whole.floor_mean(s, n)
    found = materialize(_assigned(vectors, centroids, pivots, spec), "clustered")
    per = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(total_of("distance").alias("d")).collect()}
    known = list(per.values())
    inertia = sum(known) if None not in known and sum(known) <= whole.LONG else None
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    listed = lambda values, kind: F.array(*[F.lit(v).cast(kind) for v in values]).cast(f"array<{kind}>")
    at = F.col("cluster")
    out = found.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(listed([per.get(k) for k in range(len(centroids))], "long"), at).alias("cluster_inertia"),
        F.lit(inertia).cast("long").alias("inertia"),
        F.get(listed(digests, "string"), at).alias("centroid_sha256"),
    )
    return out, centroids
