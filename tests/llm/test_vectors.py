"""Vector codes and centroids against plain Python on whole numbers of any size."""

import hashlib
import math
import random

import numpy as np
import pytest

from cohortfit.llm import centroids, vector_codes, whole

SCHEMA = "vec_id long, embedding array<double>, label int, row long, part int, wide string, x string, level int"
LONG = (1 << 63) - 1


def table(seed, n=300, dims=8, big=True):
    r = random.Random(seed)
    middles = [[r.uniform(-1, 1) for _ in range(dims)] for _ in range(6)]
    vectors = [[x + r.gauss(0, 0.1) for x in r.choice(middles)] for _ in range(n)]
    vectors += [vectors[5]] * 40 + [[0.0] * dims] * 3
    if big:
        vectors += [[5000.0] * dims, [-3000.5] + [0.0] * (dims - 1), [1e30] + [0.25] * (dims - 1), [1.7e308] * dims, [-1e22] * dims]
    rows = [(k, v, r.choice([None, 0, 1, 2])) for k, v in enumerate(vectors)]
    rows += [(7, vectors[9], 3), (7, vectors[9], 3), (8, vectors[1], None)]  # ids repeated, with and without their vector
    rows += [(900, None, 1), (901, [None] * dims, 1), (902, [float("nan")] * dims, 1), (903, [float("inf")] * dims, 1)]
    rows += [(None, vectors[0], 1)]
    return [(*row, 1, 1, "w", "x", 1) for row in rows]


def scaled(x, scale):
    return int(x) * scale if abs(x) >= 2**53 else math.floor(x * scale)


def kept(rows):
    good = [r for r in rows if r[0] is not None and r[1] is not None and all(v is not None and math.isfinite(v) for v in r[1])]
    return sorted(good, key=lambda r: (r[0], r[1]))


def gap(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def long(v):
    return v if v is not None and v <= LONG else None


def improve(points, first, rounds):
    middles = [list(c) for c in first]
    for step in range(rounds + 1):
        near = [min(range(len(middles)), key=lambda k: (gap(p, middles[k]), k)) for p in points]
        if step < rounds:
            for k in range(len(middles)):
                held = [p for p, m in zip(points, near) if m == k]
                if held:
                    middles[k] = [sum(c) // len(held) for c in zip(*held)]
    return near, middles


def coded(rows, spec):
    good = kept(rows)
    width = max(1, -(-max((len(r[1]) for r in good), default=0) // spec.parts))
    codes, errors, books = [""] * len(good), [0] * len(good), []
    for p in range(spec.parts):
        points = []
        for r in good:
            each = -(-len(r[1]) // spec.parts)
            piece = [scaled(v, spec.scale) for v in r[1][p * each : (p + 1) * each]]
            points.append(piece + [0] * (width - len(piece)))
        near, book = improve(points, points[: spec.entries], spec.rounds)
        books.append(book)
        for k, e in enumerate(near):
            codes[k] += f"{e:02x}"
            errors[k] += gap(points[k], book[e])
    text = ",".join(str(v) for book in books for e in book for v in e)
    by_label = {}
    for r, e in zip(good, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    out = [(r[0], r[2], c, long(e), long(by_label[r[2]])) for r, c, e in zip(good, codes, errors)]
    return sorted(out, key=str), hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("big", [False, True])
def test_vector_codes(spark, big):
    rows, spec = table(1, big=big), vector_codes.Spec(entries=20, rounds=3)
    got, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(5), spec)
    expected, digest = coded(rows, spec)
    assert sorted([tuple(r) for r in got.collect()], key=str) == expected
    assert books.sha256() == digest


def test_vector_codes_of_uneven_lengths(spark):
    r = random.Random(3)
    rows = [(k, [r.uniform(-1, 1) for _ in range(r.choice([0, 1, 4, 6, 9]))], k % 2, 1, 1, "", "", 1) for k in range(60)]
    spec = vector_codes.Spec(entries=5, rounds=2)
    got, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3), spec)
    expected, digest = coded(rows, spec)
    assert sorted([tuple(r) for r in got.collect()], key=str) == expected
    assert books.sha256() == digest


def test_vector_codes_of_nothing(spark):
    got, books = vector_codes.compress(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["vec_id", "label", "code", "error", "label_error"] and got.count() == 0
    assert books.entries == [[], [], [], []]


def test_hilbert_curve_steps_to_a_neighbour():
    for dims, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.array(np.meshgrid(*[range(1 << bits)] * dims)).reshape(dims, -1).T
        order = np.argsort(vector_codes.hilbert(cells, bits))
        steps = np.abs(np.diff(cells[order].astype(int), axis=0)).sum(1)
        assert sorted(vector_codes.hilbert(cells, bits).tolist()) == list(range(len(cells)))
        assert (steps == 1).all()


def test_shortlists_keep_every_nearest_entry():
    r = np.random.default_rng(4)
    entries = r.integers(-500, 500, (64, 6))
    parts = r.integers(-500, 500, 6) + r.integers(-40, 40, (200, 32, 6))
    listed = vector_codes.shortlists(parts.min(1).astype(float), parts.max(1).astype(float), entries.astype(float))
    for block, allowed in zip(parts, listed):
        d = whole.squared(block, entries)
        assert allowed[(d == d.min(1, keepdims=True)).any(0)].all()
    assert listed.mean() < 0.5


def clustered(rows, spec):
    good = [r for r in kept(rows) if len(r[1]) == spec.length]
    good.sort(key=lambda r: (hashlib.sha256(f"{spec.seed}:{r[0]}".encode()).hexdigest(), r[1]))
    points = [[scaled(v, spec.scale) for v in r[1]] for r in good]
    near, middles = improve(points, points[: spec.centroids], spec.rounds)
    d = [gap(p, middles[k]) for p, k in zip(points, near)]
    total = {k: sum(x for x, m in zip(d, near) if m == k) for k in near}
    return sorted(
        [
            (r[0], k, long(x), long(total[k]), long(sum(d)), hashlib.sha256(",".join(map(str, middles[k])).encode()).hexdigest())
            for r, k, x in zip(good, near, d)
        ],
        key=str,
    )


@pytest.mark.parametrize("big", [False, True])
def test_centroids(spark, big):
    rows = table(2, big=big) + [(950, [1.0] * 7, 0, 1, 1, "", "", 1), (951, [], 0, 1, 1, "", "", 1)]
    for spec in (centroids.Spec(length=8), centroids.Spec(length=8, centroids=400, rounds=1), centroids.Spec(length=8, centroids=1)):
        got, _ = centroids.cluster(spark.createDataFrame(rows, SCHEMA).repartition(4), spec)
        assert sorted([tuple(r) for r in got.collect()], key=str) == clustered(rows, spec)


def test_centroids_of_nothing(spark):
    got, found = centroids.cluster(spark.createDataFrame([], SCHEMA))
    assert found == [] and got.count() == 0
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_ptolemaic_bounds_hold_and_skip():
    r = np.random.default_rng(5)
    middles = r.integers(-60, 60, (16, 64))
    x = middles[r.integers(0, 16, 2000)] + r.integers(-6, 6, (2000, 64))
    pivots = centroids.choose_pivots(middles.tolist(), 5)
    kernel = centroids.Kernel(middles.tolist(), pivots, 64)
    away = centroids.distances(x, whole.as_matrix(pivots, 64))
    exact = whole.squared(x, middles)
    assert (centroids.ptolemaic(away, kernel.to_pivots, kernel.between) <= exact).all()
    near, d = kernel.nearest(x, away)
    assert (near == exact.argmin(1)).all() and (d == exact.min(1)).all()
    assert kernel.compared < len(x) * 16 / 2


def test_limbs():
    for values in ([0, 0], [5, -7], [1 << 200, -(1 << 133) + 1], [-(1 << 24), (1 << 24) - 1]):
        parts = whole.limbs(values)
        assert [sum(p[i] << whole.LIMB * k for k, p in enumerate(parts)) for i in range(2)] == values
