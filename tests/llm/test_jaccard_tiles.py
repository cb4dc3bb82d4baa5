"""Large keys whose members are nearly all apart."""

import numpy as np

from cohortfit.llm import jaccard
from cohortfit.llm.words import U
from tests.llm.data import words
from tests.llm.test_operators import near


def apart(n):
    """Texts around one passage that are just below the threshold, a few of them copied with a change."""
    passage = words(50, 100)
    texts = {k: f"{words(100 + k, 9)} {passage} {words(900 + k, 9)}" for k in range(n)}
    for k in range(0, n, 10):
        w = texts[k].split()
        w[-1 - k % 3] = f"changed{k}"
        texts[n + k] = " ".join(w)
    return texts


def test_members_that_are_apart(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL_GROUP", 3)
    texts = apart(90)
    for tile in (4096, 16):
        monkeypatch.setattr(jaccard, "TILE", tile)
        table = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(table).collect()}
        assert got == near(texts)
    assert sum(k != c for k, (_, c) in got.items()) == 9


def test_forest_is_linear():
    r = np.random.default_rng(1)
    base = r.integers(1, 2**63, 120, dtype=np.uint64)
    near_misses = [np.unique(np.append(base[:96], r.integers(1, 2**63, 18, dtype=np.uint64))) for _ in range(60)]
    family = [np.unique(np.append(base[:110], r.integers(1, 2**63, 4, dtype=np.uint64))) for _ in range(60)]
    sets, label = near_misses + family, np.arange(120)
    links = jaccard.forest(sets, label, label > 0)
    expected = {(a, b) for a in range(120) for b in range(a) if jaccard.linked(sets[a], sets[b])}
    assert all((max(p), min(p)) in expected for p in links)
    assert len(links) <= len(sets) - 1

    def groups(pairs):
        parent = list(range(120))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
        return [find(k) for k in range(120)]

    assert groups(links) == groups(expected)
    assert jaccard.forest(sets, np.zeros(120, np.int64), label > 0) == []
    assert jaccard.forest([np.array([5], U), np.array([5], U)], np.array([0, 1]), np.array([True, False])) == [(0, 1)]
