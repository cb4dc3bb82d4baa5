"""A range of the suffix array is walked in pieces: bounded memory, and every stretch wherever the pieces are cut."""

import collections
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from cohortfit.llm import suffixes
from tests.llm.data import words
from tests.llm.test_operators import repeated_windows, split


class Task:
    """Stands for a frame; gives the function that its tasks run."""

    def mapInArrow(self, function, schema):
        return function


def batches(h, right, left, tag, place, size):
    side = lambda x: pa.array([row.tobytes() for row in x], pa.binary())
    columns = [pa.array(h), side(right), side(left), pa.array(tag), pa.array(place, pa.int32())]
    whole = pa.RecordBatch.from_arrays(columns, ["h", "right", "left", "tag", "place"])
    return [whole.slice(k, size) for k in range(0, len(h), size)]


@pytest.mark.parametrize("beginnings", [60_000, 1])
def test_memory_does_not_grow_with_the_range(beginnings):
    n, r = 120_000, np.random.default_rng(3)
    h = np.sort(np.resize(r.integers(-(2**62), 2**62, beginnings), n))
    right = left = np.ones((n, suffixes.SIDE), np.uint32)
    rows = batches(h, right, left, np.arange(n), np.full(n, 40), 10_000)
    task = suffixes._matched(Task())
    tracemalloc.start()
    found = sum(b.num_rows for b in task(iter(rows)) if b.column(3).null_count)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == n
    assert peak < 60 << 20


def awkward(n):
    """Sorted suffixes of few beginnings, with contexts that part late, early or end."""
    r = random.Random(7)
    rows = []
    for _ in range(n):
        sides = []
        for _ in range(2):
            side = np.ones(suffixes.SIDE, np.uint32)
            if r.random() < 0.7:
                side[r.randrange(suffixes.SIDE)] = r.randrange(2, 5)
            if r.random() < 0.4:
                side[r.randrange(suffixes.SIDE) :] = 0
            sides.append(side)
        rows.append((r.choice([-5, 3, 3, 3, 9]), sides[0].tobytes(), sides[1].tobytes(), r.randrange(60), r.randrange(100, 300)))
    h, right, left, tag, place = zip(*sorted(rows))
    return np.array(h), suffixes._side(right), suffixes._side(left), np.array(tag), np.array(place)


def starts_of_stretches(ranges, size):
    """What tasks over the ranges and the join across find, as the texts and starts of stretches."""
    task, found, edges, several = suffixes._matched(Task(), size), set(), [], collections.defaultdict(set)
    for rows in ranges:
        for tag, start, finish, key, low, high in (x.values() for b in task(iter(rows)) for x in b.to_pylist()):
            if key is None:
                found |= {(tag, k) for k in range(start, finish - suffixes.LEAST + 1)}
            else:
                several[key] |= {low, high}
                edges.append((tag, start, key))
    return found | {(tag, start) for tag, start, key in edges if tag is not None and len(several[key]) > 1}


@pytest.mark.parametrize("size", [1, 7, 100])
def test_cuts_lose_and_add_no_stretch(size):
    columns = awkward(600)
    want = starts_of_stretches([batches(*columns, 600)], 1000)
    assert len({tag for tag, _ in want}) > 30
    for cut in (250, 601):
        ranges = [batches(*[c[k : k + cut] for c in columns], 90) for k in range(0, 600, cut)]
        assert starts_of_stretches(ranges, size) == want


def test_pieces_are_bounded_and_whole():
    n = 5000
    h = np.sort(np.random.default_rng(4).zipf(1.3, n) % 50)
    side = np.zeros((n, suffixes.SIDE), np.uint32)
    for batch in (1, 64, n):
        held, inside = [], True
        for table, before, after in suffixes._pieces(iter(batches(h, side, side, np.arange(n), h, batch)), 100):
            assert 0 < table.num_rows < 300
            assert before == inside
            inside = after
            held += table.column("tag").to_pylist()
        assert held == list(range(n))


@pytest.mark.parametrize("size, ranges", [(3, 2), (40, 9)])
def test_passages_over_pieces(spark, monkeypatch, size, ranges):
    passage, r = words(21, 90).split(), random.Random(22)
    texts = {}
    for k in range(60):
        a = r.randrange(40)
        part = passage[a : a + r.randrange(30, 62)]
        texts[k] = f"{words(3000 + k, r.randrange(60))} {' '.join(part)} {words(4000 + k, r.randrange(60))}"
    for name, value in (("PIECE", size), ("RANGE", 1), ("RANGES", ranges)):
        monkeypatch.setattr(suffixes, name, value)
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = suffixes.repeated_passages(table).collect()
    assert {x.doc_id: [tuple(s) for s in x.spans] for x in found} == repeated_windows({k: split(t) for k, t in texts.items()})
