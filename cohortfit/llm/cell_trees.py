"""Boosted trees on rows described by a few small integers.

Equal descriptions are counted in Spark first, so a fit sees one cell per description: the
product of the features' codes bounds their number, whatever the number of rows. Trees are
applied as CASE expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Leaf values are shrunk by this, sums of curvature enlarged by RIDGE.
RATE, RIDGE, LEAST_GAIN, MOST = 0.4, 1.0, 1e-3, 30.0


@dataclass(frozen=True)
class Cell:
    """Rows of one description: how many there are, and how many are positive; weights will do."""

    codes: tuple[int, ...]
    n: float
    positive: float


@dataclass
class Tree:
    """A split ``codes[feature] <= cut`` with two branches, or a leaf."""

    value: float = 0.0
    feature: int = 0
    cut: int = 0
    low: Tree | None = None
    high: Tree | None = None

    def at(self, codes: tuple[int, ...]) -> float:
        node = self
        while node.low is not None:
            node = node.low if codes[node.feature] <= node.cut else node.high
        return node.value

    def column(self, code: Callable[[int], Column]) -> Column:
        if self.low is None:
            return F.lit(self.value)
        return F.when(code(self.feature) <= self.cut, self.low.column(code)).otherwise(self.high.column(code))


def _share(margin: float) -> float:
    return 1 / (1 + exp(-max(-MOST, min(MOST, margin))))


@dataclass
class Boosted:
    base: float
    trees: list[Tree]

    def score(self, codes: tuple[int, ...]) -> float:
        return _share(self.base + sum(t.at(codes) for t in self.trees))

    def column(self, code: Callable[[int], Column]) -> Column:
        """The score as an expression; ``code`` gives the column of a feature."""
        margin = F.lit(self.base)
        for tree in self.trees:
            margin = margin + tree.column(code)
        return 1 / (1 + F.exp(-F.greatest(F.lit(-MOST), F.least(F.lit(MOST), margin))))


def _grow(rows: list[tuple[tuple[int, ...], float, float]], sizes: list[int], depth: int) -> Tree:
    """``rows``: codes, gradient and curvature; second-order gain, ties to the first split."""
    g, h = sum(x[1] for x in rows), sum(x[2] for x in rows)
    best, found = LEAST_GAIN, None
    for feature, codes in enumerate(sizes) if depth else ():
        sums = [[0.0, 0.0] for _ in range(codes)]
        for row, dg, dh in rows:
            held = sums[row[feature]]
            held[0] += dg
            held[1] += dh
        lg = lh = 0.0
        for cut in range(codes - 1):
            lg, lh = lg + sums[cut][0], lh + sums[cut][1]
            gain = lg**2 / (lh + RIDGE) + (g - lg) ** 2 / (h - lh + RIDGE) - g**2 / (h + RIDGE)
            if gain > best:
                best, found = gain, (feature, cut)
    if found is None:
        return Tree(value=g / (h + RIDGE) * RATE)
    feature, cut = found
    low, high = [x for x in rows if x[0][feature] <= cut], [x for x in rows if x[0][feature] > cut]
    return Tree(0.0, feature, cut, _grow(low, sizes, depth - 1), _grow(high, sizes, depth - 1))


def merged(cells: Iterable[Cell]) -> list[Cell]:
    """One cell per description, in their order."""
    sums: dict[tuple[int, ...], list[float]] = {}
    for c in cells:
        held = sums.setdefault(c.codes, [0, 0])
        held[0] += c.n
        held[1] += c.positive
    return [Cell(codes, n, p) for codes, (n, p) in sorted(sums.items())]


def boost(cells: list[Cell], sizes: list[int], rounds: int = 20, depth: int = 3) -> Boosted:
    """Trees by logistic loss; ``sizes`` are the numbers of codes of the features."""
    n, p = sum(c.n for c in cells), sum(c.positive for c in cells)
    model = Boosted(log((p + 0.5) / (n - p + 0.5)), [])
    if p in (0, n):
        return model
    margins = [model.base] * len(cells)
    for _ in range(rounds):
        rows = []
        for c, margin in zip(cells, margins):
            q = _share(margin)
            rows.append((c.codes, c.positive - c.n * q, c.n * q * (1 - q)))
        tree = _grow(rows, sizes, depth)
        model.trees.append(tree)
        margins = [m + tree.at(c.codes) for m, c in zip(margins, cells)]
    return model


def out_of_fold(folds: dict[int, list[Cell]], sizes: list[int], **fit: int) -> list[tuple[float, Cell]]:
    """Every cell with the score of the trees that were fitted on the other folds."""
    scored = []
    for fold, cells in sorted(folds.items()):
        others = merged(c for other, held in folds.items() if other != fold for c in held)
        model = boost(others, sizes, **fit)
        scored += [(model.score(c.codes), c) for c in cells]
    return scored


def threshold(scored: list[tuple[float, Cell]], precision: float, never: float = 2.0) -> float:
    """The score from which up F1 is best, among those where the precision holds; ``never`` if there is none.

    It lies halfway between the last cell taken and the first one left, as fits on other rows
    move scores a little. Ties take fewer cells.
    """
    n = p = 0
    cut, best, rows = never, 0.0, sorted(scored, key=lambda x: -x[0])
    positive = sum(c.positive for _, c in rows)
    for k, (score, c) in enumerate(rows):
        n, p = n + c.n, p + c.positive
        last = k + 1 == len(rows) or rows[k + 1][0] < score
        f1 = 2 * p / (n + positive)
        if last and p / (n + 1) >= precision and f1 > best + 1e-9:
            cut, best = score if k + 1 == len(rows) else (score + rows[k + 1][0]) / 2, f1
    return cut
