"""Exact top-k search by inner product with paged M-trees and best-first search.

Vectors of integers get one more coordinate, sqrt(M - |x|^2) with M the largest squared
norm, and queries a 0. Then the squared Euclidean distance to a query is |q|^2 + M - 2 q.x,
so the nearest neighbours in this metric are the vectors of highest inner product.

Vectors are dealt to the nearest of a few pivots, and a pivot's vectors to as many trees
as bound the size of one. A tree is built by one task and written as pages: inner pages
with the pivots, covering radii and parent distances of their children, leaf pages with
vectors and their distances to the page's pivot. Queries come in blocks of bounded size;
every (tree, block) is one group. A search opens the page of least possible distance
first, and skips children and vectors by the triangle inequality on stored distances
before computing any; it ends when no open page can hold a better vector than the k-th
best, whose first bound comes from the pivots themselves. Scores are exact integers;
distances only skip, with a slack for rounding.

Trees hold the vectors whose squared norm is exact in a double. Longer ones, as queries or
as candidates, are compared pair by pair in blocks: doubles with a bound on their error
leave the few pairs that can be among the best k, and whole numbers of any size settle these.

Defined results: vectors that are NULL, or hold a NULL or non-finite component, and rows
without an id take no part. All others do; a score that no long can hold is ranked by its
exact value and given as NULL, or as decimal text with ``text_scores``. Rows repeated with the same id and vector count once; other
vectors of the query's own id are no candidates; vectors of several lengths are searched
apart; fewer candidates than k give fewer results; ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortfit.session import materialize

SCALE = 1024
#: Squared norms up to this are exact in trees, with room for the sum of two.
LIMIT = float(1 << 52)
#: Pivots that vectors are dealt by, vectors per tree, entries per page, queries per block.
PIVOTS, TREE, PAGE, FANOUT, BLOCK = 16, 8_192, 128, 12, 512
#: Candidates that one task compares pair by pair with a block of queries.
PART = 4_096


def scaled(vector: Column, scale: int = SCALE) -> tuple[Column, Column]:
    """Integers floor(scale * x) for trees, and the numbers of a vector too long for them.

    One of them is NULL, or both for a vector that takes no part.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    numbers = F.transform(vector, lambda x: x.cast("double"))
    fits = F.aggregate(F.transform(numbers, lambda x: _floor(x * scale)), F.lit(0.0), lambda s, v: s + v * v) <= LIMIT
    taken = vector.isNotNull() & ~F.exists(numbers, bad)
    whole = F.transform(numbers, lambda x: F.floor(x * scale).cast("int"))
    return F.when(taken & fits, whole), F.when(taken & ~fits, numbers)


def _floor(x: Column) -> Column:
    """The floor as a double; doubles from 2^53 on are whole."""
    return F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), dims)


def lifted(x: np.ndarray, most: float) -> np.ndarray:
    """Points with the additional coordinate."""
    height = np.sqrt(np.maximum(most - (x * x).sum(axis=1), 0)).astype(float)
    return np.column_stack([x.astype(float), height])


def _away(points: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - p) ** 2).sum(axis=1))


@dataclass
class Page:
    """A node: its pivot and covering radius, and either children or vectors."""

    pivot: np.ndarray
    radius: float
    children: list[int]
    parent: float = 0.0
    ids: np.ndarray | None = None
    vectors: np.ndarray | None = None
    distances: np.ndarray | None = None


def build(ids: np.ndarray, x: np.ndarray, most: float) -> list[Page]:
    """The pages of a tree, the root last."""
    points = lifted(x, most)
    pages: list[Page] = []

    def add(rows: np.ndarray, pivot: np.ndarray) -> int:
        away = _away(points[rows], pivot)
        radius = float(away.max()) if len(rows) else 0.0
        if len(rows) <= PAGE:
            pages.append(Page(pivot, radius, [], ids=ids[rows], vectors=x[rows], distances=away))
            return len(pages) - 1
        chosen, least = [int(np.argmax(away))], np.full(len(rows), np.inf)
        near = np.zeros(len(rows), np.int64)
        for k in range(FANOUT):  # each pivot is the point farthest from those before it
            d = _away(points[rows], points[rows[chosen[-1]]])
            near = np.where(d < least, k, near)
            least = np.minimum(d, least)
            if least.max() == 0:
                break
            if k + 1 < FANOUT:
                chosen.append(int(np.argmax(least)))
        if len(chosen) == 1:  # all equal: by order
            near = np.arange(len(rows)) // PAGE
        children = []
        for k in np.unique(near).tolist():
            part = rows[near == k]
            middle = points[rows[chosen[k]]] if k < len(chosen) else points[part[0]]
            child = add(part, middle)
            pages[child].parent = float(np.sqrt(((middle - pivot) ** 2).sum()))
            children.append(child)
        pages.append(Page(pivot, radius, children))
        return len(pages) - 1

    rows = np.arange(len(ids))
    add(rows, points.mean(axis=0) if len(rows) else np.zeros(x.shape[1] + 1))
    return pages


class Tree:
    """Pages ready for search: children's values as arrays."""

    def __init__(self, pages: list[Page], most: float):
        self.pages, self.most = pages, most
        self.kids = [
            (
                np.array(p.children, np.int64),
                np.array([pages[c].parent for c in p.children]),
                np.array([pages[c].radius for c in p.children]),
                np.array([pages[c].pivot for c in p.children]),
            )
            for p in pages
        ]
        self.computed = 0

    def search(self, own: int, q: np.ndarray, k: int, bound: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best k other than ``own``; none need be below ``bound``."""
        point = np.append(q.astype(float), 0.0)
        square = float((q * q).sum()) + self.most
        best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)

        def reach() -> float:
            """The distance beyond which nothing is wanted."""
            score = bound if len(best) < k else int(best[-1]) if bound is None else max(bound, int(best[-1]))
            if score is None:
                return np.inf
            return float(np.sqrt(max(square - 2 * score, 0.0))) * (1 + 1e-9) + 1e-6

        limit, root = reach(), len(self.pages) - 1
        away = float(np.sqrt(((self.pages[root].pivot - point) ** 2).sum()))
        heap = [(max(0.0, away - self.pages[root].radius), root, away)]
        while heap:
            least, number, away = heapq.heappop(heap)
            if least > limit:
                break
            page = self.pages[number]
            if page.ids is None:
                child, parent, radius, pivots = self.kids[number]
                open_ = np.abs(away - parent) - radius <= limit
                d = np.sqrt(((pivots[open_] - point) ** 2).sum(axis=1))
                self.computed += len(d)
                low = np.maximum(d - radius[open_], 0)
                for c, bottom, distance in zip(child[open_].tolist(), low.tolist(), d.tolist()):
                    if bottom <= limit:
                        heapq.heappush(heap, (bottom, c, distance))
                continue
            wanted = (np.abs(away - page.distances) <= limit) & (page.ids != own)
            scores = page.vectors[wanted] @ q
            self.computed += len(scores)
            all_ids, all_scores = np.append(best_ids, page.ids[wanted]), np.append(best, scores)
            order = np.lexsort((all_ids, -all_scores))[:k]
            best_ids, best = all_ids[order], all_scores[order]
            limit = reach()
        return best_ids, best


PAGE_SCHEMA = (
    "dims int, tree int, page int, children array<int>, parent double, radius double, pivot array<double>, "
    "ids array<long>, vectors binary, distances array<double>"
)


def build_trees(vectors: DataFrame) -> tuple[DataFrame, dict[int, float], dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Writes the pages of all trees over ``vec_id, x, dims``.

    Returns them, the largest squared norm per vector length and its pivots with their ids.
    """
    norm = F.aggregate("x", F.lit(0).cast("bigint"), lambda s, v: s + v.cast("bigint") * v.cast("bigint"))
    most = {r["dims"]: float(r["m"] or 0) for r in vectors.groupBy("dims").agg(F.max(norm).alias("m")).collect()}
    # One pivot per id: copies of a row must not count twice in the bound that pivots give.
    place = F.row_number().over(Window.partitionBy("dims").orderBy(F.xxhash64("vec_id"), "vec_id"))
    named = vectors.select("dims", "vec_id").distinct().withColumn("place", place).where(F.col("place") <= PIVOTS)
    picked = vectors.select("dims", "vec_id", "x").join(F.broadcast(named), ["dims", "vec_id"])
    picked = picked.groupBy("dims", "vec_id", "place").agg(F.min("x").alias("x")).collect()  # PIVOTS per length
    pivots = {}
    for dims in most:
        own = sorted((r for r in picked if r["dims"] == dims), key=lambda r: r["place"])
        pivots[dims] = np.array([r["vec_id"] for r in own]), np.array([r["x"] for r in own], np.int64).reshape(len(own), dims)

    def dealt(batches):
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            near = np.zeros(len(dims), np.int32)
            for d in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == d)
                x = lifted(_matrix(batch.column("x").take(pa.array(rows)), d), most[d])
                p = lifted(pivots[d][1], most[d])
                near[rows] = np.argmin((p * p).sum(axis=1)[None, :] - 2 * (x @ p.T), axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near)], [*batch.schema.names, "near"])

    near = vectors.select("vec_id", "x", "dims").mapInArrow(dealt, "vec_id long, x array<int>, dims int, near int")
    near = materialize(near, "mtree-near")
    first, trees = {}, 0
    sizes = near.groupBy("dims", "near").agg(F.count("*").alias("n")).orderBy("dims", "near").collect()
    number, parts = F.lit(0), F.lit(1)
    for r in sizes:  # at most PIVOTS rows per vector length
        n = -(-r["n"] // TREE)
        first[r["dims"], r["near"]] = trees
        own = (F.col("dims") == r["dims"]) & (F.col("near") == r["near"])
        number, parts = F.when(own, trees).otherwise(number), F.when(own, n).otherwise(parts)
        trees += n
    tree = (number + F.pmod(F.xxhash64("vec_id"), parts)).cast("int")

    def pages_of(table: pa.Table) -> pa.Table:
        dims, number = table.column("dims")[0].as_py(), table.column("tree")[0].as_py()
        x, ids = _matrix(table.column("x"), dims), table.column("vec_id").to_numpy()
        rows = np.unique(np.column_stack([ids, x]), axis=0)  # repeated rows count once
        pages = build(rows[:, 0], rows[:, 1:], most[dims])
        return pa.table(
            {
                "dims": pa.array([dims] * len(pages), pa.int32()),
                "tree": pa.array([number] * len(pages), pa.int32()),
                "page": pa.array(range(len(pages)), pa.int32()),
                "children": pa.array([p.children for p in pages], pa.list_(pa.int32())),
                "parent": [p.parent for p in pages],
                "radius": [p.radius for p in pages],
                "pivot": pa.array([p.pivot.tolist() for p in pages], pa.list_(pa.float64())),
                "ids": pa.array([None if p.ids is None else p.ids.tolist() for p in pages], pa.list_(pa.int64())),
                "vectors": pa.array(
                    [None if p.ids is None else p.vectors.astype("<i4").tobytes() for p in pages], pa.binary()
                ),
                "distances": pa.array(
                    [None if p.ids is None else p.distances.tolist() for p in pages], pa.list_(pa.float64())
                ),
            }
        )

    built = near.withColumn("tree", tree).groupBy("dims", "tree").applyInArrow(pages_of, PAGE_SCHEMA)
    return materialize(built, "mtree-pages"), most, pivots


def _load(table: pa.Table, most: float) -> Tree:
    pages = []
    for r in table.sort_by("page").to_pylist():
        page = Page(np.array(r["pivot"]), r["radius"], r["children"], r["parent"])
        if r["ids"] is not None:
            page.ids, page.distances = np.array(r["ids"], np.int64), np.array(r["distances"])
            page.vectors = np.frombuffer(r["vectors"], "<i4").astype(np.int64).reshape(len(page.ids), -1)
        pages.append(page)
    return Tree(pages, most)


class Wide:
    """Unique (id, vector) pairs of whole numbers of any size."""

    def __init__(self, table: pa.Table, id_col: str, dims: int, scale: int):
        x = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        raw = table.column("raw").to_numpy().astype(bool)[:, None]
        with np.errstate(over="ignore"):
            whole = np.where(raw, np.floor(x * scale), x) + 0.0
        over = ~np.isfinite(whole)  # the product has no double: kept apart from its factor
        values = np.where(over, x, whole)
        ids = table.column(id_col).to_pylist()
        first = {(i, v.tobytes(), o.tobytes()): n for n, (i, v, o) in enumerate(zip(ids, values, over))}
        rows = np.array(list(first.values()), np.int64)
        self.ids, self.values, self.over, self.scale = np.array(ids, np.int64)[rows], values[rows], over[rows], scale
        # near * 2^exponent is the vector, to a few units in the last place.
        places = np.frexp(self.values)[1] + np.where(self.over, scale.bit_length(), 0)
        self.exponent = np.where(self.values != 0, places, -2000).max(axis=1)
        self.near = np.ldexp(self.values, -self.exponent[:, None]) * np.where(self.over, float(scale), 1.0)

    def numbers(self, row: int) -> list[int]:
        pairs = zip(self.values[row].tolist(), self.over[row].tolist())
        return [int(v) * self.scale if o else int(v) for v, o in pairs]


def _compare(queries: Wide, rows: Wide, k: int):
    """For every query its id and the best k of ``rows`` as (id, exact score)."""
    known: dict[int, list[int]] = {}
    same: dict[tuple[bytes, bytes], int] = {}  # equal vectors of several ids are scored once
    alike = [same.setdefault((v.tobytes(), o.tobytes()), n) for n, (v, o) in enumerate(zip(rows.values, rows.over))]
    power = rows.exponent - rows.exponent.max()
    room = 4 * (rows.near.shape[1] + 4) * np.finfo(float).eps
    size = np.abs(rows.near)
    for n, own in enumerate(queries.ids.tolist()):
        others = np.flatnonzero(rows.ids != own)
        if not len(others):
            continue
        q = queries.near[n]
        score = np.ldexp(rows.near @ q, power)[others]
        slack = np.ldexp(size @ np.abs(q), power)[others] * room + 1e-290  # the latter for underflow
        if len(others) > k:
            least = np.partition(score - slack, len(others) - k)[len(others) - k]
            others = others[score + slack >= least]
        asked, scores = queries.numbers(n), {}
        found = []
        for row in others.tolist():
            at = alike[row]
            if at not in scores:
                if at not in known:
                    known[at] = rows.numbers(at)
                scores[at] = sum(a * b for a, b in zip(asked, known[at]))
            found.append((-scores[at], int(rows.ids[row])))
        yield own, [(i, -s) for s, i in heapq.nsmallest(k, found)]


def compared(queries: DataFrame, rows: DataFrame, k: int, scale: int) -> DataFrame:
    """``query_id, vec_id, score`` (decimal text): the best k of every part of ``rows``, exactly.

    Both hold an id, ``dims``, the numbers ``v`` and whether these are yet to be scaled (``raw``).
    """
    queries = materialize(queries, "mtree-compared")  # both come of one table, which cogroups cannot tell apart
    blocks, parts = max(1, -(-queries.count() // BLOCK)), max(1, -(-rows.count() // PART))
    block, part = F.pmod(F.xxhash64("query_id"), F.lit(blocks)), F.pmod(F.xxhash64("vec_id"), F.lit(parts))
    left = rows.withColumn("part", part.cast("int")).select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = queries.withColumn("block", block.cast("int")).select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))

    def pairs(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            dims = left.column("dims")[0].as_py()
            for own, best in _compare(Wide(right, "query_id", dims, scale), Wide(left, "vec_id", dims, scale), k):
                out["query_id"] += [own] * len(best)
                out["vec_id"] += [i for i, _ in best]
                out["score"] += [str(s) for _, s in best]
        return pa.table({c: pa.array(v, pa.string() if c == "score" else pa.int64()) for c, v in out.items()})

    keys = ["dims", "part", "block"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys))
    return met.applyInArrow(pairs, "query_id long, vec_id long, score string")


def _in_order(score: Column) -> Column:
    """Text in the order of the whole numbers that ``score`` holds as decimal text."""
    negative, digits = score.startswith("-"), F.regexp_replace(score, "^-", "")
    length = F.length(digits)
    below = F.concat(F.lit("0"), F.lpad((99_999 - length).cast("string"), 5, "0"), F.translate(digits, "0123456789", "9876543210"))
    return F.when(negative, below).otherwise(F.concat(F.lit("1"), F.lpad(length.cast("string"), 5, "0"), digits))


def top_k(
    rows: DataFrame,
    queries: Column,
    k: int = 10,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    text_scores: bool = False,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for rows where ``queries`` holds, the best k of all rows."""
    whole, wide = scaled(F.col(vector_col), scale)
    every = rows.select(
        F.col(id_col).cast("long").alias("vec_id"),
        whole.alias("x"),
        wide.alias("wide"),
        F.coalesce(queries, F.lit(False)).alias("is_query"),
    )
    every = every.where("vec_id is not null and (x is not null or wide is not null)")
    every = materialize(every.withColumn("dims", F.size(F.coalesce(F.col("x").cast("array<double>"), "wide"))), "mtree-vectors")
    vectors = every.where("x is not null").drop("wide")
    pages, most, pivots = build_trees(vectors)
    asked = vectors.where("is_query").select(F.col("vec_id").alias("query_id"), "x", "dims").distinct()
    asked = materialize(asked, "mtree-queries")
    blocks = max(1, -(-asked.count() // BLOCK))
    trees = pages.groupBy("dims").agg(F.sort_array(F.collect_set("tree")).alias("trees"))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block")
    # The set of tree numbers is one per TREE vectors, so it grows slowly; it meets blocks, not queries.
    blocked = asked.select("query_id", "x", "dims", block)
    numbers = blocked.select("dims", "block").distinct().join(trees, "dims").select("dims", "block", F.explode("trees").alias("tree"))
    queries_by_tree = blocked.join(numbers, ["dims", "block"])
    pages_by_block = pages.select("*", every_block)

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            dims = right.column("dims")[0].as_py()
            tree = _load(left, most[dims])
            pivot_ids, pivot_vectors = pivots[dims]
            asked_ids, q = right.column("query_id").to_numpy(), _matrix(right.column("x"), dims)
            first = q @ pivot_vectors.T
            for row, own in enumerate(asked_ids.tolist()):
                others = np.sort(first[row][pivot_ids != own])[::-1]
                bound = int(others[k - 1]) if len(others) >= k else None
                ids, scores = tree.search(own, q[row], k, bound)
                out["query_id"] += [own] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += scores.tolist()
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    keys = ["dims", "tree", "block"]
    found = pages_by_block.groupBy(*keys).cogroup(queries_by_tree.groupBy(*keys))
    found = found.applyInArrow(searched, "query_id long, vec_id long, score long")
    order = F.col("score")
    if not every.where("wide is not null").isEmpty():
        raw = F.col("wide").isNotNull()
        numbers = F.coalesce(F.col("wide"), F.col("x").cast("array<double>"))
        all_rows = every.select("vec_id", "dims", numbers.alias("v"), raw.alias("raw"), "is_query")
        long_rows = all_rows.where("raw").drop("is_query")
        all_asked = all_rows.where("is_query").select(F.col("vec_id").alias("query_id"), "dims", "v", "raw")
        found = found.withColumn("score", F.col("score").cast("string"))
        found = found.unionByName(compared(all_asked, long_rows, k, scale))
        others = all_rows.where("not raw").drop("is_query")
        found = found.unionByName(compared(all_asked.where("raw"), others, k, scale))
        order = _in_order(F.col("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(order.desc(), "vec_id"))
    score = F.col("score").cast("string") if text_scores else F.col("score").try_cast("bigint")
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", score.alias("score"))
