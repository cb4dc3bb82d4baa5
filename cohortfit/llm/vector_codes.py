"""Vector codes: every part of a vector is replaced by the number of its nearest codebook entry.

Components become whole numbers, vectors are cut into equal consecutive parts, and every
part position has a codebook that a few rounds of assigning and averaging improve. All
distances, sums and averages are whole numbers, so results depend on no order.

The parts of one position are sorted along a Hilbert curve and written as flat blocks of
``BLOCK`` parts, each with the box of its least and greatest components and their sums. A
round compares boxes with entries first: no part of a block is farther from an entry than
the far corner of its box and none is nearer than the near one, so an entry whose near
distance exceeds the least far distance of all entries can be nearest for no part. The
entries left are the block's shortlist. With one entry on it the block's sums go to that
entry and its parts are not looked at; otherwise a kernel on whole numbers compares the
block's parts with the shortlist only. Tasks return sums per entry; a round brings entries
times parts rows to the driver, however many vectors there are.

The curve takes as many dimensions as fit 64 bits, those of the greatest spread first. It
only decides which parts share a block. Ties on the curve are spread by a hash, so equal
vectors fill many ranges.

Defined results: vectors that are NULL or hold a NULL or non-finite component, and rows
without an id, take no part; every other row counts, repeated ones too. The parts of a
vector whose length cannot be cut evenly, or is shorter than that of others, are filled up
with zeros; an empty vector has only zeros. Equal ids are ordered by their vectors. Fewer
vectors than entries give as many entries. Components of any size take part; an error that
no long can hold is NULL, and so is a sum of errors that contains one. Equal distances go
to the lower entry; an entry that nothing is assigned to stays. An empty table gives none.
Only the three columns named are read, so names of others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortfit.llm import whole
from cohortfit.llm.batches import materialize
from cohortfit.operators.groups import attach

#: Parts per block, and bytes of blocks that one sorted range holds.
BLOCK, RANGE_BYTES = 64, 32 << 20
#: Box corners compared with entries at a time, as numbers held in memory.
CORNERS = 2_000_000
#: Bits of the key on the curve, and dimensions it takes at most.
KEY_BITS, KEY_DIMS = 64, 16


@dataclass(frozen=True)
class Spec:
    scale: int = 1024
    parts: int = 4
    entries: int = 256
    rounds: int = 4


@dataclass(frozen=True)
class Codebooks:
    """``entries[p]`` is the codebook of part position ``p``; all entries have ``width`` components."""

    width: int
    entries: list[list[list[int]]]

    def sha256(self) -> str:
        """Of all components by part, entry and position, comma-joined."""
        numbers = ",".join(str(v) for book in self.entries for entry in book for v in entry)
        return hashlib.sha256(numbers.encode()).hexdigest()


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve through a cube of 2^bits cells a side (Skilling 2004).

    ``points``: one row of whole numbers below 2^bits each; bits times columns is at most 64.
    """
    x = points.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):  # undo the turns and reflections of each level
        q, low = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] & np.uint64(1 << b)) != 0, np.uint64((1 << b) - 1), np.uint64(0))
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return key


@dataclass(frozen=True)
class Curve:
    """Dimensions of one part position that the curve takes, and the range each is cut into."""

    dims: np.ndarray
    low: np.ndarray
    step: np.ndarray
    bits: int

    @classmethod
    def through(cls, mean: np.ndarray, spread: np.ndarray) -> Curve:
        dims = np.argsort(-spread, kind="stable")[:KEY_DIMS]
        dims = dims[spread[dims] > 0] if (spread > 0).any() else dims[:1]
        bits = min(16, KEY_BITS // max(1, len(dims)))
        low = mean[dims] - 2 * spread[dims]
        return cls(dims, low, np.maximum(4 * spread[dims], 1e-9) / (1 << bits), bits)

    def keys(self, numbers: np.ndarray) -> np.ndarray:
        """Signed keys in the order of the curve."""
        if not len(self.dims):
            return np.zeros(len(numbers), np.int64)
        cells = np.clip((numbers[:, self.dims] - self.low) / self.step, 0, (1 << self.bits) - 1)
        return (hilbert(cells.astype(np.uint64), self.bits) ^ np.uint64(1 << 63)).view(np.int64)


def cut(lists: pa.Array, parts: int, width: int) -> np.ndarray:
    """Vectors as an array (vectors, parts, width) of doubles, parts filled up with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    numbers = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
    if (sizes == parts * width).all():
        return numbers.reshape(len(sizes), parts, width)
    out = np.zeros((len(sizes), parts, width))
    ends = np.cumsum(sizes)
    for k, (size, end) in enumerate(zip(sizes.tolist(), ends.tolist())):
        each = -(-size // parts)
        for p in range(parts):
            values = numbers[end - size + p * each : min(end, end - size + (p + 1) * each)]
            out[k, p, : len(values)] = values
    return out


def _spreads(vectors: DataFrame, parts: int, width: int) -> list[Curve]:
    """One curve per part position; sums of all small vectors, added up per component."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q = 0, np.zeros(parts * width), np.zeros(parts * width)
        for batch in batches:
            x = cut(batch["x"], parts, width).reshape(batch.num_rows, -1)
            n, s, q = n + len(x), s + x.sum(0), q + (x * x).sum(0)
        at = np.arange(parts * width, dtype=np.int32)
        yield pa.RecordBatch.from_pydict({"at": at, "n": np.full(len(at), n), "s": s, "q": q})

    sums = vectors.where("not wide").select("x").mapInArrow(task, "at int, n long, s double, q double")
    rows = sums.groupBy("at").agg(*[F.sum(c).alias(c) for c in "nsq"]).orderBy("at").collect()
    n = max(1, rows[0]["n"]) if rows else 1
    mean = np.array([r["s"] / n for r in rows] or [0.0] * (parts * width))
    square = np.array([r["q"] / n for r in rows] or [0.0] * (parts * width))
    spread = np.sqrt(np.maximum(square - mean * mean, 0))
    each = lambda a, p: a[p * width : (p + 1) * width]
    return [Curve.through(each(mean, p), each(spread, p)) for p in range(parts)]


BLOCKS = "part int, wide boolean, rows array<long>, small array<int>, far array<double>, low array<int>, high array<int>, total array<long>"


def _blocks(vectors: DataFrame, count: int, curves: list[Curve], spec: Spec, width: int) -> DataFrame:
    """Flat blocks of parts, sorted along the curve of their position."""
    parts, scale = spec.parts, spec.scale

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = cut(batch["x"], parts, width)
            for p in range(parts):
                values = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * width, x[:, p].ravel())
                keys = curves[p].keys(x[:, p])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), p, np.int32)), batch["wide"], pa.array(keys), batch["row"], values],
                    ["part", "wide", "key", "row", "x"],
                )

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("part", pa.int32()), ("wide", pa.bool_()), ("rows", pa.list_(pa.int64())), ("small", pa.list_(pa.int32())),
             ("far", pa.list_(pa.float64())), ("low", pa.list_(pa.int32())), ("high", pa.list_(pa.int32())),
             ("total", pa.list_(pa.int64()))]
        )
        for batch in batches:
            if not batch.num_rows:
                continue
            position = batch["part"].to_numpy()
            wide = batch["wide"].to_numpy(zero_copy_only=False)
            row = batch["row"].to_numpy()
            x = cut(batch["x"], 1, width)[:, 0]
            edges = np.flatnonzero((np.diff(position) != 0) | (np.diff(wide.astype(np.int8)) != 0)) + 1
            out = []
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(x)]):
                for k in range(a, b, BLOCK):
                    end = min(b, k + BLOCK)
                    block = {"part": int(position[k]), "wide": bool(wide[k]), "rows": row[k:end]}
                    if wide[k]:
                        block["far"] = x[k:end].ravel()
                    else:
                        whole_x = np.floor(x[k:end] * scale).astype(np.int64)
                        block |= {
                            "small": whole_x.astype(np.int32).ravel(), "low": whole_x.min(0).astype(np.int32),
                            "high": whole_x.max(0).astype(np.int32), "total": whole_x.sum(0),
                        }
                    out.append(block)
            yield pa.RecordBatch.from_pylist(out, schema)

    spark = vectors.sparkSession
    ranges = -(-count * parts * (8 * width + 40) // RANGE_BYTES)
    ranges = max(ranges, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = ["part", "wide", "key", F.xxhash64("row")]
    rows = vectors.mapInArrow(keyed, "part int, wide boolean, key long, row long, x array<double>")
    rows = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return materialize(rows.mapInArrow(flat, BLOCKS), "code-blocks")


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Which entries can be nearest to a part in each box (boxes, entries), with room for rounding."""
    out = np.empty((len(low), len(entries)), bool)
    step = max(1, CORNERS // max(1, entries.size))
    for a in range(0, len(low), step):
        lo, hi = low[a : a + step, None, :], high[a : a + step, None, :]
        below, above = lo - entries, entries - hi
        near = np.maximum(np.maximum(below, above), 0)
        far = np.maximum(hi - entries, entries - lo)
        with np.errstate(over="ignore"):
            near, far = (near * near).sum(2), (far * far).sum(2)
        out[a : a + step] = near * (1 - 1e-9) <= far.min(1, keepdims=True) * (1 + 1e-9)
    return out


class Kernel:
    """Assigns blocks to the entries of one set of codebooks."""

    def __init__(self, books: Codebooks, scale: int):
        self.width, self.scale = books.width, scale
        self.entries = [whole.as_matrix(book, books.width) for book in books.entries]
        self.corners = [whole.as_floats(book, books.width) for book in books.entries]
        self.compared = 0

    def blocks(self, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, Callable]]:
        """For every block: position, rows, the shortlist, and a function that gives the block's numbers."""
        position = batch["part"].to_numpy()
        wide = batch["wide"].to_numpy(zero_copy_only=False)
        allowed: dict[int, np.ndarray] = {}
        for p in np.unique(position).tolist():
            at = np.flatnonzero((position == p) & ~wide)
            if len(at):
                box = [batch[c].take(pa.array(at)).flatten().to_numpy().reshape(len(at), -1) for c in ("low", "high")]
                allowed |= dict(zip(at.tolist(), shortlists(*[b.astype(float) for b in box], self.corners[p])))
        rows, small, far = batch["rows"], batch["small"], batch["far"]
        for k, p in enumerate(position.tolist()):
            ids = rows[k].values.to_numpy()
            listed = np.flatnonzero(allowed[k]) if k in allowed else np.arange(len(self.entries[p]))

            def numbers(k=k, n=len(ids)):
                if wide[k]:
                    return whole.floors(far[k].values.to_numpy().reshape(n, self.width), self.scale)
                return small[k].values.to_numpy().astype(np.int64).reshape(n, self.width)

            yield p, ids, listed, numbers, k

    def nearest(self, p: int, listed: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of every part."""
        entries = self.entries[p][listed]
        if entries.dtype == object and all(abs(v) <= whole.SMALL for v in entries.ravel()):
            entries = entries.astype(np.int64)
        self.compared += len(x) * len(listed)
        d = whole.squared(x, entries)
        best = np.array([int(np.argmin(r)) for r in d]) if d.dtype == object else d.argmin(1)
        return listed[best], d[np.arange(len(x)), best]


def _sums(blocks: DataFrame, books: Codebooks, spec: Spec) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and sums of what is assigned to each entry."""
    spark, width, scale = blocks.sparkSession, books.width, spec.scale
    sent = spark.sparkContext.broadcast(books)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = Kernel(sent.value, scale)
        counts = [np.zeros(len(e), np.int64) for e in kernel.entries]
        small = [np.zeros((len(e), width), np.int64) for e in kernel.entries]
        wide: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            totals = batch["total"]
            for p, ids, listed, numbers, k in kernel.blocks(batch):
                if len(listed) == 1:
                    counts[p][listed[0]] += len(ids)
                    if totals[k].is_valid:
                        small[p][listed[0]] += totals[k].values.to_numpy()
                        continue
                    x, entry = numbers(), np.repeat(listed, len(ids))
                else:
                    x = numbers()
                    entry, _ = kernel.nearest(p, listed, x)
                    np.add.at(counts[p], entry, 1)
                if x.dtype == object:
                    for e, row in zip(entry.tolist(), x.tolist()):
                        held = wide.setdefault((p, e), [0] * width)
                        wide[p, e] = [a + b for a, b in zip(held, row)]
                else:
                    np.add.at(small[p], entry, x)
        out = []
        for p, counted in enumerate(counts):
            for e in np.flatnonzero(counted).tolist():
                total = [a + b for a, b in zip(small[p][e].tolist(), wide.get((p, e), [0] * width))]
                for level, limb in enumerate(whole.limbs(total)):
                    out.append({"part": p, "entry": e, "level": level, "n": 0 if level else int(counted[e]), "s": limb})
        schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("level", pa.int32()), ("n", pa.int64()), ("s", pa.list_(pa.int64()))])
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    try:
        each = blocks.mapInArrow(task, "part int, entry int, level int, n long, s array<long>")
        added = each.groupBy("part", "entry", "level").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(width)]).alias("s")
        )
        found: dict[tuple[int, int], tuple[int, list[int]]] = {}
        for r in added.collect():  # parts x entries x limbs rows
            n, s = found.get((r["part"], r["entry"]), (0, [0] * width))
            found[r["part"], r["entry"]] = n + r["n"], [a + (b << whole.LIMB * r["level"]) for a, b in zip(s, r["s"])]
    finally:
        sent.unpersist()
    return found


def _codes(blocks: DataFrame, books: Codebooks, spec: Spec) -> DataFrame:
    """``row, code, error`` of every vector."""
    scale = spec.scale
    sent = blocks.sparkSession.sparkContext.broadcast(books)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = Kernel(sent.value, scale)
        for batch in batches:
            rows, part, entry, error = [], [], [], []
            for p, ids, listed, numbers, _ in kernel.blocks(batch):
                e, d = kernel.nearest(p, listed, numbers())
                rows.append(ids)
                part.append(np.full(len(ids), p, np.int32))
                entry.append(e.astype(np.int32))
                error += whole.longs(d.tolist())
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(rows)), pa.array(np.concatenate(part)), pa.array(np.concatenate(entry)),
                     pa.array(error, pa.int64())], ["row", "part", "entry", "error"]
                )

    each = blocks.mapInArrow(task, "row long, part int, entry int, error long")
    digits = [F.lpad(F.lower(F.hex(F.max(F.when(F.col("part") == p, F.col("entry"))))), 2, "0") for p in range(spec.parts)]
    return each.groupBy("row").agg(F.concat(*digits).alias("code"), total_of("error").alias("error"))


def total_of(column: str):
    """The sum as a long; NULL if it exceeds one, as any sum with a value that does."""
    total = F.sum(F.col(column).cast("decimal(38,0)"))
    exact = (F.count(F.lit(1)) == F.count(column)) & (total <= F.lit(str(whole.LONG)).cast("decimal(38,0)"))
    return F.when(exact, total).cast("long")


def compress(
    rows: DataFrame,
    spec: Spec = Spec(),
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, Codebooks]:
    """``vec_id, label, code, error, label_error`` of every vector, and the codebooks."""
    chosen = rows.where(whole.usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    numbers = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    named = chosen.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), numbers.alias("x"))
    named = named.withColumns({"wide": whole.is_wide(F.col("x"), spec.scale), "row": F.monotonically_increasing_id()})
    vectors = materialize(named, "code-vectors")
    count, longest = vectors.agg(F.count("*"), F.max(F.size("x"))).first()
    width = max(1, -(-(longest or 0) // spec.parts))
    seeds = vectors.orderBy("vec_id", "x").limit(spec.entries).select("x").collect()
    first = [[] for _ in range(spec.parts)]
    for r in seeds:
        cells = cut(pa.array([r["x"]], pa.list_(pa.float64())), spec.parts, width)[0]
        for p in range(spec.parts):
            first[p].append([int(v) for v in whole.floors(cells[p], spec.scale)])
    books = Codebooks(width, first)
    blocks = _blocks(vectors, count, _spreads(vectors, spec.parts, width), spec, width)
    for _ in range(spec.rounds if count else 0):
        moved = _sums(blocks, books, spec)
        entries = [list(book) for book in books.entries]
        for (p, e), (n, s) in moved.items():
            entries[p][e] = whole.floor_mean(s, n)
        books = Codebooks(width, entries)
    codes = materialize(vectors.select("row", "vec_id", "label").join(_codes(blocks, books, spec), "row"), "codes")
    labels = materialize(codes.groupBy("label").agg(total_of("error").alias("label_error")), "label-errors")
    out = attach(codes.drop("row"), labels, ["label"], stats_rows=labels.count(), row_bytes=64)
    return out.select("vec_id", "label", "code", "error", "label_error"), books
