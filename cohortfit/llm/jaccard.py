"""Near-duplicate documents by an exact n-gram Jaccard join on parity sketches.

A document is the set of its distinct shingles. Hashing every shingle to one bit and
XOR-ing (a parity sketch) gives sketches whose Hamming distance never exceeds the
symmetric difference of the sets; and a pair above the threshold differs in at most a
third of the smaller set. So, per band of sizes, the sketch is cut into chunks, more of
them than a pair may differ in: two linked documents agree in a whole chunk that is not
empty (pigeonhole), and an equi-join on chunks finds every link.

The joined sketch has one bit per 64-bit hash value; a chunk of it is kept as the XOR of
the hashes in it. A second, short sketch per document (about four bits a shingle) rejects
most of the other candidates by its distance before the sets themselves are compared.

Steps, with everything that grows written or shuffled by Spark:

1. sets: size, digest and short sketch of every document (no shuffle of texts);
2. chunk keys, packed as numpy blocks, dealt over buckets of keys, sorted there; documents
   with the same set as one before in the same task emit none;
3. keys met by few sets give all their pairs, the others ("large" keys, of widespread
   passages or large families) only their members;
4. a set that fills f chunks of a band agrees with a linked one in at least f - differ of
   them. So a pair must have met that often, less the large keys of either set, and a set
   with fewer large keys than that needs none of them: its links all show elsewhere. That
   settles widespread passages exactly, with counts alone; other sets stay members of their
   rarest large keys only, as many as a link cannot avoid;
5. the members left at large keys are joined to one of them, another at every key, which
   connects large families by a linear number of pairs;
6. pairs are filtered by size and short sketch, then verified exactly on the sets;
7. connected components. Then, for the large keys whose members are not all connected,
   every unconnected member is compared with all others in tiles of bounded size, by sketch
   and then by whole sets; a tile returns a forest of verified links between components, so
   no link that would connect two components is lost and never more come out than went in.

Sets of fewer than 32 shingles have one band without chunks: each shingle is a key, as a
parity over so few would tell little; counts, sketches and verification are the same. Sets
are compared by the 64-bit hashes of their shingles.

Defined results: NULL or empty texts (and those of white space only) have no shingles and
are linked with nothing; a text of fewer words than a shingle has its whole sequence as
one; rows without an id are left out; repeated rows are documents of the same set, and
rows of one id with different texts are judged on their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cohortfit.llm.batches import materialize, unused
from cohortfit.llm.graph import components
from cohortfit.llm.words import U, Slice, distinct_within, mix, slices, sum_within

SHINGLE = 5
#: Link: 100 * intersection >= 75 * union. The sketch bounds below are for this value.
SIMILARITY = 75

#: Keys met by at most so many sets give all their pairs.
SMALL_GROUP = 6
#: One in so many large keys gives a star; the tiles make up for the others.
STAR_KEYS = 4
#: Rows and columns of a tile, and the shingles either holds.
TILE, TILE_SHINGLES = 4_096, 2_000_000
#: Bytes of chunk keys that one task sorts.
BUCKET_BYTES = 32 << 20
#: Chunk keys a task gathers before it hands them on.
FLUSH = 700_000
#: Ids that may be broadcast instead of shuffling texts for them.
BROADCAST_IDS = 500_000

#: Lower edges of the size bands: all sizes below 32 are band 0, then a factor of the root of 2.
EDGES = np.unique(np.ceil(32 * 2 ** (np.arange(0, 58) / 2)).astype(np.int64))


@dataclass(frozen=True)
class Band:
    chunks: int
    differ: int


def _band(k: int) -> Band:
    """Chunks of band ``k`` of the smaller set.

    A linked pair (a <= b <= 4a/3) differs in at most (a + b) / 7 <= a / 3 shingles. With
    ``chunks`` so many that a set of the least size leaves more than ``differ`` of them
    not empty (but for very rare sets, which get a key of their own), the pair agrees in
    one that is not empty.
    """
    low, high = int(EDGES[k - 1]), int(EDGES[k])
    differ = (high - 1) // 3
    chunks = differ + 2
    while True:
        load = low / chunks
        empty = chunks * np.exp(-load)
        deviation = np.sqrt(max(empty * (1 - (1 + load) * np.exp(-load)), 0))
        if chunks - differ - 1 >= empty + 4 * deviation:
            return Band(chunks, differ)
        chunks = int(chunks * 1.02) + 1


_bands: dict[int, Band] = {}


def band(k: int) -> Band:
    if k not in _bands:
        _bands[k] = _band(k)
    return _bands[k]


def bands_of(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The band of a set's size and that of the smallest set it may be linked with."""
    return np.searchsorted(EDGES, n, "right"), np.searchsorted(EDGES, -(-3 * n // 4), "right")


@dataclass
class Sets:
    """The distinct shingle hashes of the texts of a slice, sorted within each."""

    hashes: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, part: Slice, shingle: int = SHINGLE) -> Sets:
        return cls(*distinct_within(*part.grams(shingle)))

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """Two sums over the hashes: equal for equal sets."""
        sums = [sum_within(mix(self.hashes ^ U(salt)), self.bounds) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
        return tuple(mix(s + self.sizes.astype(U)).view(np.int64) for s in sums)

    def sketches(self) -> list[bytes]:
        """The short parity sketch of every set, of a power of two of bits (at least 4 a shingle)."""
        width = 64 << np.maximum(0, np.ceil(np.log2(np.maximum(self.sizes, 1) / 16)).astype(np.int64))
        starts = np.concatenate([[0], np.cumsum(width)])
        bit = (self.hashes & np.repeat(width - 1, self.sizes).astype(U)).astype(np.int64)
        flips = np.bincount(bit + np.repeat(starts[:-1], self.sizes), minlength=starts[-1])
        packed = np.packbits((flips & 1).astype(bool)).tobytes()
        return [packed[a // 8 : b // 8] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]

    def _banded(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per band above 0: its sets, and hashes, set and first place of every filled chunk, in order."""
        sizes = self.sizes
        own, least = bands_of(sizes)
        text = np.repeat(np.arange(len(sizes)), sizes)
        for k in np.unique(np.concatenate([own[sizes > 0], least[sizes > 0]])).tolist():
            member = (sizes > 0) & (least <= k) & (k <= own)
            of_member = member[text]
            hashes, owner = self.hashes[of_member], text[of_member]
            if k == 0:
                yield k, member, hashes, owner, np.arange(len(hashes))
                continue
            chunk = ((hashes >> U(32)) * U(band(k).chunks)) >> U(32)
            first = np.ones(len(hashes), bool)
            first[1:] = (chunk[1:] != chunk[:-1]) | (owner[1:] != owner[:-1])
            yield k, member, hashes, owner, np.flatnonzero(first)

    def agreement(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The two bands of every set, and the keys it shares at least with a linked one in each."""
        own, least = bands_of(self.sizes)
        in_own, in_least = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        for k, member, _, owner, first in self._banded():
            if k == 0:
                shared = -(-3 * self.sizes // 4)
            else:
                shared = np.bincount(owner[first], minlength=len(own)) - band(k).differ
            in_own = np.where(member & (own == k), shared, in_own)
            in_least = np.where(member & (least == k), shared, in_least)
        return own, least, in_own, in_least

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Chunk keys of all sets, with the band in the last six bits, and the set of each key."""
        keys, owners = [np.empty(0, U)], [np.empty(0, np.int64)]
        for k, member, hashes, owner, first in self._banded():
            if k == 0:
                value = mix(hashes)
            else:
                b = band(k)
                chunk = ((hashes[first] >> U(32)) * U(b.chunks)) >> U(32)
                parity = np.bitwise_xor.reduceat(hashes, first) if len(first) else hashes
                value = mix(parity ^ mix(chunk + U(k << 40)))
                filled = np.bincount(owner[first], minlength=len(member))
                sparse = np.flatnonzero(member & (filled <= b.differ))
                keys.append(np.full(len(sparse), (mix(np.array([(k << 40) - 1], U)) & ~U(63)) | U(k)))
                owners.append(sparse)
            keys.append((value & ~U(63)) | U(k))
            owners.append(owner[first])
        return np.concatenate(keys), np.concatenate(owners)


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.where("doc_id is not null")


def shingle_sets(rows: DataFrame) -> DataFrame:
    """Size, digests, sketch and bands of every row; ``node`` stands for the set."""
    names = ["doc_id", "n", "node", "check", "sketch", "own", "least", "in_own", "in_least"]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                sets = Sets.of(part)
                node, check = sets.digests()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, len(part)), pa.array(sets.sizes), pa.array(node),
                     pa.array(check), pa.array(sets.sketches(), pa.binary()), *map(pa.array, sets.agreement())],
                    names,
                )

    schema = "doc_id long, n long, node long, check long, sketch binary, own long, least long, in_own long, in_least long"
    return rows.mapInArrow(summed, schema)


def _packed(keys: np.ndarray, owners: np.ndarray, nodes: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One block per bucket: numbers of nodes and keys and bytes of a count, the nodes, all keys node by node, the counts."""
    bucket = (((keys >> U(32)) * U(buckets)) >> U(32)).astype(np.int64)
    order = np.argsort(bucket * len(nodes) + owners, kind="stable")
    keys, owners, bucket = keys[order], owners[order], bucket[order]
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    blocks = []
    for a, b in zip(starts, np.append(starts[1:], len(keys))):
        own = owners[a:b]
        runs = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        counts = np.diff(np.append(runs, b - a))
        small = np.dtype(np.uint16 if counts.max() < 1 << 16 else np.uint32)
        blocks.append(
            np.array([len(runs), b - a, small.itemsize], np.int64).tobytes()
            + nodes[own[runs]].tobytes() + keys[a:b].tobytes() + counts.astype(small).tobytes()
        )
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[starts].astype(np.int32)), pa.array(blocks, pa.binary())], ["bucket", "block"]
    )


def _unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    nodes, keys, width = np.frombuffer(block, np.int64, 3).tolist()
    known = np.frombuffer(block, np.int64, nodes, 24)
    counts = np.frombuffer(block, f"u{width}", nodes, 24 + 8 * (nodes + keys))
    return np.frombuffer(block, U, keys, 24 + 8 * nodes), np.repeat(known, counts)


def chunk_blocks(rows: DataFrame, buckets: int) -> DataFrame:
    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        count = base = 0

        def flush():
            keys, owners, nodes = (np.concatenate(x) for x in zip(*held))
            return _packed(keys, owners, nodes, buckets)

        for batch in batches:
            for part in slices(batch.column(1)):
                sets = Sets.of(part)
                node = sets.digests()[0]
                new = np.zeros(len(node), bool)
                for k, value in enumerate(node.tolist()):
                    if value not in seen:
                        seen.add(value)
                        new[k] = True
                kept = np.repeat(new, sets.sizes)
                bounds = np.concatenate([[0], np.cumsum(np.where(new, sets.sizes, 0))])
                keys, owners = Sets(sets.hashes[kept], bounds).keys()
                held.append((keys, owners + base, node))
                base, count = base + len(node), count + len(keys)
                if count >= FLUSH:
                    yield flush()
                    held, count, base = [], 0, 0
        if count:
            yield flush()

    return rows.mapInArrow(emitted, "bucket int, block binary")


def _met(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, node) where a key meets several nodes, and the starts of the keys' runs."""
    order = np.argsort(keys, kind="stable")
    keys, nodes = keys[order], nodes[order]
    same = keys[1:] == keys[:-1]
    several = np.append(same, False) | np.append(False, same) if len(keys) else np.zeros(0, bool)
    keys, nodes = keys[several], nodes[several]
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    keys, nodes = keys[new], nodes[new]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys, nodes, np.append(starts, len(keys))


def candidate_pairs(blocks: DataFrame, partitions: int) -> DataFrame:
    """``key, a, b, times``: pairs with their band as key, and the members ``a`` of large keys (b NULL)."""
    names = ["key", "a", "b", "times"]

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [_unpacked(x) for batch in batches for x in batch.column("block").to_pylist()]
        if not found:
            return
        keys, nodes, starts = _met(*(np.concatenate(x) for x in zip(*found)))
        del found
        lengths = np.diff(starts)
        rows = [np.empty((0, 3), np.int64)]
        for g in np.unique(lengths[(lengths > 1) & (lengths <= SMALL_GROUP)]).tolist():
            first = starts[:-1][lengths == g]
            members = nodes[first[:, None] + np.arange(g)]  # in rising order
            i, j = np.triu_indices(g, 1)
            bands = np.repeat((keys[first] & U(63)).astype(np.int64), len(i))
            rows.append(np.column_stack([bands, members[:, i].ravel(), members[:, j].ravel()]))
        pairs, times = np.unique(np.concatenate(rows), axis=0, return_counts=True)
        for k in range(0, len(pairs), 100_000):
            part = pairs[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([*map(pa.array, part.T), pa.array(times[k : k + 100_000])], names)
        large = np.repeat(lengths > SMALL_GROUP, lengths)
        keys, nodes = keys[large].view(np.int64), nodes[large]
        for k in range(0, len(keys), 100_000):
            n = len(keys[k : k + 100_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[k : k + n]), pa.array(nodes[k : k + n]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
                names,
            )

    return blocks.repartitionById(partitions, F.col("bucket")).mapInArrow(paired, "key long, a long, b long, times long")


def sizes_allow(a: str, b: str) -> Column:
    """Whether sets of these sizes can be linked."""
    return 4 * F.least(a, b) >= 3 * F.greatest(a, b)


def _plausible(found: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs that met often enough, and the members that need their large keys.

    A pair that shares no small key shares at least ``q`` of the ``h`` large keys of either
    set. With the keys of every set in one order, rare ones first, both then hold a common
    key among their first h - q + 1, so a set is a member of these alone.
    """
    large = found.where("b is null").select("key", "a", F.col("key").bitwiseAND(63).alias("band"))
    times_large = large.groupBy(F.col("a").alias("node"), "band").agg(F.count("*").alias("h"))
    both = F.array(F.struct(F.col("own").alias("band"), F.col("in_own").alias("q")), F.struct(F.col("least").alias("band"), F.col("in_least").alias("q")))
    needs = classes.select("node", "n", "own", F.explode(F.array_distinct(both)).alias("x"))
    needs = needs.select("node", "n", "own", "x.band", "x.q").join(times_large, ["node", "band"], "left")
    needs = needs.withColumn("need", F.col("q") - F.coalesce("h", F.lit(0))).select("node", "n", "own", "band", "need", "h")
    needs = materialize(needs, "set-needs")
    pairs = found.where("b is not null").groupBy("a", "b", F.col("key").alias("band")).agg(F.sum("times").alias("times"))
    for s in "ab":
        own = needs.select(F.col("node").alias(s), "band", F.col("own").alias(f"own_{s}"), F.col("need").alias(f"need_{s}"), F.col("n").alias(f"n_{s}"))
        pairs = pairs.join(own, [s, "band"])
    enough = F.col("times") >= F.greatest(F.lit(1), "need_a", "need_b")
    pairs = pairs.where((F.col("band") == F.least("own_a", "own_b")) & enough & sizes_allow("n_a", "n_b")).select("a", "b")
    open_ = needs.where("h is not null and need <= 0")
    open_ = open_.select(F.col("node").alias("a"), "n", "band", (1 - F.col("need")).alias("first"))
    sizes = large.groupBy("key").agg(F.count("*").alias("size"))
    rarest = Window.partitionBy("a", "band").orderBy("size", "key")  # at most as many rows as a set has shingles
    chosen = large.join(open_, ["a", "band"]).join(sizes, "key").withColumn("rank", F.row_number().over(rarest))
    return pairs, materialize(chosen.where("rank <= first").select("key", "a", "n"), "large-keys")


def _stars(large: DataFrame) -> DataFrame:
    """Every member of a large key with one of them, picked by a hash that differs by key."""
    pick = F.min(F.struct(F.xxhash64("key", "a").alias("h"), F.col("a").alias("x"), "n"))
    large = large.where(F.pmod(F.xxhash64("key"), F.lit(STAR_KEYS)) == 0)
    centre = large.groupBy("key").agg(pick.alias("c")).select("key", F.col("c.x").alias("centre"), F.col("c.n").alias("m"))
    joined = large.join(centre, "key").where((F.col("a") != F.col("centre")) & sizes_allow("n", "m"))
    return joined.select(F.least("a", "centre").alias("a"), F.greatest("a", "centre").alias("b")).distinct()


def _fold(sketch: np.ndarray, size: int) -> np.ndarray:
    """Halves XOR-ed until the sketch has ``size`` bytes: the sketch of that width."""
    while len(sketch) > size:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def may_link(n_a: int, sketch_a: bytes, n_b: int, sketch_b: bytes) -> bool:
    if 4 * min(n_a, n_b) < 3 * max(n_a, n_b):
        return False
    size = min(len(sketch_a), len(sketch_b))
    a, b = (_fold(np.frombuffer(x, np.uint8), size) for x in (sketch_a, sketch_b))
    return 7 * int(np.bitwise_count(a ^ b).sum()) <= n_a + n_b


@F.arrow_udf(T.BooleanType())
def _may_link(n_a: pa.Array, sketch_a: pa.Array, n_b: pa.Array, sketch_b: pa.Array) -> pa.Array:
    columns = (x.to_pylist() for x in (n_a, sketch_a, n_b, sketch_b))
    return pa.array([may_link(*row) for row in zip(*columns)], pa.bool_())


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of distinct hashes are similar enough."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= SIMILARITY * (len(a) + len(b) - both)


@F.arrow_udf(T.BooleanType())
def _linked(set_a: pa.Array, set_b: pa.Array) -> pa.Array:
    sides = ([np.frombuffer(x.as_buffer(), U) for x in values] for values in (set_a, set_b))
    return pa.array([linked(a, b) for a, b in zip(*sides)], pa.bool_())


def _hashes(nodes: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``node, hashes`` of the wanted nodes, from the whole text of one document each; written."""
    wanted = materialize(nodes.join(classes, "node").select("node", "doc_id"), "near-sets")
    few = wanted.count() <= BROADCAST_IDS

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(1).to_pylist()
            for part in slices(batch.column(0)):
                sets = Sets.of(part)
                own = sets.digests()[0].tolist()
                # A row of the same id with another text is not the one that is meant.
                chosen = [k for k in range(len(part)) if own[k] == nodes[part.first + k]]
                members = [sets.hashes[sets.bounds[k] : sets.bounds[k + 1]].tobytes() for k in chosen]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([own[k] for k in chosen], pa.int64()), pa.array(members, pa.binary())], ["node", "hashes"]
                )

    texts = rows.join(F.broadcast(wanted) if few else wanted, "doc_id").select("text", "node")
    return materialize(texts.mapInArrow(hashed, "node long, hashes binary").dropDuplicates(["node"]), "near-hashes")


def _verified(pairs: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The links among ``pairs(a, b)``, by comparing whole sets; written."""
    sides = [classes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"s_{s}")) for s in "ab"]
    near = pairs.distinct().join(sides[0], "a").join(sides[1], "b")
    near = near.where(_may_link("n_a", "s_a", "n_b", "s_b")).select("a", "b")
    near = materialize(near, "near-pairs")
    members = _hashes(near.select(F.col("a").alias("node")).union(near.select("b")).distinct(), rows, classes)
    sides = [members.select(F.col("node").alias(s), F.col("hashes").alias(f"h_{s}")) for s in "ab"]
    links = near.join(sides[0], "a").join(sides[1], "b").where(_linked("h_a", "h_b"))
    return materialize(links.select("a", "b"), "links")


def plausible(
    sketches: list[bytes], n: np.ndarray, label: np.ndarray, is_row: np.ndarray
) -> Iterator[tuple[int, np.ndarray]]:
    """For every row the members of other components that sizes and sketches allow, closest first."""
    bits = [np.frombuffer(x, np.uint8) for x in sketches]
    widths = np.array([len(x) for x in bits])
    folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for w in np.unique(widths).tolist():  # partners are at most one width apart
        place = np.flatnonzero((widths >= w) & (widths <= 2 * w))
        folded[w] = place, np.stack([_fold(bits[k], w) for k in place])
    for k in np.flatnonzero(is_row).tolist():
        hits, aparts = [], []
        for w in {int(widths[k]), int(widths[k]) // 2} & folded.keys():
            place, known = folded[w]
            apart = np.bitwise_count(known ^ _fold(bits[k], w)).sum(axis=1, dtype=np.int64)
            good = (7 * apart <= n[place] + n[k]) & (label[place] != label[k])
            good &= 4 * np.minimum(n[place], n[k]) >= 3 * np.maximum(n[place], n[k])
            hits.append(place[good])
            aparts.append(apart[good])
        yield k, np.concatenate(hits)[np.argsort(np.concatenate(aparts), kind="stable")]


def forest(hashes: list[np.ndarray], label: np.ndarray, is_row: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the tile's links connect: at most one less than there are labels.

    Pairs that are connected by then are skipped, the others compared as whole sets.
    """
    n = np.array([len(h) for h in hashes])
    sets = Sets(np.concatenate(hashes), np.concatenate([[0], np.cumsum(n)]))
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    links = []
    for k, partners in plausible(sets.sketches(), n, label, is_row):
        for other in partners.tolist():
            x, y = root(int(label[k])), root(int(label[other]))
            if x != y and linked(hashes[k], hashes[other]):
                parent[max(x, y)] = min(x, y)
                links.append((k, other))
    return links


def _left_over(large: DataFrame, labels: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Links of members of the same large key that are not connected yet; written.

    Members outside the key's most frequent component are compared with all members, in
    tiles of bounded numbers of members and shingles: first by sketches, which leaves the
    members that any pair needs; then those by their sets. A tile gives a forest of verified
    links, so what comes out of it is linear in its members, however many are alike.
    """
    known = large.join(labels.withColumnRenamed("node", "a"), "a", "left")
    known = materialize(known.select("key", "a", "n", F.coalesce("label", "a").alias("label")), "large-labels")
    drawn = classes.select(F.col("node").alias("a"), "n", "sketch")
    counts = known.groupBy("key", "label").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
    groups = counts.groupBy("key").agg(
        F.sum("c").alias("size"),
        F.sum("n").alias("total"),
        F.max(F.struct("c", "label"))["label"].alias("main"),
        F.count("*").alias("labels"),
    )
    tiles = F.greatest(F.ceil(F.col("size") / TILE), F.ceil(F.col("total") / TILE_SHINGLES)).cast("int")
    split = groups.where("labels > 1").select("key", "main", tiles.alias("tiles"))
    members = materialize(known.join(split, "key").select("key", "a", "label", "main", "tiles"), "large-open")
    if members.isEmpty():
        return None
    own = F.pmod(F.xxhash64("a"), F.col("tiles")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    fields = ["key", "a", "label"]
    is_row = (F.col("label") != F.col("main")).alias("row")
    # A key of one tile needs each member once; otherwise rows and columns of the tiles are dealt apart.
    whole = members.where("tiles = 1").select(*fields, is_row, F.lit(0).alias("i"), F.lit(0).alias("j"))
    rows_of = members.where("tiles > 1 and label <> main").select(*fields, F.lit(True).alias("row"), own.alias("i"), every.alias("j"))
    columns_of = members.where("tiles > 1").select(*fields, F.lit(False).alias("row"), own.alias("j"), every.alias("i"))
    dealt = whole.unionByName(rows_of).unionByName(columns_of)

    def involved(table: pa.Table) -> pa.Table:
        n, label, is_row = (table.column(c).to_numpy() for c in ("n", "label", "row"))
        met = np.zeros(len(n), bool)
        for k, partners in plausible(table.column("sketch").to_pylist(), n, label, is_row):
            met[k] |= len(partners) > 0
            met[partners] = True
        return table.select(["key", "i", "j", "a", "label", "row"]).filter(pa.array(met))

    def compared(table: pa.Table) -> pa.Table:
        node, label = (table.column(c).to_numpy() for c in ("a", "label"))
        hashes = [np.frombuffer(x, U) for x in table.column("hashes").to_pylist()]
        found = forest(hashes, label, table.column("row").to_numpy())
        pairs = np.array([sorted((node[a], node[b])) for a, b in found], np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    tile = ["key", "i", "j"]
    near = dealt.join(drawn, "a").groupBy(*tile).applyInArrow(involved, "key long, i int, j int, a long, label long, row boolean")
    near = materialize(near, "tile-members")
    sets = _hashes(near.select(F.col("a").alias("node")).distinct(), rows, classes).withColumnRenamed("node", "a")
    return materialize(near.join(sets, "a").groupBy(*tile).applyInArrow(compared, "a long, b long").distinct(), "tile-links")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document; components by links of 0.75 or more."""
    rows = _named(docs, id_col, text_col)
    sets = materialize(shingle_sets(rows), "shingle-sets")
    fields = ["doc_id", "n", "sketch", "own", "least", "in_own", "in_least"]
    classes = sets.where("n > 0").groupBy("node").agg(F.min(F.struct(*fields)).alias("x"))
    classes = materialize(classes.select("node", "x.*"), "set-classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    conf = docs.sparkSession.conf
    partitions = max(int(conf.get("spark.sql.shuffle.partitions")), int(10 * total // BUCKET_BYTES) + 1)
    found = materialize(candidate_pairs(chunk_blocks(rows, partitions), partitions), "candidates")
    pairs, large = _plausible(found, classes)
    links = _verified(pairs.union(_stars(large)), rows, classes)
    labels = materialize(components(links), "labels")
    more = _left_over(large, labels, rows, classes)
    if more is not None and not more.isEmpty():
        labels = materialize(components(links.union(more)), "labels")
    known = classes.select("node", "doc_id").join(labels, "node", "left")
    least = known.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    known = known.join(least, "label", "left").select("node", F.coalesce("least", "doc_id").alias("component_id"))
    full = sets.where("n > 0").select("doc_id", "n", "node").join(known, "node")
    empty = sets.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    result = full.select("doc_id", "n", "component_id").unionByName(empty)
    return result.withColumnRenamed("n", "n_shingles")


def keep_one_per_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents whose group has a smaller id."""
    groups = near_duplicates(docs, id_col=id_col, text_col=text_col)
    kept = F.max((F.col("doc_id") == F.col("component_id")).cast("int"))
    dropped = groups.groupBy("doc_id").agg(kept.alias("kept")).where("kept = 0")
    dropped = materialize(dropped.select("doc_id"), "near-dropped")
    few = dropped.count() <= BROADCAST_IDS
    rows = docs.where(F.col(id_col).isNotNull())
    dropped = dropped.withColumnRenamed("doc_id", unused(docs, "dropped")[0])
    same = rows[id_col].cast("long") == dropped[dropped.columns[0]]
    return rows.join(F.broadcast(dropped) if few else dropped, same, "left_anti")
