"""Passages that repeat across documents, by a sparse suffix array.

Suffixes (of words) are retained only at minimisers: positions whose run of ``GRAM``
words has the least hash within ``WINDOW`` neighbouring positions. Every stretch of
``LEAST`` = GRAM + WINDOW - 1 words holds such a position, chosen by content alone, so two
copies of a stretch retain the same suffixes.

1. The retained suffixes' beginnings are counted; those found in one text only go.
2. The others get their context, ``WINDOW - 1`` word hashes on either side, and are dealt
   over ranges of (beginning, right context, left context, text) and sorted: the suffix
   array. Ranges split a beginning that many texts share. A task walks its range in
   pieces, so it holds one piece however long the range is.
3. Suffixes next to each other with the same beginning form a run. Their matches are
   extended: for every split of LEAST words into a left and a right part, the run's
   members with equal parts share a stretch. So a passage is found with every partner,
   not only with the nearest in the order. Where the boundary of a range or piece cuts a
   run, the stretches that may lie on both sides are joined across the pieces.
4. Stretches of a text are merged to maximal spans.

Texts equal but for case are one text until the end; their copies repeat as a whole.

Defined results: texts of fewer than LEAST words have no spans, NULL texts none; repeats
within one text do not count; rows without an id are left out; rows repeated with the
same id and text count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortfit.llm.batches import materialize
from cohortfit.llm.words import _ODD, U, Slice, mix, slices

GRAM, WINDOW = 18, 33
LEAST = GRAM + WINDOW - 1
SIDE = WINDOW - 1
#: Positions that may be broadcast instead of shuffling texts for them.
BROADCAST_POSITIONS = 200_000
#: Suffixes of a range of the order, and of a piece of it that a task holds at a time (some 1 KB each).
RANGE, PIECE = 1 << 16, 1 << 15
#: Ranges at most, as the driver draws their bounds from some 300 suffixes each; beyond, ranges have more pieces.
RANGES = 3_000


def minimisers(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and word number of every retained suffix of a slice."""
    hashes, bounds = part.word_hashes, part.word_bounds
    none = np.empty(0, np.int64)
    n = len(hashes) - GRAM + 1
    if n < WINDOW:
        return none.astype(U), none, none
    grams = np.zeros(n, U)
    for k in range(GRAM):
        grams += hashes[k : k + n] * _ODD[k]
    grams = mix(grams)
    least, span = np.arange(n), 1
    while span < WINDOW:  # the place of the least hash among the next ``span`` ones, leftmost on ties
        step = min(span, WINDOW - span)
        a, b = least[: len(least) - step], least[step:]
        least = np.where(grams[b] < grams[a], b, a)
        span += step
    counts = np.diff(bounds)
    text = np.repeat(np.arange(len(counts)), counts)
    starts = np.arange(len(least))
    inside = starts + LEAST <= bounds[1:][text[: len(starts)]]
    chosen = np.unique(least[inside])
    return grams[chosen], text[chosen], chosen - bounds[text[chosen]]


def _tags(part: Slice) -> np.ndarray:
    return part.hashes(part.bounds[:-1], part.bounds[1:]).view(np.int64)


def texts_and_suffixes(rows: DataFrame) -> DataFrame:
    """Rows of two kinds: ``doc_id, tag, n`` of every document, and ``h, tag, n`` of a suffix (n its word)."""

    def retained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "h", "tag", "n"]
        for batch in batches:
            for part in slices(batch.column(1)):
                tags = _tags(part)
                words = np.diff(part.word_bounds).astype(np.int32)
                ids = batch.column(0).slice(part.first, len(part))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.nulls(len(part), pa.int64()), pa.array(tags), pa.array(words)], names
                )
                h, text, place = minimisers(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(h), pa.int64()), pa.array(h.view(np.int64)), pa.array(tags[text]),
                     pa.array(place.astype(np.int32))], names
                )

    return rows.mapInArrow(retained, "doc_id long, h long, tag long, n int")


def _contexts(rows: DataFrame) -> DataFrame:
    """Both contexts of the suffixes at ``places`` of every text."""
    schema = "h long, right binary, left binary, tag long, place int"

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = np.arange(SIDE)
        for batch in batches:
            wanted, places = batch.column(1).to_pylist(), batch.column(2)
            for part in slices(batch.column(0)):
                tags, bounds = _tags(part), part.word_bounds
                short = (part.word_hashes >> U(32)).astype(np.uint32) | np.uint32(1)  # 0: no word
                for k in range(len(part)):
                    row = part.first + k
                    if wanted[row] != tags[k]:  # another text of the same id
                        continue
                    p = np.sort(places[row].values.to_numpy(zero_copy_only=False).astype(np.int64))
                    own = np.concatenate([np.zeros(SIDE, np.uint32), short[bounds[k] : bounds[k + 1]], np.zeros(SIDE + GRAM, np.uint32)])
                    left = own[p[:, None] + SIDE - 1 - shifts]
                    right = own[p[:, None] + SIDE + GRAM + shifts]
                    full = part.word_hashes[bounds[k] : bounds[k + 1]]
                    grams = np.zeros(len(p), U)
                    for j in range(GRAM):
                        grams += full[p + j] * _ODD[j]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mix(grams).view(np.int64)), pa.array([x.tobytes() for x in right], pa.binary()),
                         pa.array([x.tobytes() for x in left], pa.binary()), pa.array(np.full(len(p), tags[k])),
                         pa.array(p.astype(np.int32))], ["h", "right", "left", "tag", "place"]
                    )

    return rows.mapInArrow(around, schema)


def _side(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(-1, SIDE)


def stretches(
    h: np.ndarray, right: np.ndarray, left: np.ndarray, tag: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For every number of words to the left: the suffixes with a whole stretch of LEAST words, by stretch.

    Yields that number, the suffixes ordered by the stretch's key and the text, the keys, the
    starts of the keys' runs and the lengths of these.
    """
    rights, lefts = np.zeros(len(h), U), np.zeros(len(h), U)  # of the words that the stretch has on that side
    for k in range(SIDE):
        rights += right[:, k].astype(U) * _ODD[k]
    for a in range(SIDE + 1):
        b = SIDE - a
        whole = np.ones(len(h), bool)
        if a:
            lefts += left[:, a - 1].astype(U) * _ODD[a] * _ODD[0]
            rights -= right[:, b].astype(U) * _ODD[b]
            whole &= left[:, a - 1] > 0
        if b:
            whole &= right[:, b - 1] > 0
        rows = np.flatnonzero(whole)
        if not len(rows):
            continue
        key = mix(h.view(U)[rows] ^ mix(lefts[rows] + mix(rights[rows])))
        order = np.lexsort((tag[rows], key))
        rows, key = rows[order], key[order]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        yield a, rows, key, starts, np.diff(np.append(starts, len(key)))


def _pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Table, bool, bool]]:
    """Sorted suffixes in pieces of fewer than 3 * ``size``, cut between beginnings unless one fills a piece.

    With every piece comes whether the run of its first, and that of its last beginning may go on outside.
    """
    held, n, inside = [], 0, True
    for batch in batches:
        for k in range(0, batch.num_rows, size):
            held.append(batch.slice(k, size))
            n += held[-1].num_rows
            if n < size:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            h = table.column("h").to_numpy()
            over = int(np.searchsorted(h, h[-1]))  # the suffixes before the last run
            end = over or n
            yield table.slice(0, end), inside, not over
            held, n, inside = table.slice(end).to_batches(), n - end, not over
    if n:
        yield pa.Table.from_batches(held), inside, True


def _in_common(h: np.ndarray, right: np.ndarray, row: int) -> np.ndarray:
    """How many words to the right every suffix has as the one at ``row`` does; -1 of another beginning."""
    words = np.cumprod(right == right[row], axis=1, dtype=np.int8).sum(axis=1)
    return np.where(h == h[row], words, -1)


def _matched(sorted_suffixes: DataFrame, size: int = PIECE) -> DataFrame:
    """``tag, start, finish`` of stretches shared inside a piece, and the stretches that may be shared across pieces.

    In the order, suffixes of the same beginning and right words are together. So other pieces
    may hold a stretch only if a cut run has its beginning and right words at the boundary.
    Such stretches have a ``key``, and the least and largest text (``low, high``) that the piece
    has it in; ``tag, start, finish`` only where that is one text.
    """
    names = ["tag", "start", "finish", "key", "low", "high"]
    schema = "tag long, start int, finish int, key long, low long, high long"

    def matches(table: pa.Table, before: bool, after: bool) -> Iterator[pa.RecordBatch]:
        h, tag, place = (table.column(c).to_numpy() for c in ("h", "tag", "place"))
        right, left = (_side(table.column(c).to_pylist()) for c in ("right", "left"))
        cut = np.full(len(h), -1)  # stretches of at most this many words to the right may lie outside too
        for row in [0] * before + [-1] * after:
            cut = np.maximum(cut, _in_common(h, right, row))
        hit = np.zeros((len(h), SIDE + 1), bool)
        for a, rows, key, starts, lengths in stretches(h, right, left, tag):
            low, high = tag[rows[starts]], tag[rows[starts + lengths - 1]]
            several, edge = low != high, cut[rows] >= SIDE - a
            hit[rows[np.repeat(several, lengths)], a] = True
            known = several & edge[starts]
            alone = np.flatnonzero(np.repeat(~several, lengths) & edge)
            if known.any():
                nothing = [pa.nulls(int(known.sum()), t) for t in (pa.int64(), pa.int32(), pa.int32())]
                ends = [pa.array(x[known]) for x in (low, high)]
                yield pa.RecordBatch.from_arrays([*nothing, pa.array(key[starts[known]].view(np.int64)), *ends], names)
            if len(alone):
                own, start = pa.array(tag[rows[alone]]), place[rows[alone]] - a
                span = [pa.array(start, pa.int32()), pa.array(start + LEAST, pa.int32())]
                yield pa.RecordBatch.from_arrays([own, *span, pa.array(key[alone].view(np.int64)), own, own], names)
        first, last = hit.copy(), hit.copy()  # of the splits in a row that are shared
        first[:, 1:] &= ~hit[:, :-1]
        last[:, :-1] &= ~hit[:, 1:]
        (row, most), (_, least) = np.nonzero(last), np.nonzero(first)
        if len(row):
            start, finish = place[row] - most, place[row] + LEAST - least
            spans = [pa.array(tag[row]), pa.array(start, pa.int32()), pa.array(finish, pa.int32())]
            yield pa.RecordBatch.from_arrays([*spans, *[pa.nulls(len(row), pa.int64())] * 3], names)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, size):
            yield from matches(*piece)

    return sorted_suffixes.mapInArrow(matched, schema)


def _across(edges: DataFrame) -> DataFrame:
    """The stretches that a piece has in one text only, and another piece in another text.

    A piece has at most one such text for a key, and one row for a key of several texts, so no
    key is met by more rows than there are pieces (and repeats within a text).
    """
    shared = edges.groupBy("key").agg(F.min("low").alias("least"), F.max("high").alias("most")).where("least <> most")
    return edges.where("tag is not null").join(shared, "key", "left_semi").select("tag", "start", "finish")


def _merged(spans):
    """Overlapping or touching stretches of an ordered array as one."""

    def add(done, s):
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["finish"], s["finish"]).alias("finish"))
        return (
            F.when(F.size(done) == 0, F.array(s))
            .when(s["start"] <= last["finish"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)))
            .otherwise(F.concat(done, F.array(s)))
        )

    return F.aggregate(spans, F.array().cast("array<struct<start:int,finish:int>>"), add)


def joined(spans):
    """``start:finish`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["finish"])), ",")


def repeated_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_repeated, spans`` of documents with passages that another has too.

    ``spans`` are word numbers, from 0, the end exclusive.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("doc_id is not null")
    found = materialize(texts_and_suffixes(rows), "suffixes")
    texts = found.where("h is null").select("doc_id", "tag", F.col("n").alias("n_words")).distinct()
    suffixes = found.where("h is not null").select("h", "tag", F.col("n").alias("place"))
    shared = suffixes.groupBy("h").agg(F.min("tag").alias("low"), F.max("tag").alias("high")).where("low <> high")
    # Written, so that the join has plain sides and its hot beginnings can be split.
    shared = materialize(shared.select("h"), "suffix-shared")
    places = suffixes.join(shared, "h", "left_semi").select("tag", "place").distinct()
    places = places.groupBy("tag").agg(F.collect_list("place").alias("places"))  # bounded by the text
    one_of = texts.groupBy("tag").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    one_of = materialize(one_of.join(texts.select("tag", "n_words").distinct(), "tag"), "suffix-texts")
    places = materialize(places.join(one_of.select("tag", "doc_id"), "tag"), "suffix-places")
    few = (places.agg(F.sum(F.size("places"))).first()[0] or 0) <= BROADCAST_POSITIONS
    chosen = rows.join(F.broadcast(places) if few else places, "doc_id").select("text", "tag", "places")
    context = materialize(_contexts(chosen).distinct(), "suffix-contexts")
    keys = ["h", "right", "left", "tag", "place"]
    # By the count, as adaptive merging goes by bytes, and suffixes of one beginning take few when compressed.
    ranges = min(-(-context.count() // RANGE), RANGES)
    dealt = context.repartitionByRange(ranges, *keys) if ranges > 1 else context.repartitionByRange(*keys)
    matched = materialize(_matched(dealt.sortWithinPartitions(*keys), PIECE), "suffix-matches")
    stretched = matched.where("key is null").select("tag", "start", "finish")
    stretched = stretched.unionByName(_across(matched.where("key is not null")))
    copied = one_of.where((F.col("copies") > 1) & (F.col("n_words") >= LEAST))
    stretched = stretched.unionByName(copied.select("tag", F.lit(0).alias("start"), F.col("n_words").alias("finish")))
    spans = stretched.groupBy("tag").agg(F.sort_array(F.collect_set(F.struct("start", "finish"))).alias("spans"))
    spans = spans.select("tag", _merged(F.col("spans")).alias("spans"))
    covered = F.aggregate("spans", F.lit(0), lambda n, s: n + s["finish"] - s["start"])
    return texts.join(spans, "tag").select("doc_id", "n_words", covered.alias("n_repeated"), "spans")
