"""Token ids in files of independent zstandard frames.

A file holds one frame per document (its ids as little-endian unsigned 32-bit integers),
then two skippable frames: the document ids, and a seek table with the sizes and a
checksum of every frame, ending in a fixed footer. A reader seeks to the footer, reads
the two tables and decompresses only the frames it wants; any zstandard tool can
decompress the whole file.

Writing is one Spark job: documents are dealt over ranges of ids, sorted, encoded and
written by the tasks, one file per range and attempt. Names are unique to the attempt
and only those in the returned manifest count, so a lost or repeated task does no harm.

The strings of special tokens in a text become their ids, as in the library's plain call.

Defined results: a NULL or empty text has only the end id; rows without an id are left
out; rows that repeat an id follow each other in order of their text; an empty table
gives an empty manifest. Only the id and text columns are read.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortfit.llm.batches import materialize
from cohortfit.session import shared_dir

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1

# Fixed values of the seekable zstandard format: magic numbers of a skippable frame and
# of the footer, and the descriptor bit for checksums.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80
#: Magic number of the skippable frame with the document ids (the format allows 0x184D2A50 to 0x184D2A5F).
DOC_IDS = 0x184D2A51

#: Pieces a worker remembers; it forgets all when there are more, so memory stays bounded.
REMEMBERED = 300_000
#: Characters of texts encoded together; a longer text is taken alone.
SLICE = 1 << 19

MANIFEST = "path string, first_id long, n_docs long, n_tokens long"

_SPACE, _LETTER, _DIGIT, _MARK, _OTHER = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[33:127] = _MARK
_CLASS[[32, *range(9, 14)]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[[*range(65, 91), *range(97, 123)]] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Lead byte of U+00C0 to U+00FF, and the second bytes of the two of them that are no letters.
_LATIN, _NO_LETTERS = 0xC3, (0x97, 0xB7)
#: What the tokenizer's split pattern cuts off as one piece after an apostrophe.
_ENDINGS = {1: "stmd", 2: ("re", "ve", "ll")}


def _shifted(x: np.ndarray, k: int) -> np.ndarray:
    """``x[i + k]`` at place i; 0 beyond the end."""
    out = np.zeros_like(x)
    out[: max(0, len(x) - k)] = x[k:]
    return out


def pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places where the pieces of a text begin, which of them are whole words, and the bytes to encode.

    A word of letters (ASCII and U+00C0 to U+00FF), digits and marks is cut as the tokenizer
    cuts it and taken in lower case. Any other word (further scripts, combining marks,
    control characters, what may be a special token) is one piece and left as it is.
    """
    kind = _CLASS[data]
    latin = data == _LATIN
    after_latin = np.append(False, latin[:-1])
    following = _shifted(data, 1)
    letter = (latin & ~np.isin(following, _NO_LETTERS)) | (after_latin & ~np.isin(data, _NO_LETTERS))
    kind[letter] = _LETTER
    space = kind == _SPACE
    odd = (kind == _OTHER) | ((data == ord("<")) & (following == ord("|")))
    lower = _LOWER[data]
    lower[after_latin & letter & (data < 0x9F)] += 0x20

    first = ~space
    first[1:] &= space[:-1]
    begin = ~space & (kind == _DIGIT)
    begin[1:] |= ~space[1:] & (kind[1:] != kind[:-1])
    mark_before = np.append(False, kind[:-1] == _MARK)
    apostrophe = np.flatnonzero((data == ord("'")) & ~mark_before)
    one, two = _shifted(lower, 1)[apostrophe], _shifted(lower, 2)[apostrophe]
    short = np.isin(one, [ord(c) for c in _ENDINGS[1]])
    long = np.zeros(len(one), bool)
    for a, b in _ENDINGS[2]:
        long |= (one == ord(a)) & (two == ord(b))
    for chosen, size in ((short, 1), (long & ~short, 2)):
        at = apostrophe[chosen]
        begin[at + 1] = False
        at = at + size + 1
        at = at[at < len(data)]
        begin[at] = ~space[at]
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(data))
    found = np.concatenate([[0], np.cumsum(odd)])
    whole = found[ends] > found[starts]
    for a, b in zip(starts[whole].tolist(), ends[whole].tolist()):
        lower[a:b] = data[a:b]
        begin[a:b] = False
    begin |= first
    whole_at = np.zeros(len(data), bool)
    whole_at[starts[whole]] = True
    begins = np.flatnonzero(begin)
    return begins, whole_at[begins], lower


class PieceEncoder:
    """Encodes texts through the tokenizers library, each different piece once.

    The tokenizer drops white space and merges within pieces only, so the ids of a text are
    those of its pieces in order. Pieces are found for many texts at once, made distinct by
    Arrow's exact dictionary, and only those not met before go to the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The ids that end a piece: the vocabulary marks them with the end-of-word suffix.
        vocabulary = self.tokenizer.get_vocab()
        suffix = self.tokenizer.model.end_of_word_suffix
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.starts, self.lengths, self.used = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def _store(self, texts: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n = len(self.codes)
        while n + len(texts) > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.lengths[n : n + len(texts)] = lengths
        self.starts[n : n + len(texts)] = self.used + np.cumsum(lengths) - lengths
        self.codes.update(zip(texts, range(n, n + len(texts))))
        self.used += len(ids)

    def _learn(self, plain: list[str], words: list[str]) -> None:
        if plain:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, np.int64)
            last = np.flatnonzero(self.ends[ids])
            if len(last) == len(plain):
                self._store(plain, ids, np.diff(np.append(-1, last)))
            else:  # a tokenizer without end-of-word tokens
                words = plain + words
        if words:
            got = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            flat = np.fromiter((i for ids in got for i in ids), np.int64)
            self._store(words, flat, np.array([len(ids) for ids in got], np.int64))

    def _part(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoded = [t.encode() for t in texts]
        data = np.frombuffer(b"\n".join([*encoded, b""]), np.uint8)  # a separator after every text
        bounds = np.concatenate([[0], np.cumsum([len(e) + 1 for e in encoded])])
        begins, whole, lower = pieces(data)
        solid = _CLASS[data] != _SPACE
        offsets = np.concatenate([[0], np.cumsum(solid)])[np.append(begins, len(data))].astype(np.int32)
        strings = pa.StringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(lower[solid]))
        distinct = strings.dictionary_encode()
        kinds, places = distinct.dictionary.to_pylist(), distinct.indices.to_numpy()
        is_whole = np.zeros(len(kinds), bool)
        is_whole[places[whole]] = True
        plain, words = [], []
        for text, odd in zip(kinds, is_whole.tolist()):
            if text not in self.codes:
                (words if odd else plain).append(text)
        self._learn(plain, words)
        codes = np.fromiter(map(self.codes.__getitem__, kinds), np.int64, len(kinds))[places]
        lengths = self.lengths[codes]
        ends = np.cumsum(lengths)
        if not len(ends):
            return np.empty(0, np.uint32), np.zeros(len(bounds), np.int64)
        flat = self.flat[np.repeat(self.starts[codes] - (ends - lengths), lengths) + np.arange(ends[-1])]
        return flat, np.concatenate([[0], ends])[np.searchsorted(begins, bounds)]

    def __call__(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of consecutive texts, some megabytes of text at a time, and their bounds."""
        k = 0
        while k < len(texts):
            if len(self.codes) > REMEMBERED:
                self.forget()
            stop, size = k, 0
            while stop < len(texts) and (stop == k or size + len(texts[stop]) <= SLICE):
                size += len(texts[stop])
                stop += 1
            yield self._part(texts[k:stop])
            k = stop


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The end id after every document."""
    shift = np.arange(len(bounds))
    out = np.full(len(ids) + len(bounds) - 1, end_id, "<u4")
    out[np.arange(len(ids)) + np.repeat(shift[:-1], np.diff(bounds))] = ids
    return out, bounds + shift


class FrameWriter:
    """Writes frames to an open binary file and the tables at the end."""

    def __init__(self, out):
        self.out, self.entries, self.ids = out, [], []
        self.compressor = zstandard.ZstdCompressor(level=1, write_checksum=False)

    def add(self, doc_id: int, data: bytes | memoryview) -> None:
        frame = self.compressor.compress(data)
        self.out.write(frame)
        self.entries.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.ids.append(doc_id)

    def finish(self) -> None:
        ids = np.array(self.ids, "<i8").tobytes()
        table = np.array(self.entries, "<u4").tobytes() + struct.pack("<IBI", len(self.ids), CHECKSUMS, SEEKABLE)
        for magic, body in ((DOC_IDS, ids), (SKIPPABLE, table)):
            self.out.write(struct.pack("<II", magic, len(body)))
            self.out.write(body)


class FrameReader:
    """Random access to the documents of one file."""

    def __init__(self, source):
        self.source, size = source, source.size()
        source.seek(size - 9)
        frames, descriptor, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE or descriptor != CHECKSUMS:
            raise ValueError("not a file of seekable frames")
        table = size - 9 - 12 * frames
        source.seek(table - 8 - 8 * frames)
        self.ids = np.frombuffer(source.read(8 * frames), "<i8")
        source.seek(table)
        self.entries = np.frombuffer(source.read(12 * frames), "<u4").reshape(frames, 3)
        self.starts = np.concatenate([[0], np.cumsum(self.entries[:, 0], dtype=np.int64)])
        self.decompressor = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.ids)

    def read(self, k: int) -> bytes:
        """The bytes of frame ``k``; raises if its checksum differs."""
        size, length, checksum = (int(x) for x in self.entries[k])
        self.source.seek(int(self.starts[k]))
        data = self.decompressor.decompress(self.source.read(size), max_output_size=max(length, 1))
        if len(data) != length or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} is damaged")
        return data


def _place(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_tokens(
    docs: DataFrame,
    folder: str | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
) -> DataFrame:
    """Encode and write all documents in order of their ids; returns the saved manifest.

    ``folder`` is a URI that every executor reaches (default: the session's shared folder).
    """
    folder = folder or f"{shared_dir(docs.sparkSession)}/cohortfit/tokens-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out, tokens, writer = piece_encoder(tokenizer), None, 0, None
        name = f"{folder}/{uuid.uuid4().hex}.zst"
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                system, path = _place(name)
                system.create_dir(os.path.dirname(path), recursive=True)
                out = system.open_output_stream(path, compression=None)
                writer = FrameWriter(out)
            doc_ids, k = batch.column(0).to_pylist(), 0
            for ids, bounds in encoder([t or "" for t in batch.column(1).to_pylist()]):
                ids, bounds = with_end(ids, bounds, end_id)
                data, edges = memoryview(ids.tobytes()), (bounds * 4).tolist()
                for a, b in zip(edges, edges[1:]):
                    writer.add(doc_ids[k], data[a:b])
                    k += 1
                tokens += len(ids)
        if out is not None:
            writer.finish()
            out.close()
            row = {"path": [name], "first_id": [writer.ids[0]], "n_docs": [len(writer.ids)], "n_tokens": [tokens]}
            yield pa.RecordBatch.from_pydict(row)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    dealt = rows.where("doc_id is not null").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return materialize(dealt.mapInArrow(write, MANIFEST), "token-manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """Adds ``start``, the number of ids in all earlier files, and ``number``, that of the files before.

    Running totals in two levels: inside ranges of files, and over the ranges.
    """
    dealt = manifest.repartitionByRange("first_id").withColumn("block", F.spark_partition_id())
    dealt = materialize(dealt, "token-files")
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("block").orderBy("first_id", "path").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda column, window: F.coalesce(F.sum(column).over(window), F.lit(0))
    blocks = dealt.groupBy("block").agg(F.sum("n_tokens").alias("total"), F.count("*").alias("files"))
    blocks = blocks.select("block", earlier("total", before).alias("base"), earlier("files", before).alias("first"))
    return dealt.join(blocks, "block").select(
        "path",
        "n_docs",
        (F.col("base") + earlier("n_tokens", inside)).alias("start"),
        (F.col("first") + F.count("*").over(inside)).cast("int").alias("number"),
    )


def read_tokens(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, read back from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                system, place = _place(path)
                with system.open_input_file(place) as source:
                    reader = FrameReader(source)
                    for k in range(0, len(reader), 256):
                        ids = [np.frombuffer(reader.read(i), "<u4") for i in range(k, min(k + 256, len(reader)))]
                        lengths = np.array([len(x) for x in ids], np.int64)
                        ends = np.cumsum(lengths)
                        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                        flat = pa.array(np.concatenate(ids).astype(np.int32))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(reader.ids[k : k + 256]),
                                pa.array(start + ends - lengths),
                                pa.array(lengths),
                                pa.ListArray.from_arrays(offsets, flat),
                            ],
                            ["doc_id", "start", "n_tokens", "ids"],
                        )
                        start += int(ends[-1])

    files = with_starts(manifest)
    each = files.repartitionById(max(1, manifest.count()), F.col("number"))  # one file a task
    return each.mapInArrow(read, "doc_id long, start long, n_tokens long, ids array<int>")


def ids_crc32(ids):
    """CRC-32 of an array of ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("long")
    def crc(batch: pa.Array) -> pa.Array:
        flat, ends = batch.flatten().to_numpy(zero_copy_only=False).astype("<u4"), batch.offsets.to_numpy()
        ends = ends - ends[0] if len(ends) else ends
        return pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends, ends[1:])], pa.int64())

    return crc(ids)
