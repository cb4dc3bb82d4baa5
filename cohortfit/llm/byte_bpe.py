"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Encoding and decoding are Arrow functions from column to column; a worker loads a rank
file once. The file must be readable at the same path on every machine (it is part of an
installed package, or shipped with ``--files``).

Long texts are cut before encoding where no token can span the cut: before a single
space between two letters or digits. Every match of the split pattern ends there, since
only white space may follow a space inside a match, and a match never holds a letter
followed by a space. So the ids do not change, and no call sees a text much longer than
``PIECE``. A long text without such a place is encoded whole.

Defined results: a NULL or empty text has no ids and decodes to no bytes; strings that
look like special tokens are ordinary text; rows are independent, so repeated rows,
repeated ids and clashing names of other columns play no part.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

#: Characters after which a long text is cut at the next safe place.
PIECE = 100_000

#: Rows that a worker turns into Python objects at a time.
ROWS = 256

_SAFE = re.compile(r"(?<=[^\W_]) (?=[^\W_])")


@lru_cache(maxsize=4)
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def encode_text(encoder: tiktoken.Encoding, text: str, size: int = PIECE) -> list[int]:
    if len(text) <= size:
        return encoder.encode_ordinary(text)
    return [i for piece in pieces(text, size) for i in encoder.encode_ordinary(piece)]


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))


def encode(
    text: Column, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN, *, verify: bool = False
) -> Column:
    """``array<int>`` of token ids; with ``verify``, each text is decoded again in the same worker and compared."""

    def ids_of(encoder: tiktoken.Encoding, text: str) -> np.ndarray:
        ids = encode_text(encoder, text)
        if verify and encoder.decode_bytes(ids) != text.encode():
            raise ValueError("token ids do not decode to the text")
        return np.array(ids, np.int32)

    @F.arrow_udf(T.ArrayType(T.IntegerType(), False))
    def bpe_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = encoding(ranks, pattern)
        for batch in batches:
            lists = [_lists([])]
            for k in range(0, len(batch), ROWS):  # few texts and ids as Python objects at a time
                texts = batch.slice(k, ROWS).to_pylist()
                lists.append(_lists([ids_of(encoder, t or "") for t in texts]))
            yield pa.concat_arrays(lists)

    return bpe_ids(text)


def decode(ids: Column, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> Column:
    """The bytes behind an array of ids; not cast to text, since ids may cut a character."""

    @F.arrow_udf(T.BinaryType())
    def bpe_bytes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = encoding(ranks, pattern)
        for batch in batches:
            texts = [pa.array([], pa.binary())]
            for k in range(0, len(batch), ROWS):
                lists = batch.slice(k, ROWS).to_pylist()
                texts.append(pa.array([encoder.decode_bytes(ids) for ids in lists], pa.binary()))
            yield pa.concat_arrays(texts)

    return bpe_bytes(F.coalesce(ids, F.array().cast("array<int>")))
