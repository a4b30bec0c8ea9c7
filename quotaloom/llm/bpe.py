"""Byte-pair encoding with a public vocabulary (problem 7).

A text is cut into pieces by the vocabulary's pattern. Within a piece, a segment tree over the byte positions holds for each
live position the rank of the pair that starts there; its root is the leftmost pair of least rank. A merge takes the
root, kills the right half's position and updates three leaves (the merged one, the dead one, the left neighbour's), each in
logarithmic time. So a piece of n bytes takes O(n log n), also a text of thousands of words without one blank.

Corpus texts repeat their pieces, so each worker keeps a bounded cache from piece to ids; it is a cache only and changes no
result.

Cases: null and empty texts give an empty list. Strings of special tokens are ordinary text. Lone surrogates can't occur in
Parquet strings.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotaloom.workspace import spread_small

#: Fixed value: the public vocabulary's pattern of pieces.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""

#: The same pattern for texts of the characters in ``COMMON`` only, where the standard library's classes agree with it; alternatives
#: that can't match at one place stand in order of their frequency.
PATTERN_COMMON = r""" ?[^\W\d_]+| ?\d+|'(?:s|t|re|ve|m|ll|d)| ?(?:[^\s\w]+(?:_[^\s\w]*)*|_+[^\s\w]*(?:_[^\s\w]*)*)|\s+(?!\S)|\s+"""
COMMON = r"[\t-\r -\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u0300-\u036f\u1e00-\u1eff\u2010-\u2027\u2030-\u205e]*"

NONE = 1 << 62
CACHE_PIECES = 1 << 18
CACHED_CHARS = 64


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece."""
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    whole = ranks.get(piece)
    if whole is not None and n == 2:
        return [whole]
    size = 1 << (n - 1).bit_length()
    tree = [NONE] * (2 * size)
    end = list(range(1, n + 1))  # end[i]: where the token that starts at live position i ends
    before = list(range(-1, n))  # before[i]: the live position left of i
    get = ranks.get
    for i in range(n - 1):
        r = get(piece[i : i + 2])
        if r is not None:
            tree[size + i] = r << 32 | i  # rank first, then position: the minimum is the leftmost
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b

    def put(i: int, value: int) -> None:
        k = size + i
        tree[k] = value
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            least = a if a < b else b
            if tree[k] == least:
                break
            tree[k] = least
            k >>= 1

    def pair(i: int) -> int:
        j = end[i]
        r = get(piece[i : end[j]]) if j < n else None
        return NONE if r is None else r << 32 | i

    while tree[1] != NONE:
        i = tree[1] & 0xFFFFFFFF
        j = end[i]
        end[i] = end[j]
        if end[i] < n:
            before[end[i]] = i
        put(j, NONE)
        put(i, pair(i))
        if before[i] >= 0:
            put(before[i], pair(before[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class _Cache(dict):
    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks

    def __missing__(self, piece: str) -> list[int]:
        ids = merge(piece.encode("utf-8"), self.ranks)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """An encoder from the text of a rank file: lines of base64 token and rank."""

    def __init__(self, rank_file: bytes, pattern: str = PATTERN) -> None:
        self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, rank_file.splitlines()) if t}
        self.cache = _Cache(self.ranks)
        self._pieces = regex.compile(pattern).findall
        common = pattern == PATTERN
        self._common = re.compile(COMMON).fullmatch if common else lambda text: None
        self._pieces_common = re.compile(PATTERN_COMMON).findall

    def pieces(self, text: str) -> list[str]:
        """The pieces of the pattern, which together are the text."""
        return self._pieces_common(text) if self._common(text) else self._pieces(text)

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.cache.__getitem__, self.pieces(text)))) if text else []


_ENCODERS: dict[tuple[int, int], Encoder] = {}


def worker_encoder(rank_file: bytes) -> Encoder:
    """One encoder per worker process and vocabulary."""
    key = (len(rank_file), hash(rank_file))
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(rank_file)
    return _ENCODERS[key]


def broadcast_ranks(spark: SparkSession, path: str):
    """The rank file, read on the driver: executors needn't see the path. Its size is that of the vocabulary."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _first_of_repeats(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """``df`` with each id once. Only ids are shuffled to look for repeats; just rows with repeated ids are compared."""
    rows = df.select(*[F.col(c) for c in columns])
    repeated = rows.groupBy(id_col).count().filter("count > 1").select(id_col)
    if repeated.isEmpty():
        return rows
    single = rows.join(repeated, rows[id_col].eqNullSafe(repeated[id_col]), "left_anti")
    others = [c for c in columns if c != id_col]
    several = rows.join(repeated, rows[id_col].eqNullSafe(repeated[id_col]), "left_semi")
    several = several.groupBy(id_col).agg(F.min(F.struct(*others)).alias("_s")).select(id_col, *[F.col(f"_s.{c}").alias(c) for c in others])
    return single.unionByName(several.select(*columns))


def encode_corpus(df: DataFrame, *, id_col: str, text_col: str, rank_path: str, rows_per_batch: int = 500) -> DataFrame:
    """(id_col, ids) of each id once. Of rows that share an id with different texts, the smallest text counts, null first."""
    file = broadcast_ranks(df.sparkSession, rank_path)
    docs = spread_small(_first_of_repeats(df, id_col, [id_col, text_col]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder(file.value)
        for b in batches:
            for at in range(0, b.num_rows, rows_per_batch):
                part = b.slice(at, rows_per_batch)
                ids = [enc.encode(t) for t in part.column(1).to_pylist()]
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                flat = np.fromiter(chain.from_iterable(ids), np.int32, offsets[-1])
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[id_col, "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return docs.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")
