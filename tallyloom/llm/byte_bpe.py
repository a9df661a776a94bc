"""Byte-level BPE: pattern split, merges by rank, and back.

Each match of the pattern is merged on its own. Its bytes stand in a linked list of parts; every two
neighbours that together are a token wait in the bucket of that token's rank. A bitmap of bitmaps
marks the buckets that hold something, so the lowest rank is found by two find-first-set steps
whatever the length of the match. Entries that an earlier merge has outdated are recognised when
taken and skipped; within a bucket, positions are taken from the left, as the merge order asks.

- Null text: like an empty one, no ids.
- Repeated rows and ids are encoded one by one; no row is dropped.
- Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import base64
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.tables import kept, map_arrow

#: Entries of a worker's cache, and the longest match in characters that it keeps.
CACHE_ENTRIES = 800_000
KEPT_PIECE = 64
OWNER = "byte_bpe"


class RankQueue:
    """Positions by rank; the lowest rank comes first, within a rank the leftmost position.

    One word of 64 bits for 64 ranks says which of their buckets hold positions; ``top`` says which words
    aren't zero. An emptied queue is as new, so one serves all matches.
    """

    __slots__ = ("buckets", "words", "top")

    def __init__(self, ranks: int) -> None:
        self.buckets: list[list[int]] = [[] for _ in range(ranks)]
        self.words = [0] * ((ranks >> 6) + 1)
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets[rank]
        if bucket:
            heappush(bucket, position)
            return
        bucket.append(position)
        word = rank >> 6
        self.words[word] |= 1 << (rank & 63)
        self.top |= 1 << word

    def take(self) -> tuple[int, int]:
        """Removes and returns the first rank and position; the queue must hold some."""
        top = self.top
        word = (top & -top).bit_length() - 1
        bits = self.words[word]
        low = bits & -bits
        rank = (word << 6) + low.bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        self.words[word] = bits ^ low
        if bits == low:
            self.top = top ^ 1 << word
        return rank, bucket.pop()


def merged(piece: bytes, ranks: dict[bytes, int], queue: RankQueue) -> list[int]:
    """The ids of one match of the pattern; ``queue`` is empty before and after."""
    rank_of, push, take = ranks.get, queue.push, queue.take
    rank = rank_of(piece)
    if rank is not None:
        return [rank]
    n = len(piece)
    after = list(range(1, n + 1))
    before = list(range(-1, n))
    expected = [-1] * n  # the rank at which a part and the next one may merge now
    for i in range(n - 1):
        rank = rank_of(piece[i : i + 2])
        if rank is not None:
            expected[i] = rank
            push(rank, i)
    while queue.top:
        rank, i = take()
        if expected[i] != rank:
            continue
        gone = after[i]
        end = after[i] = after[gone]
        expected[i] = expected[gone] = -1
        before[end] = i
        if end < n:
            rank = rank_of(piece[i : after[end]])
            if rank is not None:
                expected[i] = rank
                push(rank, i)
        j = before[i]
        if j >= 0:
            rank = rank_of(piece[j:end])
            if rank is None:
                expected[j] = -1
            else:
                expected[j] = rank
                push(rank, j)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class PieceCache(dict):
    """The encoded ids of matches lately seen, as bytes: two halves, the older one dropped when the newer is full.

    A hit in the newer half is a plain dict lookup. Very long matches are not kept.
    """

    def __init__(self, ranks: dict[bytes, int], entries: int) -> None:
        super().__init__()
        self.ranks, self.half, self.old = ranks, max(1, entries // 2), {}
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = np.array(merged(piece.encode(), self.ranks, self.queue), np.uint32).tobytes()
            if len(piece) > KEPT_PIECE:
                return ids
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class ByteBpe:
    """Encodes and decodes with the ranks of one file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.pieces = regex.compile(pattern).findall
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.cache = PieceCache(ranks, CACHE_ENTRIES)

    @staticmethod
    def load(path: str, pattern: str) -> ByteBpe:
        def read() -> ByteBpe:
            with open(path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            return ByteBpe(ranks, pattern)

        return kept(OWNER, (path, pattern), read)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.cache.__getitem__, self.pieces(text))), np.uint32)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encode_texts(
    df: DataFrame,
    path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    decode: bool = False,
) -> DataFrame:
    """Per row: the id and ``token_ids``; with ``decode`` also ``decoded``, the bytes that the ids stand for."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = ByteBpe.load(path, pattern)
        ids = [bpe.encode(x.as_py() or "") for x in batch.column(1)]
        sizes = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
        columns = [batch.column(0), pa.ListArray.from_arrays(sizes, pa.array(np.concatenate(ids).astype(np.int32)))]
        if decode:
            columns.append(pa.array([bpe.decode(x.tolist()) for x in ids], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, ["id", "token_ids", "decoded"][: len(columns)])

    narrow = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = f"id {dict(narrow.dtypes)['id']}, token_ids array<int>" + ", decoded binary" * decode
    return map_arrow(narrow, work, schema, OWNER).withColumnRenamed("id", id_column)


def decode_ids(df: DataFrame, path: str, pattern: str, id_column: str = "doc_id") -> DataFrame:
    """Per row: the id and ``decoded``, the bytes that ``token_ids`` stand for. Null stays null."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = ByteBpe.load(path, pattern)
        out = [None if x is None else bpe.decode(x) for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "decoded"])

    narrow = df.select(F.col(id_column).alias("id"), "token_ids")
    schema = f"id {dict(narrow.dtypes)['id']}, decoded binary"
    return map_arrow(narrow, work, schema, OWNER).withColumnRenamed("id", id_column)
