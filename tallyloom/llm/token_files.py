"""Token ids in files of compressed byte or bit planes.

A file holds the ids of some documents in a row, cut into blocks of ``BLOCK_IDS``. Each block is
transposed: all lowest bytes (or bits) of its ids, then all next ones, and so on; each plane is
compressed with zstandard on its own, and a plane of zeros takes no bytes. The end of the file holds
the chunk index: where each block's planes lie and how many ids they hold, and each document's id and
count. A reader finds any range of ids from the index and opens only the blocks that it needs.

    magic | plane kind u8 | block ids u32 | planes of all blocks | index (zstd) | index bytes u64 | magic

Documents are range-partitioned by id, so files in order of (part, number) hold them in ascending id;
equal ids stand by a hash of the text, then by text, null ids come first. Files are rows of a table in the
shared folder, written by Spark's committer: a lost executor's files are simply made again.

A null text counts as empty. Every document ends with ``end_id``. Repeated rows are all written.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm.tables import arrow_rows, kept, map_arrow, written

MAGIC = b"IDPLANE1"
BYTE_PLANES, BIT_PLANES = 0, 1
BLOCK_IDS, FILE_IDS = 1 << 16, 1 << 22
LEVEL = 3
OWNER = "token_files"
#: Words that a worker remembers.
CACHE_WORDS = 1_000_000
#: Up to here letters are composed, and lowered one by one whatever stands beside them.
LAST_LATIN = "\u024f"
#: A run of letters and then ASCII marks, without the apostrophe that may begin an ending.
LETTERS_AND_MARKS = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)").fullmatch
HEAD, BLOCK = struct.Struct("<8sBI"), struct.Struct("<QI")


def to_planes(ids: np.ndarray, kind: int) -> np.ndarray:
    """One row per plane, lowest first."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if kind == BYTE_PLANES:
        return planes
    bits = np.unpackbits(planes, axis=1, bitorder="little").reshape(4, -1, 8)
    return np.packbits(bits.transpose(0, 2, 1).reshape(32, -1), axis=1, bitorder="little")


def from_planes(planes: np.ndarray, n: int, kind: int) -> np.ndarray:
    if kind == BIT_PLANES:
        bits = np.unpackbits(planes, axis=1, count=n, bitorder="little").reshape(4, 8, n)
        planes = np.packbits(bits.transpose(0, 2, 1).reshape(4, -1), axis=1, bitorder="little")
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def file_bytes(
    ids: np.ndarray, documents: list[int | None], counts: list[int], kind: int = BYTE_PLANES, block_ids: int = BLOCK_IDS
) -> bytes:
    """A whole file; ``counts`` are the ids of each document."""
    press = zstandard.ZstdCompressor(level=LEVEL).compress
    parts, index, at = [HEAD.pack(MAGIC, kind, block_ids)], [], HEAD.size
    for start in range(0, len(ids), block_ids):
        block = ids[start : start + block_ids]
        planes = [press(plane.tobytes()) if plane.any() else b"" for plane in to_planes(block, kind)]
        index.append(BLOCK.pack(at, len(block)) + struct.pack(f"<{len(planes)}I", *map(len, planes)))
        parts += planes
        at += sum(map(len, planes))
    known = np.array([x is not None for x in documents], np.uint8)
    names = np.array([x or 0 for x in documents], "<i8")
    whole = struct.pack("<QQ", len(index), len(documents)) + b"".join(index)
    whole = press(whole + known.tobytes() + names.tobytes() + np.array(counts, "<u8").tobytes())
    return b"".join([*parts, whole, struct.pack("<Q", len(whole)), MAGIC])


class TokenFile:
    """A file's index, and any range of its ids."""

    def __init__(self, data: bytes) -> None:
        magic, self.kind, self.block_ids = HEAD.unpack_from(data)
        size = struct.unpack_from("<Q", data, len(data) - 16)[0]
        if magic != MAGIC or data[-8:] != MAGIC:
            raise ValueError("not a token file, or cut off")
        whole = zstandard.decompress(data[len(data) - 16 - size : len(data) - 16])
        blocks, documents = struct.unpack_from("<QQ", whole)
        planes = 32 if self.kind == BIT_PLANES else 4
        width = BLOCK.size + 4 * planes
        self.data, at = data, 16 + blocks * width
        self.blocks = [
            (*BLOCK.unpack_from(whole, 16 + i * width), struct.unpack_from(f"<{planes}I", whole, 16 + i * width + BLOCK.size))
            for i in range(blocks)
        ]
        known = np.frombuffer(whole, np.uint8, documents, at)
        names = np.frombuffer(whole, "<i8", documents, at + documents)
        self.counts = np.frombuffer(whole, "<u8", documents, at + 9 * documents).astype(np.int64)
        self.documents = [int(x) if k else None for k, x in zip(known, names)]

    def block(self, i: int) -> np.ndarray:
        at, n, sizes = self.blocks[i]
        width = n if self.kind == BYTE_PLANES else (n + 7) // 8
        planes = np.zeros((len(sizes), width), np.uint8)
        for plane, size in zip(planes, sizes):
            if size:
                plane[:] = np.frombuffer(zstandard.decompress(self.data[at : at + size]), np.uint8)
            at += size
        return from_planes(planes, n, self.kind)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file, from the blocks that hold them."""
        if stop <= start:
            return np.empty(0, "<u4")
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        ids = np.concatenate([self.block(i) for i in range(first, last + 1)])
        return ids[start - first * self.block_ids : stop - first * self.block_ids]


def byte_letters() -> dict[int, str]:
    """The byte-level letter of each byte: itself if it can be printed, else the next from 256 on."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [x for x in range(256) if x not in printed]
    return {x: chr(x) for x in printed} | {x: chr(256 + i) for i, x in enumerate(others)}


class WordIds(dict):
    """The ids of words as bytes, those lately seen: two halves, the older dropped when the newer is full.

    The tokenizer drops white space and looks at nothing beyond it, so a text's ids are those of its words
    in a row. A word of Latin letters goes straight to the tokenizer's merges, lowered and as byte-level
    letters, as its own normalizer and splitter would pass it on; ASCII marks after it are a piece of their
    own. All other words go through the whole tokenizer, those with a special token's mark among them: it
    gets that token's id, as the library gives it by default.
    """

    LETTERS = byte_letters()

    def __init__(self, path: str, entries: int = CACHE_WORDS) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.half, self.old = max(1, entries // 2), {}

    @staticmethod
    def load(path: str) -> WordIds:
        return kept(OWNER, path, lambda: WordIds(path))

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._ids(word)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self._run(word.lower())
        match = LETTERS_AND_MARKS(word)
        run = match[1].lower() if match else ""
        if not run.isalpha() or max(run) > LAST_LATIN:
            return self._whole(word)
        if match[2]:
            marks = match[2]
            return (self.get(run) or self.old.get(run) or self._run(run)) + (self.get(marks) or self._whole(marks))
        return self._run(run)

    def _run(self, run: str) -> bytes:
        letters = run if run.isascii() else run.encode().decode("latin-1").translate(self.LETTERS)
        return array("I", [token.id for token in self.merges(letters)]).tobytes()

    def _whole(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()


def encode_files(
    df: DataFrame,
    encoder: Callable[[], Callable[[str], bytes]],
    end_id: int,
    parts: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    kind: int = BYTE_PLANES,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Rows (part, number, n_documents, n_ids, payload): a file each, of about ``file_ids`` ids.

    ``encoder`` is called in each task and returns what makes a text's ids, as little-endian bytes. Write
    the result before reading it more than once: the partitions' limits are sampled anew with each run.
    """
    end = np.array([end_id], "<u4").tobytes()
    tie = F.xxhash64("text")
    ordered = (
        df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
        .repartitionByRange(parts, F.col("id").asc_nulls_first(), tie)
        .sortWithinPartitions(F.col("id").asc_nulls_first(), tie, F.col("text").asc_nulls_first())
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, encode = TaskContext.get().partitionId(), 0, encoder()
        names: list[int | None] = []
        pieces: list[bytes] = []
        total = 0

        def file() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(pieces), "<u4")
            payload = file_bytes(ids, names, [len(x) // 4 for x in pieces], kind)
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "number": pa.array([number], pa.int32()),
                    "n_documents": pa.array([len(names)], pa.int64()),
                    "n_ids": pa.array([len(ids)], pa.int64()),
                    "payload": pa.array([payload], pa.binary()),
                }
            )

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                pieces.append(encode(text.as_py() or "") + end)
                names.append(name)
                total += len(pieces[-1]) // 4
                if total >= file_ids:
                    yield file()
                    number, total, names, pieces = number + 1, 0, [], []
        if names:
            yield file()

    return arrow_rows(ordered, run, "part int, number int, n_documents long, n_ids long, payload binary", OWNER)


def read_files(files: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per document: id, ``start`` (ids of all documents before it), ``n_tokens``, ``ids`` (little-endian bytes).

    Where a file starts is a running sum over the table of files, one narrow row each; written, so that
    Spark knows its size when it picks the join.
    """
    earlier = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("part", "number", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("file_start"))
    starts = written(starts, "file-starts")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for part, number, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
            file = TokenFile(payload)
            ids = file.read(0, int(file.counts.sum())).astype("<u4").tobytes()
            at = 0
            for name, n in zip(file.documents, file.counts.tolist()):
                out.append((part, number, name, at, n, ids[4 * at : 4 * (at + n)]))
                at += n
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        columns = [pa.array(x, k) for x, k in zip(zip(*out), kinds)]
        return pa.RecordBatch.from_arrays(columns, ["part", "number", "id", "at", "n_tokens", "ids"])

    schema = "part int, number int, id long, at long, n_tokens long, ids binary"
    rows = map_arrow(files.select("part", "number", "payload"), work, schema)
    return rows.join(starts, ["part", "number"]).select(
        F.col("id").alias(id_column), (F.col("file_start") + F.col("at")).alias("start"), "n_tokens", "ids"
    )
