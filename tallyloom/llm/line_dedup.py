"""Deduplication of lines that many documents share, by probing a sharded minimal perfect hash.

A line's key is the line without white space at its ends, A-Z lower-cased. Keys that are long enough and
stand in enough documents lose all their lines, but for those of the document with the largest id.

1. Each document gives the distinct 128-bit hashes of its long keys; Spark counts for each hash its
   documents and the largest id. Partial sums come before the shuffle, so a line on a third of all
   documents is one row per task.
2. Hashes found more than once are dealt to shards. A shard builds a minimal perfect hash of its own: in
   each of its levels a hash that has a bit to itself keeps it, the others go on to the next level, and
   the rank of a bit is the slot in the shard's arrays: fingerprints (64 bits), numbers of documents, and
   who is the largest id. Hashes found once need no slot, as no fingerprint matches them.
3. Documents send their hashes to the shards, which look them up in the arrays; no line meets another
   line. A shard that expects many probes is copied, and documents are dealt to the copies by their own
   hash, so that the documents of one line spread. What comes back is each document's dropped lines.

Shards hold about ``SHARD_KEYS`` hashes until there are ``MOST_SHARDS``, and grow then; copies get at least
``PROBES`` probes and four times as many as the shard has hashes. The driver holds the number of copies of
each shard, at most ``MOST_SHARDS`` numbers. A document's lines are dropped in the task that has its text.

- Null or empty text: one empty line, which is too short to go.
- All lines dropped: empty text.
- Null id: smaller than any other. Rows that share the largest id all keep the line.
- Repeated rows each count as a document.
- Very long texts and lines are hashed as a whole. No rows: no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.tables import SPACE_BYTES, map_arrow, text_buffers, written
from tallyloom.llm.words import mixed
from tallyloom.workspace import ship_package

LEAST_CHARS, LEAST_DOCUMENTS = 40, 5
SHARD_KEYS, MOST_SHARDS, PROBES = 1 << 10, 1 << 16, 1 << 12
#: Bits per hash that is still without a slot, in each level.
ROOM = 2
_STEP = 0x9E3779B97F4A7C15


def lines_of(data: np.ndarray, at: np.ndarray) -> Iterator[list[bytes]]:
    for begin, end in zip(at[:-1], at[1:]):
        yield data[begin:end].tobytes().split(b"\n")


def line_hash(line: bytes, least_chars: int) -> bytes | None:
    """The hash of the line's key; None if that is too short."""
    key = line.strip(SPACE_BYTES).lower()
    if len(key) < least_chars or (len(key) < 4 * least_chars and len(key.decode(errors="replace")) < least_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def document_hashes(texts: pa.Array, least_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row of each distinct hash of each text, and the hash as two numbers."""
    rows, found = [], []
    for row, lines in enumerate(lines_of(*text_buffers(texts))):
        hashes = {h for line in lines if (h := line_hash(line, least_chars))}
        found += hashes
        rows.append((row, len(hashes)))
    halves = np.frombuffer(b"".join(found), "<u8").reshape(-1, 2)
    texts_of, counts = np.array(rows, np.int64).reshape(-1, 2).T
    return np.repeat(texts_of, counts), halves[:, 0], halves[:, 1]


def _place(first: np.ndarray, second: np.ndarray, level: int, bits: int) -> np.ndarray:
    seed = np.uint64((level + 1) * _STEP % (1 << 64))
    return (mixed(first ^ mixed(second + seed)) % np.uint64(bits)).astype(np.int64)


@dataclass
class LineIndex:
    """Arrays over distinct hashes, in the slots of a minimal perfect hash.

    ``levels`` holds the number of bits of each level, ``bits`` those of all levels in a row.
    """

    levels: np.ndarray
    bits: np.ndarray
    fingerprints: np.ndarray
    counts: np.ndarray
    owners: np.ndarray

    @classmethod
    def build(cls, first: np.ndarray, second: np.ndarray, counts: np.ndarray, owners: np.ndarray) -> LineIndex:
        levels, bits = [], []
        left = np.arange(len(first))
        while len(left):
            size = max(64, ROOM * len(left))
            place = _place(first[left], second[left], len(levels), size)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(size)
            bits.append(alone)
            left = left[~alone[place]]
        index = cls(np.array(levels, np.int64), np.concatenate([*bits, np.zeros(0, bool)]), *[np.zeros(0)] * 3)
        slot = index.slots(first, second)
        index.fingerprints, index.counts, index.owners = (np.empty(len(first), t) for t in ("<u8", "<i8", "<i8"))
        index.fingerprints[slot], index.counts[slot], index.owners[slot] = second, counts, owners
        return index

    def slots(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The slot of each hash that was built in, any slot or -1 for others."""
        rank = np.cumsum(self.bits) - 1
        out = np.full(len(first), -1)
        left, start = np.arange(len(first)), 0
        for level, size in enumerate(self.levels):
            place = start + _place(first[left], second[left], level, size)
            hit = self.bits[place]
            out[left[hit]] = rank[place[hit]]
            left, start = left[~hit], start + size
        return out

    def found(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of documents of each hash, 0 if it isn't there, and who has the largest id."""
        slot = self.slots(first, second)
        if not len(self.fingerprints):
            return np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
        known = (slot >= 0) & (self.fingerprints[slot] == second)
        return np.where(known, self.counts[slot], 0), self.owners[slot]

    def arrays(self) -> dict[str, bytes]:
        return {
            "levels": self.levels.astype("<i8").tobytes(),
            "bits": np.packbits(self.bits).tobytes(),
            "fingerprints": self.fingerprints.tobytes(),
            "counts": self.counts.tobytes(),
            "owners": self.owners.tobytes(),
        }

    @classmethod
    def read(cls, arrays: dict[str, bytes]) -> LineIndex:
        levels = np.frombuffer(arrays["levels"], "<i8")
        bits = np.unpackbits(np.frombuffer(arrays["bits"], np.uint8), count=int(levels.sum())).astype(bool)
        numbers = [np.frombuffer(arrays[x], t) for x, t in (("fingerprints", "<u8"), ("counts", "<i8"), ("owners", "<i8"))]
        return cls(levels, bits, *numbers)


ARRAYS = ("levels", "bits", "fingerprints", "counts", "owners")


def counted_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """From (id, text): a written row per distinct hash: its two numbers, ``n`` documents, a hash of the largest id."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, first, second = document_hashes(batch.column(1), least_chars)
        columns = [batch.column(0).take(pa.array(row)), pa.array(first.view(np.int64)), pa.array(second.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, ["id", "first", "second"])

    found = map_arrow(docs.select("id", "text"), work, f"id {dict(docs.dtypes)['id']}, first long, second long")
    counts = found.groupBy("first", "second").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("largest"))
    return written(counts.select("first", "second", "n", F.xxhash64("largest").alias("owner")), "line-counts")


def sharded_index(counts: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """A written row of arrays per shard and copy, and the number of copies of each shard."""
    spark = counts.sparkSession
    ship_package(spark)
    shards = max(1, min(MOST_SHARDS, -(-counts.count() // SHARD_KEYS)))
    dealt = counts.withColumn("shard", F.pmod("first", F.lit(shards)).cast("int"))
    expected = dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("hashes"), F.sum("n").alias("probes")).toArrow()
    copies = np.ones(shards, np.int64)
    probes, hashes = expected["probes"].to_numpy(), expected["hashes"].to_numpy()
    copies[expected["shard"].to_numpy()] = -(-probes // np.maximum(PROBES, 4 * hashes))

    def build(part: pa.Table) -> pa.Table:
        first, second, n, owner = (part[x].to_numpy() for x in ("first", "second", "n", "owner"))
        arrays = LineIndex.build(first.view(np.uint64), second.view(np.uint64), n, owner).arrays()
        shard = part["shard"][0].as_py()
        row = {"shard": shard, "copies": int(shared.value[shard])} | arrays
        return pa.Table.from_pylist([row], pa.schema([("shard", pa.int32()), ("copies", pa.int32()), *[(x, pa.binary()) for x in ARRAYS]]))

    shared = spark.sparkContext.broadcast(copies)
    schema = "shard int, copies int, " + ", ".join(f"{x} binary" for x in ARRAYS)
    index = written(dealt.where("n > 1").groupBy("shard").applyInArrow(build, schema), "line-index")
    return index.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies"), copies


def dropped_lines(docs: DataFrame, index: DataFrame, copies: np.ndarray, least_chars: int, least_documents: int) -> DataFrame:
    """From (id, text, key): per key with any, the hashes of the lines it loses."""
    shared = docs.sparkSession.sparkContext.broadcast(copies)

    def probes(batch: pa.RecordBatch) -> pa.RecordBatch:
        copies = shared.value
        row, first, second = document_hashes(batch.column(2), least_chars)
        shard = (first.view(np.int64) % len(copies)).astype(np.int32)
        keys = np.frombuffer(b"".join(x.as_py()[:8] for x in batch.column(0)), "<u8")
        copy = (keys[row] % copies[shard].astype(np.uint64)).astype(np.int32)
        taken = [c.take(pa.array(row)) for c in (batch.column(0), batch.column(1))]
        halves = [pa.array(x.view(np.int64)) for x in (first, second)]
        return pa.RecordBatch.from_arrays([pa.array(shard), pa.array(copy), *taken, *halves], ["shard", "copy", "key", "owner", "first", "second"])

    def look_up(probed: pa.Table, arrays: pa.Table) -> pa.Table:
        if not arrays.num_rows or not probed.num_rows:
            return pa.table({"key": pa.array([], pa.binary()), "line": pa.array([], pa.binary())})
        index = LineIndex.read({x: arrays[x][0].as_py() for x in ARRAYS})
        first, second = (probed[x].to_numpy().view(np.uint64) for x in ("first", "second"))
        n, largest = index.found(first, second)
        lost = np.flatnonzero((n >= least_documents) & (probed["owner"].to_numpy() != largest))
        lines = np.stack([first[lost], second[lost]], axis=1).astype("<u8").tobytes()
        hashes = pa.array([lines[i : i + 16] for i in range(0, len(lines), 16)], pa.binary())
        return pa.table({"key": probed["key"].combine_chunks().take(pa.array(lost)), "line": hashes})

    narrow = docs.select("key", F.xxhash64("id").alias("owner"), "text")
    sent = map_arrow(narrow, probes, "shard int, copy int, key binary, owner long, first long, second long")
    lost = sent.groupBy("shard", "copy").cogroup(index.groupBy("shard", "copy")).applyInArrow(look_up, "key binary, line binary")
    return lost.groupBy("key").agg(F.collect_set("line").alias("lost"))


def dedup_lines(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_chars: int = LEAST_CHARS,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """Per row: id, ``kept`` (the text without its dropped lines), ``n_lines`` (before), ``n_dropped``."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    key = F.unhex(F.md5(F.concat_ws("/", F.coalesce(F.col(id_column).cast("string"), F.lit("null")), text)))
    docs = df.select(F.col(id_column).alias("id"), text.alias("text"), key.alias("key"))
    index, copies = sharded_index(counted_lines(docs, least_chars))
    lost = written(dropped_lines(docs, index, copies, least_chars, least_documents), "dropped-lines")

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, n_lines, n_dropped = [], [], []
        for lines, lost in zip(lines_of(*text_buffers(batch.column(1))), batch.column(2)):
            lost = set(lost.as_py() or ())
            stay = [x for x in lines if line_hash(x, least_chars) not in lost] if lost else lines
            kept.append(b"\n".join(stay))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        texts = pa.array(kept, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), texts, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
            ["id", "kept", "n_lines", "n_dropped"],
        )

    whole = docs.join(lost, "key", "left").select("id", "text", "lost")
    kind = dict(docs.dtypes)["id"]
    return map_arrow(whole, keep, f"id {kind}, kept string, n_lines long, n_dropped long").withColumnRenamed("id", id_column)
