"""Importance resampling towards a target corpus, by hashed runs of words.

A document's features are its runs of 1 to ``order`` words in a row, each hashed to a bucket by the CRC-32
of its text. A bucket's gain is the logarithm of how much more often the target corpus uses it than the
documents do; a document's weight is the mean gain of its features. Adding a Gumbel draw per document and
taking the highest scores samples without replacement in proportion to the exponential of the weight.

No run of words is ever put together: a document is scanned once, in the form in which one space separates
its words, and the CRC of everything before each word and up to its end is kept. The CRC of a run that
begins at s and ends at e is crc(up to e) xor crc(up to s) shifted by the e - s bytes of the run; the shift
is linear over GF(2), so it cancels what stands before the run. Shifts by up to 63 bytes and by larger
powers of two are tables of 4 x 256 entries, and all runs of a batch are shifted together.

Counts are over all documents. The driver holds one number per bucket, whatever the input. Ranks come from
a sort by range, so no task sees all documents, and ties are cut like any other rows.

- Null text, or one without words: no features, weight 0, never drawn.
- Very long texts are scanned in slices, so memory does not follow the text.
- Null id: hashed as ``null``, last among equal scores. Repeated rows are documents of their own.
- No documents: no rows. No target text: gains tell how rare a bucket is. Only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.ranking import with_place
from tallyloom.llm.tables import arrow_rows, map_arrow, text_buffers, written

#: Words, after A-Z have become a-z, and what stands between them.
TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
#: A word of the normalised text, with the space before it.
PARTED = re.compile(rb" ?[^ ]+")
#: Fixed value: the polynomial of CRC-32, its lowest power in the highest bit.
POLYNOMIAL = np.uint32(0xEDB88320)
#: Binary digits of the shifts that have a table each.
FEW = 6
#: Bytes of a text and words that are worked on at once.
SLICE, PIECE = 1 << 22, 1 << 20


@dataclass(frozen=True)
class Rules:
    """Longest run of words, buckets, least words of a document that may be drawn, share to draw, seed."""

    order: int = 2
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 25
    seed: int = 7


def _moved(crc: np.ndarray, tables: np.ndarray, which: np.ndarray | int = 0) -> np.ndarray:
    """Each CRC through the four lookups, one per byte, of its table."""
    at = (np.asarray(which) << 10) + (crc & np.uint32(255))
    out = tables.take(at)
    for byte in (1, 2, 3):
        out ^= tables.take((np.asarray(which) << 10) + (byte << 8) + (crc >> np.uint32(8 * byte) & np.uint32(255)))
    return out


def _byte_table() -> np.ndarray:
    """By place and value of a byte of a CRC: what a zero byte makes of it."""
    crc = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32)[:, None] * np.uint32(8))
    for _ in range(8):
        crc = np.where(crc & np.uint32(1), crc >> np.uint32(1) ^ POLYNOMIAL, crc >> np.uint32(1))
    return crc.ravel()


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Shifts by 0 to 2**FEW - 1 bytes, and by 2**k bytes for each k from FEW on."""
    one = _byte_table()
    few = [(np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32)[:, None] * np.uint32(8))).ravel()]
    while len(few) < 1 << FEW:
        few.append(_moved(few[-1], one))
    powers = [_moved(few[-1], one)]
    while len(powers) < 40 - FEW:
        powers.append(_moved(powers[-1], powers[-1]))
    return np.concatenate(few), np.concatenate(powers)


_FEW_BYTES, _POWERS = _tables()
_ONE_BYTE = _byte_table()[:256]


def shifted(crc: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each CRC as it would stand before ``sizes`` more bytes."""
    out, left = _moved(crc, _FEW_BYTES, sizes & ((1 << FEW) - 1)), sizes >> FEW
    power = 0
    while left.any():
        odd = np.flatnonzero(left & 1)
        out[odd] = _moved(out[odd], _POWERS, power)
        left, power = left >> 1, power + 1
    return out


@dataclass
class Words:
    """Words in a row: the text of each, the CRC before it and up to its end, its bytes.

    The first ``known`` ones were the last of the piece before.
    """

    owner: np.ndarray
    before: np.ndarray
    upto: np.ndarray
    size: np.ndarray
    known: int


def _after_space(crc: np.ndarray) -> np.ndarray:
    """The CRC of each text with a space behind it."""
    ones = np.uint32(0xFFFFFFFF)
    return (crc ^ ones) >> np.uint32(8) ^ _ONE_BYTE[((crc ^ ones) ^ np.uint32(ord(" "))) & np.uint32(255)] ^ ones


def scanned(data: np.ndarray, at: np.ndarray, order: int) -> Iterator[Words]:
    """The words of all texts, in pieces; the last words of a text go over into its next piece."""
    owner: list[tuple[int, int]] = []
    #: Words that begin a slice, and the CRC before them.
    first: list[tuple[int, int]] = []
    upto: list[int] = []
    size: list[int] = []
    known = 0

    def piece() -> Words:
        texts, counts = np.array(owner, np.int64).T
        ends = np.array(upto, np.uint32)
        before = np.empty_like(ends)
        before[1:] = _after_space(ends[:-1])
        places, crcs = np.array(first, np.int64).T
        before[places] = crcs
        return Words(np.repeat(texts, counts), before, ends, np.array(size, np.int64), known)

    crc32 = zlib.crc32
    for text in range(len(at) - 1):
        folded = data[at[text] : at[text + 1]].tobytes().lower()
        start, crc = 0, None
        while start < len(folded):
            gap = GAP.search(folded, start + SLICE) if len(folded) - start > SLICE else None
            stop = gap.start() if gap else len(folded)
            words = TOKEN.findall(folded, start, stop)
            start = stop
            if not words:
                continue
            normal = b" ".join(words) if crc is None else b" " + b" ".join(words)
            first.append((len(size), 0 if crc is None else crc32(b" ", crc)))
            crc = crc or 0
            upto += [crc := crc32(word, crc) for word in PARTED.findall(normal)]
            size += map(len, words)
            owner.append((text, len(words)))
            if len(size) >= PIECE:
                out = piece()
                yield out
                known = min(order - 1, len(size))
                keep = len(size) - known
                owner = [(int(x), 1) for x in out.owner[keep:]]
                first = [(i, int(x)) for i, x in enumerate(out.before[keep:])]
                upto, size = upto[keep:], size[keep:]
    if len(size) > known:
        yield piece()


def run_crcs(words: Words, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of runs: the text and the CRC-32 of each run that is new in this piece."""
    ends = np.cumsum(words.size)
    for n in range(1, order + 1):
        last = np.arange(max(n - 1, words.known), len(words.size))
        first = last - (n - 1)
        inside = words.owner[first] == words.owner[last]
        last, first = last[inside], first[inside]
        sizes = ends[last] - ends[first] + words.size[first] + (n - 1)
        yield words.owner[last], words.upto[last] ^ shifted(words.before[first], sizes)


def bucket_counts(texts: DataFrame, rules: Rules = Rules()) -> np.ndarray:
    """How many features of all texts (the only column) fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(rules.buckets, np.int64)
        for batch in batches:
            for words in scanned(*text_buffers(batch.column(0)), rules.order):
                for _, crcs in run_crcs(words, rules.order):
                    counts += np.bincount(crcs % np.uint32(rules.buckets), minlength=rules.buckets)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(counts[found])], ["bucket", "n"])

    summed = arrow_rows(texts, run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(rules.buckets, np.int64)
    out[summed["bucket"].to_numpy()] = summed["n"].to_numpy()
    return out


def bucket_gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the natural logarithm of each bucket's share in the target over that in the documents."""
    n = len(documents)
    above = (target + 1).astype(float) * float(documents.sum() + n)
    below = (documents + 1).astype(float) * float(target.sum() + n)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, rules: Rules) -> DataFrame:
    """For (id, text): id, ``n_words``, ``n_features``, ``weight``."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        gains, rows = shared.value, batch.num_rows
        n_words, n_features, total = (np.zeros(rows, np.int64) for _ in range(3))
        for words in scanned(*text_buffers(batch.column(1)), rules.order):
            n_words += np.bincount(words.owner[words.known :], minlength=rows)
            for owner, crcs in run_crcs(words, rules.order):
                n_features += np.bincount(owner, minlength=rows)
                np.add.at(total, owner, gains[crcs % np.uint32(rules.buckets)])
        weight = total // np.maximum(n_features, 1)
        found = [pa.array(x) for x in (n_words, n_features, weight)]
        return pa.RecordBatch.from_arrays([batch.column(0), *found], ["id", "n_words", "n_features", "weight"])

    return map_arrow(docs, work, f"id {dict(docs.dtypes)['id']}, n_words long, n_features long, weight long")


def gumbel(key: Column, seed: int) -> Column:
    """Thousandths of a Gumbel draw that the key decides, rounded down."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    digits = F.substring(F.sha2(name, 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(u)))


def resample(
    df: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
    rules: Rules = Rules(),
) -> DataFrame:
    """Per row: id, ``n_features``, ``weight``, ``score`` and ``rank`` (1, 2, ... of those drawn, else null)."""
    docs = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    gains = bucket_gains(bucket_counts(docs.select("text"), rules), bucket_counts(target.select(target_column), rules))
    score = F.col("weight") + gumbel(F.col("id"), rules.seed)
    scored = written(weighed(docs, gains, rules).withColumn("score", score), "resampling-scores")
    may = F.col("n_words") >= rules.least_words
    wanted = rules.percent * scored.where(may).count() // 100
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    ranked = with_place(scored.where(may), order, "rank")
    drawn = F.when(F.col("rank") <= wanted, F.col("rank"))
    out = ranked.withColumn("rank", drawn).unionByName(scored.where(~may).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("id").alias(id_column), "n_features", "weight", "score", "rank")
