"""Ranked lexical search: exact top documents for every query, by pruned inner products.

A document's score for a query is the sum, over the query's terms, of the term's weight times the
document's impact of that term; both are integers. With the root of a term's weight put to either side
this is the inner product of a query vector and a document vector, and their lengths bound it.

1. Queries with equal sets of terms are one. They are taken in blocks of about ``BLOCK_TERMS`` terms, so
   what a block broadcasts has a bound whatever the number of queries.
2. Documents are tokenised once per block; of each stay its number of terms and the frequencies of the
   block's terms. From these come the counts over all documents, the weights and the impact vectors.
3. Impact vectors are written in order of their lengths, the longest first in each task, and so read in
   buckets of similar length. The longest ones of all documents are searched first: the tenth best score
   among them is a bound that a document must reach.
4. A bucket takes up the queries whose length times the bucket's largest reaches the bound
   (Cauchy-Schwarz). For these the query's ``FOCUS`` heaviest coordinates are multiplied out, and the rest
   is bounded by the lengths of what remains; documents below the bound go. What survives is scored exactly
   in integers. Bounds rise as a task finds better documents.
5. Each bucket passes on its best documents that reach the bound; Spark ranks them per query.

Lengths are doubles with ``SLACK`` to spare; no document that could rank is dropped. Documents with many
copies all reach the bound, and of a bucket's ties those with the smallest ids go on.

- Null text or one without terms: a document that is never found, a query without results.
- Repeated items are ranked one by one, as are documents that share an id. Null ids come last among ties.
- Very long texts count with all their terms. No documents or no queries: no rows.
- Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.tables import arrow_rows, map_arrow, text_buffers, written
from tallyloom.llm.words import text_words

#: The scoring rule.
UNIT, SCALE, SHARE = 1_000_000_000, 1000, 90
TOP = 10
BLOCK_TERMS = 1 << 20
#: Documents of a bucket; coordinates that are multiplied out first; documents that give the first bounds.
BUCKET, FOCUS, SEEDS = 2048, 6, 1 << 14
#: Vectors of one length class differ by no more than this factor.
LENGTH_RATIO = 0.9
SLACK = 1 + 1e-9

#: Bytes between terms: all below 0x80 but digits and letters.
_IS_GAP = np.ones(256, bool)
_IS_GAP[0x80:] = False
_IS_GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


def term_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    """The hashes of each text's terms, in order and with repeats."""
    yield from text_words(*text_buffers(texts), fold_case=True, is_space=_IS_GAP)


def query_sets(items: DataFrame) -> DataFrame:
    """For (item, text): a written row per item with the ``terms`` of its set and the set's name."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [np.unique(x) for x in term_hashes(batch.column(1))]
        names = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]
        terms = pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.binary()), terms], ["item", "set", "terms"])

    return written(map_arrow(items, work, f"item {dict(items.dtypes)['item']}, set binary, terms array<long>"), "query-sets")


@dataclass
class Queries:
    """A block of queries: names, and for each its terms as places in the block's ``vocabulary``."""

    names: list[bytes]
    vocabulary: np.ndarray
    terms: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> Queries:
        terms = rows["terms"].combine_chunks()
        hashes = terms.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        vocabulary, places = np.unique(hashes, return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False))])
        return cls(rows["set"].to_pylist(), vocabulary, places, starts)


def query_blocks(sets: DataFrame) -> Iterator[Queries]:
    """The different sets in blocks, dealt by a hash of their names."""
    different = sets.where(F.col("set").isNotNull()).groupBy("set").agg(F.first("terms").alias("terms"))
    different = written(different, "different-sets")
    size = different.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-size // BLOCK_TERMS)
    for block in range(blocks):
        rows = different.where(F.pmod(F.xxhash64("set"), F.lit(blocks)) == block).toArrow()
        if rows.num_rows:
            yield Queries.of(rows)


def term_counts(docs: DataFrame, queries: Queries) -> DataFrame:
    """For (id, text): a written row per document with ``n`` terms, and places and frequencies of the block's terms."""
    shared = docs.sparkSession.sparkContext.broadcast(queries.vocabulary)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        vocabulary = shared.value
        n, places, counts = [], [], []
        for hashes in term_hashes(batch.column(1)):
            at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
            found, times = np.unique(at[vocabulary[at] == hashes], return_counts=True)
            n.append(len(hashes))
            places.append(found.astype(np.int32))
            counts.append(times.astype(np.int64))
        columns = [pa.array(n, pa.int64()), pa.array(places, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "n", "terms", "counts"])

    schema = f"id {dict(docs.dtypes)['id']}, n long, terms array<int>, counts array<long>"
    return written(map_arrow(docs, work, schema), "term-counts")


def term_weights(counted: DataFrame, queries: Queries) -> tuple[np.ndarray, int, int]:
    """The weight of each of the block's terms, the number of documents with terms, and that of their terms."""
    documents, terms = counted.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(queries.vocabulary))
    found = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).toArrow()
    holding[found["term"].to_numpy()] = found["n"].to_numpy()
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * holding + 1))).astype(np.int64), documents, terms


def _split(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and how many each row has."""
    return lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)


def impact_vectors(counted: DataFrame, weights: np.ndarray, documents: int, terms: int) -> DataFrame:
    """A written row per document with one of the block's terms: id, ``terms``, ``impacts``, ``length``, ``length_class``.

    The longest come first in each task. Class 0 holds lengths down to 1; each further one is longer.
    """
    shared = counted.sparkSession.sparkContext.broadcast(weights)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.column(1).to_numpy()
        places, sizes = _split(batch.column(2))
        times, _ = _split(batch.column(3))
        row = np.repeat(np.arange(len(n)), sizes)
        m = 100 - SHARE + SHARE * n * documents // terms
        impacts = UNIT * times // (SCALE * times + 8 * m[row])
        squares = np.bincount(row, shared.value[places] * impacts.astype(float) ** 2, minlength=len(n))
        starts = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        vectors = pa.ListArray.from_arrays(starts, pa.array(impacts))
        classes = np.floor(np.log(np.maximum(squares, 1)) / (-2 * np.log(LENGTH_RATIO))).astype(np.int32)
        columns = [batch.column(0), batch.column(2), vectors, pa.array(np.sqrt(squares)), pa.array(classes)]
        found = pa.RecordBatch.from_arrays(columns, ["id", "terms", "impacts", "length", "length_class"])
        return found.filter(pa.array(squares > 0))

    schema = f"id {dict(counted.dtypes)['id']}, terms array<int>, impacts array<long>, length double, length_class int"
    found = map_arrow(counted.where(F.size("terms") > 0), work, schema)
    return written(found.sortWithinPartitions(F.desc("length")), "impact-vectors")


class Bucket:
    """Documents of similar length, by term."""

    def __init__(self, rows: pa.RecordBatch) -> None:
        places, sizes = _split(rows.column(1))
        impacts, _ = _split(rows.column(2))
        self.length = rows.column(3).to_numpy()
        order = np.argsort(places, kind="stable")
        self.row, self.impact = np.repeat(np.arange(len(sizes)), sizes)[order], impacts[order]
        self.terms, starts = np.unique(places[order], return_index=True)
        self.starts = np.append(starts, len(order))
        ids = np.empty(len(sizes), np.int64)
        ids[pc.sort_indices(rows.column(0)).to_numpy()] = np.arange(len(sizes))
        self.id_order = ids

    def postings(self, terms: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each of the terms that the bucket has: its number among them, rows, impacts."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        for i in np.flatnonzero(self.terms[at] == terms):
            part = slice(self.starts[at[i]], self.starts[at[i] + 1])
            yield i, self.row[part], self.impact[part]

    def candidates(self, focus: np.ndarray, weights: np.ndarray, rest: float, bound: int) -> np.ndarray:
        """Rows that may reach ``bound``, by their coordinates in ``focus`` and the lengths of the rest."""
        product, used = np.zeros(len(self.length)), np.zeros(len(self.length))
        for i, rows, impacts in self.postings(focus):
            part = weights[i] * impacts.astype(float)
            product[rows] += part
            used[rows] += part * impacts
        most = product + rest * np.sqrt(np.maximum(self.length**2 * SLACK - used, 0))
        return np.flatnonzero(most * SLACK >= bound)

    def scores(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.length), np.int64)
        for i, rows, impacts in self.postings(terms):
            out[rows] += weights[i] * impacts
        return out


class Searcher:
    """The queries with their weights, heaviest terms first, and the bounds that a task raises."""

    def __init__(self, queries: Queries, weights: np.ndarray, bounds: np.ndarray, top: int) -> None:
        self.bounds, self.top = bounds.copy(), top
        self.best = np.zeros((len(bounds), top), np.int64)
        self.queries = []
        for begin, end in zip(queries.starts[:-1], queries.starts[1:]):
            terms = queries.terms[begin:end]
            order = np.argsort(-weights[terms], kind="stable")
            own = weights[terms[order]]
            self.queries.append((terms[order], own, float(np.sqrt(own[FOCUS:].sum()))))
        self.lengths = np.array([np.sqrt(float(own.sum())) for _, own, _ in self.queries])

    def search(self, bucket: Bucket) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query: the bucket's best rows that reach its bound, and their scores."""
        for q in np.flatnonzero(self.lengths * (bucket.length.max() * SLACK) >= self.bounds):
            terms, weights, rest = self.queries[q]
            rows = bucket.candidates(terms[:FOCUS], weights[:FOCUS], rest, self.bounds[q])
            if not len(rows):
                continue
            scores = bucket.scores(terms, weights)[rows]
            rows, scores = rows[scores >= self.bounds[q]], scores[scores >= self.bounds[q]]
            if not len(rows):
                continue
            order = np.lexsort((bucket.id_order[rows], -scores))[: self.top]
            rows, scores = rows[order], scores[order]
            self.best[q] = np.sort(np.concatenate([self.best[q], scores]))[-self.top :]
            self.bounds[q] = max(self.bounds[q], self.best[q][0])
            yield q, rows, scores


def best_documents(vectors: DataFrame, queries: Queries, weights: np.ndarray, bounds: np.ndarray, top: int) -> DataFrame:
    """(query, id, score): for each query the documents that reach its bound, at least its best ones."""
    shared = vectors.sparkSession.sparkContext.broadcast((queries, weights, bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = None
        for batch in batches:
            searcher = searcher or Searcher(*shared.value, top)
            for start in range(0, batch.num_rows, BUCKET):
                part = batch.slice(start, BUCKET)
                found = list(searcher.search(Bucket(part)))
                if not found:
                    continue
                query = np.repeat([q for q, _, _ in found], [len(rows) for _, rows, _ in found]).astype(np.int32)
                rows = np.concatenate([rows for _, rows, _ in found])
                scores = np.concatenate([scores for _, _, scores in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query), part.column(0).take(pa.array(rows)), pa.array(scores)], ["query", "id", "score"]
                )

    narrow = vectors.select("id", "terms", "impacts", "length")
    return arrow_rows(narrow, run, f"query int, id {dict(vectors.dtypes)['id']}, score long")


def ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def first_bounds(vectors: DataFrame, queries: Queries, weights: np.ndarray, top: int) -> np.ndarray:
    """For each query a score that its last ranked document reaches, from the longest vectors of all."""
    bounds = np.ones(len(queries.names), np.int64)
    classes = vectors.groupBy("length_class").agg(F.count(F.lit(1)).alias("n")).collect()
    least, total = 0, 0
    for row in sorted(classes, reverse=True):
        least, total = row["length_class"], total + row["n"]
        if total >= SEEDS:
            break
    seeds = vectors.where(F.col("length_class") >= least)
    last = ranked(best_documents(seeds, queries, weights, bounds, top), top).where(F.col("rank") == top)
    found = last.select("query", "score").toArrow()
    bounds[found["query"].to_numpy()] = found["score"].to_numpy()
    return bounds


def search_block(docs: DataFrame, queries: Queries, top: int) -> DataFrame:
    """(set, rank, id, score) of one block of queries."""
    counted = term_counts(docs, queries)
    weights, documents, terms = term_weights(counted, queries)
    vectors = impact_vectors(counted, weights, documents, max(terms, 1))
    bounds = first_bounds(vectors, queries, weights, top)
    found = ranked(best_documents(vectors, queries, weights, bounds, top), top)
    names = docs.sparkSession.createDataFrame(list(enumerate(queries.names)), "query int, set binary")
    return found.join(names, "query").select("set", "rank", "id", "score")


def ranked_search(
    df: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    top: int = TOP,
) -> DataFrame:
    """Per item its ``top`` best documents with a score above 0: item, ``rank``, id, ``score``."""
    docs = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    sets = query_sets(items.select(F.col(item_column).alias("item"), F.col(item_text_column).alias("text")))
    found = None
    for queries in query_blocks(sets):
        block = search_block(docs, queries, top)
        found = block if found is None else found.unionByName(block)
    if found is None:
        kind = dict(docs.dtypes)["id"]
        found = df.sparkSession.createDataFrame([], f"set binary, rank int, id {kind}, score long")
    ranks = sets.select("item", "set").join(found, "set")
    return ranks.select(F.col("item").alias(item_column), "rank", F.col("id").alias(id_column), "score")
