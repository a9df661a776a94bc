"""Exactly-once by processed ids: a copy is dropped however late it comes.

The ids of all events so far stand in a table, cut by hash into buckets, next to a Bloom filter per bucket.
A batch asks the filters first and reads only the buckets in which one of its ids may stand; a batch
without copies reads hardly any id. Events, ids and filters of a batch get one entry in the ledger, so a
batch that is killed or replayed adds each event once.

Ids are kept in segments that double: batch N merges with the segments before it as a binary counter
carries, so after N batches there are at most log2 N segments, and an id is written as often at most. Which
segments are alive follows from the number of batches alone.

A task holds the hashes and filters of one bucket; choose ``buckets`` for all ids to come. Rows without an
id are no known copies and all pass. Of copies within a batch the one that arrived first stays.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.bloom import bloom_filter, may_hold
from tallyloom.operators.quality import dedup_events
from tallyloom.streaming.ledger import BATCH, BatchLedger
from tallyloom.workspace import remove_folder, ship_package

BUCKETS = 256
EVENTS, IDS, FILTERS, STAGED = "events", "ids", "filters", "staged"
FILTER = "bucket int, n long, bits binary"
HASH = "id_hash"


def live_segments(batches: int) -> list[int]:
    """The numbers of the batches whose segments hold the ids of the first ``batches`` batches."""
    ends, done = [], 0
    for power in range(batches.bit_length() - 1, -1, -1):
        if batches >> power & 1:
            done += 1 << power
            ends.append(done - 1)
    return ends


def merged_segments(number: int) -> list[int]:
    """The segments that batch ``number`` takes into its own."""
    before, after = live_segments(number), live_segments(number + 1)
    return [x for x in before if x not in after]


def build_filters(ids: DataFrame) -> DataFrame:
    """A Bloom filter per bucket of (bucket, id_hash)."""

    def build(rows: pa.Table) -> pa.Table:
        hashes = rows[HASH].to_numpy()
        row = {"bucket": rows["bucket"][0].as_py(), "n": len(hashes), "bits": bloom_filter(hashes)}
        return pa.Table.from_pylist([row], pa.schema([("bucket", pa.int32()), ("n", pa.int64()), ("bits", pa.binary())]))

    ship_package(ids.sparkSession)
    return ids.select("bucket", HASH).groupBy("bucket").applyInArrow(build, FILTER)


def suspects(ids: DataFrame, filters: DataFrame) -> DataFrame:
    """(segment, bucket) in which one of the ids may stand already."""

    def ask(new: pa.Table, known: pa.Table) -> pa.Table:
        found = []
        if new.num_rows:
            hashes = new[HASH].to_numpy()
            for row in range(known.num_rows):
                n, bits = known["n"][row].as_py(), known["bits"][row].as_py()
                if may_hold(bits, hashes, n).any():
                    found.append({"segment": known[BATCH][row].as_py(), "bucket": known["bucket"][row].as_py()})
        return pa.Table.from_pylist(found, pa.schema([("segment", pa.int64()), ("bucket", pa.int32())]))

    ship_package(ids.sparkSession)
    asked = ids.select("bucket", HASH).groupBy("bucket")
    return asked.cogroup(filters.groupBy("bucket")).applyInArrow(ask, "segment long, bucket int")


class IdStore:
    """Events by the batch, each id once."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str = "event_id", first_by: str | None = "arrival", buckets: int = BUCKETS
    ) -> None:
        self.ledger = BatchLedger(spark, path)
        self.schema, self.key, self.first_by, self.buckets = schema, key, first_by, buckets
        kind = schema[key].dataType.simpleString()
        self.id_schema = f"id {kind}, bucket int, {HASH} long"

    def events(self, spark: SparkSession) -> DataFrame:
        """All events so far."""
        return self.ledger.read(spark, EVENTS, self.schema).drop(BATCH)

    def ids(self, spark: SparkSession, segments: Sequence[int]) -> DataFrame:
        rows = self.ledger.read(spark, IDS, self.id_schema)
        return rows.where(F.col(BATCH).isin(list(segments)))

    def known(self, ids: DataFrame, number: int) -> DataFrame:
        """Of the ids so far those in the buckets that the filters can't rule out.

        The driver holds the numbers of these buckets, at most ``buckets`` per segment.
        """
        spark, live = ids.sparkSession, live_segments(number)
        filters = self.ledger.read(spark, FILTERS, FILTER).where(F.col(BATCH).isin(live))
        wanted: dict[int, list[int]] = {}
        for row in suspects(ids, filters).collect():
            wanted.setdefault(row["segment"], []).append(row["bucket"])
        if not wanted:
            return self.ids(spark, []).where(F.lit(False))
        rows = self.ids(spark, sorted(wanted))
        chosen = F.lit(False)
        for segment, buckets in sorted(wanted.items()):
            chosen = chosen | ((F.col(BATCH) == segment) & F.col("bucket").isin(sorted(buckets)))
        return rows.where(chosen)

    def take(self, batch: DataFrame, number: int) -> dict[str, int]:
        """Writes the batch's new events, their ids and filters; the number of events for the ledger."""
        spark, key, names = batch.sparkSession, self.key, self.schema.fieldNames()
        self.drop_merged(spark, number - 1)
        digest = F.xxhash64(key)
        bucket = F.pmod(F.shiftrightunsigned(digest, 20), F.lit(self.buckets)).cast("int")
        batch = batch.select(names).persist()
        once = dedup_events(batch, key, self.first_by).withColumns({HASH: digest, "bucket": bucket})
        once = self.ledger.write(STAGED, 0, once)
        batch.unpersist()
        known = self.known(once.where(F.col(key).isNotNull()), number).select(F.col("id").alias(key))
        events = self.ledger.write(EVENTS, number, once.join(known, key, "left_anti").select(names))
        ids = events.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), bucket.alias("bucket"), digest.alias(HASH))
        if merged := merged_segments(number):
            ids = ids.unionByName(self.ids(spark, merged).drop(BATCH))
        ids = self.ledger.write(IDS, number, ids.repartitionByRange("bucket").sortWithinPartitions("bucket"))
        self.ledger.write(FILTERS, number, build_filters(ids))
        return {"events": events.count()}

    def drop_merged(self, spark: SparkSession, number: int) -> None:
        """Removes the segments that a finished batch took into its own."""
        for segment in merged_segments(number) if number >= 0 else []:
            for table in (IDS, FILTERS):
                remove_folder(spark, self.ledger.folder(table, segment))

    def start(self, stream: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        """Takes up the stream: every ``every``, or what is there now and then stops."""
        trigger = {"availableNow": True} if every is None else {"processingTime": every}
        writer = stream.writeStream.foreachBatch(self.ledger.each(self.take))
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
