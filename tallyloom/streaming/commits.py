"""A run whose windows, latencies and totals always tell of the same batches.

Lines are parsed once. The pass that stores a batch's records counts them on the way (``observe``), and
what it stored gives the batch's window cells and latency sketches. All of them are partial results that
can be added up, they stand under the batch's number, and one entry of the ledger makes them count. A run
killed between two of them, or between the last one and the entry, leaves nothing that a reader sees.

With ``alert_above`` a batch also tells of the windows that it closes: those that end ``delay_seconds``
before its last arrival. Alerts come once at the start of an episode of late events and once at its end;
an episode that is open is carried to the next batch under the same entry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.episodes import alert_episodes
from tallyloom.operators.quality import good_events, is_bad
from tallyloom.operators.sketches import latency_sketches, sketch_percentiles
from tallyloom.operators.windows import DEFAULT_WIDTH, late_rate_alerts, window_cells, window_totals
from tallyloom.streaming.ledger import BATCH, BatchLedger

RECORDS, CELLS, LATENCY, ALERTS, OPEN = "records", "cells", "latency", "alerts", "open_alerts"
ALERT, OPEN_ALERT = "kind string, at double, value double", "window_start long, window_end long, value double"
CELL = (
    "window struct<start:timestamp,end:timestamp>, category string, event_type string, on_time long, late long, "
    "revenue_cents decimal(38,0), revenue_rest double, revenue_n long"
)
SKETCH = "window_start long, sketch binary, count long, least double, most double"


class CommittedRun:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        width: int = DEFAULT_WIDTH,
        late_after_seconds: float | None = None,
        clock: str = "arrival",
        alert_above: float | None = None,
        delay_seconds: float | None = None,
        quiet_seconds: float | None = None,
    ) -> None:
        """``schema`` is that of parsed lines, with the column of corrupt records.

        ``alert_above`` is the share of late events that is too much; windows close ``delay_seconds`` (by
        default two widths) after their end, and ``quiet_seconds`` (by default as long) without a window
        end an episode.
        """
        self.alert_above = alert_above
        self.delay = 2 * width if delay_seconds is None else delay_seconds
        self.quiet = 2 * width if quiet_seconds is None else quiet_seconds
        self.ledger = BatchLedger(spark, path)
        self.schema = T.StructType([*schema.fields, T.StructField("bad", T.BooleanType())])
        self.width, self.late_after, self.clock = width, late_after_seconds, clock

    def take(self, batch: DataFrame, number: int) -> dict[str, int]:
        counts = Observation("records")
        split = batch.withColumn("bad", is_bad()).observe(
            counts, F.count_if(~F.col("bad")).alias("processed"), F.count_if("bad").alias("errors")
        )
        records = self.ledger.write(RECORDS, number, split)
        events = good_events(records.where(~F.col("bad")).drop("bad"))
        self.ledger.write(CELLS, number, window_cells(events, self.width, self.late_after, self.clock))
        self.ledger.write(LATENCY, number, latency_sketches(events, self.width, clock=self.clock))
        facts = {name: int(n) for name, n in counts.get.items()}
        return facts | (self.tell(events, number) if self.alert_above is not None else {})

    def tell(self, events: DataFrame, number: int) -> dict[str, int]:
        """Alerts of the windows that this batch closes; until when they are closed, for the entry."""
        spark = events.sparkSession
        before = self.ledger.entries(spark).agg(F.max(F.col("facts")["closed_until"])).first()[0]
        last = events.agg(F.max(self.clock)).first()[0]
        until = max(int((last - self.delay) // 1), before or 0) if last is not None else before or 0
        end = F.unix_seconds("window.end")
        closed = self._cells_upto(spark, number).where((end <= until) & (end > (before or 0)))
        rates = late_rate_alerts(window_totals(closed), -1.0)
        carried = None
        if number:
            carried = self.ledger.read(spark, OPEN, OPEN_ALERT).where(F.col(BATCH) == number - 1).drop(BATCH)
        alerts, left = alert_episodes(
            rates, F.col("late_rate"), F.col("late_rate") > self.alert_above, F.lit(until), self.quiet, open_before=carried
        )
        self.ledger.write(ALERTS, number, alerts)
        self.ledger.write(OPEN, number, left)
        return {"closed_until": until}

    def _cells_upto(self, spark: SparkSession, number: int) -> DataFrame:
        """Cells of finished batches and of the one that is under way."""
        return spark.read.schema(CELL).parquet(self.ledger.folder(CELLS)).where(F.col(BATCH) <= number).drop(BATCH)

    def alerts(self, spark: SparkSession) -> DataFrame:
        """The starts and ends of episodes of too many late events."""
        return self.ledger.read(spark, ALERTS, ALERT).drop(BATCH)

    def start(self, parsed: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        """Takes up the stream of parsed lines: every ``every``, or what is there now and then stops."""
        trigger = {"availableNow": True} if every is None else {"processingTime": every}
        writer = parsed.writeStream.foreachBatch(self.ledger.each(self.take))
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()

    def totals(self, spark: SparkSession) -> DataFrame:
        """One row: records processed and errors, from the entries alone."""
        facts = [F.coalesce(F.sum(F.col("facts")[name]), F.lit(0)).alias(name) for name in ("processed", "errors")]
        return self.ledger.entries(spark).agg(*facts)

    def records(self, spark: SparkSession) -> DataFrame:
        return self.ledger.read(spark, RECORDS, self.schema).drop(BATCH)

    def cells(self, spark: SparkSession) -> DataFrame:
        """Cells for ``window_totals`` and the other reports, partial ones not yet added up."""
        return self.ledger.read(spark, CELLS, CELL).drop(BATCH)

    def sketches(self, spark: SparkSession) -> DataFrame:
        """Latency sketches per window, partial ones not yet merged."""
        return self.ledger.read(spark, LATENCY, SKETCH).drop(BATCH)

    def latency(self, spark: SparkSession) -> DataFrame:
        """Latency percentiles per window, to within the sketches' rank error."""
        merged = self.sketches(spark).groupBy("window_start").agg(
            F.kll_merge_agg_double("sketch").alias("sketch"),
            F.sum("count").alias("count"),
            F.min("least").alias("least"),
            F.max("most").alias("most"),
        )
        return sketch_percentiles(merged)
