"""Windows anchored at the first event, over a stream: the batch operator, batch by batch.

Between batches stands the open window: when it opened, and its cells so far. A batch takes it up, closes
what its events close, and leaves a new open window, all under one entry of the ledger. So a batch works on
its own events only, spread over all tasks, and a run that is killed goes on where the last entry stands.

Events of a batch arrive after those of earlier batches; one with an older arrival counts in the window
that is open when its batch comes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.anchored import KEYS, SUMS, WINDOW, added_up, anchored_cells, anchored_windows
from tallyloom.operators.windows import DEFAULT_WIDTH
from tallyloom.streaming.ledger import BATCH, BatchLedger

CLOSED, OPEN, ANCHOR = "closed", "open", "anchor"
CENTS = T.DecimalType(38, 0)
CELLS = T.StructType(
    [T.StructField(name, T.DoubleType()) for name in WINDOW]
    + [T.StructField(name, T.StringType()) for name in ("category", "event_type")]
    + [T.StructField(name, kind) for name, kind in zip(SUMS, (T.LongType(), T.LongType(), CENTS, T.DoubleType(), T.LongType()))]
)


class AnchoredStream:
    def __init__(self, spark: SparkSession, path: str, width: int = DEFAULT_WIDTH, late_after_seconds: float | None = None, clock: str = "arrival") -> None:
        self.ledger = BatchLedger(spark, path)
        self.width, self.late_after, self.clock = width, late_after_seconds, clock

    def _last(self, spark: SparkSession, table: str, schema: T.StructType | str, number: int) -> DataFrame:
        return self.ledger.read(spark, table, schema).where(F.col(BATCH) == number).drop(BATCH)

    def take(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = self._last(spark, ANCHOR, "at double", number - 1).first()
        events = self.ledger.write("events", 0, batch)
        windows = anchored_windows(events, lambda df, name: self.ledger.write(f"rounds/{name}", 0, df), self.width, self.late_after, self.clock, before and before[0])
        windows = self.ledger.write("rounds/windows", 0, windows)
        cells = anchored_cells(events, windows, self.width, self.late_after, self.clock).select(*KEYS, *SUMS)
        if before:
            # What the open window holds so far goes to the window that opened there.
            first = windows.where(F.col("window_start") == F.lit(before[0])).select(*[F.col(x).alias(f"now_{x}") for x in ("window_start", "window_end")])
            carried = self._last(spark, OPEN, CELLS, number - 1).join(first, F.col("window_start") == F.col("now_window_start"))
            carried = carried.withColumn("window_end", F.col("now_window_end")).select(*KEYS, *SUMS)
            cells = cells.unionByName(carried)
        schema = [F.col(f.name).cast(f.dataType).alias(f.name) for f in CELLS.fields]
        cells = self.ledger.write("rounds/cells", 0, added_up(cells).select(schema))
        self.ledger.write(CLOSED, number, cells.where("window_end IS NOT NULL"))
        self.ledger.write(OPEN, number, cells.where("window_end IS NULL"))
        opened = windows.where("window_end IS NULL").select(F.col("window_start").alias("at"))
        self.ledger.write(ANCHOR, number, opened)

    def cells(self, spark: SparkSession) -> DataFrame:
        """Cells of all closed windows and of the open one."""
        closed = self.ledger.read(spark, CLOSED, CELLS).drop(BATCH)
        return closed.unionByName(self._last(spark, OPEN, CELLS, self.ledger.last(spark)))

    def start(self, stream: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        """Takes up the stream: every ``every``, or what is there now and then stops."""
        trigger = {"availableNow": True} if every is None else {"processingTime": every}
        writer = stream.writeStream.foreachBatch(self.ledger.each(self.take))
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
