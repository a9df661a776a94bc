"""Tables that a stream writes batch by batch, where a batch counts as a whole or not at all.

Every batch writes its part of each table to a folder of its own, ``<table>/batch=<number>``, and last an
entry in the ledger. Readers take the batches up to the last entry, so what a killed batch left behind is
never seen; the batch is run again under its number and writes the same folders anew. A batch that has an
entry is a replay and does nothing. Numbers are those of the stream's checkpoint, one after the other, so
ledger and checkpoint belong together: a ledger with a new checkpoint is refused once a number is missing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch"
ENTRY = "facts map<string,long>, batch long"


class BatchLedger:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path
        # An entry before the first batch, so that the ledger can be read from the start.
        self._enter(spark, -1, {}, mode="ignore")

    def folder(self, table: str, number: int | None = None) -> str:
        return f"{self.path}/{table}" + ("" if number is None else f"/{BATCH}={number}")

    def _enter(self, spark: SparkSession, number: int, facts: Mapping[str, int], mode: str) -> None:
        entry = spark.createDataFrame([(dict(facts),)], "facts map<string,long>").coalesce(1)
        entry.write.mode(mode).parquet(self.folder("ledger", number))

    def entries(self, spark: SparkSession) -> DataFrame:
        """(batch, facts) of every finished batch."""
        return spark.read.schema(ENTRY).parquet(self.folder("ledger")).where(F.col(BATCH) >= 0).select(BATCH, "facts")

    def last(self, spark: SparkSession) -> int:
        """The number of the last finished batch, -1 before the first."""
        return spark.read.schema(ENTRY).parquet(self.folder("ledger")).agg(F.max(BATCH)).first()[0]

    def write(self, table: str, number: int, rows: DataFrame) -> DataFrame:
        """A batch's part of a table, as read back from its folder."""
        path = self.folder(table, number)
        rows.write.mode("overwrite").parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def commit(self, spark: SparkSession, number: int, facts: Mapping[str, int] | None = None) -> None:
        """From now on the batch counts."""
        self._enter(spark, number, facts or {}, mode="overwrite")

    def read(self, spark: SparkSession, table: str, schema: T.StructType | str) -> DataFrame:
        """The finished batches' rows of a table, with their ``batch``; no rows before the first."""
        last = self.last(spark)
        if last < 0:
            schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
            return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())]))
        rows = spark.read.schema(schema).parquet(self.folder(table))
        return rows.withColumn(BATCH, F.col(BATCH).cast("long")).where(F.col(BATCH) <= last)

    def each(self, work: Callable[[DataFrame, int], Mapping[str, int] | None]) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: ``work`` writes a batch's tables and gives the facts of its entry.

        A batch that has its entry is left out, one that comes too early is refused.
        """

        def run(batch: DataFrame, number: int) -> None:
            last = self.last(batch.sparkSession)
            if number <= last:
                return
            if number != last + 1:
                raise ValueError(f"batch {number} after {last}: checkpoint and {self.path} don't belong together")
            self.commit(batch.sparkSession, number, work(batch, number))

        return run
