"""Starting streams. The transformations are the batch operators themselves.

Every stream names its checkpoint folder, which holds the source offsets and
the window state. A restart on the same folder goes on where the last run
stopped, and the file sinks commit each batch once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.latency import (
    RANKS,
    approx_latency_by_window,
    latency_by_window,
    latency_percentiles,
)
from tallyloom.operators.quality import dedup_stream, good_events, is_bad, parse_totals
from tallyloom.operators.windows import DEFAULT_WIDTH, window_cells, window_results
from tallyloom.sources.readers import stream_parquet
from tallyloom.sources.writers import write_json


def start(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    every: str | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append to files at ``path``: every ``every``, or all that is there now and then stop."""
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()


def run_available(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet"
) -> StreamingQuery:
    """Process what the source holds now; the finished query."""
    query = start(stream, path, checkpoint, fmt)
    query.awaitTermination()
    return query


def window_cell_stream(
    events: DataFrame,
    width_seconds: int = DEFAULT_WIDTH,
    watermark_seconds: int | None = None,
    clock: str = "arrival",
    **options,
) -> DataFrame:
    """Cells of closed windows, events counted in the window in which they arrive.

    Late events and those with a time in the future arrive like all others, so
    they are counted, and close nobody's window. The state is kept for two more
    windows unless told otherwise; in a replay that must cover how far recorded
    arrivals are out of order.
    """
    delay = 2 * width_seconds if watermark_seconds is None else watermark_seconds
    return window_cells(events, width_seconds, clock=clock, watermark_seconds=delay, **options)


def window_result_stream(
    events: DataFrame,
    width_seconds: int = DEFAULT_WIDTH,
    watermark_seconds: int | None = None,
    **options,
) -> DataFrame:
    """One nested row per closed window, ready for a JSON lines sink."""
    return window_results(window_cell_stream(events, width_seconds, watermark_seconds, **options))


def start_parsed(
    parsed: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Parsed records to Parquet, read once: folders ``record=good`` and ``record=bad``."""
    split = parsed.withColumn("record", F.when(is_bad(), "bad").otherwise("good"))
    return start(split, path, checkpoint, every=every, partition_by=["record"])


def parsed_events(records: DataFrame) -> DataFrame:
    """The good events of a table that ``start_parsed`` wrote."""
    return good_events(records.filter(F.col("record") == "good").drop("record"))


def run_totals(records: DataFrame) -> DataFrame:
    """One row: records processed, errors, and the latency of the events that could be read."""
    latencies = latency_percentiles(parsed_events(records))
    counts = parse_totals(records)
    both = counts.withColumn("one", F.lit(1)).join(latencies.withColumn("one", F.lit(1)), "one")
    return both.select("processed", "errors", *RANKS, F.col("count").alias("latencies"))


def run_events_job(
    arrived: DataFrame, output: str, checkpoint: str, width_seconds: int, every: str | None
) -> None:
    """Parsed records with their arrival to ``events``; from there window results and latencies.

    With ``every`` all three are streams until stopped: the second and third read
    the committed files of the first, so lines are parsed once, and report the
    windows that are closed. Without it the first one takes up what is there, and
    ``windows``, ``latency`` (exact) and ``totals`` report all of ``events``, open
    windows too; another run adds to ``events`` and reports anew.
    """
    spark = arrived.sparkSession
    events = f"{output}/events"
    first = start_parsed(arrived, events, f"{checkpoint}/events", every)
    kept = T.StructType([*arrived.schema.fields, T.StructField("record", T.StringType())])
    if every is None:
        first.awaitTermination()
        records = spark.read.schema(kept).parquet(events)
        stored = parsed_events(records)
        cells = window_cells(stored, width_seconds, clock="arrival")
        write_json(window_results(cells), f"{output}/windows")
        write_json(latency_by_window(stored, width_seconds, "arrival"), f"{output}/latency")
        write_json(run_totals(records), f"{output}/totals")
        return
    first.processAllAvailable()  # so that the folder is there
    stored = parsed_events(stream_parquet(spark, events, kept))
    results = window_result_stream(stored, width_seconds)
    latencies = approx_latency_by_window(stored, width_seconds, 2 * width_seconds)
    queries = [
        start(results, f"{output}/windows", f"{checkpoint}/windows", "json", every),
        start(latencies, f"{output}/latency", f"{checkpoint}/latency", "json", every),
    ]
    for query in [*queries, first]:
        query.awaitTermination()


def start_dedup(
    events: DataFrame, path: str, checkpoint: str, every: str | None = None, **options
) -> StreamingQuery:
    return start(dedup_stream(events, **options), path, checkpoint, every=every)
