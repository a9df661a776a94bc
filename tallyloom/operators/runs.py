"""Run metrics from Spark's event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Only the fields read here; the JSON reader skips the rest of each line.
_LOG = """
    `Event` string,
    `Timestamp` bigint,
    `Task Metrics` struct<
        `Memory Bytes Spilled`: bigint,
        `Disk Bytes Spilled`: bigint,
        `Shuffle Read Metrics`: struct<
            `Remote Bytes Read`: bigint, `Local Bytes Read`: bigint>,
        `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: bigint>>
"""


_NO_EVENTS = "no application start in the event log; was spark.eventLog.compress=false set?"


def run_metrics(spark: SparkSession, event_log: str, label: str = "run") -> DataFrame:
    """One row: runtime, tasks, shuffle and spill of the application behind a log.

    Needs an application run with ``spark.eventLog.enabled=true`` and
    ``spark.eventLog.compress=false``; ``event_log`` is its file or folder.
    ``peak_spill_mb`` is the largest spill of one task.
    """
    log = (
        spark.read.schema(_LOG)
        .json(event_log)
        .filter(
            F.col("Event").isin(
                "SparkListenerApplicationStart",
                "SparkListenerApplicationEnd",
                "SparkListenerTaskEnd",
            )
        )
    )
    task = F.col("`Task Metrics`")
    read = task["Shuffle Read Metrics"]
    starts = F.when(F.col("Event") == "SparkListenerApplicationStart", F.col("Timestamp"))
    ends = F.when(F.col("Event") == "SparkListenerApplicationEnd", F.col("Timestamp"))
    megabyte = 1e6
    return log.agg(
        F.when(F.count(starts) > 0, (F.max(ends) - F.min(starts)) / 1000)
        .otherwise(F.raise_error(F.lit(_NO_EVENTS)).cast("double"))
        .alias("runtime_seconds"),
        F.count_if(F.col("Event") == "SparkListenerTaskEnd").alias("tasks"),
        (
            F.coalesce(F.sum(read["Remote Bytes Read"] + read["Local Bytes Read"]), F.lit(0))
            / megabyte
        ).alias("shuffle_read_mb"),
        (
            F.coalesce(F.sum(task["Shuffle Write Metrics"]["Shuffle Bytes Written"]), F.lit(0))
            / megabyte
        ).alias("shuffle_write_mb"),
        (F.coalesce(F.max(task["Memory Bytes Spilled"]), F.lit(0)) / megabyte).alias(
            "peak_spill_mb"
        ),
        (F.coalesce(F.sum(task["Disk Bytes Spilled"]), F.lit(0)) / megabyte).alias(
            "disk_spill_mb"
        ),
    ).select(F.lit(label).alias("label"), "*")


def speedup(runs: DataFrame, baseline: str, candidate: str) -> DataFrame:
    """One row: the runtimes of two labelled runs and their ratio."""

    def runtime(label: str):
        return F.max(F.when(F.col("label") == label, F.col("runtime_seconds")))

    return runs.agg(
        runtime(baseline).alias("baseline_seconds"), runtime(candidate).alias("candidate_seconds")
    ).withColumn("speedup", F.try_divide("baseline_seconds", "candidate_seconds"))
