"""Batch writers. All overwrite, so a repeated run leaves one copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def write_parquet(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").parquet(path)


def write_csv(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("header", True).csv(path)


def write_json(table: DataFrame, path: str) -> None:
    """JSON lines: events, window results, run metrics, fingerprints, load summaries.

    NULL fields are left out of the line, as a producer that lacks them would.
    """
    table.write.mode("overwrite").json(path)


def write_events(events: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The generator's choice of formats."""
    writers = {"parquet": write_parquet, "csv": write_csv, "json": write_json}
    if fmt not in writers:
        raise ValueError(f"format must be one of {sorted(writers)}, not {fmt!r}")
    writers[fmt](events, path)


def write_by_date(events: DataFrame, path: str, date: Column, name: str = "event_date") -> None:
    """Parquet with one folder per date, so that a daily run reads only its dates.

    The rebalance hint brings the rows of a date together, which keeps the file
    count down, and lets adaptive execution cut a date that is far larger than
    the others into several tasks.
    """
    dated = events.withColumn(name, date)
    dated.hint("rebalance", name).write.mode("overwrite").partitionBy(name).parquet(path)
