"""The batch run: three feature tables written, counted and fingerprinted."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.features import (
    PRODUCT_KEYS,
    category_features,
    product_features,
    user_features,
)
from tallyloom.operators.fingerprint import fingerprints
from tallyloom.sources.readers import read_parquet
from tallyloom.sources.writers import write_json, write_parquet

FEATURE_TABLES = {
    "user_features": user_features,
    "product_features": product_features,
    "category_features": category_features,
}

# The columns that tell the rows of each table apart.
FEATURE_KEYS = {
    "user_features": ["user_id"],
    "product_features": PRODUCT_KEYS,
    "category_features": ["category"],
}


def write_features(events: DataFrame, output: str) -> None:
    """Write the three tables below ``output``.

    The events are not cached. Each table reads only the columns it needs, and
    at full scale a cache would spill more than the second scan costs.
    """
    for name, build in FEATURE_TABLES.items():
        write_parquet(build(events), f"{output}/{name}")


def read_features(spark: SparkSession, output: str) -> dict[str, DataFrame]:
    return {name: read_parquet(spark, f"{output}/{name}") for name in FEATURE_TABLES}


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row with the number of rows of every table."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, table in tables.items()
    ]
    first, *others = counts
    for other in others:
        first = first.unionByName(other)
    return first.agg(
        *[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in tables]
    )


def feature_row_counts(events: DataFrame) -> DataFrame:
    """Rows of the events and of the tables that they would give, from the tables' keys alone."""
    keys = {f"{name}_rows": events.select(k).distinct() for name, k in FEATURE_KEYS.items()}
    return row_counts({"rows_processed": events, **keys})


def run(spark: SparkSession, events: DataFrame, output: str, mode: str = "run") -> DataFrame:
    """Write the tables, their metrics and their fingerprints; the metrics row.

    ``mode`` is a name for the run. Shuffle and spill come from the event log,
    see ``operators.runs``.
    """
    started = time.monotonic()
    write_features(events, output)
    tables = read_features(spark, output)
    written = {f"{name.removesuffix('s')}_rows": table for name, table in tables.items()}
    counted = row_counts({"rows_processed": events, **written}).first()
    workers = F.lit(spark.sparkContext.defaultParallelism).cast("bigint").alias("workers")
    runtime = F.lit(time.monotonic() - started).alias("runtime_seconds")
    metrics = spark.range(1).select(
        F.lit(mode).alias("mode"),
        F.lit(spark.sparkContext.master).alias("master"),
        workers,
        F.lit(int(spark.conf.get("spark.sql.shuffle.partitions")))
        .cast("bigint")
        .alias("shuffle_partitions"),
        *[F.lit(n).cast("bigint").alias(name) for name, n in counted.asDict().items()],
        runtime,
    )
    write_json(metrics, metrics_path(output, mode))
    hashes = fingerprints(tables).select(F.lit(mode).alias("mode"), workers, runtime, "*")
    write_json(hashes, f"{output}/output_hashes")
    return metrics


def metrics_path(output: str, mode: str = "run") -> str:
    return f"{output}/metrics_{mode}"
