"""Batch and stream readers for events and results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.sources.lines import parse_lines
from tallyloom.sources.schemas import STREAM_EVENT


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A directory of Parquet files; the schema comes from the footers unless given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV files with a header line. The schema is declared: no pass over the data to infer it."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType = STREAM_EVENT
) -> DataFrame:
    """One JSON object per line, see ``parse_lines``."""
    return parse_lines(spark.read.text(path), schema=schema)


def stream_json_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType = STREAM_EVENT,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same lines as a stream over files added to a directory.

    Files must appear whole (written elsewhere and moved in, or committed by a
    writer); a file that is still growing is read once, as it then is.
    """
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_lines(reader.text(path), schema=schema)


def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
