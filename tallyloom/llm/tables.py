"""Helpers shared by the corpus operators: reading, Arrow batches, written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.workspace import new_folder, ship_package

#: What separates words, as a class of both regex dialects and as bytes.
SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Whether Spark removes the shuffles of a query once it ends.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, cut from their lineage: written to the cluster's shared folder and read again.

    The shuffles behind them leave the executors' disks at once, as nothing reads them again.
    """
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    before = spark.conf.get(CLEANUP_SETTING, "false")
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP_SETTING, before)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove broadcasts, and the files of shuffles that ``written`` did not make, if nothing refers to them.

    Without it they stay with the executors until the driver's JVM happens to look for garbage.
    """
    if jvm := getattr(spark, "_jvm", None):
        jvm.System.gc()


ROWS_AT_ONCE = 1024

_kept: dict[str, tuple[object, object]] = {}


def kept(owner: str, key: object, make: Callable[[], object]) -> object:
    """What a worker keeps from task to task for ``owner``, made anew for another key."""
    if owner not in _kept or _kept[owner][0] != key:
        _kept[owner] = key, make()
    return _kept[owner][1]


def release_others(owner: str | None) -> None:
    """Drops what the worker keeps for others, so that caches don't outlive their stage."""
    for name in [x for x in _kept if x != owner]:
        del _kept[name]


def arrow_rows(
    df: DataFrame,
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
    owner: str | None = None,
) -> DataFrame:
    """``run`` on the Arrow batches of each partition; ``owner`` names what its tasks keep in a worker."""
    ship_package(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_others(owner)
        yield from run(batches)

    return df.mapInArrow(task, schema)


def map_arrow(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str | StructType,
    owner: str | None = None,
) -> DataFrame:
    """``work`` on each Arrow batch of ``df``, ``ROWS_AT_ONCE`` rows at a time to bound what it makes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                if (out := work(batch.slice(start, ROWS_AT_ONCE))) is not None:
                    yield out

    return arrow_rows(df, run, schema, owner)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if the table has a column of that name."""
    taken = {x.lower() for x in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Rows that a piece holds at most, about.
PIECE_ROWS = 1 << 16


def piece_digits(rows: int) -> int:
    """How many hexadecimal digits of a hash name the pieces of a group of ``rows`` rows; at least two."""
    digits = 2
    while PIECE_ROWS * 16**digits < rows:
        digits += 1
    return digits


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each begins and the last ends. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]
