"""Folders for data a job writes and reads back, and this package for Python workers."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path nobody else uses, below the folder the cluster shares; gone when the driver's JVM ends.

    The shared folder is the session's ``spark.checkpoint.dir``. Only a local
    session, whose executors are threads of this machine, may fall back to a
    temporary folder.
    """
    shared = spark.conf.get(CHECKPOINT_SETTING, None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="tallyloom-")
    folder = f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if jvm := getattr(spark, "_jvm", None):  # a session without one can't ask for the removal
        path = jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
    return f"{folder}/data"


def written_rows(table: DataFrame, purpose: str) -> DataFrame:
    """The rows, computed once: written below the shared folder and read again."""
    spark = table.sparkSession
    path = new_folder(spark, purpose)
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder that this package has written, wherever it lies; nothing if it isn't there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives this package to the session's Python workers, which needn't have it installed."""
    context = spark.sparkContext
    package = os.path.dirname(os.path.abspath(__file__))
    if context.applicationId in _shipped or not os.path.isdir(package):
        return
    parent, name = os.path.split(package)
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), name)
    context.addPyFile(shutil.make_archive(archive, "zip", parent, name))
    _shipped.add(context.applicationId)
