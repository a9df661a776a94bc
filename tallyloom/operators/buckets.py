"""Tables that know where they differ: rows in hash buckets under a tree of content hashes.

A written table is cut into buckets by a hash of its key. Each bucket has its content hash, and nodes above
hash their children up to one root. Two versions are compared from the root down: where nodes are equal,
nothing below is looked at. Only rows of buckets that differ are read, to name the rows themselves.

Buckets are folders, so reading some of them touches no file of the others. The driver holds the numbers of
nodes that differ, at most one per bucket. A table needs the same key and number of buckets in both versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.fingerprint import content_numbers

BUCKETS, FAN = 256, 16
ROWS, HASHES = "rows", "hashes"
NODE = "level int, node int, row_count long, hash_a string, hash_b string"


def _levels(buckets: int) -> int:
    """How often nodes are taken together until one is left."""
    levels = 0
    while FAN**levels < buckets:
        levels += 1
    return levels


def write_bucketed(table: DataFrame, path: str, key: Sequence[str], buckets: int = BUCKETS) -> None:
    """The table's rows by bucket, and its tree of hashes. Rows with a NULL key have a bucket like others.

    Each node sums up what its rows hash to, so the tree is the same in any order and any partitioning.
    A bucket that is far larger than the others is written by several tasks.
    """
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
    rows = table.withColumn("bucket", bucket)
    rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{ROWS}")
    spark = table.sparkSession
    stored = spark.read.schema(rows.schema).parquet(f"{path}/{ROWS}")
    a, b = content_numbers(table)
    sums = stored.groupBy("bucket").agg(F.count(F.lit(1)).alias("row_count"), F.sum(a).alias("a"), F.sum(b).alias("b"))
    # A node of level l stands for FAN**l buckets.
    levels = F.explode(F.sequence(F.lit(0), F.lit(_levels(buckets)))).alias("level")
    node = F.floor(F.col("bucket") / F.pow(F.lit(FAN), F.col("level"))).cast("int")
    nodes = sums.select("*", levels).groupBy("level", node.alias("node"))
    # Sums are kept apart by bucket, so that what two buckets exchange shows above them.
    placed = F.sum(F.xxhash64("bucket", "row_count", "a", "b").cast("decimal(38,0)"))
    tree = nodes.agg(F.sum("row_count").alias("row_count"), F.sum("a").cast("string").alias("hash_a"), placed.cast("string").alias("hash_b"))
    tree.coalesce(1).write.mode("overwrite").parquet(f"{path}/{HASHES}")


def differing_buckets(spark: SparkSession, left: str, right: str, buckets: int = BUCKETS) -> list[int]:
    """The buckets whose contents differ, found from the root down."""
    trees = [spark.read.schema(NODE).parquet(f"{path}/{HASHES}") for path in (left, right)]
    wanted = [0]
    for level in range(_levels(buckets), -1, -1):
        a, b = (tree.where((F.col("level") == level) & F.col("node").isin(wanted)).alias(side) for tree, side in zip(trees, "ab"))
        both = a.join(b, F.col("a.node") == F.col("b.node"), "full")
        same = F.lit(True)
        for name in ("row_count", "hash_a", "hash_b"):
            same = same & F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
        found = both.where(~same).select(F.coalesce("a.node", "b.node").alias("node"))
        differ = [row["node"] for row in found.collect()]
        if not differ or level == 0:
            return sorted(differ)
        wanted = [node * FAN + i for node in differ for i in range(FAN)]
    return []


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, buckets: Sequence[int]) -> DataFrame:
    """The rows of some buckets; files of others are not opened."""
    # The schema names the bucket too, as a table without rows has no folder that would tell of it.
    whole = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    rows = spark.read.schema(whole).parquet(f"{path}/{ROWS}")
    return rows.where(F.col("bucket").isin(list(buckets))).drop("bucket")


def located_diff(spark: SparkSession, left: str, right: str, schema: T.StructType, buckets: int = BUCKETS) -> DataFrame:
    """The rows that one version has more often than the other: its columns, ``only_left``, ``only_right``."""
    differ = differing_buckets(spark, left, right, buckets)
    names = [f.name for f in schema.fields]
    sides = [
        read_buckets(spark, path, schema, differ).select(*names, F.lit(n).alias("side")) for path, n in ((left, 1), (right, -1))
    ]
    surplus = sides[0].unionByName(sides[1]).groupBy(*names).agg(F.sum("side").cast("long").alias("surplus")).where("surplus <> 0")
    return surplus.select(
        *names,
        F.greatest("surplus", F.lit(0)).cast("long").alias("only_left"),
        F.greatest(-F.col("surplus"), F.lit(0)).cast("long").alias("only_right"),
    )
