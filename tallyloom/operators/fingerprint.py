"""Content hashes and comparison of tables, independent of row order and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(field.dataType) for field in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.MapType)


def _ordered(value: Column, kind: T.DataType) -> Column:
    """The value with every map in it, at any depth, as an array in order of its keys."""
    if not _has_map(kind):
        return value
    if isinstance(kind, T.StructType):
        parts = [_ordered(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _ordered(x, kind.elementType))
    entries = F.transform(
        F.map_entries(value),
        lambda x: F.struct(
            F.to_json(F.struct(_ordered(x["key"], kind.keyType).alias("k"))).alias("key"),
            _ordered(x["value"], kind.valueType).alias("value"),
        ),
    )
    # Keys are unique, so their order alone decides; values needn't be comparable.
    keys = F.array_sort(F.transform(entries, lambda x: x["key"]))
    return F.transform(keys, lambda k: F.filter(entries, lambda x: x["key"] == k)[0])


def _plain(field: T.StructField) -> Column:
    """The column as a plain value; nested ones as JSON, maps at any depth in order of their keys."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.MapType, T.ArrayType, T.StructType)):
        return F.to_json(_ordered(column, field.dataType))
    return column


def _text(field: T.StructField) -> Column:
    """A text that another engine can make from the same value; doubles by their bits."""
    column = _plain(field)
    if isinstance(field.dataType, T.BinaryType):
        return F.hex(column)
    if isinstance(field.dataType, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        number = F.when(column == 0, 0.0).otherwise(column.cast("double"))  # -0.0 equals 0.0
        bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), number)
        return F.when(number.isNotNull(), bits)
    return column.cast("string")


def _fields(table: DataFrame) -> list[T.StructField]:
    return sorted(table.schema.fields, key=lambda field: field.name)


def _fast_numbers(table: DataFrame) -> list[Column]:
    # xxhash64 passes over NULL, so every value comes with a mark for it.
    marked = [c for f in _fields(table) for c in (_plain(f), _plain(f).isNull())]
    return [F.xxhash64(F.lit(seed), *marked).cast("decimal(20,0)") for seed in (1, 2)]


def _sha256_numbers(table: DataFrame) -> list[Column]:
    # Every value carries its length and NULL its own mark, so that no two
    # different rows give the same text.
    parts = []
    for field in _fields(table):
        text = _text(field)
        parts.append(
            F.when(text.isNull(), "n;").otherwise(
                F.concat(F.lit("v"), F.length(text).cast("string"), F.lit(":"), text)
            )
        )
    digest = F.sha2(F.concat(*parts), 256)
    return [
        F.conv(F.substring(digest, first, 15), 16, 10).cast("decimal(20,0)") for first in (1, 16)
    ]


def content_numbers(table: DataFrame) -> list[Column]:
    """Two numbers per row of the table, for sums that tell of its contents in any order."""
    return _fast_numbers(table)


METHODS = {"xxhash64": _fast_numbers, "sha256": _sha256_numbers}


def content_hash(table: DataFrame, method: str = "xxhash64") -> DataFrame:
    """One row: number of rows and two sums over hashes of the rows.

    The sums do not depend on the order of rows or columns, on partitions or on
    file names, and count duplicates. Each task adds up its own rows, so only
    one row per task is shuffled. ``xxhash64`` stays in generated code;
    ``sha256`` costs several times as much and gives a result that other
    engines can recompute from the columns' text.
    """
    a, b = METHODS[method](table)
    return (
        table.select(a.alias("a"), b.alias("b"))
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("a").alias("a"), F.sum("b").alias("b"))
        .select(
            "row_count",
            F.coalesce(F.col("a").cast("string"), F.lit("0")).alias("hash_a"),
            F.coalesce(F.col("b").cast("string"), F.lit("0")).alias("hash_b"),
        )
    )


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: how many rows only ``left`` and only ``right`` has, copies counted.

    Same numbers as ``exceptAll`` both ways, from a single shuffle.
    """
    names = left.columns
    if sorted(names) != sorted(right.columns):
        raise ValueError(f"columns differ: {sorted(names)} and {sorted(right.columns)}")
    sides = [
        table.select(
            *[_plain(f).alias(f.name) for f in table.schema.fields], F.lit(n).alias("side")
        )
        for table, n in ((left, 1), (right, -1))
    ]
    surplus = (
        sides[0]
        .unionByName(sides[1])
        .groupBy(*names)
        .agg(F.sum("side").alias("surplus"))
    )
    return surplus.agg(
        F.coalesce(F.sum(F.greatest("surplus", F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-F.col("surplus"), F.lit(0))), F.lit(0)).alias("only_right"),
    )


def fingerprints(tables: dict[str, DataFrame]) -> DataFrame:
    """The content hashes of several tables, one row each."""
    rows = [
        content_hash(table).select(F.lit(name).alias("table_name"), "*")
        for name, table in tables.items()
    ]
    first, *others = rows
    for other in others:
        first = first.unionByName(other)
    return first
