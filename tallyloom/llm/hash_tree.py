"""Sharding by a tree of weighted hash draws: region, then rack, then shard.

Every node below the root draws a number for every row: -ln(u) / weight, with u from a hash of the
row's key and the node's name. A row goes to the child with the smallest draw, so each child gets rows
in proportion to its weight (the sum of its shards' weights). Draws of other nodes don't change when
one node's weight does: rows move only into a subtree that gained weight or out of one that lost it.

Only the key decides where a row goes; equal keys go to one shard. A null key is a key like any other.
Weights of 0 take no rows. ``grown`` adds one shard as a region of its own: rows move to it alone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.tables import piece_digits, unused

#: (shard, weight) by rack by region.
Tree = tuple[tuple[tuple[tuple[int, int], ...], ...], ...]

#: Hexadecimal digits of the hash that make a draw, few enough for an exact double.
DRAW_DIGITS = 13


def even_tree(shards: int, racks_of_region: int = 2, shards_of_rack: int = 4) -> Tree:
    """``shards`` shards of weight 1 in racks and regions of equal size; the last may be smaller."""
    numbers = [(i, 1) for i in range(shards)]
    racks = [tuple(numbers[i : i + shards_of_rack]) for i in range(0, shards, shards_of_rack)]
    return tuple(tuple(racks[i : i + racks_of_region]) for i in range(0, len(racks), racks_of_region))


def grown(tree: Tree, weight: int = 1) -> Tree:
    """The tree and one more shard, in a region of its own."""
    highest = max((s for region in tree for rack in region for s, _ in rack), default=-1)
    return (*tree, (((highest + 1, weight),),))


def _draw(key: Column, name: Column, weight: Column) -> Column:
    digits = F.substring(F.md5(F.concat(key, F.lit("/"), name)), 1, DRAW_DIGITS)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**DRAW_DIGITS)
    return -F.log(u) / weight


def _children(nodes: Iterable[tuple[str, int, int]]) -> Column:
    """(name, weight, number) of the children that can take rows."""
    kind = "array<struct<name:string,weight:int,number:int>>"
    usable = [F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight"), F.lit(i).alias("number")) for n, w, i in nodes if w > 0]
    return F.array(*usable).cast(kind)


def _winner(key: Column, children: Column) -> Column:
    draws = F.transform(
        children, lambda c: F.struct(_draw(key, c["name"], c["weight"]).alias("draw"), c["number"].alias("number"))
    )
    return F.array_min(draws)["number"]


def with_shard(df: DataFrame, key_column: str, tree: Tree, into: str) -> DataFrame:
    """All rows and columns, and the shard of each row."""
    rack_weight = lambda rack: sum(w for _, w in rack)
    region_weight = lambda region: sum(map(rack_weight, region))
    regions = _children((f"{r}", region_weight(x), r) for r, x in enumerate(tree))
    racks = F.array(*[_children((f"{r}.{k}", rack_weight(y), k) for k, y in enumerate(x)) for r, x in enumerate(tree)])
    shards = F.array(
        *[F.array(*[_children((f"{r}.{k}.{s}", w, s) for s, w in y) for k, y in enumerate(x)]) for r, x in enumerate(tree)]
    )
    key = F.coalesce(F.col(key_column).cast("string"), F.lit("null"))
    region, rack = unused(df, "region"), unused(df, "rack")
    return (
        df.withColumn(region, _winner(key, regions))
        .withColumn(rack, _winner(key, racks[F.col(region)]))
        .withColumn(into, _winner(key, shards[F.col(region)][F.col(rack)]))
        .drop(region, rack)
    )


def with_slot(df: DataFrame, shard_column: str, order: list[str], into: str) -> DataFrame:
    """All rows and columns, and a number within the shard, from 0 without gaps.

    A shard's rows are numbered in pieces dealt by a hash of ``order``, never in one task, and the largest
    shard's rows decide how many pieces there are; a piece starts where the ones before it end. Rows equal
    in ``order`` take numbers in a row. ``df`` is read three times, so it should be a written table.
    """
    piece, before, n = unused(df, "piece"), unused(df, "before"), unused(df, "n")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in order]
    largest = df.groupBy(shard_column).agg(F.count(F.lit(1)).alias(n)).agg(F.max(n)).first()[0] or 0
    dealt = df.withColumn(piece, F.substring(F.md5(F.concat_ws("/", *parts)), 1, piece_digits(largest)))
    sizes = dealt.groupBy(shard_column, piece).agg(F.count(F.lit(1)).alias(n))
    earlier = Window.partitionBy(shard_column).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(shard_column, piece, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before))
    within = Window.partitionBy(shard_column, piece).orderBy(*order)
    numbered = dealt.withColumn(into, F.row_number().over(within).cast("long") - 1).join(starts, [shard_column, piece])
    return numbered.select(*df.columns, (F.col(into) + F.col(before)).alias(into))
