"""Places in one order over all rows, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.tables import unused, written

#: Fixed value: bits of ``monotonically_increasing_id`` that number the rows of a partition.
ROW_BITS = 33


def with_place(df: DataFrame, order: list[Column], into: str) -> DataFrame:
    """All rows and columns, and each row's place in ``order``, from 1; ``df`` should be a written table.

    Rows are sorted by range and numbered within their partition; a partition starts where the ones before
    it end, which one row per partition tells. Rows equal in ``order`` take places in a row; their own
    numbers stand last in the order, so that a range may end among them however many they are.
    """
    spread, number, part, before = (unused(df, x) for x in ("spread", "number", "part", "before"))
    order = [*order, F.col(spread)]
    ranged = df.withColumn(spread, F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = written(ranged.drop(spread).withColumn(number, F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn(part, F.shiftright(number, ROW_BITS))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(part).agg(F.count(F.lit(1)).alias(into))
    starts = sizes.select(part, F.coalesce(F.sum(into).over(earlier), F.lit(0)).alias(before))
    within = F.col(number).bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    return ranged.join(starts, part).select(*df.columns, (F.col(before) + within).alias(into))
