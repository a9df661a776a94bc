"""Group aggregates next to exact distinct counts, safe for hot groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup(
    rows: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    distinct: Mapping[str, str],
) -> DataFrame:
    """One row per ``keys``: the aggregates ``sums`` and the counts ``distinct``.

    ``sums`` holds sums and counts, which can be added up again. ``distinct``
    maps an output to the column whose different non-null values it counts.

    Each distinct count is taken from its own narrow set of (keys, value) pairs.
    The pairs are spread over the cluster by key *and* value, so a group with a
    third of all rows is still counted by every task, and no task ever holds the
    set of a whole group. Several ``countDistinct`` in one aggregate would be as
    safe, but would copy each row once per count with all the sums attached.
    The small partial results meet in a union, not in a join, so that a NULL key
    needs no special care.
    """
    parts = [rows.groupBy(*keys).agg(*[agg.alias(name) for name, agg in sums.items()])]
    for name, value in distinct.items():
        pairs = rows.select(*keys, F.col(value).alias("counted")).distinct()
        parts.append(pairs.groupBy(*keys).agg(F.count("counted").alias(name)))
    return together(parts, keys, [*sums, *distinct])


def together(
    parts: Sequence[DataFrame], keys: Sequence[str], names: Sequence[str], default: Mapping[str, int] | None = None
) -> DataFrame:
    """Partial results in one row per ``keys``; ``default`` stands in where no part has a name for a group."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    default = default or {}
    sums = {name: F.sum(name) for name in names}
    sums |= {name: F.coalesce(sums[name], F.lit(value)) for name, value in default.items()}
    return union.groupBy(*keys).agg(*[column.alias(name) for name, column in sums.items()])
