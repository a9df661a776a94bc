"""Feature tables that are kept up to date by the day.

Each day has partial states of its own: per group the sums that can be added up, and the different values
of each distinct count. A day that got new events, however late, is computed again from that day's events
alone, and only its folders are written; the tables are merges of all days' states. Sums of money are in
whole cents, so a merge equals a full rebuild to the last digit for prices of two decimals.

Values are dealt by group *and* value, as in a rebuild, so a hot group is merged by every task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.features import FEATURES
from tallyloom.operators.rollup import together

DAY = "event_date"
SUMS, PAIRS = "sums", "pairs"


def day_states(events: DataFrame, table: str, day: str = DAY) -> tuple[DataFrame, DataFrame]:
    """Per day: the sums of each group, and (group, name, value) of its different values."""
    spec = FEATURES[table]
    keys = [day, *spec.keys]
    sums = events.groupBy(*keys).agg(*[aggregate.alias(name) for name, aggregate in spec.sums().items()])
    named = [F.struct(F.lit(name).alias("name"), F.col(value).cast("string").alias("value")) for name, value in spec.distinct.items()]
    pairs = events.select(*keys, F.explode(F.array(*named)).alias("one")).select(*keys, "one.name", "one.value")
    return sums, pairs.where(F.col("value").isNotNull()).distinct()


def refresh(events: DataFrame, path: str, days: Sequence[date] | None = None, day: str = DAY) -> None:
    """Writes the states of some days (all if None) of events that have their day as a column.

    ``events`` holds all events of these days; a filter on the days reaches the folders of a table
    written by date. States of other days stay as they are. Days whose events are gone keep their states.
    """
    if days is not None:
        events = events.where(F.col(day).isin(list(days)))
    for table in FEATURES:
        for name, state in zip((SUMS, PAIRS), day_states(events, table, day)):
            writer = state.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(day).parquet(f"{path}/{table}/{name}")


def maintained_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The feature table, merged from the states of all days."""
    spec = FEATURES[table]
    sums, pairs = (spark.read.parquet(f"{path}/{table}/{name}") for name in (SUMS, PAIRS))
    kinds = dict(sums.dtypes)
    names = [x for x in sums.columns if x not in (DAY, *spec.keys)]
    merged = sums.groupBy(*spec.keys).agg(*[F.sum(name).cast(kinds[name]).alias(name) for name in names])
    parts = [merged]
    different = pairs.select(*spec.keys, "name", "value").distinct()
    for name in spec.distinct:
        parts.append(different.where(F.col("name") == name).groupBy(*spec.keys).agg(F.count(F.lit(1)).alias(name)))
    return spec.finish(together(parts, spec.keys, [*names, *spec.distinct], {name: 0 for name in spec.distinct}))
