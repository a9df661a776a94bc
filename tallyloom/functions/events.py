"""Column expressions over events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_type(event_type: str) -> Column:
    return F.col("event_type") == event_type


def spend() -> Column:
    return F.col("price") * F.col("quantity")


def ratio(part: str, whole: str) -> Column:
    """``part / whole`` as a double, NULL when ``whole`` is 0."""
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


def ratio_over_at_least_one(part: str, whole: str) -> Column:
    """``part / whole`` where a ``whole`` of 0 counts as 1."""
    return F.col(part) / F.when(F.col(whole) == 0, 1).otherwise(F.col(whole))


def with_defaults(events: DataFrame) -> DataFrame:
    """Values for missing fields: unknown category and type, price 0, quantity 1."""
    defaults = {
        "category": F.lit("unknown"),
        "event_type": F.lit("unknown"),
        "price": F.lit(0.0),
        "quantity": F.lit(1).cast("bigint"),
    }
    return events.withColumns({name: F.coalesce(name, value) for name, value in defaults.items()})


def event_time(seconds: str = "timestamp") -> Column:
    """Epoch seconds, whole or with a fraction, as a timestamp."""
    return F.timestamp_seconds(seconds)


def with_arrival(events: DataFrame) -> DataFrame:
    """Events with the present second as ``arrival``; in a stream, the start of the batch.

    A source that records when it received an event gives a better arrival.
    """
    now = F.unix_micros(F.current_timestamp()) / F.lit(1e6)
    return events.withColumn("arrival", now)


def age_seconds(event: str = "timestamp", arrival: str = "arrival") -> Column:
    return F.col(arrival) - F.col(event)


def is_late(width_seconds: int, event: str = "timestamp", arrival: str = "arrival") -> Column:
    """Older on arrival than two windows; exactly two windows is on time."""
    return age_seconds(event, arrival) > 2 * width_seconds


def latency_ms(event: str = "timestamp", arrival: str = "arrival") -> Column:
    return age_seconds(event, arrival) * 1000


def rounded(table: DataFrame, digits: int = 2) -> DataFrame:
    """For display: every double column rounded. Stored results stay as they are."""
    doubles = [name for name, kind in table.dtypes if kind == "double"]
    return table.withColumns({name: F.round(name, digits) for name in doubles})
