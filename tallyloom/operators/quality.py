"""Quarantine of bad records, and deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.events import event_time, with_defaults
from tallyloom.sources.schemas import CORRUPT


def is_bad() -> Column:
    """A record that did not parse or has no event time."""
    return F.col(CORRUPT).isNotNull() | F.col("timestamp").isNull()


def good_events(parsed: DataFrame) -> DataFrame:
    """Usable events, with defaults for missing fields."""
    return with_defaults(parsed.filter(~is_bad()).drop(CORRUPT))


def quarantine(parsed: DataFrame) -> DataFrame:
    """The records ``good_events`` leaves out, for a table of their own."""
    return parsed.filter(is_bad())


def quarantine_reasons(parsed: DataFrame) -> DataFrame:
    """Number of bad records by what is wrong with them."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "not one well-typed object").otherwise("no time")
    bad = quarantine(parsed).groupBy(reason.alias("reason"))
    return bad.agg(F.count(F.lit(1)).alias("records"))


def parse_totals(parsed: DataFrame) -> DataFrame:
    """One row: events processed and errors."""
    return parsed.agg(
        F.count_if(~is_bad()).alias("processed"), F.count_if(is_bad()).alias("errors")
    )


def dedup_events(
    events: DataFrame, key: str = "event_id", first_by: str | None = None
) -> DataFrame:
    """One row per ``key``; rows without a key are all kept, as none is a known copy.

    Copies are equal when a sender repeats itself, and then any will do. Where
    they may differ, ``first_by`` names the column whose smallest value wins,
    NULL last, ties going to the smallest row. Both forms drop copies before the shuffle,
    so a key with a third of all rows leaves one row per task.
    """
    keyed = events.filter(F.col(key).isNotNull())
    others = [name for name in events.columns if name not in (key, first_by)]
    if first_by is None:
        one = F.any_value(F.struct(*others))
    else:
        one = F.min(F.struct(F.col(first_by).isNull().alias("unknown"), first_by, *others))
    unique = keyed.groupBy(key).agg(one.alias("one")).select(key, "one.*").select(events.columns)
    return unique.unionByName(events.filter(F.col(key).isNull()))


def dedup_stream(
    events: DataFrame, key: str = "event_id", arrival: str = "arrival", within_seconds: int = 60
) -> DataFrame:
    """The streaming form: copies that arrive within ``within_seconds`` of each other.

    The watermark is on arrival (epoch seconds), so an event is kept however old
    it is, and old keys leave the state. Rows without a key go past the state
    and are all kept. In a replay, ``within_seconds`` must also cover how far
    recorded arrivals are out of order.
    """
    clock = "arrival_clock"
    timed = events.withColumn(clock, event_time(arrival))
    timed = timed.withWatermark(clock, f"{within_seconds} seconds")
    unique = timed.filter(F.col(key).isNotNull()).dropDuplicatesWithinWatermark([key])
    return unique.unionByName(timed.filter(F.col(key).isNull())).drop(clock)
