"""Load levels by schedule: events that carry no label are told by the time in which they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVEL = ("label", "rate", "burst")


def with_scheduled_level(events: DataFrame, schedule: DataFrame, clock: str = "arrival", slot_seconds: int = 60) -> DataFrame:
    """Events with the levels of ``schedule`` (label, rate, burst, start, end) that hold at their ``clock``.

    A level holds from its start up to, not including, its end. An event in an overlap has a row per level,
    one in a gap, or without a time, a row without a level. Each level stands in every slot of time that it
    touches, and events meet the levels of their own slot only, so the join is one on equal slots; longer
    slots make fewer rows of long levels. A slot with a third of all events is cut by adaptive execution, or
    needs no shuffle if the schedule is small enough to be broadcast.
    """
    first, last = (F.floor(F.col(x) / slot_seconds) for x in ("start", "end"))
    slots = schedule.where("start < end").select(*LEVEL, "start", "end", F.explode(F.sequence(first, last)).alias("slot"))
    timed = events.withColumn("slot", F.floor(F.col(clock) / slot_seconds)).alias("e")
    holds = (F.col("e.slot") == F.col("s.slot")) & (F.col(f"e.{clock}") >= F.col("s.start")) & (F.col(f"e.{clock}") < F.col("s.end"))
    both = timed.join(slots.alias("s"), holds, "left")
    return both.select(*[F.col(f"e.{name}") for name in events.columns], *[F.col(f"s.{name}") for name in LEVEL])
