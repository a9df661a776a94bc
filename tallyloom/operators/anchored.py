"""Windows that open with the first event and close with an event, not with the clock.

The first window opens at the first arrival. The first on-time event that arrives a width or more after a
window opened belongs to it, closes it, and opens the next one at its own arrival. So windows are as long
as it takes, and idle time makes no empty ones. Events older on arrival than ``late_after_seconds`` are
late: they are counted in the window in which they arrive, but add nothing else and close nothing.

Each window depends on the one before, yet no task walks through the events. Every on-time arrival points
to the arrival that would close a window opened there; pointers are joined with themselves, so that they
span 1, 2, 4, ... windows, as many rounds as the number of windows has binary digits. After each round only
arrivals that some pointer leads to keep theirs, so tables get smaller where windows meet. Then the rounds
are gone back: the longest pointers lead from the first arrival, each shorter round finds what lies between.
Two closings lie a width apart at least, so a stretch of time of that width holds one at most, and events
find their window by their stretch.

Tasks order the different arrivals of one stretch; one task orders a row per stretch. Running values go
with the order, never against it: a frame up to the end of its partition is computed anew for every row.
Events with equal arrival go by ``event_id``, NULL first. No events: no windows. The window that is still
open has no end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.events import age_seconds, is_type, with_defaults
from tallyloom.functions.money import money_sums, money_total, or_zero
from tallyloom.operators.windows import DEFAULT_WIDTH

WINDOW = ["window_start", "window_end"]
KEYS = [*WINDOW, "category", "event_type"]

Save = Callable[[DataFrame, str], DataFrame]


def _stretch(seconds: Column, width: int) -> Column:
    return F.floor(seconds / width)


def closing_arrivals(opens: DataFrame, width: int) -> DataFrame:
    """From (at), the arrivals at which a window might open: also ``closes``, the first arrival a width later, if any.

    ``opens`` has a row per different arrival; ``closer`` tells those that can close a window.
    """
    arrivals = opens.where("closer").select(_stretch(F.col("at"), width).alias("stretch"), F.col("at").alias("x"), F.lit(1).alias("kind"), F.lit(None).cast("double").alias("at"))
    due = F.col("at") + width
    asked = opens.select(_stretch(due, width).alias("stretch"), due.alias("x"), F.lit(0).alias("kind"), "at")
    both = arrivals.unionByName(asked)
    rest = Window.partitionBy("stretch").orderBy(F.desc("x"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("here", F.min(F.when(F.col("kind") == 1, F.col("x"))).over(rest)).where("kind = 0")
    later = Window.orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    stretches = both.groupBy("stretch").agg(F.min(F.when(F.col("kind") == 1, F.col("x"))).alias("least"))
    stretches = stretches.select("stretch", F.min("least").over(later).alias("later"))
    closes = F.coalesce("here", "later")
    # Where a width later is no later (NaN, infinity) nothing closes, or pointers would never end.
    return found.join(stretches, "stretch").select("at", F.when(closes > F.col("at"), closes).alias("closes"))


def _reached(pointers: DataFrame, start: float, save: Save) -> DataFrame:
    """(at): where pointers lead from ``start``, itself included; each round of pointers is saved."""
    first = F.col("at") == F.lit(start)
    rounds = [pointers.where("closes IS NOT NULL")]
    while not rounds[-1].where(first).isEmpty():
        jumps = rounds[-1]
        ends = jumps.select(F.col("closes").alias("at")).distinct()
        led_to = jumps.join(ends, "at", "left_semi").unionByName(jumps.where(first))
        onward = jumps.select(F.col("at").alias("closes"), F.col("closes").alias("onward"))
        twice = led_to.join(onward, "closes").select("at", F.col("onward").alias("closes"))
        rounds.append(save(twice, f"jumps-{len(rounds)}"))
    reached = pointers.where(first).select("at")
    for number, jumps in reversed(list(enumerate(rounds[:-1]))):
        between = reached.join(jumps, "at").select(F.col("closes").alias("at"))
        reached = save(reached.unionByName(between), f"reached-{number}")
    return reached


def anchored_windows(
    events: DataFrame, save: Save, width: int = DEFAULT_WIDTH, late_after_seconds: float | None = None, clock: str = "arrival", start: float | None = None
) -> DataFrame:
    """(window_start, window_end, closer): the windows, the end and closing event of the last one NULL.

    ``start`` opens the first window earlier than the first arrival. ``save`` writes a table under a name
    and reads it again; each round of pointers is saved.
    """
    late = age_seconds(arrival=clock) > (2 * width if late_after_seconds is None else late_after_seconds)
    on_time = ~F.coalesce(late, F.lit(False))
    arrivals = events.where(F.col(clock).isNotNull()).select(F.col(clock).cast("double").alias("at"), on_time.alias("closer"), "event_id")
    first_id = F.min(F.when(F.col("closer"), F.struct("event_id"))).alias("first")
    arrivals = arrivals.groupBy("at").agg(F.max("closer").alias("closer"), first_id)
    if start is not None:
        opening = events.sparkSession.createDataFrame([(float(start), False)], "at double, closer boolean")
        arrivals = opening.withColumn("first", F.lit(None).cast(dict(arrivals.dtypes)["first"])).unionByName(arrivals)
    arrivals = save(arrivals, "arrivals")
    if start is None:
        start = arrivals.agg(F.min("at")).first()[0]
    once = arrivals.where((F.col("at") >= F.lit(start))).groupBy("at").agg(F.max("closer").alias("closer"), F.max("first").alias("first"))
    # A late arrival opens a window only if it is the first of all.
    opens = once.where(F.col("closer") | (F.col("at") == F.lit(start)))
    pointers = save(closing_arrivals(opens, width), "pointers")
    reached = _reached(pointers, start, save)
    ends = once.join(reached, "at", "left_semi").select(F.col("at").alias("window_end"), F.col("first.event_id").alias("closer"))
    windows = reached.join(pointers, "at").select(F.col("at").alias("window_start"), F.col("closes").alias("window_end"))
    return windows.join(ends, "window_end", "left").select(*WINDOW, "closer")


def anchored_cells(
    events: DataFrame, windows: DataFrame, width: int = DEFAULT_WIDTH, late_after_seconds: float | None = None, clock: str = "arrival"
) -> DataFrame:
    """Counts and revenue per window, category and event type: partial results that can be added up.

    ``windows`` should be a written table; when the open one began, a number, passes through the driver.
    """
    late = age_seconds(arrival=clock) > (2 * width if late_after_seconds is None else late_after_seconds)
    timed = with_defaults(events.where(F.col(clock).isNotNull())).withColumn("late", F.coalesce(late, F.lit(False)))
    at = F.col(clock).cast("double")
    timed = timed.withColumn("stretch", _stretch(at, width)).withColumn("place", F.struct(at.alias("at"), "event_id"))

    closed = windows.where("window_end IS NOT NULL")
    here = closed.select(
        _stretch(F.col("window_end"), width).alias("stretch"),
        F.struct(F.col("window_end").alias("at"), F.col("closer").alias("event_id")).alias("end"),
        F.struct(*WINDOW).alias("window"),
    )
    stretches = timed.select("stretch").distinct().join(here, "stretch", "full")
    after = Window.orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    last = windows.where("window_end IS NULL").select("window_start").first()
    opened = F.struct(F.lit(last and last[0]).cast("double").alias("window_start"), F.lit(None).cast("double").alias("window_end"))
    stretches = stretches.withColumn("next", F.coalesce(F.last("window", ignorenulls=True).over(after), opened))
    placed = timed.join(stretches, "stretch")
    window = F.when(F.col("end").isNotNull() & (F.col("place") <= F.col("end")), F.col("window")).otherwise(F.col("next"))
    placed = placed.withColumn("own", window).withColumns({x: F.col(f"own.{x}") for x in WINDOW})
    sold = ~F.col("late") & is_type("purchase")
    revenue = money_sums("revenue", F.col("price"), F.col("quantity"), sold)
    return placed.groupBy(*KEYS).agg(
        F.count_if(~F.col("late")).alias("on_time"),
        F.count_if("late").alias("late"),
        *[aggregate.alias(name) for name, aggregate in revenue.items()],
    )


SUMS = ("on_time", "late", "revenue_cents", "revenue_rest", "revenue_n")


def added_up(cells: DataFrame) -> DataFrame:
    """Cells with one row per key again, after partial ones were put together."""
    kinds = dict(cells.dtypes)
    return cells.groupBy(*KEYS).agg(*[F.sum(name).cast(kinds[name]).alias(name) for name in SUMS])


def anchored_totals(cells: DataFrame) -> DataFrame:
    """Events processed, late events and revenue per window."""
    windows = cells.groupBy(*WINDOW).agg(
        F.sum("on_time").alias("events_processed"),
        F.sum("late").alias("late_dropped"),
        F.sum("revenue_cents").alias("revenue_cents"),
        F.sum("revenue_rest").alias("revenue_rest"),
    )
    duration = (F.col("window_end") - F.col("window_start")).alias("duration_s")
    return windows.select(*WINDOW, duration, "events_processed", "late_dropped", or_zero(money_total("revenue")).alias("total_revenue"))


def anchored_category_revenue(cells: DataFrame) -> DataFrame:
    """Purchase revenue per window and category that had an on-time purchase."""
    sold = cells.where(is_type("purchase") & (F.col("on_time") > 0)).groupBy(*WINDOW, "category")
    sums = sold.agg(F.sum("revenue_cents").alias("revenue_cents"), F.sum("revenue_rest").alias("revenue_rest"))
    return sums.select(*WINDOW, "category", or_zero(money_total("revenue")).alias("revenue"))


def anchored_type_counts(cells: DataFrame) -> DataFrame:
    """On-time events per window and event type."""
    return cells.where("on_time > 0").groupBy(*WINDOW, "event_type").agg(F.sum("on_time").alias("events"))
