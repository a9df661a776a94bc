"""Alerts as episodes: one row when trouble starts and one when it is over, not one per window.

An episode is a row of bad windows. A good window ends it, and so does silence: more than ``quiet_seconds``
from the end of a bad window to the next window, or to the present. One task orders the windows, of which
there is one per width of time; give keys in ``by`` to have episodes of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "start", "end"
OPEN = ("window_start", "window_end", "value")


def alert_episodes(
    windows: DataFrame, value: Column, bad: Column, now: Column, quiet_seconds: float, by: Sequence[str] = (), open_before: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Alerts (by, kind, at, value) of closed windows, and the bad windows whose episodes are still open at ``now``.

    ``at`` is the start of an episode's first window, or the end of its last one; ``value`` is that
    window's. ``open_before`` is what an earlier call left open; its starts have been told.
    """
    keys = list(by)
    rows = windows.select(*keys, "window_start", "window_end", value.cast("double").alias("value"), F.coalesce(bad, F.lit(False)).alias("bad"), F.lit(False).alias("told"))
    if open_before is not None:
        rows = rows.unionByName(open_before.select(*keys, *OPEN, F.lit(True).alias("bad"), F.lit(True).alias("told")))
    order = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("window_start")
    rows = rows.withColumns({f"{side}_{name}": step(name).over(order) for side, step in (("last", F.lag), ("next", F.lead)) for name in ("window_start", "window_end", "bad")})
    joins = F.coalesce(F.col("last_bad") & (F.col("window_start") - F.col("last_window_end") <= quiet_seconds), F.lit(False))
    # What goes on after this window: another bad one, or no window yet and not long enough without one.
    waits = F.col("next_bad").isNull() & (now - F.col("window_end") <= quiet_seconds)
    goes_on = waits | F.coalesce(F.col("next_bad") & (F.col("next_window_start") - F.col("window_end") <= quiet_seconds), F.lit(False))
    begins = F.when(F.col("bad") & ~F.col("told") & ~joins, F.struct(F.lit(START).alias("kind"), F.col("window_start").cast("double").alias("at")))
    ends = F.when(F.col("bad") & ~goes_on, F.struct(F.lit(END).alias("kind"), F.col("window_end").cast("double").alias("at")))
    alerts = rows.select(*keys, "value", F.explode(F.array_compact(F.array(begins, ends))).alias("one"))
    return alerts.select(*keys, "one.kind", "one.at", "value"), rows.where(F.col("bad") & waits).select(*keys, *OPEN)
