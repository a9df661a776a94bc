"""Tumbling windows over events, in batch and under Structured Streaming.

``window_cells`` is the one stateful step. Its rows, one per window, category
and type, are few and can be added up, so everything a window reports is a
small second step over finished cells. Windows are aligned to the epoch.
Events older on arrival than two windows are late: they are counted, and add
to nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.events import age_seconds, event_time, is_late, is_type, with_defaults
from tallyloom.functions.money import ALL_CENTS, money_sums, money_total, or_zero

DEFAULT_WIDTH = 10
REVENUE_KINDS = {"revenue_cents": ALL_CENTS, "revenue_rest": "double"}


def late_split(events: DataFrame, width_seconds: int = DEFAULT_WIDTH) -> DataFrame:
    """Every event with its age on arrival and whether it is late."""
    return events.withColumns({"age_s": age_seconds(), "late": is_late(width_seconds)})


def window_cells(
    events: DataFrame,
    width_seconds: int = DEFAULT_WIDTH,
    late_after_seconds: int | None = None,
    clock: str = "timestamp",
    watermark_seconds: int | None = None,
) -> DataFrame:
    """Counts and revenue per window, category and event type.

    ``clock`` names the epoch seconds that place an event in a window: its own
    time or its arrival. An event is late by more than ``late_after_seconds``,
    by default two windows. ``watermark_seconds`` bounds the state of a stream,
    which should go by arrival: by event time, whatever is older than the
    watermark would vanish uncounted, and one event from the future would close
    the windows of all others. A batch needs no watermark. The partial sums before the shuffle keep a hot window or category
    from reaching one task row by row.
    """
    late = (
        is_late(width_seconds)
        if late_after_seconds is None
        else age_seconds() > late_after_seconds
    )
    timed = with_defaults(events).withColumns({"event_time": event_time(clock), "late": late})
    if watermark_seconds is not None:
        timed = timed.withWatermark("event_time", f"{watermark_seconds} seconds")
    on_time = ~F.coalesce("late", F.lit(False))
    sold = on_time & is_type("purchase")
    revenue = money_sums("revenue", F.col("price"), F.col("quantity"), sold)
    return timed.groupBy(
        F.window("event_time", f"{width_seconds} seconds").alias("window"),
        "category",
        "event_type",
    ).agg(
        F.count_if(on_time).alias("on_time"),
        F.count_if("late").alias("late"),
        *[aggregate.alias(name) for name, aggregate in revenue.items()],
    )


def _bounds() -> list[Column]:
    return [
        F.unix_seconds("window.start").alias("window_start"),
        F.unix_seconds("window.end").alias("window_end"),
    ]


def _revenue_sums() -> list[Column]:
    return [
        F.sum("revenue_cents").alias("revenue_cents"),
        F.sum("revenue_rest").alias("revenue_rest"),
    ]


def window_totals(cells: DataFrame) -> DataFrame:
    """Events processed, late events and revenue per window."""
    windows = cells.groupBy("window").agg(
        F.sum("on_time").alias("events_processed"),
        F.sum("late").alias("late_dropped"),
        *_revenue_sums(),
    )
    return windows.select(
        *_bounds(),
        "events_processed",
        "late_dropped",
        or_zero(money_total("revenue")).alias("total_revenue"),
    )


def window_category_revenue(cells: DataFrame) -> DataFrame:
    """Purchase revenue per window and category that had an on-time purchase."""
    sold = cells.filter(is_type("purchase") & (F.col("on_time") > 0))
    windows = sold.groupBy("window", "category").agg(*_revenue_sums())
    return windows.select(
        *_bounds(), "category", or_zero(money_total("revenue")).alias("revenue")
    )


def window_type_counts(cells: DataFrame) -> DataFrame:
    """On-time events per window and event type."""
    seen = cells.filter(F.col("on_time") > 0)
    windows = seen.groupBy("window", "event_type").agg(F.sum("on_time").alias("events"))
    return windows.select(*_bounds(), "event_type", "events")


def window_results(cells: DataFrame) -> DataFrame:
    """One nested row per window, with revenue by category and counts by type as maps.

    Cells are first summed up to one entry per category and one per type of a
    window, so a row gathers as many entries as its two maps have. Where these
    are free text, with many values per window, use the flat tables above.
    """
    of_type = F.struct(
        F.lit("type").alias("kind"),
        F.col("event_type").alias("name"),
        F.col("on_time").alias("events"),
        F.col("late").alias("late"),
        F.lit(0).cast("bigint").alias("sales"),
        *[F.lit(0).cast(kind).alias(name) for name, kind in REVENUE_KINDS.items()],
    )
    of_category = F.struct(
        F.lit("category").alias("kind"),
        F.col("category").alias("name"),
        F.lit(0).cast("bigint").alias("events"),
        F.lit(0).cast("bigint").alias("late"),
        F.when(is_type("purchase"), F.col("on_time")).otherwise(0).alias("sales"),
        *[F.coalesce(name, F.lit(0)).cast(kind).alias(name) for name, kind in REVENUE_KINDS.items()],
    )
    entries = (
        cells.select("window", F.explode(F.array(of_type, of_category)).alias("entry"))
        .groupBy("window", "entry.kind", "entry.name")
        .agg(*[F.sum(f"entry.{n}").alias(n) for n in ("events", "late", "sales", *REVENUE_KINDS)])
    )
    counted = (F.col("kind") == "type") & (F.col("events") > 0)
    sold = (F.col("kind") == "category") & (F.col("sales") > 0)
    amount = or_zero(money_total("revenue"))
    windows = entries.groupBy("window").agg(
        F.sum("events").alias("events_processed"),
        F.sum("late").alias("late_dropped"),
        *_revenue_sums(),
        F.collect_list(F.when(sold, F.struct("name", amount.alias("value")))).alias("sold"),
        F.collect_list(F.when(counted, F.struct("name", "events"))).alias("seen"),
    )
    start = F.unix_seconds("window.start").cast("double")
    end = F.unix_seconds("window.end").cast("double")
    return windows.select(
        start.alias("window_start"),
        end.alias("window_end"),
        (end - start).alias("duration_s"),
        "events_processed",
        "late_dropped",
        F.map_from_entries(F.array_sort("sold")).alias("revenue_by_category"),
        F.map_from_entries(F.array_sort("seen")).alias("counts_by_type"),
        or_zero(money_total("revenue")).alias("total_revenue"),
    )


def window_result_scalars(results: DataFrame) -> DataFrame:
    """Window results with the sizes of their maps in place of the maps."""
    return results.select(
        "window_start",
        "window_end",
        "duration_s",
        "events_processed",
        "late_dropped",
        F.size("revenue_by_category").cast("bigint").alias("categories"),
        F.size("counts_by_type").cast("bigint").alias("types"),
        "total_revenue",
    )


def window_result_entries(results: DataFrame) -> DataFrame:
    """The maps of window results as rows: window, kind of entry, name, value."""
    revenue = results.select(
        "window_start",
        F.lit("revenue").alias("kind"),
        F.explode("revenue_by_category").alias("name", "value"),
    )
    counts = results.select(
        "window_start",
        F.lit("count").alias("kind"),
        F.explode("counts_by_type").alias("name", "value"),
    )
    return revenue.unionByName(counts.withColumn("value", F.col("value").cast("double")))


def late_rate_alerts(totals: DataFrame, threshold: float = 0.01) -> DataFrame:
    """Windows in which more than ``threshold`` of the events were late."""
    rate = F.try_divide(
        F.col("late_dropped").cast("double"), F.col("late_dropped") + F.col("events_processed")
    )
    return totals.withColumn("late_rate", rate).filter(F.col("late_rate") > threshold)
