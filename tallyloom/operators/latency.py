"""Exact latency percentiles without sorting a whole group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.events import event_time, is_late, latency_ms
from tallyloom.workspace import written_rows

# The reported ranks.
RANKS = {"p50": 0.50, "p95": 0.95, "p99": 0.99}

# Buckets per factor e of the value; a bucket spans 0.1 % of its value. Latencies
# in milliseconds between 1 microsecond and 1 day fill some 20,000 buckets at
# most, doubles of any size some 1,500,000. A bucket that holds a rank is cut
# again, linearly from its smallest to its largest value.
BUCKETS_PER_E = 1024
SLICES = 4096
# Samples of a bucket whose different values one task puts in order.
SORTED = 1 << 14


def _bucket(value: Column) -> Column:
    return (F.signum(value) * F.floor(F.log1p(F.abs(value)) * BUCKETS_PER_E)).cast("bigint")


def _equal(left: str, right: str, names: Sequence[str]) -> Column:
    same = F.lit(True)
    for name in names:
        same = same & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return same


def rank_percentiles(
    samples: DataFrame,
    value: str,
    by: Sequence[str] = (),
    ranks: Mapping[str, float] = RANKS,
) -> DataFrame:
    """Per group the value at 0-based position floor(n * q) of the sorted samples.

    One row per group with a column per rank and ``count``; without groups one
    row, zeros when there are no samples. NULL and NaN are not samples.

    Samples are counted by coarse bucket, which partial sums keep to some
    thousand rows per group; a running sum over them finds the bucket of each
    rank. Where such a bucket holds more than ``SORTED`` samples, these are counted
    again by slice of their bucket. The last pass counts the samples of the found
    buckets or slices by value, and only these values are put in order. So the
    samples are read twice, or three times; each pass leaves a row per group and
    rank, which is written before the next one starts.
    """
    groups = list(by) or ["everything"]
    if not by:
        samples = samples.withColumn("everything", F.lit(0))
    at = F.col(value).cast("double")
    samples = samples.select(*groups, at.alias("value"))
    samples = samples.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    samples = samples.withColumn("bucket", _bucket(F.col("value")))

    buckets = samples.groupBy(*groups, "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    group = Window.partitionBy(*groups)
    ordered = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    wanted = F.array(
        *[F.struct(F.lit(name).alias("rank"), F.lit(q).alias("q")) for name, q in ranks.items()]
    )
    found = (
        buckets.withColumns({"upto": F.sum("n").over(ordered), "count": F.sum("n").over(group)})
        .withColumn("wanted", F.explode(wanted))
        .withColumn("rank", F.col("wanted.rank"))
        .withColumn(
            "position",
            F.least(F.floor(F.col("count") * F.col("wanted.q")), F.col("count") - 1)
            - (F.col("upto") - F.col("n")),
        )
        .filter(F.col("position").between(0, F.col("n") - 1))
        .select(*groups, "rank", "bucket", "low", "high", "n", "count", "position")
    )
    found = written_rows(found, "percentile-buckets")
    most = found.agg(F.max("n")).first()[0] or 0
    if by:
        # What no group wants is left out before samples are moved to their group's targets.
        samples = samples.join(found.select("bucket").distinct(), "bucket", "left_semi")
    inside = samples.alias("s").join(found.alias("f"), _equal("s", "f", [*groups, "bucket"]))
    span = F.col("high") - F.col("low")
    slice_of = F.when(span > 0, F.floor((F.col("value") - F.col("low")) / span * SLICES)).otherwise(0)
    inside = inside.select(
        *[f"s.{name}" for name in groups], "rank", "value", slice_of.alias("slice"), "count", "position"
    )

    keys = [*groups, "rank"]
    if most > SORTED:
        slices = inside.groupBy(*keys, "slice", "count", "position").agg(F.count(F.lit(1)).alias("n"))
        found = _containing(slices, keys, "slice").select(*keys, "slice", "position")
        found = written_rows(found, "percentile-slices")
        same = _equal("s", "f", [*keys, "slice"])
        inside = inside.drop("position").alias("s").join(found.alias("f"), same)
        inside = inside.select(*[f"s.{name}" for name in keys], "value", "count", "position")
    values = inside.groupBy(*keys, "value", "count", "position").agg(F.count(F.lit(1)).alias("n"))
    last = _containing(values, keys, "value")
    columns = [F.max(F.when(F.col("rank") == name, F.col("value"))).alias(name) for name in ranks]
    count = F.max("count").alias("count")
    if by:
        return last.groupBy(*by).agg(*columns, count)
    return last.agg(*columns, count).fillna(0)


def _containing(counts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The rows that hold the wanted position, which from there on counts from their start."""
    upto = F.sum("n").over(
        Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    )
    start = F.col("upto") - F.col("n")
    return (
        counts.withColumn("upto", upto)
        .filter(F.col("position").between(start, F.col("upto") - 1))
        .withColumn("position", F.col("position") - start)
    )


def with_latency(events: DataFrame) -> DataFrame:
    """Events with ``latency_ms`` from their own time to their arrival, late ones too."""
    return events.withColumn("latency_ms", latency_ms())


def latency_percentiles(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """p50, p95, p99 and number of latencies, over all events or per group."""
    return rank_percentiles(with_latency(events), "latency_ms", by)


def latency_by_window(
    events: DataFrame, width_seconds: int = 10, clock: str = "timestamp"
) -> DataFrame:
    """Latency percentiles of each tumbling window."""
    start = F.unix_seconds(F.window(event_time(clock), f"{width_seconds} seconds")["start"])
    return latency_percentiles(events.withColumn("window_start", start), ["window_start"])


def latency_alerts(percentiles: DataFrame, threshold_ms: float = 500.0) -> DataFrame:
    """Groups whose 99th percentile is above ``threshold_ms``."""
    return percentiles.filter(F.col("p99") > threshold_ms)


def approx_latency_by_window(
    events: DataFrame,
    width_seconds: int = 10,
    watermark_seconds: int = 60,
    accuracy: int = 10_000,
    clock: str = "arrival",
) -> DataFrame:
    """The streaming form: sketches of bounded size in place of exact positions.

    Windows and watermark go by arrival, so the slowest events are in.
    """
    timed = with_latency(events).withColumn("at_time", event_time(clock))
    windows = (
        timed.withWatermark("at_time", f"{watermark_seconds} seconds")
        .groupBy(F.window("at_time", f"{width_seconds} seconds").alias("window"))
        .agg(
            F.percentile_approx("latency_ms", list(RANKS.values()), accuracy).alias("at"),
            F.count("latency_ms").alias("count"),
        )
    )
    return windows.select(
        F.unix_seconds("window.start").alias("window_start"),
        *[F.col("at")[i].alias(name) for i, name in enumerate(RANKS)],
        "count",
    )


def sketch_errors(
    sketched: DataFrame,
    events: DataFrame,
    width_seconds: int = 10,
    accuracy: int = 10_000,
    clock: str = "arrival",
) -> DataFrame:
    """Per sketched window its ``count`` and whether each rank is right to within 1 / accuracy."""
    start = F.unix_seconds(F.window(event_time(clock), f"{width_seconds} seconds")["start"])
    samples = with_latency(events).select(start.alias("window_start"), "latency_ms")
    both = samples.join(sketched, "window_start").groupBy("window_start")
    below = [F.count_if(F.col("latency_ms") < F.col(name)).alias(f"{name}_below") for name in RANKS]
    upto = [F.count_if(F.col("latency_ms") <= F.col(name)).alias(f"{name}_upto") for name in RANKS]
    ranked = both.agg(F.max("count").alias("count"), F.count("latency_ms").alias("n"), *below, *upto)
    # A rank is a whole number of samples, so one sample is allowed for.
    right = [
        (
            (F.col(f"{name}_below") <= F.col("n") * (q + 1 / accuracy) + 1)
            & (F.col(f"{name}_upto") >= F.col("n") * (q - 1 / accuracy) - 1)
        ).alias(f"{name}_right")
        for name, q in RANKS.items()
    ]
    return ranked.select("window_start", "count", *right)


def load_level_summary(
    runs: DataFrame, width_seconds: int = 10, levels: Sequence[str] = ("label", "rate", "burst")
) -> DataFrame:
    """Per load level: latency percentiles, events and windows with an on-time event.

    ``runs`` holds the events of all runs, each tagged with the columns
    ``levels`` of its run.
    """
    on_time = runs.filter(~is_late(width_seconds)).select(
        *levels, F.floor(F.col("timestamp") / width_seconds).alias("window")
    )
    windows = on_time.distinct().groupBy(*levels).agg(F.count(F.lit(1)).alias("windows"))
    both = latency_percentiles(runs, levels).unionByName(windows, allowMissingColumns=True)
    return (
        both.groupBy(*levels)
        .agg(*[F.max(name).alias(name) for name in [*RANKS, "count", "windows"]])
        .fillna(0, subset=["windows"])
    )
