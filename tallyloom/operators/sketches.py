"""Latency percentiles from sketches that are kept per window and merged to any longer span.

A KLL sketch has a bounded size whatever it has seen, and merging sketches is as good as one sketch over
all samples, in any order. So windows are summarised once, and hours, days or load levels are merges of
rows, without a sample being read again. Ranks are right to within ``rank_error`` of the samples.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.events import event_time, latency_ms
from tallyloom.operators.latency import RANKS

#: Size of a sketch, and the share of the samples by which a rank may be off; it falls about with the size.
SIZE, RANK_ERROR = 4096, 0.005


def _summaries(merged) -> list:
    return [merged.alias("sketch"), F.sum("count").alias("count"), F.min("least").alias("least"), F.max("most").alias("most")]


def latency_sketches(events: DataFrame, width_seconds: int = 10, by: Sequence[str] = (), clock: str = "arrival", size: int = SIZE) -> DataFrame:
    """Per window (and columns ``by``): sketch, number, least and most of the latencies, in ms.

    NULL and NaN are not samples; a window without samples has no row.
    """
    start = F.unix_seconds(F.window(event_time(clock), f"{width_seconds} seconds")["start"])
    samples = events.select(start.alias("window_start"), *by, latency_ms().cast("double").alias("ms"))
    samples = samples.where(F.col("ms").isNotNull() & ~F.isnan("ms"))
    return samples.groupBy("window_start", *by).agg(
        F.kll_sketch_agg_double("ms", size).alias("sketch"),
        F.count("ms").alias("count"),
        F.min("ms").alias("least"),
        F.max("ms").alias("most"),
    )


def rolled_up(sketches: DataFrame, span_seconds: int | None = None, by: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """The same summaries per span of time (all time if None) and columns ``by``.

    Sketches of a key are merged in two steps, the first dealt by time, so that a key of many windows is
    not merged in one task.
    """
    keys = [*by]
    if span_seconds is not None:
        start = (F.floor(F.col("window_start") / span_seconds) * span_seconds).cast("long")
        sketches, keys = sketches.withColumn("span_start", start), ["span_start", *by]
    part = F.pmod(F.xxhash64("window_start"), F.lit(64)).alias("part")
    first = sketches.groupBy(*keys, part).agg(*_summaries(F.kll_merge_agg_double("sketch", size)))
    out = first.groupBy(*keys).agg(*_summaries(F.kll_merge_agg_double("sketch", size)))
    return out if span_seconds is None else out.withColumnRenamed("span_start", "window_start")


def sketch_percentiles(sketches: DataFrame, ranks: Mapping[str, float] = RANKS) -> DataFrame:
    """The summaries with a column per rank in place of the sketch."""
    names = [x for x in sketches.columns if x != "sketch"]
    values = [F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(name) for name, q in ranks.items()]
    return sketches.select(*names, *values)


def rank_errors(percentiles: DataFrame, samples: DataFrame, by: Sequence[str], value: str, ranks: Mapping[str, float] = RANKS, error: float = RANK_ERROR) -> DataFrame:
    """Per group: the number of samples, and whether each percentile's rank is right to within ``error``."""
    keys = [*by] or ["everything"]
    if not by:
        percentiles, samples = percentiles.withColumn("everything", F.lit(0)), samples.withColumn("everything", F.lit(0))
    at = percentiles.select(*keys, *[F.col(name).alias(f"at_{name}") for name in ranks])
    both = samples.select(*keys, F.col(value).alias("sample")).join(at if by else F.broadcast(at), keys)
    below = [F.count_if(F.col("sample") < F.col(f"at_{name}")).alias(f"{name}_below") for name in ranks]
    upto = [F.count_if(F.col("sample") <= F.col(f"at_{name}")).alias(f"{name}_upto") for name in ranks]
    ranked = both.groupBy(*keys).agg(F.count("sample").alias("n"), *below, *upto)
    right = [
        ((F.col(f"{name}_below") <= F.col("n") * (q + error) + 1) & (F.col(f"{name}_upto") >= F.col("n") * (q - error) - 1)).alias(f"{name}_right")
        for name, q in ranks.items()
    ]
    return ranked.select(*by, F.col("n").alias("count"), *right)
