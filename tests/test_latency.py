import random

import pytest
from helpers import arrived, by

from tallyloom.operators import latency
from tallyloom.operators.latency import (
    RANKS,
    latency_percentiles,
    load_level_summary,
    rank_percentiles,
)


def brute(values):
    values = sorted(values)
    n = len(values)
    at = {name: values[min(int(n * q), n - 1)] for name, q in RANKS.items()}
    return {**at, "count": n}


def frame(spark, groups):
    rows = [(g, v) for g, values in groups.items() for v in values]
    return spark.createDataFrame(rows, "g string, v double")


@pytest.mark.parametrize("n", [1, 2, 3, 19, 20, 21, 99, 100, 101])
def test_small_counts(spark, n):
    values = [float(i + 1) for i in range(n)]
    random.Random(n).shuffle(values)
    got = rank_percentiles(frame(spark, {"a": values}), "v").first().asDict()
    assert got == brute(values)


def test_no_samples_give_zeros(spark):
    got = rank_percentiles(frame(spark, {}), "v").first().asDict()
    assert got == {"p50": 0, "p95": 0, "p99": 0, "count": 0}
    empty = spark.createDataFrame([("a", None), ("a", float("nan"))], "g string, v double")
    assert rank_percentiles(empty, "v").first()["count"] == 0


@pytest.mark.parametrize("sorted_rows", [latency.SORTED, 100, 0])
def test_many_shapes_against_brute_force(spark, monkeypatch, sorted_rows):
    monkeypatch.setattr(latency, "SORTED", sorted_rows)
    rng = random.Random(11)
    groups = {
        "uniform": [rng.uniform(0, 1000) for _ in range(2000)],
        "close": [100 + rng.random() * 1e-9 for _ in range(1500)],
        "signed": [rng.gauss(0, 5) for _ in range(1500)],
        "wide": [10 ** rng.uniform(-6, 12) for _ in range(1500)],
        "tied": [rng.choice([1.0, 2.0, 2.5]) for _ in range(1500)],
        "same": [7.25] * 500,
        "tiny": [0.0, -0.0, 1e-300, 5e-324, float("inf"), -float("inf")],
    }
    got = by(rank_percentiles(frame(spark, groups), "v", ["g"]), "g")
    for name, values in groups.items():
        assert {k: got[name][k] for k in ("p50", "p95", "p99", "count")} == brute(values), name


def test_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "g string, v double")
    assert by(rank_percentiles(df, "v", ["g"]), "g")[None]["p50"] == 3.0


def test_latency_is_in_milliseconds_and_keeps_late_events(spark):
    t = 1_700_000_000.0
    events = arrived(spark, *[{"timestamp": t, "arrival": t + s} for s in (0.25, 0.5, 90.0)])
    assert latency_percentiles(events).first().asDict() == {
        "p50": 500.0, "p95": 90_000.0, "p99": 90_000.0, "count": 3,
    }


def test_load_level_with_only_late_events_has_no_window(spark):
    from pyspark.sql import functions as F

    t = 1_700_000_000.0
    events = arrived(
        spark,
        {"user_id": 1, "timestamp": t, "arrival": t + 50},
        {"user_id": 2, "timestamp": t, "arrival": t + 1},
        {"user_id": 2, "timestamp": t + 10, "arrival": t + 12},
    ).withColumns(
        {"label": F.col("user_id").cast("string"), "rate": F.lit(5), "burst": F.lit(False)}
    )
    rows = by(load_level_summary(events), "label")
    assert (rows["1"]["windows"], rows["1"]["count"]) == (0, 1)
    assert (rows["2"]["windows"], rows["2"]["p50"]) == (2, 2000.0)


def test_a_dense_bucket_is_cut_again(spark, monkeypatch):
    """20,000 different values within one coarse bucket: no task orders more than a slice of them."""
    values = [1000 + i * 1e-5 for i in range(20_000)]
    df = frame(spark, {"a": values}).repartition(4)
    assert df.select(latency._bucket(df.v)).distinct().count() == 1
    ordered, containing = {}, latency._containing

    def noted(counts, keys, order):
        ordered[order] = counts.groupBy(*keys).count().agg({"count": "max"}).first()[0]
        return containing(counts, keys, order)

    monkeypatch.setattr(latency, "_containing", noted)
    assert rank_percentiles(df, "v").first().asDict() == brute(values)
    assert ordered["slice"] <= latency.SLICES + 1 and ordered["value"] <= 10
