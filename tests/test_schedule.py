import random

import pytest
from helpers import arrived

from tallyloom.operators.latency import load_level_summary
from tallyloom.operators.schedule import with_scheduled_level

LEVELS = [("low", 100, False, 0.0, 500.0), ("medium", 1000, False, 400.0, 700.5), ("high", 5000, True, 800.0, 801.0), ("empty", 1, False, 5.0, 5.0), ("again", 7, False, 400.0, 700.5)]


@pytest.mark.parametrize("slot", [1, 60, 10_000])
def test_overlaps_gaps_and_a_hot_level(spark, slot):
    rnd = random.Random(1)
    times = [rnd.uniform(-50, 1000) for _ in range(300)] + [800.5] * 200 + [0.0, 400.0, 500.0, 700.5, 801.0, None]
    events = arrived(spark, *[{"event_id": i, "arrival": t} for i, t in enumerate(times)])
    schedule = spark.createDataFrame(LEVELS, "label string, rate long, burst boolean, start double, end double")
    joined = with_scheduled_level(events, schedule, slot_seconds=slot)
    got = sorted((r.event_id, r.label or "", r.rate or 0) for r in joined.collect())
    want = []
    for i, t in enumerate(times):
        own = [(i, x[0], x[1]) for x in LEVELS if t is not None and x[3] <= t < x[4]]
        want += own or [(i, "", 0)]
    assert got == sorted(want) and joined.columns == [*events.columns, "label", "rate", "burst"]
    plan = joined._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_summary_of_scheduled_levels(spark):
    events = arrived(spark, *[{"event_id": i, "timestamp": float(i), "arrival": i + 0.5} for i in range(1000)])
    schedule = spark.createDataFrame(LEVELS[:3], "label string, rate long, burst boolean, start double, end double")
    rows = load_level_summary(with_scheduled_level(events, schedule).where("label IS NOT NULL")).collect()
    assert sorted((r.label, r["count"], r.p50) for r in rows) == [("high", 1, 500.0), ("low", 500, 500.0), ("medium", 300, 500.0)]
