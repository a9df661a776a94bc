import os
import shutil

import pytest
from helpers import arrived, by
from pyspark.sql import functions as F

from tallyloom.operators.latency import approx_latency_by_window, latency_by_window, sketch_errors
from tallyloom.operators.quality import dedup_stream, good_events
from tallyloom.operators.windows import window_cells, window_results, window_totals
from tallyloom.sources.readers import stream_json_lines, stream_parquet
from tallyloom.sources.schemas import ARRIVED_EVENT, WINDOW_RESULT
from tallyloom.sources.writers import write_json
from tallyloom.streaming import streams

T0 = 1_700_000_000.0
DELAY = 30  # covers how far the replay's arrivals are out of order


def replay(spark, n=300):
    types = ["view", "purchase", "add_to_cart", "wishlist"]
    return arrived(
        spark,
        *[
            {
                "timestamp": T0 + i / 3,
                "arrival": T0 + i / 3 + i % 31,
                "event_type": types[i % 4],
                "category": f"c{i % 3}",
                "price": i / 100,
            }
            for i in range(n)
        ],
    )


def files(spark, events, folder, parts):
    """The events in order of time, one JSON file per slice, each newer than the last."""
    os.makedirs(folder, exist_ok=True)
    n = events.count()
    for k in range(parts):
        slice_ = events.filter(
            (F.col("event_id") >= n * k // parts) & (F.col("event_id") < n * (k + 1) // parts)
        )
        one = f"{folder}-slice-{k}"
        write_json(slice_.coalesce(1), one)
        (name,) = [f for f in os.listdir(one) if f.endswith(".json")]
        shutil.copy(os.path.join(one, name), os.path.join(folder, f"{k:03}.json"))
        os.utime(os.path.join(folder, f"{k:03}.json"), (1_000_000 + k, 1_000_000 + k))


def stream_of(spark, folder, **options):
    return good_events(stream_json_lines(spark, folder, ARRIVED_EVENT, **options))


def rows_read(query):
    return sum(progress["numInputRows"] for progress in query.recentProgress)


def closed(totals, events, delay):
    last = events.agg(F.max("arrival")).first()[0]
    return sorted(tuple(r) for r in totals.collect() if r.window_end <= last - delay)


def by_arrival(events):
    return window_cells(events, 10, clock="arrival")


@pytest.mark.parametrize("per_batch", [None, 1])
def test_closed_windows_are_those_of_the_batch(spark, tmp_path, per_batch):
    events = replay(spark)
    files(spark, events, str(tmp_path / "in"), 4)
    stream = stream_of(spark, str(tmp_path / "in"), max_files_per_trigger=per_batch)
    cells = streams.window_cell_stream(stream, 10, DELAY)
    query = streams.run_available(cells, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert rows_read(query) == 300
    got = window_totals(spark.read.parquet(str(tmp_path / "out")))
    want = closed(window_totals(by_arrival(events)), events, DELAY)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert len(want) == 9  # 130 s of arrivals, the last 30 s and the open window not yet closed


def test_nested_results_as_json_lines(spark, tmp_path):
    events = replay(spark)
    files(spark, events, str(tmp_path / "in"), 2)
    results = streams.window_result_stream(stream_of(spark, str(tmp_path / "in")), 10, DELAY)
    streams.run_available(results, str(tmp_path / "out"), str(tmp_path / "ck"), fmt="json")
    got = by(spark.read.schema(WINDOW_RESULT).json(str(tmp_path / "out")), "window_start")
    want = by(window_results(by_arrival(events)), "window_start")
    assert len(got) == 9
    for start, row in got.items():
        # Spark's JSON writer keeps empty maps, and doubles exactly
        assert row == want[start]


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    events = replay(spark)
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))
    files(spark, events, str(tmp_path / "all"), 3)
    os.makedirs(folder)
    read = []
    for k in (0, 1, None, 2):
        if k is not None:
            shutil.copy2(str(tmp_path / "all" / f"{k:03}.json"), folder)
        cells = streams.window_cell_stream(stream_of(spark, folder), 10, DELAY)
        read.append(rows_read(streams.run_available(cells, out, checkpoint)))
    assert read == [100, 100, 0, 100]
    got = window_totals(spark.read.parquet(out))
    want = closed(window_totals(by_arrival(events)), events, DELAY)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_late_events_and_those_from_the_future_are_counted(spark, tmp_path):
    """In a stream of several batches; none vanishes behind the watermark."""
    plain = [{"timestamp": T0 + i / 4, "arrival": T0 + i / 4} for i in range(400)]
    for i in range(20):
        plain[200 + i]["timestamp"] -= 155
    plain[150]["timestamp"] += 1e6
    events = arrived(spark, *plain)
    files(spark, events, str(tmp_path / "in"), 4)
    stream = stream_of(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    cells = streams.window_cell_stream(stream, 10)
    streams.run_available(cells, str(tmp_path / "out"), str(tmp_path / "ck"))
    totals = window_totals(spark.read.parquet(str(tmp_path / "out")))
    assert sorted(tuple(r) for r in totals.collect()) == closed(
        window_totals(by_arrival(events)), events, 20
    )
    rows = totals.collect()
    assert sum(r.late_dropped for r in rows) == 20
    assert all(r.late_dropped + r.events_processed == 40 for r in rows if r.window_start > T0)


def test_dedup_keeps_late_events_and_those_without_an_id(spark, tmp_path):
    plain = [{"timestamp": T0 + i, "arrival": T0 + i} for i in range(300)]
    for i in range(250, 255):
        plain[i]["timestamp"] -= 9000
    for i in (20, 21, 290):
        plain[i]["event_id"] = None
    events = arrived(spark, *plain)
    copies = events.filter("event_id % 10 = 0").withColumn("arrival", F.col("arrival") + 3)
    both = events.unionByName(copies)
    for k in range(3):
        part = both.filter((F.col("arrival") >= T0 + 100 * k) & (F.col("arrival") < T0 + 100 * k + 100))
        part.write.mode("append").parquet(str(tmp_path / "in"))
        stream = stream_parquet(spark, str(tmp_path / "in"), ARRIVED_EVENT)
        streams.run_available(dedup_stream(stream), str(tmp_path / "out"), str(tmp_path / "ck"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    ids = [r.event_id for r in rows if r.event_id is not None]
    assert sorted(ids) == sorted(set(range(300)) - {20, 21, 290})
    assert len(rows) - len(ids) == 3


def test_copies_are_dropped_across_batches(spark, tmp_path):
    events = replay(spark, 60)
    files(spark, events, str(tmp_path / "in"), 2)
    for name in os.listdir(tmp_path / "in"):
        shutil.copy2(tmp_path / "in" / name, tmp_path / "in" / f"again-{name}")
    stream = stream_of(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    streams.run_available(
        dedup_stream(stream, within_seconds=3600), str(tmp_path / "out"), str(tmp_path / "ck")
    )
    ids = [r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(ids) == list(range(60))


def test_parsed_stream_splits_good_and_bad(spark, tmp_path):
    lines = ['{"event_id":1,"timestamp":1.5}', "{bad", "", '{"event_id":2}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(str(tmp_path / "in"))
    parsed = stream_json_lines(spark, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    streams.start_parsed(parsed, out, str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(out).filter("record = 'bad'").count() == 2
    assert spark.read.parquet(f"{out}/record=good").first().event_id == 1


def test_streaming_latency_sketch(spark, tmp_path):
    events = replay(spark)
    events.write.parquet(str(tmp_path / "in"))
    stream = stream_parquet(spark, str(tmp_path / "in"), ARRIVED_EVENT, max_files_per_trigger=100)
    sketch = approx_latency_by_window(stream, 10, DELAY)
    streams.run_available(sketch, str(tmp_path / "out"), str(tmp_path / "ck"))
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.count() == 9
    checked = sketch_errors(rows, events, 10).collect()
    assert len(checked) == 9 and all(r.p50_right and r.p95_right and r.p99_right for r in checked)
    exact = by(latency_by_window(events, 10, "arrival"), "window_start")
    assert all(r["count"] == exact[r.window_start]["count"] for r in checked)
    assert max(r.p99 for r in rows.collect()) > 29_000


def test_a_wrong_sketch_is_noticed(spark):
    events = replay(spark)
    exact = latency_by_window(events, 10, "arrival")
    good = sketch_errors(exact, events, 10).collect()
    assert all(r.p50_right and r.p99_right for r in good)
    bad = sketch_errors(exact.withColumn("p50", F.col("p50") + 5000), events, 10).collect()
    assert any(not r.p50_right for r in bad)
