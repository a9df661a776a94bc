import random
import re

import pytest
from helpers import arrived
from pyspark.sql import functions as F

from tallyloom.operators.anchored import anchored_category_revenue, anchored_cells, anchored_totals, anchored_type_counts, anchored_windows, closing_arrivals
from tallyloom.sources.schemas import ARRIVED_EVENT
from tallyloom.streaming.anchored import AnchoredStream


def plain_loop(events, width=10, start=None):
    """One pass in order of arrival; the last window is open."""
    events = sorted(events, key=lambda e: (e["arrival"], e["event_id"] is not None, e["event_id"] or 0))
    windows, open_ = [], None
    for e in events:
        if open_ is None:
            open_ = {"start": e["arrival"] if start is None else start, "end": None, "late": 0, "n": 0, "revenue": {}, "types": {}}
        if e["arrival"] - e["timestamp"] > 2 * width:
            open_["late"] += 1
            continue
        open_["n"] += 1
        open_["types"][e["event_type"]] = open_["types"].get(e["event_type"], 0) + 1
        if e["event_type"] == "purchase":
            open_["revenue"][e["category"]] = open_["revenue"].get(e["category"], 0) + e["price"] * e["quantity"]
        if e["arrival"] >= open_["start"] + width:
            open_["end"] = e["arrival"]
            windows.append(open_)
            open_ = {"start": e["arrival"], "end": None, "late": 0, "n": 0, "revenue": {}, "types": {}}
    return windows + [open_] * (open_ is not None and open_["n"] + open_["late"] > 0)


def rows(seed, n):
    rnd = random.Random(seed)
    at, out = 1000.0, []
    for i in range(n):
        at += rnd.choice([0, 0, 0.25, 1.5, 4, 10, 35]) if rnd.random() < 0.9 else rnd.choice([0, 95, 200])
        out.append(
            {
                "event_id": rnd.choice([i, i, i, None]),
                "arrival": at,
                "timestamp": at - rnd.choice([0, 5, 20, 20.5, 300]),
                "event_type": rnd.choice(["view", "purchase"]),
                "category": rnd.choice("ab"),
                "price": rnd.randint(1, 9) / 4,
                "quantity": rnd.randint(1, 3),
            }
        )
    return out


def saver(tmp_path):
    made = []

    def save(df, name):
        made.append(str(tmp_path / f"{len(made)}-{name}"))
        df.write.parquet(made[-1])
        return df.sparkSession.read.schema(df.schema).parquet(made[-1])

    return save


def result(cells):
    out = {(r.window_start, r.window_end): [r.events_processed, r.late_dropped, {}, {}, r.total_revenue] for r in anchored_totals(cells).collect()}
    for r in anchored_category_revenue(cells).collect():
        out[r.window_start, r.window_end][2][r.category] = r.revenue
    for r in anchored_type_counts(cells).collect():
        out[r.window_start, r.window_end][3][r.event_type] = r.events
    return out


def expected(windows):
    return {(w["start"], w["end"]): [w["n"], w["late"], w["revenue"], w["types"], sum(w["revenue"].values())] for w in windows}


@pytest.mark.parametrize("seed, n", [(1, 1), (2, 2), (3, 5), (4, 23), (5, 60), (6, 150)])
def test_batch_is_the_plain_loop(spark, tmp_path, seed, n):
    events = rows(seed, n)
    table = arrived(spark, *events).repartition(3, F.rand(1))
    windows = anchored_windows(table, saver(tmp_path))
    assert result(anchored_cells(table, windows)) == expected(plain_loop(events))


def test_edges(spark, tmp_path):
    none = arrived(spark, {}).where("false")
    assert anchored_cells(none, anchored_windows(none, saver(tmp_path / "a"))).collect() == []
    late = [{"event_id": i, "arrival": 1000.0 + 50 * i, "timestamp": 0.0, "event_type": "view", "category": "a", "price": 1.0, "quantity": 1} for i in range(3)]
    table = arrived(spark, *late)
    assert result(anchored_cells(table, anchored_windows(table, saver(tmp_path / "b")))) == {(1000.0, None): [0, 3, {}, {}, 0.0]}
    same = [{**late[0], "timestamp": 1000.0, "event_id": i} for i in range(4)] + [{**late[0], "arrival": 1010.0, "timestamp": 1010.0, "event_id": i} for i in (9, 8, 7)]
    table = arrived(spark, *same)
    cells = anchored_cells(table, anchored_windows(table, saver(tmp_path / "c")))
    assert {k: v[0] for k, v in result(cells).items()} == {(1000.0, 1010.0): 5, (1010.0, None): 2}
    early = anchored_windows(table, saver(tmp_path / "d"), start=985.0)
    assert sorted((r.window_start, r.window_end) for r in early.collect() if r.window_end) == [(985.0, 1000.0), (1000.0, 1010.0)]


def apart(events):
    """The same events at arrivals that all differ."""
    return [{**e, "arrival": e["arrival"] + i / 1024, "timestamp": e["timestamp"] + i / 1024} for i, e in enumerate(events)]


@pytest.mark.parametrize("cuts", [[30], [1, 2, 40], [10, 20, 30, 40, 50, 60]])
def test_stream_is_the_plain_loop_on_every_prefix(spark, tmp_path, cuts):
    events = apart(rows(7, 70))
    stream = AnchoredStream(spark, str(tmp_path / "out"))
    run = stream.ledger.each(stream.take)
    for number, (low, high) in enumerate(zip([0, *cuts], [*cuts, 70])):
        part = arrived(spark, *events[low:high])
        run(part, number)
        run(part, number)  # a replay
        assert result(stream.cells(spark)) == expected(plain_loop(events[:high]))


def test_stream_restarted_and_killed(spark, tmp_path, monkeypatch):
    events = apart(rows(8, 60))
    for part in (events[:25], events[25:26], events[26:]):
        arrived(spark, *part).write.mode("append").parquet(str(tmp_path / "in"))
        stream = AnchoredStream(spark, str(tmp_path / "out"))
        source = spark.readStream.schema(ARRIVED_EVENT).parquet(str(tmp_path / "in"))
        write = stream.ledger.commit
        monkeypatch.setattr(stream.ledger, "commit", lambda *x: 1 / 0)
        with pytest.raises(Exception):
            stream.start(source, str(tmp_path / "ck")).awaitTermination()
        monkeypatch.setattr(stream.ledger, "commit", write)
        stream.start(source, str(tmp_path / "ck")).awaitTermination()
    assert result(stream.cells(spark)) == expected(plain_loop(events))


def test_no_frame_runs_against_its_order(spark, tmp_path):
    """A frame up to the end of its partition is computed anew for every row: quadratic in a stretch."""
    table = arrived(spark, *rows(9, 40))
    windows = anchored_windows(table, saver(tmp_path))
    opens = spark.createDataFrame([(1000.0, True)], "at double, closer boolean")
    for df in (closing_arrivals(opens, 10), anchored_cells(table, windows)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert re.search("unboundedpreceding", plan, re.I) and not re.search("unboundedfollowing", plan, re.I)


def test_rounds_of_pointers_get_smaller(spark, tmp_path):
    """Dense arrivals over many windows: later rounds hold few of them, and no window is lost."""
    rnd, at, events = random.Random(10), 1000.0, []
    for i in range(6000):
        at += rnd.random() / 2
        events.append({"event_id": i, "arrival": at, "timestamp": at, "event_type": "view", "category": "a", "price": 1.0, "quantity": 1})
    table, sizes, save = arrived(spark, *events), {}, saver(tmp_path)

    def counted(df, name):
        saved = save(df, name)
        sizes[name] = saved.count()
        return saved

    windows = anchored_windows(table, counted)
    assert sorted(windows.collect()) == sorted((w["start"], w["end"], None) if w["end"] is None else (w["start"], w["end"], e["event_id"]) for w in plain_loop(events) for e in events if e["arrival"] == (w["end"] or w["start"]))
    assert sizes["jumps-4"] < len(events) / 3


@pytest.mark.parametrize("odd", [float("nan"), float("inf"), 1e18])
def test_arrivals_that_no_width_moves_end_the_chain(spark, tmp_path, odd):
    events = [{"event_id": i, "arrival": x, "timestamp": x} for i, x in enumerate([1000.0, 1011.0, odd])]
    windows = anchored_windows(arrived(spark, *events), saver(tmp_path))
    assert windows.where("window_end IS NULL").count() == 1
