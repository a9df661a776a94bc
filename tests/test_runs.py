import json
import os
import subprocess
import sys

import pytest
from helpers import by

from tallyloom.jobs import cli
from tallyloom.operators.fingerprint import table_diff
from tallyloom.operators.runs import run_metrics, speedup
from tallyloom.plans import feature_run
from tallyloom.sources.schemas import WINDOW_RESULT
from tallyloom.sources.shop import synthetic_events

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture
def job(spark):
    """Runs a job in the tests' session."""
    before = spark.conf.get(STATE_STORE)
    yield lambda *args: cli.main(list(args))
    spark.conf.set(STATE_STORE, before)


def submit(tmp_path, log, *args):
    """Runs a job as a command of its own, with an event log."""
    os.makedirs(log)
    settings = [
        "--master local[4]",
        "--conf spark.ui.enabled=false",
        "--conf spark.sql.shuffle.partitions=4",
        "--conf spark.eventLog.enabled=true",
        "--conf spark.eventLog.compress=false",
        f"--conf spark.eventLog.dir=file://{log}",
    ]
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": " ".join(settings) + " pyspark-shell"}
    done = subprocess.run(
        [sys.executable, os.path.join(ROOT, "tallyloom", "jobs", "cli.py"), *args],
        env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-3000:]


def test_jobs_end_to_end(spark, job, tmp_path, capsys):
    data, one, two = (str(tmp_path / n) for n in ("data", "one", "two"))
    log = str(tmp_path / "log")
    job("generate", "--rows", "3000", "--output", data)
    assert spark.read.parquet(data).count() == 3000
    submit(tmp_path, log, "features", "--input", data, "--output", one)

    metrics = spark.read.json(f"{one}/metrics_run").first()
    assert metrics.rows_processed == 3000
    assert metrics.category_feature_rows == 6
    assert {r.table_name for r in spark.read.json(f"{one}/output_hashes").collect()} == set(
        feature_run.FEATURE_TABLES
    )

    # Compared with the log itself, read without Spark.
    tasks = []
    for folder, _, names in os.walk(log):
        for name in names:
            if name.startswith(("events", "local", "app")) and not name.startswith("appstatus"):
                with open(os.path.join(folder, name)) as lines:
                    tasks += [json.loads(x) for x in lines if "SparkListenerTaskEnd" in x]
    written = sum(
        t["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"] for t in tasks
    )
    (application,) = os.listdir(log)
    row = run_metrics(spark, os.path.join(log, application), "one").first()
    assert row.tasks == len(tasks) > 0
    assert row.shuffle_write_mb == written / 1e6 > 0
    assert row.shuffle_read_mb > 0
    assert row.runtime_seconds > 0

    # A second run over the same events in another order gives the same tables.
    again = synthetic_events(spark, 3000, partitions=5).orderBy("price")
    feature_run.write_features(again, two)
    left, right = feature_run.read_features(spark, one), feature_run.read_features(spark, two)
    for name in feature_run.FEATURE_TABLES:
        assert tuple(table_diff(left[name], right[name]).first()) == (0, 0)
    job("compare", "--left", one, "--right", two)
    application = os.path.join(log, application)
    job("metrics", "--baseline", application, "--candidate", application)
    printed = capsys.readouterr().out
    assert "|user_features    |0        |0         |" in printed
    assert "speedup" in printed


def test_a_log_without_events_is_an_error(spark, tmp_path):
    (tmp_path / "log").write_text("not an event log")
    with pytest.raises(Exception, match="spark.eventLog.compress"):
        run_metrics(spark, str(tmp_path / "log")).collect()


def test_speedup_picks_runs_by_label(spark):
    runs = spark.createDataFrame(
        [("a", 9.0), ("b", 3.0), ("c", 0.0)], "label string, runtime_seconds double"
    )
    assert tuple(speedup(runs, "a", "b").first()) == (9.0, 3.0, 3.0)
    assert speedup(runs, "a", "c").first().speedup is None
    assert speedup(runs, "a", "missing").first().speedup is None


def test_generated_stream_is_read_on_time(spark, job, tmp_path):
    """Events from now on are not late, and reach the windows."""
    lines, out = str(tmp_path / "lines"), str(tmp_path / "out")
    job("generate-stream", "--rate", "50", "--duration", "60", "--output", lines)
    job("stream", "--input", lines, "--output", out, "--checkpoint", str(tmp_path / "ck"))
    windows = spark.read.schema(WINDOW_RESULT).json(f"{out}/windows").collect()
    assert sum(w.events_processed for w in windows) == 3000
    for window in windows:
        assert window.late_dropped == 0
        assert sum(window.counts_by_type.values()) == window.events_processed
    assert spark.read.parquet(f"{out}/events").count() == 3000


def test_stream_job_and_load_summary(spark, job, tmp_path):
    lines = [
        json.dumps(
            {"event_id": i, "event_type": "view", "timestamp": 1.7e9 + i, "arrival": 1.7e9 + i + 1,
             "label": "low", "rate": 100, "burst": False}
        )
        for i in range(100)
    ] + ["{bad"]
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    out = str(tmp_path / "out")
    job("stream", "--input", str(tmp_path / "in"), "--output", out, "--checkpoint", str(tmp_path / "ck"))
    windows = spark.read.json(f"{out}/windows").collect()
    # read long after they happened, so all are late, and counted
    assert sum(w.late_dropped for w in windows) == 100
    assert sum(w.events_processed for w in windows) == 0
    assert spark.read.parquet(f"{out}/events").filter("record = 'bad'").count() == 1
    totals = spark.read.json(f"{out}/totals").first()
    assert (totals.processed, totals.errors, totals.latencies) == (100, 1, 100)
    assert totals.p50 > 1e9
    assert spark.read.json(f"{out}/latency").agg({"count": "sum"}).first()[0] == 100
    job("load-summary", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "load"))
    row = spark.read.json(str(tmp_path / "load")).first()
    assert (row.label, row["count"], row.windows, row.p50) == ("low", 100, 10, 1000.0)


def test_generate_stream_summarise(spark, job, tmp_path):
    """What one job writes the next one reads, and a second run adds to the first."""
    out, load = str(tmp_path / "out"), str(tmp_path / "load")
    for k in range(2):
        job("generate-stream", "--rate", "20", "--duration", "30", "--seed", str(k),
            "--output", str(tmp_path / "lines" / str(k)))
        job("stream", "--input", str(tmp_path / "lines" / "*"), "--output", out,
            "--checkpoint", str(tmp_path / "ck"), "--label", "low", "--rate", "20")
    assert spark.read.json(f"{out}/totals").first().processed == 1200
    job("load-summary", "--input", f"{out}/events", "--format", "parquet", "--output", load)
    row = spark.read.json(load).first()
    assert (row.label, row.rate, row.burst, row["count"]) == ("low", 20, False, 1200)


def test_continuous_job_reports_closed_windows(spark, tmp_path):
    """Streams over parsed records that arrive over two minutes."""
    from pyspark.sql import functions as F

    from tallyloom.streaming import streams

    lines = spark.range(600).select(
        F.to_json(F.struct("id", (F.col("id") / 5).alias("timestamp"))).alias("value")
    )
    lines.write.text(str(tmp_path / "in"))
    from tallyloom.sources.readers import stream_json_lines

    parsed = stream_json_lines(spark, str(tmp_path / "in"))
    arrived = parsed.withColumn("arrival", F.col("timestamp") + 1.0)
    out = str(tmp_path / "out")
    try:
        import threading

        args = (arrived, out, str(tmp_path / "ck"), 10, "1 second")
        worker = threading.Thread(target=streams.run_events_job, args=args, daemon=True)
        worker.start()
        import time

        for _ in range(120):
            time.sleep(0.5)
            done = [os.path.isdir(f"{out}/{name}") for name in ("windows", "latency")]
            if all(done) and spark.read.schema(WINDOW_RESULT).json(f"{out}/windows").count() >= 9:
                break
    finally:
        for query in spark.streams.active:
            query.stop()
    windows = by(spark.read.schema(WINDOW_RESULT).json(f"{out}/windows"), "window_start")
    assert len(windows) >= 9
    assert all(w["events_processed"] == 50 for start, w in windows.items() if 0 < start)
