"""The jobs as commands: ``spark-submit tallyloom/jobs/cli.py <job> ...``.

The master, memory and shuffle partitions are spark-submit's settings. Paths
may be anything the cluster can read.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tallyloom.functions.events import with_arrival  # noqa: E402
from tallyloom.operators.fingerprint import table_diff  # noqa: E402
from tallyloom.operators.latency import load_level_summary  # noqa: E402
from tallyloom.operators.quality import good_events  # noqa: E402
from tallyloom.operators.runs import run_metrics, speedup  # noqa: E402
from tallyloom.operators.windows import window_results  # noqa: E402
from tallyloom.plans import feature_run  # noqa: E402
from tallyloom.sources.readers import (  # noqa: E402
    read_json_lines,
    read_parquet,
    stream_json_lines,
)
from tallyloom.sources.schemas import BATCH_EVENT, TAGGED_EVENT  # noqa: E402
from tallyloom.sources.shop import synthetic_events, synthetic_stream_events  # noqa: E402
from tallyloom.sources.writers import write_events, write_json  # noqa: E402
from tallyloom.streaming import streams  # noqa: E402
from tallyloom.streaming.commits import CommittedRun  # noqa: E402

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def generate(spark: SparkSession, args: argparse.Namespace) -> None:
    """Seeded shop events."""
    write_events(synthetic_events(spark, args.rows, args.seed), args.output, args.format)


def generate_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Seeded stream events as JSON lines, from the present second on."""
    events = synthetic_stream_events(spark, args.rate, args.duration, args.seed, time.time())
    write_json(events, args.output)


def features(spark: SparkSession, args: argparse.Namespace) -> None:
    """User, product and category features of a folder of events."""
    events = read_parquet(spark, args.input, BATCH_EVENT)
    feature_run.run(spark, events, args.output, args.mode).show(truncate=False)


def compare(spark: SparkSession, args: argparse.Namespace) -> None:
    """Rows in which the feature tables of two runs differ."""
    left = feature_run.read_features(spark, args.left)
    right = feature_run.read_features(spark, args.right)
    rows = [
        table_diff(left[name], right[name]).select(F.lit(name).alias("table_name"), "*")
        for name in feature_run.FEATURE_TABLES
    ]
    first, *others = rows
    for other in others:
        first = first.unionByName(other)
    first.show(truncate=False)


def metrics(spark: SparkSession, args: argparse.Namespace) -> None:
    """Runtime, shuffle and spill of two runs from their event logs, and the speedup."""
    runs = run_metrics(spark, args.baseline, "baseline").unionByName(
        run_metrics(spark, args.candidate, "candidate")
    )
    if args.output:
        write_json(runs, args.output)
    runs.show(truncate=False)
    speedup(runs, "baseline", "candidate").show()


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Parsed events, window results, latency per window and run totals of a folder of JSON lines.

    Lines are parsed once, into ``events``, with their arrival and the load level
    of the run; windows and latency read that table. Without ``--every`` the run
    ends once all present files are read and reported.
    """
    parsed = stream_json_lines(spark, args.input, max_files_per_trigger=args.max_files)
    level = {"label": args.label, "rate": args.rate, "burst": args.burst}
    streams.run_events_job(
        with_arrival(parsed).withColumns({name: F.lit(value) for name, value in level.items()}),
        args.output,
        args.checkpoint,
        args.window,
        args.every,
    )


def _committed(spark: SparkSession, args: argparse.Namespace) -> tuple[CommittedRun, DataFrame]:
    arrived = with_arrival(stream_json_lines(spark, args.input, max_files_per_trigger=args.max_files))
    return CommittedRun(spark, args.output, arrived.schema, args.window, alert_above=args.alert_above), arrived


def commit_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """As ``stream``, with records, windows, latency, totals and alerts of each batch committed together."""
    run, arrived = _committed(spark, args)
    run.start(arrived, args.checkpoint, args.every).awaitTermination()


def commit_report(spark: SparkSession, args: argparse.Namespace) -> None:
    """What the finished batches of ``commit-stream`` tell, also while it runs."""
    run, _ = _committed(spark, args)
    write_json(window_results(run.cells(spark)), f"{args.report}/windows")
    write_json(run.latency(spark), f"{args.report}/latency")
    write_json(run.totals(spark), f"{args.report}/totals")
    if args.alert_above is not None:
        write_json(run.alerts(spark), f"{args.report}/alerts")


def load_summary(spark: SparkSession, args: argparse.Namespace) -> None:
    """Latency and windows per load level of events tagged with label, rate and burst.

    The events are JSON lines, or the ``events`` of stream jobs with ``--format parquet``.
    """
    if args.format == "parquet":
        tagged = streams.parsed_events(read_parquet(spark, args.input))
    else:
        tagged = good_events(read_json_lines(spark, args.input, TAGGED_EVENT))
    write_json(load_level_summary(tagged, args.window), args.output)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("generate", help=generate.__doc__)
    job.add_argument("--rows", type=int, default=10_000_000)
    job.add_argument("--output", required=True)
    job.add_argument("--seed", type=int, default=42)
    job.add_argument("--format", choices=["parquet", "csv", "json"], default="parquet")
    job.set_defaults(run=generate)

    job = jobs.add_parser("generate-stream", help=generate_stream.__doc__)
    job.add_argument("--rate", type=int, default=200)
    job.add_argument("--duration", type=int, default=60)
    job.add_argument("--output", required=True)
    job.add_argument("--seed", type=int, default=42)
    job.set_defaults(run=generate_stream)

    job = jobs.add_parser("features", help=features.__doc__)
    job.add_argument("--input", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--mode", default="run", help="name of the run, part of the metrics' path")
    job.set_defaults(run=features)

    job = jobs.add_parser("compare", help=compare.__doc__)
    job.add_argument("--left", required=True)
    job.add_argument("--right", required=True)
    job.set_defaults(run=compare)

    job = jobs.add_parser("metrics", help=metrics.__doc__)
    job.add_argument("--baseline", required=True)
    job.add_argument("--candidate", required=True)
    job.add_argument("--output")
    job.set_defaults(run=metrics)

    job = jobs.add_parser("stream", help=stream.__doc__)
    job.add_argument("--input", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--window", type=int, default=10)
    job.add_argument("--every", help="trigger interval, such as '5 seconds'")
    job.add_argument("--max-files", type=int)
    job.add_argument("--label", default="run", help="name of the load level")
    job.add_argument("--rate", type=int, default=0, help="events a second of the load level")
    job.add_argument("--burst", action="store_true")
    job.set_defaults(run=stream)

    for name, run in (("commit-stream", commit_stream), ("commit-report", commit_report)):
        job = jobs.add_parser(name, help=run.__doc__)
        job.add_argument("--input", required=True)
        job.add_argument("--output", required=True, help="folder of the committed batches")
        job.add_argument("--window", type=int, default=10)
        job.add_argument("--max-files", type=int)
        job.add_argument("--alert-above", type=float, help="share of late events that is too much")
        if run is commit_stream:
            job.add_argument("--checkpoint", required=True)
            job.add_argument("--every", help="trigger interval, such as '5 seconds'")
        else:
            job.add_argument("--report", required=True)
        job.set_defaults(run=run)

    job = jobs.add_parser("load-summary", help=load_summary.__doc__)
    job.add_argument("--input", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--format", choices=["json", "parquet"], default="json")
    job.add_argument("--window", type=int, default=10)
    job.set_defaults(run=load_summary)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = (
        SparkSession.builder.appName(f"tallyloom-{args.job}")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .getOrCreate()
    )
    args.run(spark, args)


if __name__ == "__main__":
    main()
