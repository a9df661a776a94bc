"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.events import rounded, with_defaults
from tallyloom.operators import anchored, buckets, features, fingerprint, latency, maintained, quality, sketches, windows
from tallyloom.operators.schedule import with_scheduled_level
from tallyloom.plans import feature_run
from tallyloom.sources import readers, writers
from tallyloom.sources.lines import parse_lines
from tallyloom.sources.schemas import ARRIVED_EVENT, BATCH_EVENT, STREAM_EVENT, WINDOW_RESULT, with_corrupt_column
from tallyloom.sources.shop import arrived_events, shop_events
from tallyloom.sources.variants import parse_whole_lines, read_again
from tallyloom.streaming import streams
from tallyloom.streaming.anchored import AnchoredStream
from tallyloom.streaming.commits import CommittedRun
from tallyloom.streaming.idstore import IdStore
from tallyloom.workspace import new_folder

HOUR = 3600
LATE_AFTER = 20
WATERMARK = 60
SLICES = 4
LOCATED = 64

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_parquet(spark, f"{sf_dir}/events.parquet")


def _shop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shop_events(_events(spark, sf_dir))


def _arrived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrived_events(_events(spark, sf_dir))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_cells(_arrived(spark, sf_dir), HOUR, LATE_AFTER)


def over_shop(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_shop(spark, sf_dir))


def over_purchases(operator: Callable[[DataFrame], DataFrame]) -> Query:
    """For operators on purchases only: the type filter is pushed into the scan."""
    return lambda spark, sf_dir: operator(
        shop_events(_events(spark, sf_dir), only=[features.PURCHASE])
    )


def over_arrived(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_arrived(spark, sf_dir))


def over_cells(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_cells(spark, sf_dir))


# -- data with faults, made from the whole events table -------------------------


def _every(n: int, at: int) -> Column:
    return F.col("event_id") % n == at


def _with_gaps(events: DataFrame) -> DataFrame:
    """Some categories, types, prices and quantities missing."""
    gaps = {"category": 3, "event_type": 5, "price": 11, "quantity": 13}
    return events.withColumns(
        {name: F.when(_every(17, at), None).otherwise(F.col(name)) for name, at in gaps.items()}
    )


def _lines(events: DataFrame, schema: T.StructType = STREAM_EVENT) -> DataFrame:
    """Events as JSON text, some of it blank, cut short, mistyped or incomplete."""
    names = schema.fieldNames()
    whole = F.to_json(F.struct(*names))
    no_time = F.to_json(F.struct(*[n for n in names if n != "timestamp"]))
    sparse = F.to_json(F.struct(*[n for n in names if n not in ("category", "quantity")]))
    line = (
        F.when(_every(50, 7), F.concat(F.substring(whole, 1, 20), F.lit(", bad")))
        .when(_every(50, 13), "null")
        .when(_every(50, 21), "5")
        .when(_every(50, 25), "[1]")
        .when(_every(50, 29), no_time)
        .when(_every(50, 37), "   ")
        .when(_every(50, 33), F.concat(whole, whole))
        .when(_every(50, 43), sparse)
        .when(_every(50, 47), F.regexp_replace(whole, '"price":[^,]*', '"price":"abc"'))
        .otherwise(whole)
    )
    return events.select(line.alias("value"))


def _recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field that the first schema didn't name, out of the stored records, next to the others."""
    events = _arrived(spark, sf_dir)
    named = T.StructType([*STREAM_EVENT.fields, T.StructField("channel", T.StringType())])
    channel = F.when(_every(2, 0), F.concat(F.lit("c"), (F.col("event_id") % 3).cast("string")))
    path = new_folder(spark, "whole-records")
    writers.write_parquet(parse_whole_lines(_lines(events.withColumn("channel", channel), named), STREAM_EVENT), path)
    again = read_again(readers.read_parquet(spark, path), named)
    return quality.good_events(again.drop("whole"))


def _with_copies(events: DataFrame) -> DataFrame:
    """A third of the events a second time, later and with another price."""
    copies = events.filter(_every(3, 0)).withColumns(
        {"arrival": F.col("arrival") + 5, "price": F.col("price") + 1}
    )
    return events.unionByName(copies)


def _with_strays(events: DataFrame) -> DataFrame:
    """Some events far older than their arrival, and some with a time in the far future."""
    time = (
        F.when(_every(19, 5), F.col("timestamp") - 155)
        .when(_every(23, 7), F.col("timestamp") + 1_000_000)
        .otherwise(F.col("timestamp"))
    )
    return events.withColumn("timestamp", time)


def _with_copies_and_gaps(events: DataFrame) -> DataFrame:
    """Strays, a third of all events a second time five seconds later, some ids missing."""
    strays = _with_strays(events)
    later = strays.filter(_every(3, 0)).withColumn("arrival", F.col("arrival") + 5)
    unnamed = F.when(~_every(29, 3), F.col("event_id"))
    return strays.unionByName(later).withColumn("event_id", unnamed)


def _with_late_copies(events: DataFrame) -> DataFrame:
    """A third of the events a second time, a day and more later and with another price, some ids missing."""
    later = events.filter(_every(3, 0)).withColumns(
        {"arrival": F.col("arrival") + 86_400 + F.col("event_id") % 7, "price": F.col("price") + 1}
    )
    unnamed = F.when(~_every(29, 3), F.col("event_id"))
    return events.unionByName(later).withColumn("event_id", unnamed)


def _load_levels(events: DataFrame) -> DataFrame:
    level = F.col("event_id") % 3
    return events.withColumns(
        {
            "label": F.when(level == 0, "low").when(level == 1, "medium").otherwise("high"),
            "rate": F.when(level == 0, 100).when(level == 1, 1000).otherwise(5000).cast("bigint"),
            "burst": level == 2,
        }
    )


# -- queries that write and read back --------------------------------------------


def _row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_run.feature_row_counts(_shop(spark, sf_dir))


def _feature_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = new_folder(spark, "features")
    metrics = feature_run.run(spark, _shop(spark, sf_dir), output)
    return metrics.select(
        "rows_processed", "user_feature_rows", "product_feature_rows", "category_feature_rows"
    )


METRICS = (
    "mode string, workers long, shuffle_partitions long, rows_processed long, user_feature_rows long, "
    "product_feature_rows long, category_feature_rows long, runtime_seconds double"
)
HASHES = (
    "mode string, workers long, runtime_seconds double, table_name string, row_count long, "
    "hash_a string, hash_b string"
)
SUMMARY = (
    "label string, rate long, burst boolean, p50 double, p95 double, p99 double, count long, "
    "windows long"
)


def _metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics as read back; measured values as whether they are there."""
    output = new_folder(spark, "features")
    feature_run.run(spark, _shop(spark, sf_dir), output, "check")
    row = spark.read.schema(METRICS).json(feature_run.metrics_path(output, "check"))
    measured = ("workers", "shuffle_partitions", "runtime_seconds")
    return row.withColumns({name: F.col(name) > 0 for name in measured})


def _hashes_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprints as read back, and whether they are those of the written tables."""
    output = new_folder(spark, "features")
    feature_run.run(spark, _shop(spark, sf_dir), output, "check")
    rows = spark.read.schema(HASHES).json(f"{output}/output_hashes")
    again = fingerprint.fingerprints(feature_run.read_features(spark, output)).select(
        "table_name", F.struct("row_count", "hash_a", "hash_b").alias("again")
    )
    same = F.col("again") == F.struct("row_count", "hash_a", "hash_b")
    return rows.join(again, "table_name").select(
        "mode",
        (F.col("workers") > 0).alias("workers"),
        (F.col("runtime_seconds") > 0).alias("runtime_seconds"),
        "table_name",
        "row_count",
        same.alias("same"),
    )


def _load_summary_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "load-summary")
    writers.write_json(latency.load_level_summary(_load_levels(_arrived(spark, sf_dir))), path)
    return spark.read.schema(SUMMARY).json(path)


def _round_trip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "parquet")
    writers.write_events(_shop(spark, sf_dir), path, "parquet")
    return readers.read_parquet(spark, path, BATCH_EVENT)


def _round_trip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "csv")
    writers.write_events(_shop(spark, sf_dir), path, "csv")
    return readers.read_csv(spark, path, BATCH_EVENT)


def _round_trip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "json")
    writers.write_events(_arrived(spark, sf_dir).drop("arrival"), path, "json")
    return quality.good_events(readers.read_json_lines(spark, path))


def _by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "by-date")
    day = F.date_from_unix_date(F.floor(F.col("timestamp") / 86_400).cast("int"))
    writers.write_by_date(_shop(spark, sf_dir), path, day)
    days = readers.read_parquet(spark, path).groupBy(
        F.col("event_date").cast("string").alias("event_date")
    )
    return days.agg(
        F.count("event_id").alias("events"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
    )


def _slices(events: DataFrame) -> list[DataFrame]:
    """The events in the order of their arrival, cut into slices of time of equal length."""
    low, high = events.agg(F.min("arrival"), F.max("arrival")).first()
    if low is None or low == high:
        return [events]
    place = F.least(F.floor((F.col("arrival") - low) / (high - low) * SLICES), F.lit(SLICES - 1))
    return [events.filter(place == k) for k in range(SLICES)]


def _replay(
    spark: SparkSession, events: DataFrame, folder: str, operator: Callable, fmt: str = "parquet"
) -> None:
    """Adds slice after slice to the source, and takes the stream up again after each.

    Every slice meets the state, the watermark and the checkpoint that the ones
    before it left.
    """
    for events_of_slice in _slices(events):
        events_of_slice.write.mode("append").parquet(f"{folder}/in")
        stream = readers.stream_parquet(spark, f"{folder}/in", events.schema)
        streams.run_available(operator(stream), f"{folder}/out", f"{folder}/checkpoint", fmt)


def _cell_stream(stream: DataFrame) -> DataFrame:
    return streams.window_cell_stream(stream, HOUR, WATERMARK, late_after_seconds=LATE_AFTER)


def _stream_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream-windows")
    _replay(spark, _arrived(spark, sf_dir), folder, _cell_stream)
    return readers.read_parquet(spark, f"{folder}/out")


def _stream_late_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream-late")
    _replay(spark, _with_strays(_arrived(spark, sf_dir)), folder, _cell_stream)
    return windows.window_totals(readers.read_parquet(spark, f"{folder}/out"))


def _stream_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream-results")
    _replay(
        spark,
        _arrived(spark, sf_dir),
        folder,
        lambda stream: windows.window_results(_cell_stream(stream)),
        "json",
    )
    return spark.read.schema(WINDOW_RESULT).json(f"{folder}/out")


def _stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the sink after half of the input, after a run without input, and at the end."""
    folder = new_folder(spark, "stream-resume")
    events = _arrived(spark, sf_dir)
    slices = _slices(events)
    half = len(slices) // 2
    written = []
    for some in (slices[:half], [], slices[half:]):
        for events_of_slice in some:
            events_of_slice.write.mode("append").parquet(f"{folder}/in")
        stream = readers.stream_parquet(spark, f"{folder}/in", events.schema)
        streams.run_available(_cell_stream(stream), f"{folder}/out", f"{folder}/checkpoint")
        written.append(readers.read_parquet(spark, f"{folder}/out").count())
    names = ("cells_after_half", "cells_after_idle_run", "cells_after_rest")
    return spark.range(1).select(
        *[F.lit(n).cast("bigint").alias(name) for name, n in zip(names, written)]
    )


def _stream_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream-parse")
    for events_of_slice in _slices(_arrived(spark, sf_dir)):
        _lines(events_of_slice).write.mode("append").text(f"{folder}/lines")
        parsed = readers.stream_json_lines(spark, f"{folder}/lines")
        streams.start_parsed(parsed, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return readers.read_parquet(spark, f"{folder}/out").agg(
        F.count_if(F.col("record") == "good").alias("processed"),
        F.count_if(F.col("record") == "bad").alias("errors"),
    )


def _stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream-dedup")
    _replay(
        spark, _with_copies_and_gaps(_arrived(spark, sf_dir)), folder, quality.dedup_stream
    )
    return readers.read_parquet(spark, f"{folder}/out").select("event_id", "event_type", "price")


def _stream_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream-latency")
    events = _with_strays(_arrived(spark, sf_dir))
    _replay(
        spark, events, folder, lambda s: latency.approx_latency_by_window(s, HOUR, WATERMARK)
    )
    return latency.sketch_errors(readers.read_parquet(spark, f"{folder}/out"), events, HOUR)


def _exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by id store over several runs, every batch sent a second time under its number."""
    folder = new_folder(spark, "exactly-once")
    events = _with_late_copies(_arrived(spark, sf_dir))
    for events_of_slice in _slices(events):
        events_of_slice.write.mode("append").parquet(f"{folder}/in")
        store = IdStore(spark, f"{folder}/store", events.schema, buckets=16)
        stream = readers.stream_parquet(spark, f"{folder}/in", events.schema)
        store.start(stream, f"{folder}/checkpoint").awaitTermination()
        store.ledger.each(store.take)(events_of_slice, store.ledger.last(spark))
    return store.events(spark).select("event_id", "event_type", "price")


def _anchored_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _arrived(spark, sf_dir)

    def save(table: DataFrame, name: str) -> DataFrame:
        path = new_folder(spark, f"anchored-{name}")
        table.write.parquet(path)
        return readers.read_parquet(spark, path, table.schema)

    found = save(anchored.anchored_windows(events, save, HOUR, LATE_AFTER), "windows")
    return anchored.anchored_cells(events, found, HOUR, LATE_AFTER)


def _stream_anchored(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream-anchored")
    events = _arrived(spark, sf_dir)
    for events_of_slice in _slices(events):
        events_of_slice.write.mode("append").parquet(f"{folder}/in")
        run = AnchoredStream(spark, f"{folder}/out", HOUR, LATE_AFTER)
        stream = readers.stream_parquet(spark, f"{folder}/in", events.schema)
        run.start(stream, f"{folder}/checkpoint").awaitTermination()
    return anchored.anchored_totals(run.cells(spark))


def _committed(spark: SparkSession, sf_dir: str, **options) -> CommittedRun:
    """Lines of four slices, each taken up by a run of its own."""
    folder = new_folder(spark, "committed")
    for events_of_slice in _slices(_arrived(spark, sf_dir)):
        _lines(events_of_slice, ARRIVED_EVENT).write.mode("append").text(f"{folder}/lines")
        run = CommittedRun(spark, f"{folder}/out", with_corrupt_column(ARRIVED_EVENT), HOUR, LATE_AFTER, **options)
        parsed = readers.stream_json_lines(spark, f"{folder}/lines", ARRIVED_EVENT)
        run.start(parsed, f"{folder}/checkpoint").awaitTermination()
    return run


def _committed_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per window what the sketches tell, and whether each rank is right to within their error."""
    run = _committed(spark, sf_dir)
    found = run.latency(spark)
    events = latency.with_latency(quality.good_events(run.records(spark).filter(~F.col("bad")).drop("bad")))
    events = events.withColumn("window_start", F.floor(F.col("arrival") / HOUR) * HOUR)
    errors = sketches.rank_errors(found, events, ["window_start"], "latency_ms")
    return errors.join(found.select("window_start", "least", "most"), "window_start")


def _by_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load levels that overlap and leave a gap, as shares of the time in which events arrived."""
    events = _arrived(spark, sf_dir)
    ends = events.agg(F.min("arrival").alias("low"), F.max("arrival").alias("high"))
    levels = [("low", 100, False, 0.0, 0.5), ("medium", 1000, False, 0.4, 0.7), ("high", 5000, True, 0.8, 1.0)]
    at = lambda share: F.col("low") + (F.col("high") - F.col("low")) * F.lit(share)
    names = ("label", "rate", "burst", "start", "end")
    rows = [(F.lit(label), F.lit(rate).cast("long"), F.lit(burst), at(first), at(last)) for label, rate, burst, first, last in levels]
    schedule = ends.select(F.explode(F.array(*[F.struct(*[x.alias(name) for x, name in zip(row, names)]) for row in rows])).alias("level")).select("level.*")
    tagged = with_scheduled_level(events, schedule, slot_seconds=HOUR)
    return latency.load_level_summary(tagged.where(F.col("label").isNotNull()))


def _rollup(spark: SparkSession, sf_dir: str, span: int | None, by: list[str]) -> DataFrame:
    """Sketches of 10 s windows, rolled up over time and load level and compared with the samples."""
    events = _load_levels(_arrived(spark, sf_dir))
    path = new_folder(spark, "latency-sketches")
    writers.write_parquet(sketches.latency_sketches(events, 10, by), path)
    found = sketches.sketch_percentiles(sketches.rolled_up(readers.read_parquet(spark, path), span, by))
    samples = latency.with_latency(events)
    keys = [*by]
    if span is not None:
        samples, keys = samples.withColumn("window_start", F.floor(F.col("arrival") / span) * span), ["window_start", *by]
    errors = sketches.rank_errors(found, samples, keys, "latency_ms")
    return errors.join(found.select(*keys, "least", "most"), keys)


# -- comparisons -------------------------------------------------------------------


def _table_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _shop(spark, sf_dir)
    changed = events.withColumn(
        "price", F.when(_every(97, 0), F.col("price") + 1).otherwise(F.col("price"))
    )
    return fingerprint.table_diff(events, changed.unionByName(events.filter(_every(89, 0))))


def _located_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows in which two written versions of the events differ."""
    events = _shop(spark, sf_dir)
    changed = F.when(_every(997, 0), F.col("price") + 1).otherwise(F.col("price"))
    folder = new_folder(spark, "versions")
    buckets.write_bucketed(events, f"{folder}/before", ["event_id"], LOCATED)
    after = events.withColumn("price", changed).unionByName(events.filter(_every(1009, 0)))
    buckets.write_bucketed(after, f"{folder}/after", ["event_id"], LOCATED)
    found = buckets.located_diff(spark, f"{folder}/before", f"{folder}/after", events.schema, LOCATED)
    return found.select("event_id", "price", "only_left", "only_right")


def _maintained(table: str) -> Query:
    """Feature tables of events of which a third comes late, after the first states were written."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = new_folder(spark, "maintained")
        events = _shop(spark, sf_dir)
        day = F.date_from_unix_date(F.floor(F.col("timestamp") / 86_400).cast("int"))
        late = _every(3, 0) & (F.dayofmonth(day) % 2 == 0)
        writers.write_by_date(events.filter(~late), f"{folder}/events", day)
        maintained.refresh(readers.read_parquet(spark, f"{folder}/events"), f"{folder}/states")
        more = events.filter(late).withColumn(maintained.DAY, day)
        more.write.mode("append").partitionBy(maintained.DAY).parquet(f"{folder}/events")
        days = [row[0] for row in more.select(maintained.DAY).distinct().collect()]
        maintained.refresh(readers.read_parquet(spark, f"{folder}/events"), f"{folder}/states", days)
        return maintained.maintained_table(spark, f"{folder}/states", table)

    return run


def _reproducible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the user features, the second over rows in another order."""
    events = _shop(spark, sf_dir)
    again = events.repartition(7, "product_id")
    return fingerprint.table_diff(features.user_features(events), features.user_features(again))


def _content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the hash passes over order and sees a change; its numbers belong to one engine."""
    events = _shop(spark, sf_dir)
    changed = F.when(_every(1009, 0), F.col("price") + 1).otherwise(F.col("price"))
    tables = {
        "first": events,
        "moved": events.repartition(7, "product_id").select(*sorted(events.columns)),
        "changed": events.withColumn("price", changed),
        "copied": events.unionByName(events.filter(_every(1009, 0))),
    }
    row = fingerprint.fingerprints(tables).agg(
        *[
            F.max(F.when(F.col("table_name") == name, F.struct("row_count", "hash_a", "hash_b")))
            .alias(name)
            for name in tables
        ]
    )
    return row.select(
        "first.row_count",
        (F.col("first") == F.col("moved")).alias("same_when_moved"),
        (F.col("first") != F.col("changed")).alias("differs_when_changed"),
        (F.col("first") != F.col("copied")).alias("differs_with_copies"),
    )


def _wide_numbers(events: DataFrame) -> DataFrame:
    """Doubles of sizes that engines write differently."""
    return events.select(
        "event_id", (F.col("price") * 1e9).alias("large"), (F.col("price") / 1e6).alias("small")
    )


def _scaled(events: DataFrame) -> DataFrame:
    """Prices ten thousand times as high, and fractions of a piece."""
    return events.withColumns(
        {"price": F.rint(F.col("price") * 100) * 1e4, "quantity": F.col("quantity") + 0.25}
    )


def all_queries() -> dict[str, Query]:
    return {
        # sources and projections
        "scan_events": over_shop(lambda events: events),
        "purchases_spend": over_purchases(features.purchases_with_spend),
        "defaults_applied": over_arrived(lambda e: with_defaults(_with_gaps(e))),
        # feature tables
        "user_activity": over_shop(features.user_activity),
        "user_spend": over_purchases(features.user_spend),
        "user_features": over_shop(features.user_features),
        "product_activity": over_shop(features.product_activity),
        "product_revenue": over_purchases(features.product_revenue),
        "product_features": over_shop(features.product_features),
        "product_features_by_category": over_shop(features.product_features_by_category),
        "category_activity": over_shop(features.category_activity),
        "category_revenue": over_purchases(features.category_revenue),
        "category_features": over_shop(features.category_features),
        "user_spend_of_fractions": over_purchases(lambda e: features.user_spend(_scaled(e))),
        "maintained_user_features": _maintained("user_features"),
        "maintained_product_features": _maintained("product_features"),
        "maintained_category_features": _maintained("category_features"),
        "row_counts": _row_counts,
        "feature_run": _feature_run,
        "run_metrics_json": _metrics_json,
        "output_hashes_json": _hashes_json,
        # windows
        "late_split": over_arrived(windows.late_split),
        "window_totals": over_cells(windows.window_totals),
        "window_totals_rounded": over_cells(lambda cells: rounded(windows.window_totals(cells))),
        "window_category_revenue": over_cells(windows.window_category_revenue),
        "window_type_counts": over_cells(windows.window_type_counts),
        "window_result_nested": over_cells(
            lambda cells: windows.window_result_scalars(windows.window_results(cells))
        ),
        "window_result_entries": over_cells(
            lambda cells: windows.window_result_entries(windows.window_results(cells))
        ),
        "anchored_window_totals": lambda spark, d: anchored.anchored_totals(
            _anchored_cells(spark, d)
        ),
        "anchored_window_category_revenue": lambda spark, d: anchored.anchored_category_revenue(
            _anchored_cells(spark, d)
        ),
        "anchored_window_type_counts": lambda spark, d: anchored.anchored_type_counts(
            _anchored_cells(spark, d)
        ),
        "late_rate_alerts": over_cells(
            lambda cells: windows.late_rate_alerts(windows.window_totals(cells))
        ),
        # latency
        "latency_percentiles": over_arrived(latency.latency_percentiles),
        "latency_percentiles_by_window": over_arrived(
            lambda e: latency.latency_by_window(e, HOUR)
        ),
        "latency_alerts": over_arrived(
            lambda e: latency.latency_alerts(latency.latency_by_window(e, HOUR))
        ),
        "load_level_summary": over_arrived(lambda e: latency.load_level_summary(_load_levels(e))),
        "load_summary_json": _load_summary_json,
        "load_level_by_schedule": _by_schedule,
        "latency_rollup_by_day": lambda spark, d: _rollup(spark, d, 24 * HOUR, []),
        "latency_rollup_by_level": lambda spark, d: _rollup(spark, d, None, ["label"]),
        # quality
        "parse_events": over_arrived(
            lambda e: quality.good_events(parse_lines(_lines(e)))
        ),
        "quarantine": over_arrived(
            lambda e: quality.quarantine_reasons(parse_lines(_lines(e)))
        ),
        "parse_error_count": over_arrived(
            lambda e: quality.parse_totals(parse_lines(_lines(e)))
        ),
        "parse_recovered_field": _recovered,
        "dedup_events": over_arrived(
            lambda e: quality.dedup_events(_with_copies(e), first_by="arrival")
        ),
        "content_hash": _content_hash,
        "content_hash_sha256": over_shop(lambda e: fingerprint.content_hash(e, "sha256")),
        "content_hash_sha256_wide": over_shop(
            lambda e: fingerprint.content_hash(_wide_numbers(e), "sha256")
        ),
        "table_diff": _table_diff,
        "table_diff_located": _located_diff,
        "reproducible_user_features": _reproducible,
        # sinks
        "sink_round_trip_parquet": _round_trip_parquet,
        "sink_round_trip_csv": _round_trip_csv,
        "sink_round_trip_json": _round_trip_json,
        "event_date_partitioned": _by_date,
        # streams
        "stream_window_totals": lambda spark, d: windows.window_totals(_stream_cells(spark, d)),
        "stream_window_category_revenue": lambda spark, d: windows.window_category_revenue(
            _stream_cells(spark, d)
        ),
        "stream_window_type_counts": lambda spark, d: windows.window_type_counts(
            _stream_cells(spark, d)
        ),
        "stream_late_totals": _stream_late_totals,
        "stream_window_results": lambda spark, d: windows.window_result_scalars(
            _stream_results(spark, d)
        ),
        "stream_window_result_entries": lambda spark, d: windows.window_result_entries(
            _stream_results(spark, d)
        ),
        "stream_parse_events": _stream_parse,
        "stream_dedup_events": _stream_dedup,
        "stream_latency_by_window": _stream_latency,
        "stream_resume": _stream_resume,
        "stream_exactly_once": _exactly_once,
        "stream_anchored_window_totals": _stream_anchored,
        "stream_committed_windows": lambda spark, d: windows.window_totals(
            _committed(spark, d).cells(spark)
        ),
        "stream_alerts": lambda spark, d: _committed(
            spark, d, alert_above=0.34, delay_seconds=WATERMARK, quiet_seconds=2 * HOUR
        ).alerts(spark),
        "stream_committed_totals": lambda spark, d: _committed(spark, d).totals(spark),
        "stream_committed_latency": _committed_latency,
    }
