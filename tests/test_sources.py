import os

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.fingerprint import content_hash
from tallyloom.sources.readers import read_csv, read_parquet
from tallyloom.sources.schemas import BATCH_EVENT, STREAM_EVENT
from tallyloom.sources.shop import (
    CATEGORIES,
    EVENT_TYPE_WEIGHTS,
    RATING_WEIGHTS,
    STREAM_EVENT_TYPE_WEIGHTS,
    synthetic_events,
    synthetic_stream_events,
)
from tallyloom.sources.writers import write_by_date, write_csv, write_events, write_parquet
from tallyloom.workspace import new_folder


@pytest.mark.parametrize("rows", [1, 499_999, 1_250_000])
def test_exact_number_of_rows(spark, rows):
    assert synthetic_events(spark, rows).count() == rows


def test_same_events_for_any_partitioning(spark):
    one = content_hash(synthetic_events(spark, 20_000, partitions=1)).first()
    assert content_hash(synthetic_events(spark, 20_000, partitions=7)).first() == one
    assert content_hash(synthetic_events(spark, 20_000, seed=43)).first() != one


def test_schema_domains_and_weights(spark):
    events = synthetic_events(spark, 100_000)
    assert dict(events.dtypes) == {f.name: f.dataType.simpleString() for f in BATCH_EVENT}
    numbers = "user_id product_id price quantity session_id rating timestamp".split()
    row = events.agg(
        *[F.min(c).alias(f"min_{c}") for c in numbers],
        *[F.max(c).alias(f"max_{c}") for c in numbers],
    ).first()
    assert 1 <= row.min_user_id < row.max_user_id <= 100_000
    assert 1 <= row.min_product_id < row.max_product_id <= 50_000
    assert 1.0 <= row.min_price < row.max_price <= 999.99
    assert (row.min_quantity, row.max_quantity) == (1, 10)
    assert (row.min_rating, row.max_rating) == (1.0, 5.0)
    assert 1 <= row.min_session_id < row.max_session_id <= 1_000_000
    assert 1_700_000_000 <= row.min_timestamp < row.max_timestamp < 1_700_000_000 + 7_776_000
    types = {r.event_type: r["count"] for r in events.groupBy("event_type").count().collect()}
    assert set(types) == set(EVENT_TYPE_WEIGHTS)
    for name, weight in EVENT_TYPE_WEIGHTS.items():
        assert abs(types[name] / 100_000 - weight) < 0.01
    ratings = {r.rating: r["count"] for r in events.groupBy("rating").count().collect()}
    for rating, weight in RATING_WEIGHTS.items():
        assert abs(ratings[rating] / 100_000 - weight) < 0.01
    assert {r.category for r in events.select("category").distinct().collect()} == set(CATEGORIES)


def test_stream_events_come_at_the_rate(spark):
    events = synthetic_stream_events(spark, rate=500, seconds=20)
    assert [(f.name, f.dataType) for f in events.schema] == [
        (f.name, f.dataType) for f in STREAM_EVENT
    ]
    assert events.count() == 10_000
    per_second = events.groupBy(F.floor("timestamp").alias("s")).count().collect()
    assert len(per_second) == 20 and {r["count"] for r in per_second} == {500}
    types = {r.event_type: r["count"] for r in events.groupBy("event_type").count().collect()}
    for name, weight in STREAM_EVENT_TYPE_WEIGHTS.items():
        assert abs(types.pop(name) / 10_000 - weight) < 0.02
    assert not types


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_round_trip(spark, tmp_path, fmt):
    events = synthetic_events(spark, 1000)
    write_events(events, str(tmp_path / "t"), fmt)
    read = read_parquet if fmt == "parquet" else read_csv
    again = read(spark, str(tmp_path / "t"), BATCH_EVENT)
    assert content_hash(again).first() == content_hash(events).first()


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        write_events(synthetic_events(spark, 1), str(tmp_path / "t"), "xml")


def test_writing_again_leaves_one_copy(spark, tmp_path):
    for write in (write_parquet, write_csv):
        for _ in range(2):
            write(synthetic_events(spark, 10), str(tmp_path / write.__name__))
    assert spark.read.parquet(str(tmp_path / "write_parquet")).count() == 10


def test_a_day_reads_only_its_folder(spark, tmp_path):
    path = str(tmp_path / "days")
    day = F.date_from_unix_date(F.floor(F.col("timestamp") / 86_400).cast("int"))
    write_by_date(synthetic_events(spark, 5000), path, day)
    assert len([d for d in os.listdir(path) if d.startswith("event_date=")]) in (90, 91)
    # one file per day, not one per day and task
    written = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(written) < 120
    one = spark.read.parquet(path).filter(F.col("event_date") == F.lit("2023-12-01").cast("date"))
    assert one.count() > 0
    assert len(one.inputFiles()) >= 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_folder_is_below_the_shared_one_and_new(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, other = new_folder(spark, "x"), new_folder(spark, "x")
    assert one != other
    assert one.startswith(shared)


class FakeSession:
    def __init__(self, **settings):
        self.conf = settings


def test_no_temporary_folder_on_a_cluster():
    assert "tallyloom-" in new_folder(FakeSession(**{"spark.master": "local[4]"}), "x")
    with pytest.raises(ValueError):
        new_folder(FakeSession(**{"spark.master": "yarn"}), "x")
