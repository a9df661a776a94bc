import os
import random
from datetime import date

import pytest
from helpers import batch_events
from pyspark.sql import functions as F

from tallyloom.operators.features import FEATURES
from tallyloom.operators.fingerprint import table_diff
from tallyloom.operators.maintained import DAY, maintained_table, refresh
from tallyloom.sources.writers import write_by_date

DAY_0 = 1_700_006_400  # midnight


def made(seed, n, days):
    rnd = random.Random(seed)
    return [
        {
            "event_id": rnd.choice([i, i, i, None]),
            "user_id": rnd.choice([1, 1, 2, 3, None]),
            "product_id": rnd.choice([10, 11, None]),
            "category": rnd.choice(["a", "b", None]),
            "event_type": rnd.choice(["view", "purchase", "add_to_cart"]),
            "price": rnd.choice([None, 0.25, 9.99, 100.0]),
            "quantity": rnd.choice([1, 2, None]),
            "session_id": rnd.choice([None, 5, 6, 7]),
            "rating": rnd.choice([None, 1.0, 4.0]),
            "timestamp": DAY_0 + 86_400 * rnd.choice(days) + rnd.randrange(86_400),
        }
        for i in range(n)
    ]


def stored(spark, path):
    return spark.read.parquet(path)


def dated(events):
    return events.withColumn(DAY, F.date_from_unix_date(F.floor(F.col("timestamp") / 86_400).cast("int")))


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def equal(spark, states, events):
    for table in FEATURES:
        got, want = maintained_table(spark, states, table), FEATURES[table].of(events)
        assert got.dtypes == want.dtypes
        assert tuple(table_diff(got, want).first()) == (0, 0), table


def test_late_days_rewrite_only_their_folders(spark, tmp_path):
    store, states = str(tmp_path / "events"), str(tmp_path / "states")
    first = batch_events(spark, *made(1, 120, [0, 1, 2, 3]))
    day = dated(first)[DAY]
    write_by_date(first, store, F.date_from_unix_date(F.floor(F.col("timestamp") / 86_400).cast("int")))
    refresh(stored(spark, store), states)
    equal(spark, states, first)
    before = files(states)
    late = batch_events(spark, *made(2, 40, [1, 5]))
    dated(late).write.mode("append").partitionBy(DAY).parquet(store)
    days = [r[0] for r in dated(late).select(DAY).distinct().collect()]
    assert len(days) == 2 and all(isinstance(d, date) for d in days) and day is not None
    refresh(stored(spark, store), states, days)
    equal(spark, states, first.unionByName(late))
    after = files(states)
    names = {str(d) for d in days}
    touched = {f for f in before.keys() | after.keys() if before.get(f) != after.get(f)}
    assert touched and all(any(f"{DAY}={n}" in f for n in names) for f in touched)
    kept = [f for f in before if not any(n in f for n in names)]
    assert kept and all(after[f] == before[f] for f in kept)


def test_refreshing_again_changes_nothing(spark, tmp_path):
    store, states = str(tmp_path / "events"), str(tmp_path / "states")
    events = batch_events(spark, *made(3, 60, [0, 1]))
    write_by_date(events, store, F.date_from_unix_date(F.floor(F.col("timestamp") / 86_400).cast("int")))
    for _ in range(2):
        refresh(stored(spark, store), states)
    equal(spark, states, events)


def test_only_the_named_days_are_read(spark, tmp_path):
    store = str(tmp_path / "events")
    events = batch_events(spark, *made(4, 60, [0, 1, 2]))
    write_by_date(events, store, F.date_from_unix_date(F.floor(F.col("timestamp") / 86_400).cast("int")))
    read = stored(spark, store).where(F.col(DAY).isin([date(2023, 11, 15)]))
    assert "PartitionFilters: [isnotnull(event_date" in read._jdf.queryExecution().toString()
    folders = {f.split(f"{DAY}=")[1].split("/")[0] for (f,) in read.select(F.input_file_name()).distinct().collect()}
    assert folders == {"2023-11-15"}


@pytest.mark.parametrize("table", sorted(FEATURES))
def test_hot_group_is_dealt_by_value(spark, tmp_path, table):
    states = str(tmp_path / "states")
    refresh(dated(batch_events(spark, *made(5, 50, [0]))), states)
    plan = maintained_table(spark, states, table)._jdf.queryExecution().toString()
    assert "value" in plan and "collect_set" not in plan
