import pytest
from helpers import batch_events
from pyspark.sql import functions as F

from tallyloom.operators import buckets
from tallyloom.operators.buckets import differing_buckets, located_diff, read_buckets, write_bucketed
from tallyloom.operators.fingerprint import table_diff


def events(spark, n=200):
    return batch_events(spark, *[{"event_id": i if i % 50 else None, "price": i / 4, "rating": 1.0 if i % 3 else None} for i in range(n)])


def versions(spark, tmp_path, left, right, n=64):
    paths = [str(tmp_path / "left"), str(tmp_path / "right")]
    for table, path in zip((left, right), paths):
        write_bucketed(table, path, ["event_id"], n)
    return paths


def test_equal_versions_differ_nowhere(spark, tmp_path):
    left = events(spark)
    paths = versions(spark, tmp_path, left, left.repartition(5, "price"))
    assert differing_buckets(spark, *paths, buckets=64) == []
    assert located_diff(spark, *paths, left.schema, 64).count() == 0


@pytest.mark.parametrize("n", [1, 16, 64, 300])
def test_changed_added_and_removed_rows(spark, tmp_path, n):
    left = events(spark)
    price = F.when(F.col("event_id") == 77, F.col("price") + 1).otherwise(F.col("price"))
    right = left.withColumn("price", price).where("event_id IS NULL OR event_id <> 13").unionByName(left.where("event_id IN (5, 6)")).unionByName(left.where("event_id IS NULL").limit(1))
    paths = versions(spark, tmp_path, left, right, n)
    rows = located_diff(spark, *paths, left.schema, n).collect()
    got = sorted((str(r.event_id), r.only_left, r.only_right) for r in rows)
    assert got == sorted([("77", 1, 0), ("77", 0, 1), ("13", 1, 0), ("5", 0, 1), ("6", 0, 1), ("None", 0, 1)])
    totals = table_diff(left, right).first()
    assert (totals.only_left, totals.only_right) == (sum(r.only_left for r in rows), sum(r.only_right for r in rows))


def test_unchanged_buckets_are_not_scanned(spark, tmp_path, monkeypatch):
    left = events(spark)
    right = left.withColumn("price", F.when(F.col("event_id") == 77, 0.5).otherwise(F.col("price")))
    paths = versions(spark, tmp_path, left, right)
    (bucket,) = differing_buckets(spark, *paths, buckets=64)
    read = read_buckets(spark, paths[0], left.schema, [bucket])
    plan = read._jdf.queryExecution().toString()
    assert f"PartitionFilters: [isnotnull(bucket" in plan and "PushedFilters: []" in plan
    folders = {f.split("/rows/")[1].split("/")[0] for f in read.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert folders == {f"bucket={bucket}"}
    asked = []
    whole = buckets.read_buckets
    monkeypatch.setattr(buckets, "read_buckets", lambda spark, path, schema, found: asked.append(found) or whole(spark, path, schema, found))
    assert located_diff(spark, *paths, left.schema, 64).count() == 2 and asked == [[bucket]] * 2


def test_contents_exchanged_between_buckets_are_seen_at_the_root(spark, tmp_path):
    one = spark.createDataFrame([(i, 1.0) for i in range(40)], "event_id long, price double")
    paths = versions(spark, tmp_path, one, one.withColumn("event_id", F.col("event_id") + 40))
    assert len(differing_buckets(spark, *paths, buckets=64)) > 20


def test_empty_versions(spark, tmp_path):
    none = events(spark).where("false")
    paths = versions(spark, tmp_path, none, events(spark, 3))
    assert located_diff(spark, *paths, none.schema, 64).agg(F.sum("only_right")).first()[0] == 3
    assert differing_buckets(spark, paths[0], paths[0], 64) == []
