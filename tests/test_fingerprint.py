import pytest
from helpers import batch_events
from pyspark.sql import functions as F

from tallyloom.operators.fingerprint import content_hash, fingerprints, table_diff
from tallyloom.sources.shop import synthetic_events


@pytest.fixture(params=["xxhash64", "sha256"])
def digest(request):
    return lambda df: content_hash(df, request.param).first()


def test_order_partitions_and_column_order_do_not_matter(spark, digest):
    events = synthetic_events(spark, 500, partitions=3)
    again = events.repartition(7, "price").orderBy(F.desc("price")).select(*sorted(events.columns))
    assert digest(events) == digest(again)


def test_one_changed_cell_or_one_copy_matters(spark, digest):
    events = synthetic_events(spark, 500)
    base = digest(events)
    changed = events.withColumn(
        "quantity", F.when(F.col("event_id") == 7, F.lit(99)).otherwise(F.col("quantity"))
    )
    assert digest(changed) != base
    assert digest(events.unionByName(events.filter("event_id = 7"))) != base


def test_null_and_boundaries_between_columns_matter(spark, digest):
    def table(*rows):
        return spark.createDataFrame(rows, "a string, b string")

    rows = [(None, "1"), ("1", None), ("", "1"), ("1", ""), ("n;", None)]
    seen = [digest(table(row)) for row in rows]
    assert len(set(seen)) == len(seen)
    assert digest(table(("ab", "c"))) != digest(table(("a", "bc")))


def test_empty_table(spark, digest):
    assert tuple(digest(batch_events(spark))) == (0, "0", "0")


def test_maps_hash_by_content(spark, digest):
    one = spark.sql("SELECT map('a', 1, 'b', 2) AS m")
    other = spark.sql("SELECT map('b', 2, 'a', 1) AS m")
    assert digest(one) == digest(other)
    assert table_diff(one, other).first() == (0, 0)


def test_diff_counts_copies(spark):
    left = batch_events(spark, {"event_id": 1}, {"event_id": 1}, {"event_id": 2}, {"rating": None})
    right = batch_events(spark, {"event_id": 1}, {"event_id": 3}, {"event_id": 4}, {"rating": None})
    want = (left.exceptAll(right).count(), right.exceptAll(left).count())
    assert tuple(table_diff(left, right).first()) == want == (2, 2)


def test_diff_of_empty_tables(spark):
    assert tuple(table_diff(batch_events(spark), batch_events(spark)).first()) == (0, 0)


def test_diff_needs_the_same_columns(spark):
    with pytest.raises(ValueError):
        table_diff(batch_events(spark), batch_events(spark).drop("rating"))


def test_fingerprints_name_their_table(spark):
    events = batch_events(spark, {}, {})
    rows = fingerprints({"a": events, "b": events.limit(1)}).collect()
    assert {(r.table_name, r.row_count) for r in rows} == {("a", 2), ("b", 1)}


def test_maps_at_any_depth_have_no_order(spark, digest):
    def table(first, second):
        return spark.range(1).selectExpr(
            f"struct(map('{first}', 1, '{second}', 2) AS m, 1 AS n) AS s",
            f"array(map('{first}', map('{first}', 1, '{second}', 1))) AS a",
        ).selectExpr("s", "a", "map('k', s) AS deep")

    one, other = table("a", "b"), table("b", "a")
    assert digest(one) != digest(other)  # the values belong to other keys
    swapped = "struct(map('b', 2, 'a', 1) AS m, 1 AS n)"
    same = spark.range(1).selectExpr(
        f"{swapped} AS s", "array(map('a', map('b', 1, 'a', 1))) AS a"
    ).selectExpr("s", "a", "map('k', s) AS deep")
    one = spark.range(1).selectExpr(
        "struct(map('a', 1, 'b', 2) AS m, 1 AS n) AS s", "array(map('a', map('a', 1, 'b', 1))) AS a"
    ).selectExpr("s", "a", "map('k', s) AS deep")
    assert digest(one) == digest(same)
    assert tuple(table_diff(one, same).first()) == (0, 0)
    nothing = one.selectExpr("CAST(NULL AS struct<m:map<string,int>>) AS s", "a")
    assert digest(nothing) != digest(one.select("s", "a"))


def test_doubles_are_told_apart_to_the_last_bit(spark, digest):
    def table(x):
        return spark.createDataFrame([(x,)], "x double")

    values = [0.1, 0.1 + 2**-56, 1e300, 5e-324, 1e7, 1e-4, float("inf"), -float("inf"), float("nan"), None]
    assert len({digest(table(x)) for x in values}) == len(values)
    assert digest(table(0.0)) == digest(table(-0.0))
