import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.quality import good_events, parse_totals
from tallyloom.sources.lines import parse_lines
from tallyloom.sources.schemas import CORRUPT, STREAM_EVENT
from tallyloom.sources.variants import parse_whole_lines, read_again

EVENT = {"event_id": 1, "user_id": 2, "product_id": 3, "category": "a", "event_type": "view", "price": 1.5, "quantity": 1, "timestamp": 10.25}
LINES = [
    json.dumps(EVENT),
    json.dumps({**EVENT, "channel": "web", "depth": {"a": [1, 2]}}),
    json.dumps({**EVENT, "event_id": 2, "channel": 7}),
    json.dumps({"event_id": 3, "timestamp": 5}),
    json.dumps({**EVENT, "price": None}),
    json.dumps({**EVENT, "price": "abc"}),
    json.dumps({**EVENT, "quantity": 1.5}),
    json.dumps({**EVENT, "category": 5}),
    json.dumps(EVENT) * 2,
    json.dumps(EVENT)[:20],
    "null", "5", "[1]", "", "   ", '{"timestamp": 1}', "{}",
]


def lines(spark, values=LINES):
    return spark.createDataFrame([(x,) for x in values], "value string")


def known(df):
    """Columns of good lines, the text of bad ones."""
    rows = df.select(*STREAM_EVENT.fieldNames(), CORRUPT).collect()
    return sorted((r[CORRUPT] if r[CORRUPT] else tuple(r) for r in rows), key=repr)


def test_same_events_and_errors_as_the_plain_parser(spark):
    whole = parse_whole_lines(lines(spark), STREAM_EVENT)
    assert known(whole) == known(parse_lines(lines(spark)))
    assert tuple(parse_totals(whole).first()) == tuple(parse_totals(parse_lines(lines(spark))).first())


@pytest.mark.parametrize("fmt", ["parquet"])
def test_a_field_named_later_is_recovered_from_what_is_stored(spark, tmp_path, fmt):
    path = str(tmp_path / "records")
    parse_whole_lines(lines(spark), STREAM_EVENT).write.parquet(path)
    stored = spark.read.parquet(path)
    later = T.StructType([*STREAM_EVENT.fields, T.StructField("channel", T.StringType())])
    again = read_again(stored, later)
    assert known(again) == known(parse_lines(lines(spark)))
    assert sorted(r.channel for r in again.where("channel IS NOT NULL").collect()) == ["7", "web"]
    assert tuple(parse_totals(again).first()) == tuple(parse_totals(stored).first())


def test_bad_lines_are_good_under_a_schema_that_fits_them(spark):
    stored = parse_whole_lines(lines(spark), STREAM_EVENT)
    wider = T.StructType([T.StructField(f.name, T.DoubleType() if f.name == "quantity" else f.dataType) for f in STREAM_EVENT.fields])
    again = read_again(stored, wider)
    assert again.where(F.col("quantity") == 1.5).count() == 1
    before, after = (parse_totals(x).first() for x in (stored, again))
    assert (after.processed, after.errors) == (before.processed + 1, before.errors - 1)
    narrower = T.StructType([T.StructField("price", T.LongType())])
    assert read_again(stored, narrower).where(F.col(CORRUPT).contains("1.5")).count() >= 3


def test_no_lines(spark):
    assert parse_whole_lines(lines(spark, []), STREAM_EVENT).count() == 0
    assert read_again(parse_whole_lines(lines(spark, []), STREAM_EVENT), STREAM_EVENT).count() == 0


def test_a_field_is_judged_once_however_rows_are_filtered(spark):
    """Filters on the parsed columns don't compute what a field holds again."""
    stored = spark.createDataFrame([], "whole variant, _corrupt_record string").localCheckpoint()
    plan = good_events(read_again(stored, STREAM_EVENT).drop("whole"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("schemaofvariant(") in range(1, 2 * (len(STREAM_EVENT) + 1) + 1)
