from helpers import arrived, by

from tallyloom.operators.quality import (
    dedup_events,
    good_events,
    parse_totals,
    quarantine,
    quarantine_reasons,
)
from tallyloom.sources.lines import parse_lines
from tallyloom.sources.readers import read_json_lines
from tallyloom.sources.schemas import CORRUPT

GOOD = [
    '{"event_id":1,"category":"books","event_type":"view","price":2.5,"quantity":3,'
    '"timestamp":10.5}',
    '  {"event_id":2,"timestamp":11}  ',
    '{"event_id":3,"timestamp":12,"extra":{"a":{"b":1}}}',
    '{"event_id":4,"timestamp":13,"category":"a}{b"}',
]
BLANK = ["", "   ", "\t"]
BAD = [
    "null", "5", "[1]", '"x"', "{bad", "[]", '[{"timestamp":1}]',
    '{"event_id":7,"price":"abc","timestamp":1.5}',
    '{"event_id":8}',
    "{}",
    '{"timestamp":1}{"timestamp":2}',
    '{"timestamp":1},{"timestamp":2}',
    '{"timestamp":1} rest',
]


def text(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def check(parsed):
    good = by(good_events(parsed), "event_id")
    assert sorted(good) == [1, 2, 3, 4]
    assert good[4]["category"] == "a}{b"
    assert (good[2]["category"], good[2]["event_type"]) == ("unknown", "unknown")
    assert (good[2]["price"], good[2]["quantity"]) == (0.0, 1)
    bad = quarantine(parsed)
    assert bad.count() == len(BAD)
    # a record that lacks only its time parsed well; all others keep their text
    assert {r[CORRUPT] for r in bad.collect()} - {None} == set(BAD) - {'{"event_id":8}', "{}"}
    assert parse_totals(parsed).first().asDict() == {"processed": 4, "errors": len(BAD)}


def test_parse_lines(spark):
    check(parse_lines(text(spark, GOOD + BLANK + BAD)))


def test_read_json_lines(spark, tmp_path):
    path = str(tmp_path / "lines")
    text(spark, GOOD + BLANK + BAD).write.text(path)
    check(read_json_lines(spark, path))


def test_totals_of_nothing(spark):
    totals = parse_totals(parse_lines(text(spark, [])))
    assert totals.first().asDict() == {"processed": 0, "errors": 0}


def test_one_row_per_event_id(spark):
    events = arrived(spark, *[{"event_id": i % 4} for i in range(40)])
    assert sorted(r.event_id for r in dedup_events(events).collect()) == [0, 1, 2, 3]


def test_first_arrival_wins_and_ties_are_settled(spark):
    events = arrived(
        spark,
        {"event_id": 1, "arrival": 5.0, "price": 1.0},
        {"event_id": 1, "arrival": 3.0, "price": 9.0},
        {"event_id": 1, "arrival": 3.0, "price": 8.0},
        {"event_id": 2, "arrival": 4.0},
    )
    rows = by(dedup_events(events, first_by="arrival"), "event_id")
    assert (rows[1]["arrival"], rows[1]["price"]) == (3.0, 8.0)
    assert sorted(rows) == [1, 2]


def test_rows_without_an_id_are_all_kept(spark):
    events = arrived(spark, {"event_id": None}, {"event_id": None}, {"event_id": 1})
    assert dedup_events(events).count() == 3
    assert dedup_events(events, first_by="arrival").count() == 3


def test_an_unknown_arrival_comes_last(spark):
    events = arrived(spark, {"event_id": 1, "arrival": None}, {"event_id": 1, "arrival": 9.0})
    assert dedup_events(events, first_by="arrival").first().arrival == 9.0


def test_reasons_of_bad_records(spark):
    reasons = quarantine_reasons(parse_lines(text(spark, GOOD + BLANK + BAD)))
    got = {r.reason: r.records for r in reasons.collect()}
    assert got == {"no time": 2, "not one well-typed object": len(BAD) - 2}
