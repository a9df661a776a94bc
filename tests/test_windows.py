import pytest
from helpers import arrived, by
from pyspark.sql import functions as F

from tallyloom.operators.windows import (
    late_rate_alerts,
    late_split,
    window_category_revenue,
    window_cells,
    window_result_entries,
    window_results,
    window_totals,
    window_type_counts,
)

T0 = 1_700_000_000.0


def at(seconds, late_by=0.0, **change):
    return {"timestamp": T0 + seconds, "arrival": T0 + seconds + late_by, **change}


def totals(events, width=10):
    return by(window_totals(window_cells(events, width)), "window_start")


def test_two_windows_old_is_on_time_and_more_is_late(spark):
    events = arrived(spark, at(1, 20.0), at(2, 20.25))
    assert [r["late"] for r in late_split(events).orderBy("event_id").collect()] == [False, True]


def test_event_on_the_boundary_belongs_to_the_later_window(spark):
    rows = totals(arrived(spark, at(9.999), at(10.0)))
    assert {start: r["events_processed"] for start, r in rows.items()} == {T0: 1, T0 + 10: 1}
    assert rows[T0]["window_end"] == T0 + 10


def test_window_with_only_late_events(spark):
    row = totals(arrived(spark, at(1, 60, event_type="purchase"), at(2, 60)))[T0]
    assert (row["events_processed"], row["late_dropped"], row["total_revenue"]) == (0, 2, 0.0)


def test_window_without_purchases_has_no_revenue_entry(spark):
    cells = window_cells(arrived(spark, at(1), at(2, event_type="wishlist")), 10)
    assert window_category_revenue(cells).count() == 0
    result = window_results(cells).first()
    assert result.revenue_by_category == {}
    assert result.counts_by_type == {"view": 1, "wishlist": 1}
    assert result.total_revenue == 0.0


def test_late_events_add_to_nothing(spark):
    buy = {"event_type": "purchase", "price": 3.0, "quantity": 2}
    cells = window_cells(arrived(spark, at(1, **buy), at(2, 21, **buy), at(3)), 10)
    assert by(window_category_revenue(cells), "category")["books"]["revenue"] == 6.0
    assert {k: r["events"] for k, r in by(window_type_counts(cells), "event_type").items()} == {
        "purchase": 1,
        "view": 1,
    }


def test_missing_fields_take_defaults(spark):
    rows = [
        at(1, category=None, event_type="purchase", price=4.0, quantity=None),
        at(2, event_type="purchase", price=None),
        at(3, event_type=None),
    ]
    cells = window_cells(arrived(spark, *rows), 10)
    revenue = by(window_category_revenue(cells), "category")
    assert revenue["unknown"]["revenue"] == 4.0
    assert revenue["books"]["revenue"] == 0.0
    assert by(window_type_counts(cells), "event_type")["unknown"]["events"] == 1


def test_windows_by_arrival(spark):
    cells = window_cells(arrived(spark, at(9, 2)), 10, clock="arrival")
    assert window_totals(cells).first().window_start == T0 + 10


def test_nested_result_adds_up(spark):
    types = ["view", "purchase", "add_to_cart"]
    rows = [
        at(i / 7, i % 25, event_type=types[i % 3], category=f"c{i % 4}", price=i / 100)
        for i in range(400)
    ]
    cells = window_cells(arrived(spark, *rows), 10)
    results = window_results(cells)
    for row in results.collect():
        assert sum(row.counts_by_type.values()) == row.events_processed
        assert abs(sum(row.revenue_by_category.values()) - row.total_revenue) < 1e-9
        assert row.duration_s == 10.0
    flat = window_category_revenue(cells).select("window_start", "category", "revenue")
    entries = window_result_entries(results).filter("kind = 'revenue'")
    nested = entries.select(F.col("window_start").cast("bigint"), "name", "value")
    assert sorted(flat.collect()) == sorted(nested.collect())


def test_alert_above_one_percent_only(spark):
    rows = [at(1 + i / 100, 30 if i < 1 else 0) for i in range(100)]
    rows += [at(11 + i / 100, 30 if i < 2 else 0) for i in range(100)]
    alerts = late_rate_alerts(window_totals(window_cells(arrived(spark, *rows), 10)))
    assert {k: r["late_rate"] for k, r in by(alerts, "window_start").items()} == {T0 + 10: 0.02}


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_session_time_zone_plays_no_role(spark, zone):
    import __spark_entry__ as contract

    query = contract.queries()["window_totals"]
    want = sorted(query(spark, "/root/testdata/sf0.001").collect())
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert sorted(query(spark, "/root/testdata/sf0.001").collect()) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
