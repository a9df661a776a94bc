import math
import random

import pytest
from helpers import batch_events, by
from pyspark.sql import functions as F

from tallyloom.operators.features import (
    category_features,
    product_features,
    product_features_by_category,
    user_features,
    user_spend,
)
from tallyloom.sources.shop import synthetic_events


def buy(**change):
    return {"event_type": "purchase", **change}


def test_user_without_purchases_or_ratings(spark):
    row = by(user_features(batch_events(spark, {}, {"event_type": "wishlist"})), "user_id")[1]
    assert (row["total_spend"], row["avg_order_value"], row["purchase_rate"]) == (0, 0, 0)
    assert row["avg_rating_given"] is None
    assert row["total_events"] == 2


def test_null_user_is_a_group_without_spend(spark):
    events = batch_events(spark, buy(user_id=None, price=9.0), {"user_id": None}, buy())
    row = by(user_features(events), "user_id")[None]
    assert (row["total_events"], row["purchase_count"], row["unique_products"]) == (2, 1, 1)
    assert (row["total_spend"], row["avg_order_value"]) == (0, 0)


def test_only_null_event_ids(spark):
    row = by(user_features(batch_events(spark, {"event_id": None})), "user_id")[1]
    assert row["total_events"] == 0
    assert row["purchase_rate"] is None


def test_null_and_unknown_types_count_in_totals_only(spark):
    events = batch_events(spark, {"event_type": None}, {"event_type": "gift"}, buy())
    row = by(user_features(events), "user_id")[1]
    assert (row["total_events"], row["purchase_count"], row["cart_add_count"]) == (3, 1, 0)


def test_nulls_are_no_distinct_values(spark):
    events = batch_events(spark, {"product_id": None, "session_id": None, "category": None})
    row = by(user_features(events), "user_id")[1]
    assert (row["unique_products"], row["unique_categories"], row["session_count"]) == (0, 0, 0)


def test_order_value_is_per_purchase(spark):
    events = batch_events(spark, buy(price=10.0, quantity=2), buy(price=1.0, quantity=4), {})
    row = by(user_features(events), "user_id")[1]
    assert (row["total_spend"], row["avg_order_value"]) == (24.0, 12.0)
    assert by(user_spend(events), "user_id")[1]["avg_order_value"] == 12.0


@pytest.mark.parametrize("price", [float("nan"), None])
def test_nan_and_null_price(spark, price):
    events = batch_events(spark, buy(price=price), buy(price=3.0))
    row = by(user_features(events), "user_id")[1]
    assert row["total_spend"] == (3.0 if price is None else 0.0)
    assert row["purchase_count"] == 2


def test_prices_below_a_cent_and_very_large_ones_are_not_rounded(spark):
    prices = [0.0001, 1 / 3, 1e-9, 2.5e15, 12.345]
    rows = [buy(price=p, quantity=3, user_id=i) for i, p in enumerate(prices)]
    spent = by(user_features(batch_events(spark, *rows)), "user_id")
    for i, price in enumerate(prices):
        assert math.isclose(spent[i]["total_spend"], price * 3, rel_tol=1e-12)
    infinite = user_features(batch_events(spark, buy(price=float("inf"))))
    assert by(infinite, "user_id")[1]["total_spend"] == float("inf")


def test_money_is_exact_in_any_order(spark):
    rng = random.Random(5)
    prices = [rng.randrange(1, 100_000) / 100 for _ in range(2000)]
    events = batch_events(spark, *[buy(price=p, quantity=3, user_id=1) for p in prices])
    want = sum(round(p * 100) * 3 for p in prices) / 100
    for n in (1, 3, 8):
        row = by(user_features(events.repartition(n, "price")), "user_id")[1]
        assert row["total_spend"] == want


def test_conversion_without_views(spark):
    row = by(product_features(batch_events(spark, buy(), buy(), buy())), "product_id")[10]
    assert row["conversion_rate"] == 3.0


def test_product_revenue_repeats_per_category_unless_asked(spark):
    events = batch_events(spark, buy(price=5.0), buy(price=7.0, category="home"), {})
    repeated = by(product_features(events), "product_id", "category")
    assert {k: r["total_revenue"] for k, r in repeated.items()} == {
        (10, "books"): 12.0,
        (10, "home"): 12.0,
    }
    split = by(product_features_by_category(events), "product_id", "category")
    assert split[(10, "books")]["total_revenue"] == 5.0
    assert split[(10, "home")]["total_revenue"] == 7.0


def test_null_product_has_no_revenue(spark):
    rows = by(product_features(batch_events(spark, buy(product_id=None))), "product_id")
    assert rows[None]["total_revenue"] == 0.0


def test_unique_buyers_counts_all_users(spark):
    events = batch_events(spark, {"user_id": 1}, {"user_id": 2}, buy(user_id=2))
    assert by(product_features(events), "product_id")[10]["unique_buyers"] == 2


def test_category_features(spark):
    events = batch_events(
        spark, buy(price=4.0, quantity=2), {"user_id": 2, "price": None}, {"category": None}
    )
    rows = by(category_features(events), "category")
    assert rows["books"] == {
        "category": "books",
        "total_events": 2,
        "purchase_count": 1,
        "avg_price": 4.0,
        "unique_users": 2,
        "total_revenue": 8.0,
    }
    assert rows[None]["total_revenue"] == 0.0


def _hot(spark):
    """A third of all events from one user, on one product and category."""
    events = synthetic_events(spark, 6000, seed=3, partitions=6)
    hot = F.col("event_id") % 3 == 0
    return events.withColumns(
        {
            "user_id": F.when(hot, -1).otherwise(F.col("user_id") % 50),
            "product_id": F.when(hot & (F.col("event_id") % 2 == 0), -1).otherwise(
                F.col("product_id")
            ),
            "category": F.when(hot, "hot").otherwise(F.col("category")),
        }
    )


def test_hot_groups_against_brute_force(spark):
    events = _hot(spark)
    pdf = events.toPandas()
    pdf["spend"] = (pdf.price * pdf.quantity).where(pdf.event_type == "purchase")
    users = by(user_features(events), "user_id")
    assert len(users) == pdf.user_id.nunique()
    for user, group in pdf.groupby("user_id"):
        row = users[user]
        assert row["total_events"] == len(group)
        assert row["unique_products"] == group.product_id.nunique()
        assert row["unique_categories"] == group.category.nunique()
        assert row["session_count"] == group.session_id.nunique()
        assert math.isclose(row["total_spend"], group.spend.sum(), rel_tol=1e-12)
    products = by(product_features(events), "product_id", "category")
    groups = pdf.groupby(["product_id", "category"])
    assert len(products) == groups.ngroups
    revenue = pdf.groupby("product_id").spend.sum()
    for key, group in groups:
        assert products[key]["unique_buyers"] == group.user_id.nunique()
        assert math.isclose(products[key]["avg_price"], group.price.mean(), rel_tol=1e-12)
        got = products[key]["total_revenue"]
        assert math.isclose(got, revenue[key[0]], rel_tol=1e-12, abs_tol=1e-12)
    categories = by(category_features(events), "category")
    for category, group in pdf.groupby("category"):
        assert categories[category]["unique_users"] == group.user_id.nunique()


def test_spend_adds_up_across_tables(spark):
    events = _hot(spark)
    of_users = user_features(events).agg(F.sum("total_spend")).first()[0]
    of_categories = category_features(events).agg(F.sum("total_revenue")).first()[0]
    assert math.isclose(of_users, of_categories, rel_tol=1e-12)


def test_amounts_of_any_size_and_fractions_of_a_piece(spark):
    from pyspark.sql import functions as F

    def spent(rows, kind="bigint"):
        df = spark.createDataFrame(
            [("purchase", 1, p, q) for p, q in rows],
            f"event_type string, user_id long, price double, quantity {kind}",
        )
        return [user_spend(df.repartition(n)).first() for n in (1, 3)]

    for row in spent([(1e20, 0)]):
        assert row.total_spend == 0
    for row in spent([(9e12, 1)] * 20_000):
        assert row.total_spend == 1.8e17
    for row in spent([(10.0, 2.5)], "double"):
        assert row.total_spend == 25.0
    for row in spent([(0.1, 3), (0.2, 7)] * 50):
        assert row.total_spend == 85.0
    for row in spent([(1e300, 10), (5.0, 1)]):
        assert row.total_spend == 1e301
    one, three = spent([(0.07 * i, 1.5) for i in range(500)], "double")
    assert one.total_spend == three.total_spend
    events = spark.createDataFrame([(float("nan"), 1)], "price double, quantity long")
    assert user_spend(events.withColumns({"event_type": F.lit("purchase"), "user_id": F.lit(1)})).count() == 1
