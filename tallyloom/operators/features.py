"""Feature tables per user, per product and per category.

The spend of a group is summed in the same pass as its other aggregates, as a
sum over its purchases, instead of in a second table that is joined on. The
result is that of a left join on the key: 0 where a group has no purchase, and
0 for a NULL key, which an equi-join never matches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.events import is_type, ratio, ratio_over_at_least_one, spend
from tallyloom.functions.money import money_mean, money_sums, money_total, or_zero
from tallyloom.operators.rollup import rollup

PURCHASE = "purchase"


def purchases_with_spend(events: DataFrame) -> DataFrame:
    """Purchases only, with ``spend`` = price * quantity."""
    return events.filter(is_type(PURCHASE)).withColumn("spend", spend())


def _named(aggregates: dict[str, Column]) -> list[Column]:
    return [aggregate.alias(name) for name, aggregate in aggregates.items()]


def _purchase_money(where: Column | None = None) -> dict[str, Column]:
    return money_sums("spend", F.col("price"), F.col("quantity"), where)


def _rating_sums() -> dict[str, Column]:
    return {"rating_sum": F.sum("rating"), "rating_n": F.count("rating")}


def _joined(amount: Column, key: str) -> Column:
    return F.when(F.col(key).isNull(), 0.0).otherwise(or_zero(amount))


# -- users --------------------------------------------------------------------


def _user_sums() -> dict[str, Column]:
    return {
        "total_events": F.count("event_id"),
        "purchase_count": F.count_if(is_type(PURCHASE)),
        "cart_add_count": F.count_if(is_type("add_to_cart")),
        **_rating_sums(),
    }


USER_DISTINCT = {
    "unique_products": "product_id",
    "unique_categories": "category",
    "session_count": "session_id",
}

USER_ACTIVITY = [
    "user_id",
    "total_events",
    "purchase_count",
    "cart_add_count",
    "unique_products",
    "unique_categories",
    "session_count",
    "avg_rating_given",
]


def user_activity(events: DataFrame) -> DataFrame:
    """Counts, distinct counts and mean rating per user."""
    users = rollup(events, ["user_id"], _user_sums(), USER_DISTINCT)
    return users.withColumn("avg_rating_given", ratio("rating_sum", "rating_n")).select(
        USER_ACTIVITY
    )


def user_spend(events: DataFrame) -> DataFrame:
    """Total spend and mean spend per purchase, for users with a purchase."""
    users = events.filter(is_type(PURCHASE)).groupBy("user_id").agg(*_named(_purchase_money()))
    return users.select(
        "user_id",
        money_total("spend").alias("total_spend"),
        money_mean("spend").alias("avg_order_value"),
    )


def user_features(events: DataFrame) -> DataFrame:
    """Activity, spend and purchase rate per user.

    ``avg_order_value`` is the mean per purchase event. ``purchase_rate`` is
    NULL when none of the user's events has an id.
    """
    return FEATURES["user_features"].of(events)


def _finish_users(users: DataFrame) -> DataFrame:
    return users.withColumn("avg_rating_given", ratio("rating_sum", "rating_n")).select(
        *USER_ACTIVITY,
        _joined(money_total("spend"), "user_id").alias("total_spend"),
        _joined(money_mean("spend"), "user_id").alias("avg_order_value"),
        ratio("purchase_count", "total_events").alias("purchase_rate"),
    )


# -- products -----------------------------------------------------------------


def _product_sums() -> dict[str, Column]:
    return {
        "total_interactions": F.count("event_id"),
        "view_count": F.count_if(is_type("view")),
        "purchase_count": F.count_if(is_type(PURCHASE)),
        "cart_count": F.count_if(is_type("add_to_cart")),
        **money_sums("price", F.col("price")),
        **_rating_sums(),
    }


PRODUCT_KEYS = ["product_id", "category"]
PRODUCT_DISTINCT = {"unique_buyers": "user_id"}
PRODUCT_ACTIVITY = [
    *PRODUCT_KEYS,
    "total_interactions",
    "view_count",
    "purchase_count",
    "cart_count",
    "avg_price",
    "unique_buyers",
    "avg_rating",
]


def _with_product_means(products: DataFrame) -> DataFrame:
    return products.withColumns(
        {"avg_price": money_mean("price"), "avg_rating": ratio("rating_sum", "rating_n")}
    )


def product_activity(events: DataFrame) -> DataFrame:
    """Counts, mean price and mean rating per product and category.

    ``unique_buyers`` counts every user with any event on the product, not only
    those who bought it.
    """
    products = rollup(events, PRODUCT_KEYS, _product_sums(), PRODUCT_DISTINCT)
    return _with_product_means(products).select(PRODUCT_ACTIVITY)


def product_revenue(events: DataFrame) -> DataFrame:
    """Revenue per product over all its categories."""
    products = (
        events.filter(is_type(PURCHASE)).groupBy("product_id").agg(*_named(_purchase_money()))
    )
    return products.select("product_id", money_total("spend").alias("total_revenue"))


def _with_revenue(products: DataFrame) -> DataFrame:
    return products.select(
        *PRODUCT_ACTIVITY,
        _joined(money_total("spend"), "product_id").alias("total_revenue"),
        ratio_over_at_least_one("purchase_count", "view_count").alias("conversion_rate"),
    )


def product_features(events: DataFrame) -> DataFrame:
    """Activity, revenue and conversion rate per product and category.

    ``total_revenue`` is that of the product over all its categories, so it
    repeats on each of the product's rows: add it up over products, not rows.
    The repeat is a window over finished rows, one per product and category.
    """
    return FEATURES["product_features"].of(events)


def _finish_products(products: DataFrame) -> DataFrame:
    of_product = Window.partitionBy("product_id")
    products = _with_product_means(products).withColumns(
        {name: F.sum(name).over(of_product) for name in ("spend_cents", "spend_rest")}
    )
    return _with_revenue(products)


def product_features_by_category(events: DataFrame) -> DataFrame:
    """As ``product_features``, but with the revenue of the row's own category."""
    spec = FEATURES["product_features"]
    return _with_revenue(_with_product_means(rollup(events, spec.keys, spec.sums(), spec.distinct)))


# -- categories ---------------------------------------------------------------


def _category_sums() -> dict[str, Column]:
    return {
        "total_events": F.count("event_id"),
        "purchase_count": F.count_if(is_type(PURCHASE)),
        **money_sums("price", F.col("price")),
    }


CATEGORY_DISTINCT = {"unique_users": "user_id"}
CATEGORY_ACTIVITY = ["category", "total_events", "purchase_count", "avg_price", "unique_users"]


def category_activity(events: DataFrame) -> DataFrame:
    """Counts, mean price and number of users per category."""
    categories = rollup(events, ["category"], _category_sums(), CATEGORY_DISTINCT)
    return categories.withColumn("avg_price", money_mean("price")).select(CATEGORY_ACTIVITY)


def category_revenue(events: DataFrame) -> DataFrame:
    """Revenue per category with a purchase."""
    categories = (
        events.filter(is_type(PURCHASE)).groupBy("category").agg(*_named(_purchase_money()))
    )
    return categories.select("category", money_total("spend").alias("total_revenue"))


def category_features(events: DataFrame) -> DataFrame:
    """Activity and revenue per category."""
    return FEATURES["category_features"].of(events)


def _finish_categories(categories: DataFrame) -> DataFrame:
    return categories.withColumn("avg_price", money_mean("price")).select(
        *CATEGORY_ACTIVITY, _joined(money_total("spend"), "category").alias("total_revenue")
    )


@dataclass(frozen=True)
class FeatureTable:
    """A feature table as partial results that can be added up, and its columns from these."""

    keys: list[str]
    own_sums: Callable[[], dict[str, Column]]
    distinct: dict[str, str]
    finish: Callable[[DataFrame], DataFrame]

    def sums(self) -> dict[str, Column]:
        return {**self.own_sums(), **_purchase_money(is_type(PURCHASE))}

    def of(self, events: DataFrame) -> DataFrame:
        return self.finish(rollup(events, self.keys, self.sums(), self.distinct))


FEATURES = {
    "user_features": FeatureTable(["user_id"], _user_sums, USER_DISTINCT, _finish_users),
    "product_features": FeatureTable(PRODUCT_KEYS, _product_sums, PRODUCT_DISTINCT, _finish_products),
    "category_features": FeatureTable(["category"], _category_sums, CATEGORY_DISTINCT, _finish_categories),
}
