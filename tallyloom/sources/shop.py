"""The test tables' ``events`` seen as shop events, and generated shop events."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.schemas import STREAM_EVENT

# The vocabulary of shop events and the weights of the types.
CATEGORIES = ["electronics", "clothing", "books", "home", "sports", "beauty"]
EVENT_TYPE_WEIGHTS = {
    "view": 0.55,
    "add_to_cart": 0.20,
    "purchase": 0.12,
    "wishlist": 0.08,
    "remove_from_cart": 0.05,
}
STREAM_EVENT_TYPE_WEIGHTS = {
    "view": 0.55,
    "add_to_cart": 0.20,
    "purchase": 0.15,
    "wishlist": 0.10,
}
RATING_WEIGHTS = {None: 0.70, 1.0: 0.03, 2.0: 0.05, 3.0: 0.08, 4.0: 0.07, 5.0: 0.07}
USERS = 100_000
PRODUCTS = 50_000
SESSIONS = 1_000_000
FIRST_SECOND = 1_700_000_000
SPAN_SECONDS = 90 * 24 * 3600

# Type names of the test tables -> type names of the shop.
TYPE_NAMES = {"click": "add_to_cart", "signup": "wishlist", "error": "remove_from_cart"}


def _category(number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, CATEGORIES)), (number + 1).cast("int"))


def _shop_type(name: Column) -> Column:
    mapped = F.lit(None).cast("string")
    for raw, shop in TYPE_NAMES.items():
        mapped = F.when(name == raw, shop).otherwise(mapped)
    return F.coalesce(mapped, name)


def _epoch_micros(ts: str = "ts") -> Column:
    # From the parts of the zoneless time, so that the session's time zone and
    # its daylight saving play no role.
    days = F.unix_date(F.col(ts).cast("date")).cast("bigint")
    minutes = (days * 24 + F.hour(ts)) * 60 + F.minute(ts)
    second = F.date_part(F.lit("SECOND"), F.col(ts)).cast("double")
    return minutes * 60_000_000 + F.rint(second * 1e6).cast("bigint")


def _shared_columns() -> list[Column]:
    event_id = F.col("event_id")
    return [
        event_id,
        F.col("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        _category(event_id % 6).alias("category"),
        _shop_type(F.col("event_type")).alias("event_type"),
        F.col("value").alias("price"),
        (event_id % 10 + 1).cast("bigint").alias("quantity"),
    ]


def shop_events(events: DataFrame, only: Iterable[str] | None = None) -> DataFrame:
    """``events`` as the ten columns of a batch shop event.

    ``only`` keeps some shop event types. It filters on the stored type names,
    before they are renamed, so the filter reaches the Parquet scan.
    """
    if only is not None:
        stored = {shop: name for name, shop in TYPE_NAMES.items()}
        events = events.filter(F.col("event_type").isin([stored.get(t, t) for t in only]))
    event_id = F.col("event_id")
    rating = (F.floor(event_id / 10) % 5 + 1).cast("double")
    return events.select(
        *_shared_columns(),
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("session_id"),
        F.when(event_id % 10 < 3, rating).alias("rating"),
        F.floor(_epoch_micros() / 1_000_000).alias("timestamp"),
    )


def arrived_events(events: DataFrame) -> DataFrame:
    """``events`` as stream events with their second of arrival.

    Arrival follows the event by 0 to 30 s; in 10 s windows about a third is late.
    """
    seconds = _epoch_micros() / F.lit(1e6)
    return events.select(
        *_shared_columns(),
        seconds.alias("timestamp"),
        (seconds + F.col("event_id") % 31).alias("arrival"),
    )


def _draw(seed: int, column: str, key: Column, size: int) -> Column:
    # A hash of (seed, column, id): a row does not depend on the partitioning,
    # on other rows or on the number of rows.
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(column), key), F.lit(size))


def _weighted(percent: Column, weights: dict) -> Column:
    upper, picked = 0, F
    for value, weight in weights.items():
        upper += round(weight * 100)
        picked = picked.when(percent < upper, F.lit(value))
    return picked


def synthetic_columns(ids: DataFrame, seed: int = 42, id_column: str = "id") -> DataFrame:
    """A generated batch event for every id."""
    key = F.col(id_column)

    def draw(column: str, size: int) -> Column:
        return _draw(seed, column, key, size)

    return ids.select(
        key.cast("bigint").alias("event_id"),
        (draw("user_id", USERS) + 1).alias("user_id"),
        (draw("product_id", PRODUCTS) + 1).alias("product_id"),
        _category(draw("category", len(CATEGORIES))).alias("category"),
        _weighted(draw("event_type", 100), EVENT_TYPE_WEIGHTS).alias("event_type"),
        ((draw("price", 99_900) + 100) / 100).alias("price"),
        (draw("quantity", 10) + 1).alias("quantity"),
        (draw("session_id", SESSIONS) + 1).alias("session_id"),
        _weighted(draw("rating", 100), RATING_WEIGHTS).cast("double").alias("rating"),
        (draw("timestamp", SPAN_SECONDS) + FIRST_SECOND).alias("timestamp"),
    )


def synthetic_events(
    spark: SparkSession, rows: int, seed: int = 42, partitions: int | None = None
) -> DataFrame:
    """Exactly ``rows`` generated batch events with ids 0 .. rows - 1."""
    return synthetic_columns(spark.range(0, rows, 1, partitions), seed)


def synthetic_stream_events(
    spark: SparkSession, rate: int, seconds: int, seed: int = 42, start: float = FIRST_SECOND
) -> DataFrame:
    """Generated stream events, ``rate`` per second for ``seconds`` from ``start`` on."""
    events = synthetic_events(spark, rate * seconds, seed)
    event_type = _weighted(
        _draw(seed, "event_type", F.col("event_id"), 100), STREAM_EVENT_TYPE_WEIGHTS
    )
    return events.withColumns(
        {
            "event_type": event_type,
            "timestamp": F.lit(float(start)) + F.col("event_id") / F.lit(rate),
        }
    ).select(STREAM_EVENT.fieldNames())
