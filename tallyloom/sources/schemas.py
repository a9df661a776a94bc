"""Declared schemas, so that no reader has to infer one from the data."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

BATCH_EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("session_id", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

STREAM_EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("timestamp", T.DoubleType()),
    ]
)

# An event together with the second it reached the reader, for replays.
ARRIVED_EVENT = T.StructType(
    STREAM_EVENT.fields + [T.StructField("arrival", T.DoubleType())]
)

# The same, tagged with the load level of its run.
TAGGED_EVENT = T.StructType(
    ARRIVED_EVENT.fields
    + [
        T.StructField("label", T.StringType()),
        T.StructField("rate", T.LongType()),
        T.StructField("burst", T.BooleanType()),
    ]
)

WINDOW_RESULT = T.StructType(
    [
        T.StructField("window_start", T.DoubleType()),
        T.StructField("window_end", T.DoubleType()),
        T.StructField("duration_s", T.DoubleType()),
        T.StructField("events_processed", T.LongType()),
        T.StructField("late_dropped", T.LongType()),
        T.StructField("revenue_by_category", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("counts_by_type", T.MapType(T.StringType(), T.LongType())),
        T.StructField("total_revenue", T.DoubleType()),
    ]
)


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
