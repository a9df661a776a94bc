"""Small hand-built events."""

from tallyloom.sources.schemas import ARRIVED_EVENT, BATCH_EVENT

BATCH_DEFAULTS = dict(
    event_id=1, user_id=1, product_id=10, category="books", event_type="view", price=2.0,
    quantity=1, session_id=5, rating=None, timestamp=1_700_000_000,
)
ARRIVED_DEFAULTS = dict(
    event_id=1, user_id=1, product_id=10, category="books", event_type="view", price=2.0,
    quantity=1, timestamp=1_700_000_000.0, arrival=1_700_000_000.0,
)


def _rows(spark, defaults, schema, changes):
    rows = [{"event_id": i, **change} for i, change in enumerate(changes)]
    data = [tuple({**defaults, **row}[name] for name in schema.fieldNames()) for row in rows]
    return spark.createDataFrame(data, schema)


def batch_events(spark, *changes):
    return _rows(spark, BATCH_DEFAULTS, BATCH_EVENT, changes)


def arrived(spark, *changes):
    return _rows(spark, ARRIVED_DEFAULTS, ARRIVED_EVENT, changes)


def by(df, *keys):
    """Rows as dicts, keyed by their values in ``keys``."""
    rows = [row.asDict() for row in df.collect()]
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}
