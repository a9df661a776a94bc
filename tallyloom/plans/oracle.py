"""The same queries in SQL for another engine, over the same tables."""

from __future__ import annotations

HOUR = 3600
LATE_AFTER = 20
WATERMARK = 60
SLICES = 4

SHOP = """
shop AS (
  SELECT event_id, user_id,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
    CASE event_id % 6 WHEN 0 THEN 'electronics' WHEN 1 THEN 'clothing' WHEN 2 THEN 'books'
      WHEN 3 THEN 'home' WHEN 4 THEN 'sports' ELSE 'beauty' END AS category,
    CASE event_type WHEN 'click' THEN 'add_to_cart' WHEN 'signup' THEN 'wishlist'
      WHEN 'error' THEN 'remove_from_cart' ELSE event_type END AS event_type,
    value AS price,
    CAST(event_id % 10 + 1 AS BIGINT) AS quantity,
    CAST(user_id * 100 + day(ts) AS BIGINT) AS session_id,
    CASE WHEN event_id % 10 < 3
      THEN CAST(CAST(floor(event_id / 10) AS BIGINT) % 5 + 1 AS DOUBLE) END AS rating,
    CAST(floor(epoch_us(ts) / 1e6) AS BIGINT) AS timestamp
  FROM events),
money AS (
  SELECT *, CAST(price AS DECIMAL(12, 2)) AS cents_price,
    CASE WHEN event_type = 'purchase' THEN CAST(price AS DECIMAL(12, 2)) * quantity END AS amount
  FROM shop)
"""

ARRIVED = SHOP.rstrip() + """,
arrived AS (
  SELECT s.event_id, s.user_id, s.product_id, s.category, s.event_type, s.price, s.quantity,
    epoch_us(e.ts) / 1e6 AS timestamp, epoch_us(e.ts) / 1e6 + e.event_id % 31 AS arrival
  FROM shop s JOIN events e ON s.event_id = e.event_id)
"""



def _timed(rows: str) -> str:
    """Windows by event time, and those by arrival that a stream over all rows has closed."""
    return f""",
timed AS (
  SELECT *, CAST(floor(timestamp / {HOUR}) AS BIGINT) * {HOUR} AS window_start,
    arrival - timestamp > {LATE_AFTER} AS late, (arrival - timestamp) * 1000 AS latency_ms,
    CASE WHEN event_type = 'purchase' THEN CAST(price AS DECIMAL(12, 2)) * quantity END AS amount
  FROM {rows}),
arriving AS (
  SELECT * REPLACE (CAST(floor(arrival / {HOUR}) AS BIGINT) * {HOUR} AS window_start) FROM timed),
closed AS (
  SELECT * FROM arriving
  WHERE window_start + {HOUR} <= (SELECT max(arrival) FROM arriving) - {WATERMARK})
"""


STRAYED = ARRIVED.rstrip() + """,
strayed AS (
  SELECT * REPLACE (CASE WHEN event_id % 19 = 5 THEN timestamp - 155
    WHEN event_id % 23 = 7 THEN timestamp + 1000000 ELSE timestamp END AS timestamp) FROM arrived)
"""
TIMED = ARRIVED.rstrip() + _timed("arrived")
TIMED_STRAYS = STRAYED.rstrip() + _timed("strayed")

SHOP, ARRIVED, STRAYED = f"WITH {SHOP}", f"WITH {ARRIVED}", f"WITH {STRAYED}"
TIMED, TIMED_STRAYS = f"WITH {TIMED}", f"WITH {TIMED_STRAYS}"

TOTAL = "CAST(sum({}) AS DOUBLE)"
SPENT = TOTAL.format("amount")
MEAN_PRICE = "CAST(sum(cents_price) AS DOUBLE) / count(cents_price)"


def _count(condition: str) -> str:
    return f"CAST(count(*) FILTER ({condition}) AS BIGINT)"


USER_ACTIVITY = f"""user_id, count(event_id) AS total_events,
  {_count("event_type = 'purchase'")} AS purchase_count,
  {_count("event_type = 'add_to_cart'")} AS cart_add_count,
  count(DISTINCT product_id) AS unique_products,
  count(DISTINCT category) AS unique_categories,
  count(DISTINCT session_id) AS session_count, avg(rating) AS avg_rating_given"""

PRODUCT_ACTIVITY = f"""product_id, category, count(event_id) AS total_interactions,
  {_count("event_type = 'view'")} AS view_count,
  {_count("event_type = 'purchase'")} AS purchase_count,
  {_count("event_type = 'add_to_cart'")} AS cart_count,
  {MEAN_PRICE} AS avg_price, count(DISTINCT user_id) AS unique_buyers, avg(rating) AS avg_rating"""

CONVERSION = """CAST(purchase_count AS DOUBLE)
  / CASE WHEN view_count = 0 THEN 1 ELSE view_count END AS conversion_rate"""

CATEGORY_ACTIVITY = f"""category, count(event_id) AS total_events,
  {_count("event_type = 'purchase'")} AS purchase_count,
  {MEAN_PRICE} AS avg_price, count(DISTINCT user_id) AS unique_users"""

ROW_COUNTS = (
    SHOP
    + """SELECT count(*) AS rows_processed, count(DISTINCT user_id) AS {user},
  count(DISTINCT (product_id, category)) AS {product}, count(DISTINCT category) AS {category}
FROM shop"""
)

BOUNDS = f"window_start, window_start + {HOUR} AS window_end"


def _window_totals(rows: str) -> str:
    return f"""SELECT {BOUNDS}, {_count("NOT late")} AS events_processed,
  {_count("late")} AS late_dropped,
  coalesce(CAST(sum(amount) FILTER (NOT late) AS DOUBLE), 0) AS total_revenue
FROM {rows} GROUP BY window_start"""


def _window_scalars(rows: str) -> str:
    return f"""SELECT CAST(window_start AS DOUBLE) AS window_start,
  CAST(window_start + {HOUR} AS DOUBLE) AS window_end, CAST({HOUR} AS DOUBLE) AS duration_s,
  {_count("NOT late")} AS events_processed, {_count("late")} AS late_dropped,
  count(DISTINCT category) FILTER (NOT late AND event_type = 'purchase') AS categories,
  count(DISTINCT event_type) FILTER (NOT late) AS types,
  coalesce(CAST(sum(amount) FILTER (NOT late) AS DOUBLE), 0) AS total_revenue
FROM {rows} GROUP BY window_start"""


def _window_category_revenue(rows: str) -> str:
    return f"""SELECT {BOUNDS}, category, {SPENT} AS revenue FROM {rows}
WHERE NOT late AND event_type = 'purchase' GROUP BY window_start, category"""


def _window_type_counts(rows: str) -> str:
    return f"""SELECT {BOUNDS}, event_type, count(*) AS events FROM {rows}
WHERE NOT late GROUP BY window_start, event_type"""


def _window_entries(rows: str) -> str:
    return f"""SELECT CAST(window_start AS DOUBLE) AS window_start, 'revenue' AS kind,
  category AS name, {SPENT} AS value FROM {rows}
WHERE NOT late AND event_type = 'purchase' GROUP BY window_start, category
UNION ALL
SELECT CAST(window_start AS DOUBLE), 'count', event_type, CAST(count(*) AS DOUBLE) FROM {rows}
WHERE NOT late GROUP BY window_start, event_type"""


def _percentiles(by: str, source: str = "timed") -> str:
    """Value at 0-based position floor(n * q) of the sorted latencies of each group."""
    part = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    at = ",\n  ".join(
        f"max(CASE WHEN i = CAST(floor(n * CAST({q} AS DOUBLE)) AS BIGINT) "
        f"THEN latency_ms END) AS p{p}"
        for p, q in ((50, "0.5"), (95, "0.95"), (99, "0.99"))
    )
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {keys}{at}, count(*) AS count FROM (
  SELECT *, row_number() OVER ({part} ORDER BY latency_ms) - 1 AS i, count(*) OVER ({part}) AS n
  FROM {source}) {group}"""


LOAD_LEVELS = f"""{TIMED}, levels AS (
  SELECT *, CASE event_id % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END AS label
  FROM timed),
latency AS ({_percentiles('label', 'levels')}),
windows AS (
  SELECT label, count(DISTINCT CAST(floor(timestamp / 10) AS BIGINT)) AS windows
  FROM levels WHERE NOT late GROUP BY label)
SELECT l.*, coalesce(windows, 0) AS windows,
  CAST(CASE l.label WHEN 'low' THEN 100 WHEN 'medium' THEN 1000 ELSE 5000 END AS BIGINT) AS rate,
  l.label = 'high' AS burst
FROM latency l LEFT JOIN windows w ON l.label = w.label"""

ANCHORED = ARRIVED.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + f""",
chain AS (
  SELECT min(arrival) AS start FROM arrived
  UNION ALL
  SELECT min(a.arrival) FROM chain c JOIN arrived a
    ON a.arrival >= c.start + {HOUR} AND a.arrival - a.timestamp <= {LATE_AFTER}
  HAVING min(a.arrival) IS NOT NULL),
closers AS (
  SELECT start, (SELECT min(event_id) FROM arrived a
    WHERE a.arrival = start AND a.arrival - a.timestamp <= {LATE_AFTER}) AS closer,
    row_number() OVER (ORDER BY start) AS k FROM chain),
anchored AS (
  SELECT o.start AS window_start, c.start AS window_end, p.*
  FROM (
    SELECT *, arrival - timestamp > {LATE_AFTER} AS late,
      CASE WHEN event_type = 'purchase' THEN CAST(price AS DECIMAL(12, 2)) * quantity END AS amount,
      1 + (SELECT count(*) FROM closers c WHERE c.k > 1
        AND (c.start < a.arrival OR (c.start = a.arrival AND c.closer < a.event_id))) AS k
    FROM arrived a) p
  JOIN closers o ON o.k = p.k LEFT JOIN closers c ON c.k = p.k + 1)
"""


def _anchored_totals() -> str:
    return f"""{ANCHORED} SELECT window_start, window_end, window_end - window_start AS duration_s,
  {_count("NOT late")} AS events_processed, {_count("late")} AS late_dropped,
  coalesce(CAST(sum(amount) FILTER (NOT late) AS DOUBLE), 0) AS total_revenue
FROM anchored GROUP BY window_start, window_end"""


BY_SCHEDULE = f"""{TIMED}, ends AS (SELECT min(arrival) AS low, max(arrival) AS high FROM arrived),
schedule AS (
  SELECT label, rate, burst, low + (high - low) * CAST(first AS DOUBLE) AS start,
    low + (high - low) * CAST(last AS DOUBLE) AS "end"
  FROM ends, (VALUES ('low', 100, false, 0.0, 0.5), ('medium', 1000, false, 0.4, 0.7),
    ('high', 5000, true, 0.8, 1.0)) v(label, rate, burst, first, last)),
levels AS (SELECT t.*, label FROM timed t JOIN schedule ON arrival >= start AND arrival < "end"),
latency AS ({_percentiles('label', 'levels')}),
windows AS (
  SELECT label, count(DISTINCT CAST(floor(timestamp / 10) AS BIGINT)) AS windows
  FROM levels WHERE NOT late GROUP BY label)
SELECT l.*, coalesce(windows, 0) AS windows, CAST(rate AS BIGINT) AS rate, burst
FROM latency l JOIN schedule USING (label) LEFT JOIN windows w ON l.label = w.label"""

BAD_LINES = "event_id % 50 IN (7, 13, 21, 25, 29, 33, 47)"
BLANK_LINES = "event_id % 50 = 37"

GOOD = ARRIVED.rstrip() + f""",
good AS (
  SELECT * REPLACE (CASE WHEN event_id % 50 = 43 THEN 'unknown' ELSE category END AS category,
    CASE WHEN event_id % 50 = 43 THEN 1 ELSE quantity END AS quantity)
  FROM arrived WHERE NOT ({BAD_LINES}) AND NOT ({BLANK_LINES}))
""" + _timed("good")

RIGHT = "true AS p50_right, true AS p95_right, true AS p99_right"
SUMMARY = f"count(*) AS count, min(latency_ms) AS least, max(latency_ms) AS most, {RIGHT}"

_HASHED = ["category", "event_id", "event_type", "price", "product_id", "quantity", "rating",
           "session_id", "timestamp", "user_id"]
_DOUBLES = {"price", "rating", "large", "small"}


def _sha256_sums(table: str, columns: list[str]) -> str:
    """Row hashes over lengths and texts of the sorted columns; a double's text is that of its bits."""
    texts = {
        c: f"CAST(CAST(CAST(CASE WHEN {c} = 0 THEN 0 ELSE {c} END AS DOUBLE) AS BIT) AS BIGINT)"
        if c in _DOUBLES
        else c
        for c in columns
    }
    row = " || ".join(
        f"CASE WHEN {c} IS NULL THEN 'n;' ELSE 'v' || length(CAST({text} AS VARCHAR)) || ':' "
        f"|| CAST({text} AS VARCHAR) END"
        for c, text in texts.items()
    )
    return f"""digests AS (SELECT sha256({row}) AS digest FROM {table})
SELECT count(*) AS row_count,
  CAST(sum(CAST(CAST('0x' || substr(digest, 1, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR) AS hash_a,
  CAST(sum(CAST(CAST('0x' || substr(digest, 16, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR) AS hash_b
FROM digests"""


def all_oracles() -> dict[str, str]:
    shop_columns = (
        "event_id, user_id, product_id, category, event_type, price, quantity, session_id, "
        "rating, timestamp"
    )
    stream_columns = (
        "event_id, user_id, product_id, category, event_type, price, quantity, timestamp"
    )
    oracles = {
        "scan_events": f"{SHOP} SELECT {shop_columns} FROM shop",
        "purchases_spend": f"""{SHOP} SELECT {shop_columns}, price * quantity AS spend FROM shop
WHERE event_type = 'purchase'""",
        "defaults_applied": f"""{ARRIVED} SELECT event_id, user_id, product_id,
  CASE WHEN event_id % 17 = 3 THEN 'unknown' ELSE category END AS category,
  CASE WHEN event_id % 17 = 5 THEN 'unknown' ELSE event_type END AS event_type,
  CASE WHEN event_id % 17 = 11 THEN 0 ELSE price END AS price,
  CASE WHEN event_id % 17 = 13 THEN 1 ELSE quantity END AS quantity, timestamp, arrival
FROM arrived""",
        "user_activity": f"{SHOP} SELECT {USER_ACTIVITY} FROM shop GROUP BY user_id",
        "user_spend": f"""{SHOP} SELECT user_id, {SPENT} AS total_spend,
  {SPENT} / count(amount) AS avg_order_value
FROM money WHERE event_type = 'purchase' GROUP BY user_id""",
        "user_features": f"""{SHOP}, activity AS (
  SELECT {USER_ACTIVITY} FROM shop GROUP BY user_id),
spend AS (
  SELECT user_id, {SPENT} AS total_spend, {SPENT} / count(amount) AS avg_order_value
  FROM money WHERE event_type = 'purchase' GROUP BY user_id)
SELECT a.*, coalesce(total_spend, 0) AS total_spend,
  coalesce(avg_order_value, 0) AS avg_order_value,
  CAST(purchase_count AS DOUBLE) / total_events AS purchase_rate
FROM activity a LEFT JOIN spend s ON a.user_id = s.user_id""",
        "product_activity": f"""{SHOP} SELECT {PRODUCT_ACTIVITY} FROM money
GROUP BY product_id, category""",
        "product_revenue": f"""{SHOP} SELECT product_id, {SPENT} AS total_revenue FROM money
WHERE event_type = 'purchase' GROUP BY product_id""",
        "product_features": f"""{SHOP}, activity AS (
  SELECT {PRODUCT_ACTIVITY} FROM money GROUP BY product_id, category),
revenue AS (
  SELECT product_id, {SPENT} AS total_revenue FROM money
  WHERE event_type = 'purchase' GROUP BY product_id)
SELECT a.*, coalesce(total_revenue, 0) AS total_revenue, {CONVERSION}
FROM activity a LEFT JOIN revenue r ON a.product_id = r.product_id""",
        "product_features_by_category": f"""{SHOP}, activity AS (
  SELECT {PRODUCT_ACTIVITY}, coalesce({SPENT}, 0) AS total_revenue
  FROM money GROUP BY product_id, category)
SELECT *, {CONVERSION} FROM activity""",
        "category_activity": f"{SHOP} SELECT {CATEGORY_ACTIVITY} FROM money GROUP BY category",
        "category_revenue": f"""{SHOP} SELECT category, {SPENT} AS total_revenue FROM money
WHERE event_type = 'purchase' GROUP BY category""",
        "category_features": f"""{SHOP}, activity AS (
  SELECT {CATEGORY_ACTIVITY} FROM money GROUP BY category),
revenue AS (
  SELECT category, {SPENT} AS total_revenue FROM money
  WHERE event_type = 'purchase' GROUP BY category)
SELECT a.*, coalesce(total_revenue, 0) AS total_revenue
FROM activity a LEFT JOIN revenue r ON a.category = r.category""",
        "row_counts": ROW_COUNTS.format(
            user="user_features_rows",
            product="product_features_rows",
            category="category_features_rows",
        ),
        "feature_run": ROW_COUNTS.format(
            user="user_feature_rows",
            product="product_feature_rows",
            category="category_feature_rows",
        ),
        "user_spend_of_fractions": f"""{SHOP}, scaled AS (
  SELECT user_id, CAST(price AS DECIMAL(12, 2)) * 1000000 * (quantity * 4 + 1) / 4 AS amount
  FROM shop WHERE event_type = 'purchase')
SELECT user_id, CAST(sum(amount) AS DOUBLE) AS total_spend,
  CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_order_value FROM scaled GROUP BY user_id""",
        "run_metrics_json": f"""WITH counts AS ({ROW_COUNTS.format(
            user="user_feature_rows",
            product="product_feature_rows",
            category="category_feature_rows",
        )}) SELECT 'check' AS mode, true AS workers, true AS shuffle_partitions,
  true AS runtime_seconds, * FROM counts""",
        "output_hashes_json": f"""{SHOP}, counts AS (
  SELECT unnest(['user_features', 'product_features', 'category_features']) AS table_name,
    unnest([count(DISTINCT user_id), count(DISTINCT (product_id, category)),
      count(DISTINCT category)]) AS row_count FROM shop)
SELECT 'check' AS mode, true AS workers, true AS runtime_seconds, *, true AS same FROM counts""",
        "late_split": f"""{ARRIVED} SELECT *, arrival - timestamp AS age_s,
  arrival - timestamp > 20 AS late FROM arrived""",
        "window_totals": f"{TIMED} {_window_totals('timed')}",
        "window_totals_rounded": f"""{TIMED}, totals AS ({_window_totals('timed')})
SELECT * REPLACE (round(total_revenue, 2) AS total_revenue) FROM totals""",
        "window_category_revenue": f"{TIMED} {_window_category_revenue('timed')}",
        "window_type_counts": f"{TIMED} {_window_type_counts('timed')}",
        "window_result_entries": f"{TIMED} {_window_entries('timed')}",
        "window_result_nested": f"{TIMED} {_window_scalars('timed')}",
        "late_rate_alerts": f"""{TIMED}, totals AS ({_window_totals('timed')})
SELECT *, CAST(late_dropped AS DOUBLE) / (late_dropped + events_processed) AS late_rate
FROM totals
WHERE CAST(late_dropped AS DOUBLE) / (late_dropped + events_processed) > CAST(0.01 AS DOUBLE)""",
        "latency_percentiles": f"{TIMED} {_percentiles('')}",
        "latency_percentiles_by_window": f"{TIMED} {_percentiles('window_start')}",
        "latency_alerts": f"""{TIMED}, latency AS ({_percentiles('window_start')})
SELECT * FROM latency WHERE p99 > 500""",
        "load_level_summary": LOAD_LEVELS,
        "load_summary_json": LOAD_LEVELS,
        "load_level_by_schedule": BY_SCHEDULE,
        "quarantine": f"""SELECT CASE WHEN event_id % 50 = 29 THEN 'no time'
    ELSE 'not one well-typed object' END AS reason, count(*) AS records
FROM events WHERE {BAD_LINES} GROUP BY 1""",
        "parse_events": f"""{ARRIVED} SELECT event_id, user_id, product_id,
  CASE WHEN event_id % 50 = 43 THEN 'unknown' ELSE category END AS category, event_type, price,
  CASE WHEN event_id % 50 = 43 THEN 1 ELSE quantity END AS quantity, timestamp
FROM arrived WHERE NOT ({BAD_LINES}) AND NOT ({BLANK_LINES})""",
        "parse_recovered_field": f"""{ARRIVED} SELECT event_id, user_id, product_id,
  CASE WHEN event_id % 50 = 43 THEN 'unknown' ELSE category END AS category, event_type, price,
  CASE WHEN event_id % 50 = 43 THEN 1 ELSE quantity END AS quantity, timestamp,
  CASE WHEN event_id % 2 = 0 THEN 'c' || (event_id % 3) END AS channel
FROM arrived WHERE NOT ({BAD_LINES}) AND NOT ({BLANK_LINES})""",
        "parse_error_count": f"""SELECT
  {_count(f"NOT ({BAD_LINES}) AND NOT ({BLANK_LINES})")} AS processed,
  {_count(BAD_LINES)} AS errors FROM events""",
        "dedup_events": f"{ARRIVED} SELECT * FROM arrived",
        "content_hash": """SELECT count(*) AS row_count, true AS same_when_moved,
  count(*) FILTER (event_id % 1009 = 0) > 0 AS differs_when_changed,
  count(*) FILTER (event_id % 1009 = 0) > 0 AS differs_with_copies FROM events""",
        "content_hash_sha256": f"{SHOP}, {_sha256_sums('shop', _HASHED)}",
        "content_hash_sha256_wide": f"""{SHOP}, wide AS (
  SELECT event_id, price * CAST(1e9 AS DOUBLE) AS large, price / CAST(1e6 AS DOUBLE) AS small
  FROM shop), {_sha256_sums('wide', ['event_id', 'large', 'small'])}""",
        "table_diff": f"""{SHOP}, changed AS (
  SELECT * REPLACE (CASE WHEN event_id % 97 = 0 THEN price + 1 ELSE price END AS price)
  FROM shop
  UNION ALL SELECT * FROM shop WHERE event_id % 89 = 0)
SELECT (SELECT count(*) FROM (SELECT * FROM shop EXCEPT ALL SELECT * FROM changed)) AS only_left,
  (SELECT count(*) FROM (SELECT * FROM changed EXCEPT ALL SELECT * FROM shop)) AS only_right""",
        "reproducible_user_features": """SELECT CAST(0 AS BIGINT) AS only_left,
  CAST(0 AS BIGINT) AS only_right""",
        "sink_round_trip_parquet": f"{SHOP} SELECT {shop_columns} FROM shop",
        "sink_round_trip_csv": f"{SHOP} SELECT {shop_columns} FROM shop",
        "sink_round_trip_json": f"{ARRIVED} SELECT {stream_columns} FROM arrived",
        "event_date_partitioned": f"""{SHOP}
SELECT CAST(CAST(DATE '1970-01-01' + CAST(timestamp // 86400 AS INTEGER) AS DATE) AS VARCHAR)
    AS event_date,
  count(event_id) AS events, {_count("event_type = 'purchase'")} AS purchases
FROM shop GROUP BY 1""",
        "stream_window_totals": f"{TIMED} {_window_totals('closed')}",
        "stream_window_category_revenue": f"{TIMED} {_window_category_revenue('closed')}",
        "stream_window_type_counts": f"{TIMED} {_window_type_counts('closed')}",
        "stream_window_result_entries": f"{TIMED} {_window_entries('closed')}",
        "stream_parse_events": f"""SELECT
  {_count(f"NOT ({BAD_LINES}) AND NOT ({BLANK_LINES})")} AS processed,
  {_count(BAD_LINES)} AS errors FROM events""",
        "stream_late_totals": f"{TIMED_STRAYS} {_window_totals('closed')}",
        "stream_window_results": f"{TIMED} {_window_scalars('closed')}",
        "stream_latency_by_window": f"""{TIMED_STRAYS}
SELECT window_start, count(*) AS count, true AS p50_right, true AS p95_right, true AS p99_right
FROM closed GROUP BY window_start""",
        "stream_dedup_events": f"""{SHOP}
SELECT CASE WHEN event_id % 29 <> 3 THEN event_id END AS event_id, event_type, price FROM shop
UNION ALL SELECT NULL, event_type, price FROM shop WHERE event_id % 29 = 3 AND event_id % 3 = 0""",
        "stream_exactly_once": f"""{SHOP}
SELECT CASE WHEN event_id % 29 <> 3 THEN event_id END AS event_id, event_type, price FROM shop
UNION ALL
SELECT NULL, event_type, price + 1 FROM shop WHERE event_id % 29 = 3 AND event_id % 3 = 0""",
        "stream_anchored_window_totals": _anchored_totals(),
        "anchored_window_totals": _anchored_totals(),
        "anchored_window_category_revenue": f"""{ANCHORED}
SELECT window_start, window_end, category, {SPENT} AS revenue FROM anchored
WHERE NOT late AND event_type = 'purchase' GROUP BY window_start, window_end, category""",
        "anchored_window_type_counts": f"""{ANCHORED}
SELECT window_start, window_end, event_type, count(*) AS events FROM anchored
WHERE NOT late GROUP BY window_start, window_end, event_type""",
        "stream_committed_windows": f"{GOOD} {_window_totals('arriving')}",
        "stream_alerts": f"""{GOOD}, rates AS (
  SELECT window_start, window_start + {HOUR} AS window_end,
    CAST(count(*) FILTER (late) AS DOUBLE) / count(*) AS value
  FROM closed GROUP BY window_start),
steps AS (
  SELECT *, value > CAST(0.34 AS DOUBLE) AS bad, lag(value) OVER o > CAST(0.34 AS DOUBLE) AS last_bad,
    window_start - lag(window_end) OVER o <= {2 * HOUR} AS near_last,
    lead(value) OVER o > CAST(0.34 AS DOUBLE) AS next_bad,
    CASE WHEN lead(window_start) OVER o IS NULL
      THEN floor((SELECT max(arrival) FROM arriving) - {WATERMARK}) - window_end <= {2 * HOUR}
      ELSE lead(window_start) OVER o - window_end <= {2 * HOUR}
        AND lead(value) OVER o > CAST(0.34 AS DOUBLE) END AS goes_on
  FROM rates WINDOW o AS (ORDER BY window_start))
SELECT 'start' AS kind, CAST(window_start AS DOUBLE) AS at, value FROM steps
WHERE bad AND NOT coalesce(last_bad AND near_last, false)
UNION ALL SELECT 'end', CAST(window_end AS DOUBLE), value FROM steps WHERE bad AND NOT goes_on""",
        "stream_committed_totals": f"""SELECT
  {_count(f"NOT ({BAD_LINES}) AND NOT ({BLANK_LINES})")} AS processed,
  {_count(BAD_LINES)} AS errors FROM events""",
        "stream_committed_latency": f"{GOOD} SELECT window_start, {SUMMARY} FROM arriving GROUP BY 1",
        "latency_rollup_by_day": f"""{TIMED} SELECT
  CAST(floor(arrival / {24 * HOUR}) AS BIGINT) * {24 * HOUR} AS window_start, {SUMMARY}
FROM timed GROUP BY 1""",
        "latency_rollup_by_level": f"""{TIMED} SELECT
  CASE event_id % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END AS label, {SUMMARY}
FROM timed GROUP BY 1""",
        "stream_resume": f"""{TIMED}, sliced AS (
  SELECT *, least(floor((arrival - min(arrival) OVER ())
    / (max(arrival) OVER () - min(arrival) OVER ()) * {SLICES}), {SLICES - 1}) AS slice
  FROM arriving),
cells AS (
  SELECT DISTINCT window_start, category, event_type,
    window_start + {HOUR} <= (SELECT max(arrival) FROM sliced WHERE slice < {SLICES // 2})
      - {WATERMARK} AS early
  FROM sliced
  WHERE window_start + {HOUR} <= (SELECT max(arrival) FROM sliced) - {WATERMARK})
SELECT {_count("early")} AS cells_after_half, {_count("early")} AS cells_after_idle_run,
  count(*) AS cells_after_rest FROM cells""",
        "table_diff_located": f"""{SHOP}, sides AS (
  SELECT event_id, price, 1 AS side FROM shop
  UNION ALL
  SELECT event_id, CASE WHEN event_id % 997 = 0 THEN price + 1 ELSE price END, -1 FROM shop
  UNION ALL SELECT event_id, price, -1 FROM shop WHERE event_id % 1009 = 0)
SELECT event_id, price, CAST(greatest(sum(side), 0) AS BIGINT) AS only_left,
  CAST(greatest(-sum(side), 0) AS BIGINT) AS only_right
FROM sides GROUP BY event_id, price HAVING sum(side) <> 0""",
    }
    rebuilt = ("user_features", "product_features", "category_features")
    return oracles | {f"maintained_{name}": oracles[name] for name in rebuilt}
