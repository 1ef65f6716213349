"""DuckDB SQL twins of the registered queries (the correctness oracle).

``EVENTS_CTE`` rebuilds the adapter of ``orderlens.sources.testdata`` in SQL
and ``VALID_CTE`` adds the quality split with the fixed batch parameters;
each oracle query is ``WITH <ctes> SELECT ...``. DuckDB integer results
(hour, count, integer sums) are cast to Spark's INT / BIGINT, and double
sums are rounded the same way on both sides (addition order differs).
"""

from __future__ import annotations

AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"

EVENTS_CTE = """
geo AS (
  SELECT n.n_nationkey AS geo_key, n.n_name AS geo_province, r.r_name AS geo_city
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
src AS (
  SELECT e.event_id, e.ts, e.user_id, e.value, e.props, g.geo_province, g.geo_city,
    CASE WHEN e.event_type = 'signup' AND e.event_id % 2 = 0 THEN 'order_item_added'
         WHEN e.event_type = 'signup' THEN 'order_confirmed'
         WHEN e.event_type = 'purchase' THEN 'order_created'
         WHEN e.event_type = 'click' THEN 'order_shipped'
         WHEN e.event_type = 'view' THEN 'order_delivered'
         WHEN e.event_type = 'error' THEN 'order_cancelled' END AS mapped_type,
    'ORD-' || CAST(e.user_id AS VARCHAR) || '-' || CAST(day(e.ts) AS VARCHAR) AS message_key
  FROM events e LEFT JOIN geo g ON e.user_id % 25 = g.geo_key
),
ev AS (
  SELECT message_key,
    CAST(event_id AS VARCHAR) AS event_id,
    CASE WHEN event_id % 103 = 0 THEN 'bogus' ELSE mapped_type END AS event_type,
    CASE WHEN event_id % 101 = 0 THEN NULL ELSE message_key END AS order_id,
    CASE WHEN event_id % 149 <> 0 THEN 'CUST-' || lpad(CAST(user_id AS VARCHAR), 6, '0') END AS customer_id,
    ts + (CASE WHEN event_id % 109 = 0 THEN INTERVAL 60 DAY ELSE INTERVAL 0 DAY END)
       - (CASE WHEN event_id % 113 = 0 THEN INTERVAL 400 DAY ELSE INTERVAL 0 DAY END) AS event_timestamp,
    CASE WHEN event_id % 107 = 0 THEN 999999.0 ELSE round(value * 10, 2) END AS total_amount,
    CASE WHEN mapped_type IN ('order_created', 'order_confirmed') THEN geo_city END AS shipping_city,
    CASE WHEN mapped_type IN ('order_created', 'order_confirmed') THEN geo_province END AS shipping_province,
    CASE WHEN mapped_type IN ('order_created', 'order_confirmed')
         THEN (['credit_card', 'debit_card', 'paypal', 'bizum', 'bank_transfer'])[user_id % 5 + 1] END AS payment_method,
    CASE WHEN mapped_type = 'order_item_added' THEN 'created'
         ELSE regexp_replace(mapped_type, '^order_', '') END AS order_status,
    CASE WHEN mapped_type = 'order_created' THEN list_transform(range(0, event_id % 3 + 1), lambda k: {
      'product_id': 'P-' || CAST(event_id + k AS VARCHAR),
      'product_name': CASE WHEN NOT (event_id % 139 = 0 AND k = 0) THEN 'Product ' || CAST(event_id + k AS VARCHAR) END,
      'quantity': CASE WHEN event_id % 137 = 0 AND k = 0 THEN 0 ELSE 1 + (event_id + k) % 4 END,
      'unit_price': floor(floor(round(value * 10, 2) * 100 / (event_id % 3 + 1)) / 100 * 100 / (1 + (event_id + k) % 4)) / 100,
      'subtotal': CASE WHEN k < event_id % 3 THEN floor(round(value * 10, 2) * 100 / (event_id % 3 + 1)) / 100
                       ELSE round(round(value * 10, 2)
                                  - floor(round(value * 10, 2) * 100 / (event_id % 3 + 1)) / 100 * (event_id % 3), 2) END
                  + CASE WHEN event_id % 131 = 0 AND k = 0 THEN 1.0 ELSE 0.0 END}) END AS items,
    'EUR' AS currency,
    CAST(user_id % 6 AS INTEGER) AS kafka_partition,
    event_id AS kafka_offset,
    ts + to_milliseconds(CAST(json_extract_string(props, '$.k') AS BIGINT) * 5) AS processing_time,
    user_id
  FROM src
)"""

REASON_SQL = f"""CASE
    WHEN order_id IS NULL THEN 'null_order_id'
    WHEN event_type = 'order_created' AND (total_amount IS NULL OR total_amount <= 0) THEN 'invalid_total_amount'
    WHEN NOT (event_type IN ('order_created', 'order_item_added', 'order_confirmed', 'order_shipped',
                             'order_delivered', 'order_cancelled')) THEN 'invalid_event_type'
    WHEN total_amount IS NOT NULL AND (total_amount < 0.01 OR total_amount > 50000) THEN 'revenue_out_of_bounds'
    WHEN event_timestamp > {AS_OF_SQL} + INTERVAL 5 MINUTE THEN 'timestamp_in_future'
    WHEN event_timestamp < {AS_OF_SQL} - INTERVAL 31 DAY THEN 'timestamp_too_old'
    ELSE 'valid' END"""

CHECKED_CTE = EVENTS_CTE + f""",
checked AS (SELECT *, {REASON_SQL} AS quality_check_result FROM ev)"""

VALID_CTE = CHECKED_CTE + """,
valid AS (
  SELECT *,
    CAST(hour(event_timestamp) AS INTEGER) AS order_hour,
    CAST(dayofweek(event_timestamp) + 1 AS INTEGER) AS order_day_of_week,
    CAST(event_timestamp AS DATE) AS order_date,
    coalesce(dayofweek(event_timestamp) IN (0, 6), false) AS is_weekend,
    CASE WHEN total_amount IS NULL THEN 'unknown' WHEN total_amount < 25 THEN 'low'
         WHEN total_amount < 100 THEN 'medium' WHEN total_amount < 500 THEN 'high'
         ELSE 'premium' END AS revenue_bucket,
    CAST(coalesce(len(items), 0) AS INTEGER) AS item_count
  FROM checked WHERE quality_check_result = 'valid'
)"""


def _with(ctes: str, select_sql: str, extra: str) -> str:
    more = f",\n{extra.strip()}" if extra else ""
    return f"WITH {ctes}{more}\n{select_sql}"


def with_valid(select_sql: str, extra: str = "") -> str:
    return _with(VALID_CTE, select_sql, extra)


def with_checked(select_sql: str, extra: str = "") -> str:
    return _with(CHECKED_CTE, select_sql, extra)


def with_events(select_sql: str, extra: str = "") -> str:
    return _with(EVENTS_CTE, select_sql, extra)


def tumbling_sql(width: str) -> str:
    return with_valid(f"""
SELECT time_bucket(INTERVAL '{width}', event_timestamp, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL '{width}', event_timestamp, TIMESTAMP '1970-01-01') + INTERVAL '{width}' AS window_end,
       shipping_province AS region,
       count(*) AS event_count,
       count(DISTINCT order_id) AS order_count,
       round(sum(CASE WHEN event_type = 'order_created' THEN total_amount ELSE 0 END), 2) AS total_revenue,
       round(avg(CASE WHEN event_type = 'order_created' THEN total_amount END), 4) AS avg_order_value,
       count(DISTINCT CASE WHEN event_type = 'order_created' THEN customer_id END) AS unique_customers,
       CAST(sum(CASE WHEN event_type = 'order_cancelled' THEN 1 ELSE 0 END) AS BIGINT) AS cancelled_count,
       round(sum(CASE WHEN event_type = 'order_cancelled' THEN 1 ELSE 0 END) / count(*), 4) AS cancellation_rate
FROM valid
GROUP BY 1, 2, 3""")


def sliding_sql(width_min: int = 5, slide_min: int = 2) -> str:
    k = -(-width_min // slide_min)  # most windows one event can belong to
    members = f"""members AS (
  SELECT *, time_bucket(INTERVAL '{slide_min} minutes', event_timestamp, TIMESTAMP '1970-01-01')
            - k * INTERVAL '{slide_min} minutes' AS window_start
  FROM (SELECT *, unnest(range(0, {k})) AS k FROM valid)
)"""
    return with_valid(f"""
SELECT window_start, window_start + INTERVAL '{width_min} minutes' AS window_end,
       shipping_province AS region,
       count(DISTINCT order_id) AS sliding_order_count,
       round(sum(CASE WHEN event_type = 'order_created' THEN total_amount ELSE 0 END), 2) AS sliding_total_revenue,
       round(avg(CASE WHEN event_type = 'order_created' THEN total_amount END), 4) AS sliding_avg_order_value,
       count(DISTINCT CASE WHEN event_type = 'order_created' THEN customer_id END) AS sliding_unique_customers
FROM members
WHERE event_timestamp < window_start + INTERVAL '{width_min} minutes'
GROUP BY 1, 2, 3""", members)


# The raw messages of the adapter, parsed: every 127th body is not JSON, so
# all its fields are NULL (the message key and broker columns survive); every
# 157th has a bare date for a timestamp, which is NULL then.
PARSED_CTE = EVENTS_CTE + """,
parsed AS (
  SELECT message_key,
    CASE WHEN kafka_offset % 127 = 0 THEN NULL ELSE event_id END AS event_id,
    CASE WHEN kafka_offset % 127 = 0 THEN NULL ELSE event_type END AS event_type,
    CASE WHEN kafka_offset % 127 = 0 THEN NULL ELSE order_id END AS order_id,
    CASE WHEN kafka_offset % 127 = 0 THEN NULL ELSE customer_id END AS customer_id,
    CASE WHEN kafka_offset % 127 <> 0 AND kafka_offset % 157 <> 0 THEN event_timestamp END AS event_timestamp,
    kafka_offset % 127 <> 0 AND kafka_offset % 157 = 0 AS time_malformed,
    CASE WHEN kafka_offset % 127 = 0 THEN NULL ELSE total_amount END AS total_amount,
    CASE WHEN kafka_offset % 127 = 0 THEN NULL ELSE currency END AS currency,
    CASE WHEN kafka_offset % 127 = 0 THEN NULL ELSE shipping_province END AS shipping_province,
    CASE WHEN kafka_offset % 127 = 0 THEN NULL ELSE shipping_city END AS shipping_city,
    CASE WHEN kafka_offset % 127 = 0 THEN NULL ELSE payment_method END AS payment_method,
    CASE WHEN kafka_offset % 127 = 0 THEN NULL ELSE items END AS items,
    kafka_offset % 127 = 0 AS malformed,
    kafka_partition, kafka_offset
  FROM ev
)"""


def with_parsed(select_sql: str, extra: str = "") -> str:
    return _with(PARSED_CTE, select_sql, extra)


def with_streamed(select_sql: str, extra: str = "") -> str:
    """Over the events that a stream of the raw messages stores: valid, and
    without NULL in what order_events needs (that is quarantined)."""
    return with_parsed(select_sql, f"""
streamed AS (SELECT * FROM (SELECT *, {REASON_SQL} AS r FROM parsed) WHERE r = 'valid'
               AND customer_id IS NOT NULL AND event_timestamp IS NOT NULL)"""
                       + (f",\n{extra}" if extra else ""))


STATUS_SQL = """CASE event_type WHEN 'order_created' THEN 'created' WHEN 'order_confirmed' THEN 'confirmed'
    WHEN 'order_shipped' THEN 'shipped' WHEN 'order_delivered' THEN 'delivered'
    WHEN 'order_cancelled' THEN 'cancelled' END"""

VALID_TYPES_SQL = ("('order_created', 'order_item_added', 'order_confirmed', 'order_shipped', "
                   "'order_delivered', 'order_cancelled')")
