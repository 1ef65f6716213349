"""Registered queries: one callable per operator of the inventory.

Each takes (spark, sf_dir) and returns a lazy DataFrame over the whole
driver tables. Double sums and averages are rounded (2 and 4 digits) only
here, in the query's final projection, because Spark and DuckDB add in a
different order; the operators themselves return exact values.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import anomalies as A
from orderlens.operators import lifecycle as L
from orderlens.operators import monitor as M
from orderlens.operators import quality as Q
from orderlens.operators import windows as W
from orderlens import schemas as S
from orderlens.operators.parse import parse_events
from orderlens.plans import batch as B
from orderlens.plans import oracle as O
from orderlens.session import checkpoint_root
from orderlens.sources import testdata as T
from orderlens.tables.sinks import conform
from orderlens.tables.store import TableStore

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _round(df: DataFrame, money=(), ratios=()) -> DataFrame:
    return df.withColumns({**{c: F.round(c, 2) for c in money}, **{c: F.round(c, 4) for c in ratios}})


# ---------------------------------------------------------------------------
# Quality, enrichment, windows
# ---------------------------------------------------------------------------
@register(
    "quality_results",
    O.with_checked("SELECT event_id, order_id, event_type, quality_check_result FROM checked"),
)
def quality_results(spark, sf_dir):
    """O-12: reason (or 'valid') for every event."""
    return B.checked(spark, sf_dir).select("event_id", "order_id", "event_type", "quality_check_result")


@register(
    "enriched_events",
    O.with_valid("""
SELECT event_id, order_hour, order_day_of_week, order_date, is_weekend, revenue_bucket,
       shipping_city, shipping_province, payment_method, order_status, item_count
FROM valid"""),
)
def enriched_events(spark, sf_dir):
    """O-11 on the valid events."""
    return B.valid_enriched(spark, sf_dir).select(
        "event_id", "order_hour", "order_day_of_week", "order_date", "is_weekend", "revenue_bucket",
        "shipping_city", "shipping_province", "payment_method", "order_status", "item_count",
    )


def _metrics(spark, sf_dir, width):
    m = W.metrics_rows(W.tumbling_metrics(B.valid_enriched(spark, sf_dir), width))
    return _round(m, money=["total_revenue"], ratios=["avg_order_value"])


@register("order_metrics_1h", O.tumbling_sql("1 hour"))
def order_metrics_1h(spark, sf_dir):
    """O-30 + O-04: hourly metrics per region in the sink shape."""
    return _metrics(spark, sf_dir, "1 hour")


@register("order_metrics_1m", O.tumbling_sql("1 minute"))
def order_metrics_1m(spark, sf_dir):
    """O-30 + O-04 at the reference's 1-minute width."""
    return _metrics(spark, sf_dir, "1 minute")


@register("sliding_metrics", O.sliding_sql(5, 2))
def sliding_metrics(spark, sf_dir):
    """O-31: 5-minute windows sliding by 2 minutes."""
    m = W.sliding_rows(W.sliding_metrics(B.valid_enriched(spark, sf_dir), "5 minutes", "2 minutes"))
    return _round(m, money=["sliding_total_revenue"], ratios=["sliding_avg_order_value"])


@register("order_metrics_1h_chained", O.tumbling_sql("1 hour"))
def order_metrics_1h_chained(spark, sf_dir):
    """O-77: hourly windows with exact distinct counts, merged from one-minute panes."""
    m = W.metrics_rows(W.tumbling_metrics(B.valid_enriched(spark, sf_dir), "1 hour", pane="1 minute"))
    return _round(m, money=["total_revenue"], ratios=["avg_order_value"])


# ---------------------------------------------------------------------------
# Parse, quality metrics, rules, contract, reconciliation
# ---------------------------------------------------------------------------


def _parsed(spark, sf_dir):
    return parse_events(T.raw_messages(spark, sf_dir), processing_time=F.col("kafka_timestamp"))


@register(
    "parsed_events",
    O.with_parsed("""
SELECT message_key, event_id, event_type, order_id, customer_id, event_timestamp, total_amount,
       shipping_province AS province, kafka_partition, kafka_offset
FROM parsed"""),
)
def parsed_events(spark, sf_dir):
    """O-10: JSON messages (with malformed bodies) back to typed events."""
    return _parsed(spark, sf_dir).select(
        "message_key", "event_id", "event_type", "order_id", "customer_id",
        F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
        F.col("payload.total_amount").alias("total_amount"),
        F.col("payload.shipping_address.province").alias("province"),
        "kafka_partition", "kafka_offset",
    )


_QM_SELECT = """
SELECT {ts} AS check_timestamp,
       count(*) AS records_checked,
       count(*) FILTER (WHERE quality_check_result = 'valid') AS records_valid,
       count(*) FILTER (WHERE quality_check_result <> 'valid') AS records_invalid,
       round(count(*) FILTER (WHERE quality_check_result <> 'valid') / count(*), 4) AS quarantine_rate
       {extra}
FROM checked {group}"""


@register("quality_metrics", O.with_checked(_QM_SELECT.format(ts=O.AS_OF_SQL, extra="", group="")))
def quality_metrics(spark, sf_dir):
    """O-33: one quality row for the whole input, checked at as_of."""
    return Q.quality_metrics(B.checked(spark, sf_dir), check_timestamp=B.AS_OF).select(
        "check_timestamp", "records_checked", "records_valid", "records_invalid", "quarantine_rate"
    )


_DAILY = _QM_SELECT.format(ts="batch_date", extra="", group="GROUP BY batch_date").replace(
    "FROM checked", "FROM (SELECT *, CAST(processing_time AS DATE) AS batch_date FROM checked)"
).replace("SELECT batch_date AS check_timestamp", "SELECT batch_date")


@register("quality_metrics_daily", O.with_checked(_DAILY))
def quality_metrics_daily(spark, sf_dir):
    """O-33 per ingest day (one 'micro-batch' per day of broker time)."""
    checked = B.checked(spark, sf_dir).withColumn("batch_date", F.to_date("processing_time"))
    return Q.quality_metrics(checked, check_timestamp=B.AS_OF, by=["batch_date"]).select(
        "batch_date", "records_checked", "records_valid", "records_invalid", "quarantine_rate"
    )


@register("quarantine_alerts", O.with_checked(f"SELECT * FROM ({_DAILY}) WHERE quarantine_rate > 0.05"))
def quarantine_alerts(spark, sf_dir):
    """O-17: ingest days whose quarantine rate is above 5 %."""
    return Q.quarantine_alerts(quality_metrics_daily(spark, sf_dir))


def _items_sql(cond: str) -> str:
    return f"len(list_filter(items, lambda x: {cond})) > 0"


_RULE_CONDS = [
    ("no_null_order_ids", "critical", "order_id IS NULL"),
    ("positive_quantity", "critical", _items_sql("x.quantity <= 0")),
    ("valid_event_type", "critical", f"NOT (event_type IN {O.VALID_TYPES_SQL})"),
    ("reasonable_revenue", "warning", "total_amount < 0.01 OR total_amount > 50000.0"),
    ("timestamp_not_future", "warning", f"event_timestamp > {O.AS_OF_SQL} + INTERVAL 300 SECOND"),
    ("timestamp_not_too_old", "warning", f"event_timestamp < {O.AS_OF_SQL} - INTERVAL 2678400 SECOND"),
]


def _rule_sql():
    name = "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, _, c in _RULE_CONDS) + " END"
    sev = "CASE " + " ".join(f"WHEN {c} THEN '{s}'" for _, s, c in _RULE_CONDS) + " END"
    n = " + ".join(f"CAST(coalesce({c}, false) AS INTEGER)" for _, _, c in _RULE_CONDS)
    return O.with_events(f"SELECT event_id, {name} AS failed_rule, {sev} AS failure_severity, "
                         f"CAST({n} AS INTEGER) AS n_failed FROM ev")


@register("rule_checks", _rule_sql())
def rule_checks(spark, sf_dir):
    """O-13: the declarative rule list (positive item quantity included;
    the age rule set to the batch's 31 days)."""
    rules = Q.with_max_age(Q.DEFAULT_RULES, 31 * 86400)
    ruled = Q.apply_rules(T.order_events(spark, sf_dir), rules, as_of=B.AS_OF)
    return ruled.select("event_id", "failed_rule", "failure_severity", F.size("failed_rules").alias("n_failed"))


_UUID = r"'^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$'"
_CONTRACT = [
    ("missing_event_id", "event_id IS NULL"),
    ("missing_event_type", "event_type IS NULL"),
    ("missing_order_id", "order_id IS NULL"),
    ("missing_customer_id", "customer_id IS NULL"),
    ("missing_timestamp", "event_timestamp IS NULL AND NOT time_malformed"),
    ("timestamp_malformed", "time_malformed"),
    ("missing_payload", "malformed"),
    ("event_id_not_uuid", f"NOT regexp_matches(event_id, {_UUID})"),
    ("order_id_not_uuid", f"NOT regexp_matches(order_id, {_UUID})"),
    ("event_type_not_allowed", f"NOT (event_type IN {O.VALID_TYPES_SQL})"),
    ("item_field_missing", _items_sql("x.product_id IS NULL OR x.product_name IS NULL OR x.quantity IS NULL "
                                      "OR x.unit_price IS NULL OR x.subtotal IS NULL")),
    ("item_quantity_below_1", _items_sql("x.quantity < 1")),
    ("item_price_negative", _items_sql("x.unit_price < 0 OR x.subtotal < 0")),
    ("total_negative", "total_amount < 0"),
    ("currency_not_eur", "currency <> 'EUR'"),
    ("payment_method_not_allowed",
     "NOT (payment_method IN ('credit_card', 'debit_card', 'paypal', 'bizum', 'bank_transfer'))"),
]


def _contract_sql():
    parts = ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _CONTRACT)
    n = " + ".join(f"CAST(coalesce({c}, false) AS INTEGER)" for _, c in _CONTRACT)
    return O.with_parsed(f"SELECT kafka_offset, concat_ws(',', {parts}) AS violations, "
                         f"CAST({n} AS INTEGER) AS n_violations FROM parsed")


@register("contract_violations", _contract_sql())
def contract_violations(spark, sf_dir):
    """O-14: violated clauses of the published event contract, per parsed
    message."""
    v = Q.contract_violations(_parsed(spark, sf_dir))
    return v.select("kafka_offset", F.concat_ws(",", "contract_violations").alias("violations"),
                    F.size("contract_violations").alias("n_violations"))


@register(
    "items_total_mismatch",
    """
WITH lines AS (
  SELECT 'ORD-' || CAST(l_orderkey AS VARCHAR) AS order_id, round(l_extendedprice, 2) AS subtotal,
         CAST(trunc(l_quantity) AS INTEGER) AS quantity, round(l_extendedprice / l_quantity, 2) AS unit_price
  FROM lineitem
),
per AS (
  SELECT order_id, sum(subtotal) AS s, count(*) AS n,
         count(*) FILTER (WHERE quantity <= 0 OR unit_price <= 0) AS bad
  FROM lines GROUP BY order_id
),
h AS (
  SELECT 'ORD-' || CAST(o_orderkey AS VARCHAR) AS order_id,
         'CUST-' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS customer_id,
         round(coalesce(round(per.s, 2) + CASE WHEN o_orderkey % 97 = 0 THEN 1.0 ELSE 0.0 END, o_totalprice), 2) AS total_amount
  FROM orders LEFT JOIN per ON per.order_id = 'ORD-' || CAST(o_orderkey AS VARCHAR)
)
SELECT h.order_id, h.customer_id, h.total_amount, round(coalesce(per.s, 0), 2) AS items_total,
       coalesce(per.n, 0) AS line_count, coalesce(per.bad, 0) AS bad_item_count
FROM h LEFT JOIN per ON h.order_id = per.order_id
WHERE abs(round(coalesce(per.s, 0), 2) - h.total_amount) >= 0.01 OR coalesce(per.bad, 0) > 0""",
)
def items_total_mismatch(spark, sf_dir):
    """O-15 over orders + lineitem: orders whose lines do not add up to the
    order total, or with a non-positive quantity or price."""
    return Q.reconcile_order_lines(T.order_headers(spark, sf_dir), T.order_lines(spark, sf_dir))


@register(
    "items_total_mismatch_nested",
    O.with_parsed("""
SELECT event_id, order_id, items_total, bad_item_count FROM (
  SELECT *, round(list_sum(list_transform(items, lambda x: coalesce(x.subtotal, 0.0))), 2) AS items_total,
         CAST(coalesce(len(list_filter(items, lambda x: x.quantity <= 0 OR x.unit_price <= 0)), 0) AS INTEGER)
           AS bad_item_count
  FROM parsed WHERE event_type = 'order_created'
) WHERE abs(items_total - total_amount) >= 0.01 OR bad_item_count > 0"""),
)
def items_total_mismatch_nested(spark, sf_dir):
    """O-15 over the items inside the parsed messages."""
    return Q.items_total_mismatch(_parsed(spark, sf_dir)).select("event_id", "order_id", "items_total", "bad_item_count")


# ---------------------------------------------------------------------------
# Anomalies
# ---------------------------------------------------------------------------
@register(
    "large_orders",
    O.with_valid("""
SELECT event_id, order_id, customer_id, total_amount AS anomaly_value, 'large_order' AS anomaly_type
FROM valid WHERE event_type = 'order_created' AND total_amount > 2000"""),
)
def large_orders(spark, sf_dir):
    """O-16: order_created events above 2000."""
    return A.large_orders(B.valid_enriched(spark, sf_dir)).select(
        "event_id", "order_id", "customer_id", "anomaly_value", "anomaly_type"
    )


_SPIKES_SQL = """
SELECT time_bucket(INTERVAL '1 minute', event_timestamp, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL '1 minute', event_timestamp, TIMESTAMP '1970-01-01') + INTERVAL '1 minute' AS window_end,
       shipping_province AS region, count(*) AS total_events,
       CAST(sum(CASE WHEN event_type = 'order_cancelled' THEN 1 ELSE 0 END) AS BIGINT) AS cancelled,
       sum(CASE WHEN event_type = 'order_cancelled' THEN 1 ELSE 0 END) / count(*) AS cancel_rate,
       'cancellation_spike' AS anomaly_type
FROM valid GROUP BY 1, 2, 3
HAVING sum(CASE WHEN event_type = 'order_cancelled' THEN 1 ELSE 0 END) / count(*) > 0.3"""


@register("cancellation_spikes", O.with_valid(_SPIKES_SQL))
def cancellation_spikes(spark, sf_dir):
    """O-32: 1-minute (window, region) groups with cancel rate above 0.3."""
    s = A.cancellation_spikes(B.valid_enriched(spark, sf_dir))
    return s.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "region", "total_events", "cancelled", "cancel_rate", "anomaly_type")


def _rapid_sql(n: int, width: str) -> str:
    return O.with_valid(f"""
SELECT event_id, customer_id, order_id, event_timestamp, orders_in_window FROM (
  SELECT *, count(DISTINCT order_id) OVER (PARTITION BY customer_id ORDER BY event_timestamp
                           RANGE BETWEEN INTERVAL '{width}' PRECEDING AND CURRENT ROW) AS orders_in_window
  FROM valid WHERE event_type = 'order_created' AND customer_id IS NOT NULL
) WHERE orders_in_window > {n}""")


def _rapid(spark, sf_dir, n, width):
    r = A.rapid_fire(B.valid_enriched(spark, sf_dir), n=n, window=width)
    return r.select("event_id", "customer_id", "order_id", "event_timestamp", "orders_in_window")


@register("rapid_fire", _rapid_sql(5, "5 minutes"))
def rapid_fire(spark, sf_dir):
    """O-34 with the documented parameters: > 5 orders within 5 minutes."""
    return _rapid(spark, sf_dir, 5, "5 minutes")


@register("rapid_fire_1h", _rapid_sql(1, "1 hour"))
def rapid_fire_1h(spark, sf_dir):
    """O-34 at > 1 order within 1 hour (the driver data is sparse)."""
    return _rapid(spark, sf_dir, 1, "1 hour")


@register("rapid_fire_24h", _rapid_sql(1, "24 hours"))
def rapid_fire_24h(spark, sf_dir):
    """O-34 at > 1 order within 24 hours (the adapter gives a customer one
    order a day)."""
    return _rapid(spark, sf_dir, 1, "24 hours")


@register("rapid_fire_desks", """
WITH ev AS (
  SELECT 'DESK-' || c_mktsegment AS customer_id, 'ORD-' || CAST(o_orderkey AS VARCHAR) AS order_id,
         'ORD-' || CAST(o_orderkey AS VARCHAR) || '-' || CAST(again AS VARCHAR) AS event_id,
         CAST(o_orderdate AS TIMESTAMP) + again * INTERVAL 2 MINUTE AS event_timestamp
  FROM (SELECT *, unnest(range(0, CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END)) AS again FROM orders)
  JOIN customer ON o_custkey = c_custkey)
SELECT event_id, customer_id, order_id, event_timestamp, orders_in_window FROM (
  SELECT *, count(DISTINCT order_id) OVER (PARTITION BY customer_id ORDER BY event_timestamp
                                           RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND CURRENT ROW) AS orders_in_window FROM ev
) WHERE orders_in_window > 5""")
def rapid_fire_desks(spark, sf_dir):
    """O-34 with the documented parameters over the orders table: desks with
    > 5 different orders within 5 minutes, orders created twice among them."""
    r = A.rapid_fire(T.desk_orders(spark, sf_dir))
    return r.select("event_id", "customer_id", "order_id", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
                    "orders_in_window")


def _anomalies_sql():
    large = f"""SELECT 'large_order' AS anomaly_type, {O.AS_OF_SQL} AS detected_at, order_id, customer_id,
       shipping_province AS region, total_amount, CAST(NULL AS DOUBLE) AS cancel_rate, CAST(NULL AS VARCHAR) AS details
FROM valid WHERE event_type = 'order_created' AND total_amount > 2000"""
    spikes = f"""SELECT 'cancellation_spike', {O.AS_OF_SQL}, NULL, NULL, region, NULL, cancel_rate,
       'window_start=' || strftime(window_start, '%Y-%m-%d %H:%M:%S') || ';events=' || CAST(total_events AS VARCHAR)
       || ';cancelled=' || CAST(cancelled AS VARCHAR)
FROM ({_SPIKES_SQL})"""
    rapid = f"""SELECT 'rapid_fire', {O.AS_OF_SQL}, order_id, customer_id, shipping_province, total_amount, NULL,
       'orders_in_window=' || CAST(orders_in_window AS VARCHAR)
FROM (SELECT *, count(DISTINCT order_id) OVER (PARTITION BY customer_id ORDER BY event_timestamp
                              RANGE BETWEEN INTERVAL '24 hours' PRECEDING AND CURRENT ROW) AS orders_in_window
      FROM valid WHERE event_type = 'order_created' AND customer_id IS NOT NULL) WHERE orders_in_window > 1"""
    return O.with_valid(f"{large}\nUNION ALL\n{spikes}\nUNION ALL\n{rapid}")


@register("anomalies", _anomalies_sql())
def anomalies(spark, sf_dir):
    """O-06: every detector in the order_anomalies shape (large orders,
    1-minute cancellation spikes, rapid fire > 1 in 24 h)."""
    ev = B.valid_enriched(spark, sf_dir)
    out = A.anomalies(
        large=A.large_orders(ev),
        spikes=A.cancellation_spikes(ev),
        rapid=A.rapid_fire(ev, n=1, window="24 hours"),
        detected_at=B.AS_OF,
    )
    return out.withColumn("detected_at", F.col("detected_at").cast("timestamp_ntz"))


# ---------------------------------------------------------------------------
# Lifecycle
# ---------------------------------------------------------------------------
@register(
    "order_state",
    O.with_valid(f"""
SELECT order_id,
       arg_max(status, event_timestamp) FILTER (WHERE status IS NOT NULL) AS current_status,
       round(arg_max(total_amount, event_timestamp), 2) AS last_total,
       arg_max_null(customer_id, event_timestamp) AS customer_id,
       min(event_timestamp) AS first_event_time, max(event_timestamp) AS last_event_time,
       count(*) AS event_count
FROM (SELECT *, {O.STATUS_SQL} AS status FROM valid) GROUP BY order_id"""),
)
def order_state(spark, sf_dir):
    """O-40: replayed state of every order."""
    s = L.current_order_state(B.valid_enriched(spark, sf_dir))
    return _round(s, money=["last_total"])


@register(
    "active_orders",
    O.with_valid(f"""
SELECT count(*) FILTER (WHERE NOT coalesce(current_status IN ('delivered', 'cancelled'), false)) AS active_orders,
       count(*) AS total_orders
FROM (SELECT order_id, arg_max(status, event_timestamp) FILTER (WHERE status IS NOT NULL) AS current_status
      FROM (SELECT *, {O.STATUS_SQL} AS status FROM valid WHERE event_timestamp <= {O.AS_OF_SQL}) GROUP BY order_id)"""),
)
def active_orders(spark, sf_dir):
    """O-43: orders not delivered or cancelled at as_of."""
    return L.active_orders(B.valid_enriched(spark, sf_dir), as_of=B.AS_OF)


@register(
    "backfill_region",
    O.with_valid("""
SELECT event_id, order_id,
  last_value(shipping_province IGNORE NULLS) OVER w AS shipping_province,
  last_value(shipping_city IGNORE NULLS) OVER w AS shipping_city,
  last_value(payment_method IGNORE NULLS) OVER w AS payment_method
FROM valid
WINDOW w AS (PARTITION BY order_id ORDER BY event_timestamp, kafka_offset
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
)
def backfill_region(spark, sf_dir):
    """O-41: region, city and payment method carried to later events."""
    f = L.backfill_region(B.valid_enriched(spark, sf_dir))
    return f.select("event_id", "order_id", "shipping_province", "shipping_city", "payment_method")


@register(
    "illegal_transitions",
    O.with_valid(f"""
SELECT event_id, order_id, event_type, previous_status,
  CASE WHEN previous_status IS NULL THEN 'first_event_not_created' ELSE 'transition_not_allowed' END AS violation
FROM (
  SELECT *, last_value(status IGNORE NULLS) OVER (PARTITION BY order_id ORDER BY event_timestamp, kafka_offset
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_status
  FROM (SELECT *, {O.STATUS_SQL} AS status FROM valid)
)
WHERE (previous_status IS NULL AND event_type <> 'order_created')
   OR (previous_status = 'created' AND event_type NOT IN ('order_item_added', 'order_confirmed', 'order_cancelled'))
   OR (previous_status = 'confirmed' AND event_type NOT IN ('order_shipped', 'order_cancelled'))
   OR (previous_status = 'shipped' AND event_type NOT IN ('order_delivered'))
   OR previous_status IN ('delivered', 'cancelled')"""),
)
def illegal_transitions(spark, sf_dir):
    """O-42: events the order's previous status does not allow."""
    t = L.illegal_transitions(B.valid_enriched(spark, sf_dir))
    return t.select("event_id", "order_id", "event_type", "previous_status", "violation")


# ---------------------------------------------------------------------------
# Monitoring
# ---------------------------------------------------------------------------
_LAT_SQL = "(epoch_us(processing_time) - epoch_us(event_timestamp)) / 1000.0"


_KPI_CTES = f"""
upto AS (SELECT *, epoch_us(event_timestamp) AS t_us, epoch_us({O.AS_OF_SQL}) AS ref_us
         FROM valid WHERE event_timestamp <= {O.AS_OF_SQL}),
c AS (
  SELECT count(*) FILTER (WHERE t_us >= ref_us - 60000000) AS n_min,
         min(t_us) FILTER (WHERE t_us >= ref_us - 60000000) AS first_min,
         max(ref_us) AS ref,
         count(*) FILTER (WHERE t_us >= ref_us - 3600000000 AND event_type = 'order_created') AS orders_last_hour,
         sum(total_amount) FILTER (WHERE t_us >= ref_us - 3600000000 AND event_type = 'order_created') AS rev,
         count(*) FILTER (WHERE t_us >= ref_us - 3600000000 AND event_type = 'order_cancelled') AS canc,
         count(*) FILTER (WHERE t_us >= ref_us - 3600000000) AS total_events_processed,
         arg_max({_LAT_SQL}, processing_time) FILTER (WHERE t_us >= ref_us - 3600000000) AS lat
  FROM upto
),
s AS (
  SELECT count(*) FILTER (WHERE NOT coalesce(st IN ('delivered', 'cancelled'), false)) AS active_orders
  FROM (SELECT order_id, arg_max(status, event_timestamp) FILTER (WHERE status IS NOT NULL) AS st
        FROM (SELECT *, {O.STATUS_SQL} AS status FROM upto) GROUP BY order_id)
)"""


@register(
    "kpis",
    O.with_valid("""
SELECT CASE WHEN n_min = 0 THEN 0.0
            ELSE n_min / greatest(CASE WHEN n_min > 1 THEN (ref - first_min) / 1e6 ELSE 60.0 END, 1.0) END
         AS events_per_second,
       orders_last_hour, round(coalesce(rev, 0.0), 2) AS revenue_last_hour,
       CASE WHEN orders_last_hour > 0 THEN round(canc / orders_last_hour, 4) ELSE 0.0 END AS cancellation_rate,
       total_events_processed, round(lat, 3) AS avg_processing_latency_ms,
       (SELECT active_orders FROM s) AS active_orders
FROM c""", _KPI_CTES),
)
def kpis(spark, sf_dir):
    """O-50: dashboard headline numbers at as_of."""
    k = M.kpis(B.valid_enriched(spark, sf_dir), as_of=B.AS_OF)
    return k.withColumns({"revenue_last_hour": F.round("revenue_last_hour", 2),
                          "avg_processing_latency_ms": F.round("avg_processing_latency_ms", 3)})


@register(
    "revenue_trend",
    O.with_valid(f"""
SELECT time_bucket(INTERVAL '5 minutes', event_timestamp, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL '5 minutes', event_timestamp, TIMESTAMP '1970-01-01') + INTERVAL '5 minutes' AS window_end,
       round(sum(total_amount), 2) AS revenue, count(*) AS order_count
FROM valid
WHERE event_type = 'order_created' AND event_timestamp >= {O.AS_OF_SQL} - INTERVAL 300 MINUTE
  AND event_timestamp < {O.AS_OF_SQL}
GROUP BY 1, 2"""),
)
def revenue_trend(spark, sf_dir):
    """O-51: revenue per 5-minute bucket, the 60 buckets before as_of."""
    return _round(M.revenue_trend(B.valid_enriched(spark, sf_dir), as_of=B.AS_OF), money=["revenue"])


@register(
    "orders_by_region",
    O.with_valid("""
SELECT shipping_province AS region, count(*) AS order_count, round(sum(total_amount), 2) AS revenue
FROM valid WHERE event_type = 'order_created' AND shipping_province IS NOT NULL
GROUP BY 1 ORDER BY order_count DESC, region ASC LIMIT 15"""),
)
def orders_by_region(spark, sf_dir):
    """O-52: top 15 regions by orders."""
    return _round(M.orders_by_region(B.valid_enriched(spark, sf_dir), 15), money=["revenue"])


@register(
    "event_type_distribution",
    O.with_valid("SELECT event_type, count(*) AS event_count FROM valid GROUP BY 1"),
)
def event_type_distribution(spark, sf_dir):
    """O-53: valid events per type."""
    return M.event_type_distribution(B.valid_enriched(spark, sf_dir))


@register(
    "hourly_pattern",
    O.with_valid("""
SELECT CAST(h.hour AS INTEGER) AS hour, coalesce(o.orders, 0) AS orders, h.days,
       round(coalesce(o.orders, 0) / h.days, 4) AS avg_orders
FROM (SELECT unnest(range(0, 24)) AS hour,
             (SELECT count(DISTINCT CAST(event_timestamp AS DATE)) FROM valid) AS days) h
LEFT JOIN (SELECT hour(event_timestamp) AS hour, count(*) AS orders FROM valid
           WHERE event_type = 'order_created' GROUP BY 1) o ON o.hour = h.hour"""),
)
def hourly_pattern(spark, sf_dir):
    """O-54: average orders per hour of day."""
    return _round(M.hourly_pattern(B.valid_enriched(spark, sf_dir)), ratios=["avg_orders"])


@register(
    "recent_events",
    O.with_valid("""
SELECT event_id, event_type, order_id, customer_id, event_timestamp, total_amount
FROM valid ORDER BY event_timestamp DESC, event_id DESC LIMIT 100"""),
)
def recent_events(spark, sf_dir):
    """O-55: the newest 100 valid events."""
    r = M.recent_events(B.valid_enriched(spark, sf_dir), 100)
    return r.select("event_id", "event_type", "order_id", "customer_id", "event_timestamp",
                    F.col("payload.total_amount").alias("total_amount"))


@register(
    "latency_bands",
    O.with_valid(f"""
SELECT event_id, {_LAT_SQL} AS latency_ms,
       CASE WHEN {_LAT_SQL} < 100 THEN 'ok' WHEN {_LAT_SQL} < 300 THEN 'warn' ELSE 'bad' END AS latency_band,
       {_LAT_SQL} > 300 AS latency_alert
FROM valid"""),
)
def latency_bands(spark, sf_dir):
    """O-56: processing latency per event and its band."""
    return M.latency_bands(B.valid_enriched(spark, sf_dir)).select(
        "event_id", "latency_ms", "latency_band", "latency_alert"
    )


@register(
    "kpi_alerts",
    O.with_valid("""
SELECT * FROM (
  SELECT time_bucket(INTERVAL '1 hour', event_timestamp, TIMESTAMP '1970-01-01') AS window_start,
         time_bucket(INTERVAL '1 hour', event_timestamp, TIMESTAMP '1970-01-01') + INTERVAL '1 hour' AS window_end,
         count(*) FILTER (WHERE event_type = 'order_created') AS orders,
         round(coalesce(sum(total_amount) FILTER (WHERE event_type = 'order_created'), 0.0), 2) AS revenue,
         count(*) FILTER (WHERE event_type = 'order_cancelled') AS cancellations,
         CASE WHEN count(*) FILTER (WHERE event_type = 'order_created') > 0
              THEN round(count(*) FILTER (WHERE event_type = 'order_cancelled')
                         / count(*) FILTER (WHERE event_type = 'order_created'), 4)
              ELSE 0.0 END AS cancellation_rate,
         'high_cancellation_rate' AS alert
  FROM valid GROUP BY 1, 2
) WHERE cancellation_rate > 0.10"""),
)
def kpi_alerts(spark, sf_dir):
    """O-57: hours whose last-hour cancellation rate (per order) is above 10 %."""
    return _round(M.kpi_alerts(M.kpis_by_hour(B.valid_enriched(spark, sf_dir))), money=["revenue"])


# ---------------------------------------------------------------------------
# Quarantine and sink projections
# ---------------------------------------------------------------------------
def _invalid_parsed(spark, sf_dir):
    checked = Q.check_events(_parsed(spark, sf_dir), **B.CHECK_ARGS)
    return Q.split_checked(checked)[1]


_PARSED_REASON = O.REASON_SQL


@register(
    "quarantine_messages",
    O.with_parsed(f"""
SELECT order_id AS key, event_id AS json_event_id, reason AS json_failure_reason, kafka_offset AS json_offset
FROM (SELECT *, {_PARSED_REASON} AS reason FROM parsed) WHERE reason <> 'valid'"""),
)
def quarantine_messages(spark, sf_dir):
    """O-07: quarantine records (key = order id, value = row JSON with the
    failure reason and the raw message)."""
    q = Q.quarantine_messages(_invalid_parsed(spark, sf_dir))
    return q.select(
        "key",
        F.get_json_object("value", "$.event_id").alias("json_event_id"),
        F.get_json_object("value", "$.failure_reason").alias("json_failure_reason"),
        F.get_json_object("value", "$.kafka_offset").cast("long").alias("json_offset"),
    )


_STRICT_REASON = O.REASON_SQL.replace(
    "CASE\n", "CASE\n    WHEN malformed THEN 'malformed_json'\n", 1
).replace("    ELSE 'valid' END", "    WHEN event_type IS NULL THEN 'null_event_type'\n"
          "    WHEN event_timestamp IS NULL THEN 'null_event_timestamp'\n    ELSE 'valid' END")


@register(
    "quarantine_replay",
    O.with_parsed(f"""
SELECT event_id, order_id, first_reason AS previous_failure_reason FROM (
  SELECT * REPLACE (coalesce(order_id, message_key) AS order_id), first_reason
  FROM (SELECT *, {_PARSED_REASON} AS first_reason FROM parsed) WHERE first_reason <> 'valid'
) WHERE ({_STRICT_REASON}) = 'valid'"""),
)
def quarantine_replay(spark, sf_dir):
    """O-18: quarantined messages re-parsed from their raw text, repaired
    (order id from the message key) and re-checked strictly; the rows that
    now pass."""
    store = _fresh_store(spark)
    store.write("order_quarantine", Q.quarantine_rows(_invalid_parsed(spark, sf_dir), B.AS_OF), "quarantine", 0)
    replayed = Q.replay_quarantine(store.read("order_quarantine"), repair=Q.order_id_from_key, strict=True,
                                   **B.CHECK_ARGS)
    return replayed.select("event_id", "order_id", "previous_failure_reason")


def _fresh_store(spark) -> TableStore:
    """Tables in a new folder under the shared checkpoint root, for queries
    that write what they then read."""
    root = checkpoint_root(spark, allow_local_fallback=True)
    return TableStore(spark, root=f"{root}/query-{uuid.uuid4().hex}")


# ---------------------------------------------------------------------------
# Tables: commits, as-of reads, added columns
# ---------------------------------------------------------------------------
# Four commits of the daily quality rows: last day of each and commit time.
# The third holds no row.
_COMMITS = (("2024-01-10", "2024-02-01 00:00:00"), ("2024-01-20", "2024-02-02 00:00:00"),
            ("2024-01-20", "2024-02-02 12:00:00"), ("9999-12-31", "2024-02-03 00:00:00"))
_COMMITS_SQL = O.with_checked(f"""
SELECT CAST(batch_date AS TIMESTAMP) AS check_timestamp, records_checked, records_valid, records_invalid,
       quarantine_rate, CASE {' '.join(f"WHEN batch_date <= DATE '{d}' THEN {n}" for n, (d, _) in enumerate(_COMMITS))} END AS n
FROM ({_DAILY})""")


def _quality_table(spark, sf_dir) -> TableStore:
    """order_quality with the daily rows in four commits; the last one
    also fills a column added before it."""
    store = _fresh_store(spark)
    daily = quality_metrics_daily(spark, sf_dir).withColumn("check_timestamp", F.col("batch_date").cast("timestamp"))
    rows = conform(daily, S.ORDER_QUALITY_SCHEMA).persist()
    day, first = F.to_date("check_timestamp"), "0001-01-01"
    for n, (last, at) in enumerate(_COMMITS):
        part = rows.filter((day > F.lit(first).cast("date")) & (day <= F.lit(last).cast("date")))
        if n == len(_COMMITS) - 1:
            store.add_column("order_quality", "checked_by", "string")
            part = part.withColumn("checked_by", F.lit("v2"))
        store.write("order_quality", part, "quality", n, committed_at=at)
        first = last
    rows.unpersist()
    return store


def _ntz(df: DataFrame, *columns) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@register("table_as_of", "SELECT check_timestamp, records_checked, records_valid, records_invalid, quarantine_rate "
                         f"FROM ({_COMMITS_SQL}) WHERE n <= 1")
def table_as_of(spark, sf_dir):
    """O-60: the daily quality table as it was when its second commit was made."""
    old = _quality_table(spark, sf_dir).read_as_of("order_quality", commit="quality-000000000001")
    return _ntz(old, "check_timestamp").select("check_timestamp", "records_checked", "records_valid",
                                               "records_invalid", "quarantine_rate")


@register("table_commits", f"""
SELECT 'quality-' || lpad(CAST(c.n AS VARCHAR), 12, '0') AS "commit", c.committed_at, count(r.n) AS "rows"
FROM (VALUES {', '.join(f"({n}, TIMESTAMP '{at}')" for n, (_, at) in enumerate(_COMMITS))}) c(n, committed_at)
LEFT JOIN ({_COMMITS_SQL}) r ON r.n = c.n GROUP BY c.n, c.committed_at""")
def table_commits(spark, sf_dir):
    """O-61: commits of the daily quality table, the empty one included."""
    return _ntz(_quality_table(spark, sf_dir).snapshots("order_quality"), "committed_at")


@register("table_added_column", "SELECT check_timestamp, records_checked, CASE WHEN n = 3 THEN 'v2' END AS checked_by "
                                f"FROM ({_COMMITS_SQL})")
def table_added_column(spark, sf_dir):
    """O-64: a column added before the last commit; older rows read NULL."""
    return _ntz(_quality_table(spark, sf_dir).read("order_quality"), "check_timestamp").select(
        "check_timestamp", "records_checked", "checked_by")


@register(
    "raw_events_table",
    O.with_valid("""
SELECT event_id, event_type, order_id, customer_id, event_timestamp, total_amount AS payload_total_amount,
       shipping_city, shipping_province, payment_method, order_status, revenue_bucket, item_count,
       order_hour, order_day_of_week, is_weekend
FROM valid"""),
)
def raw_events_table(spark, sf_dir):
    """O-03: enriched events in the order_events sink shape (payload kept as
    JSON text; its total read back to check the round trip)."""
    from orderlens.tables.sinks import order_events_rows

    rows = order_events_rows(B.valid_enriched(spark, sf_dir))
    return rows.select(
        "event_id", "event_type", "order_id", "customer_id", "event_timestamp",
        F.get_json_object("payload", "$.total_amount").cast("double").alias("payload_total_amount"),
        "shipping_city", "shipping_province", "payment_method", "order_status", "revenue_bucket", "item_count",
        "order_hour", "order_day_of_week", "is_weekend",
    )


# ---------------------------------------------------------------------------
# Streaming path
# ---------------------------------------------------------------------------
def _stream_metrics_sql() -> str:
    closed = """
valid_parsed AS (SELECT * FROM (SELECT *, {reason} AS r FROM parsed)
                 WHERE r = 'valid' AND customer_id IS NOT NULL AND event_timestamp IS NOT NULL),  -- what order_events cannot store is quarantined
bound AS (SELECT max(event_timestamp) - INTERVAL 10 MINUTE AS wm FROM valid_parsed)""".format(reason=O.REASON_SQL)
    return O.with_parsed("""
SELECT * FROM (
  SELECT time_bucket(INTERVAL '1 hour', event_timestamp, TIMESTAMP '1970-01-01') AS window_start,
         time_bucket(INTERVAL '1 hour', event_timestamp, TIMESTAMP '1970-01-01') + INTERVAL '1 hour' AS window_end,
         shipping_province AS region,
         count(*) AS event_count,
         count(DISTINCT order_id) AS order_count,
         round(sum(CASE WHEN event_type = 'order_created' THEN total_amount ELSE 0 END), 2) AS total_revenue,
         round(avg(CASE WHEN event_type = 'order_created' THEN total_amount END), 4) AS avg_order_value,
         count(DISTINCT CASE WHEN event_type = 'order_created' THEN customer_id END) AS unique_customers,
         CAST(sum(CASE WHEN event_type = 'order_cancelled' THEN 1 ELSE 0 END) AS BIGINT) AS cancelled_count,
         round(sum(CASE WHEN event_type = 'order_cancelled' THEN 1 ELSE 0 END) / count(*), 4) AS cancellation_rate
  FROM valid_parsed GROUP BY 1, 2, 3
) WHERE window_end <= (SELECT wm FROM bound)""", closed)


def _streamed(spark, sf_dir, **settings) -> TableStore:
    """The tables after a stream over the raw messages is drained, in a fresh
    folder under the shared checkpoint root. The files are as Spark wrote them,
    in any order of event time."""
    from orderlens.sources.raw import read_raw_files
    from orderlens.streaming.jobs import OrderStreams, StreamSettings

    root = f"{checkpoint_root(spark, allow_local_fallback=True)}/stream-query-{uuid.uuid4().hex}"
    files = T.write_raw_files(spark, sf_dir, f"{root}/raw")
    per_trigger = settings.pop("files", None)
    settings = StreamSettings(trigger={"availableNow": True}, check_kwargs=dict(B.CHECK_ARGS), detected_at=B.AS_OF, **settings)
    store = TableStore(spark, root=f"{root}/tables")
    jobs = OrderStreams(spark, read_raw_files(spark, files, max_files_per_trigger=per_trigger), store,
                        settings, checkpoint_dir=f"{root}/streams")
    jobs.start()
    jobs.await_termination()
    return store


@register("stream_order_metrics", _stream_metrics_sql())
def stream_order_metrics(spark, sf_dir):
    """O-70..O-77 end to end: the raw messages read as a stream
    (availableNow), parsed, checked, enriched, watermarked and aggregated with
    the chained exact distinct counts; the hourly windows the stream emitted,
    read back from its order_metrics table. All files come in one micro-batch,
    so none is late whatever its place in time; late data is tested apart."""
    store = _streamed(spark, sf_dir, tumbling="1 hour", outputs=("metrics",))
    m = store.read("order_metrics").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        *W.METRIC_COLUMNS,
    )
    return _round(m, money=["total_revenue"], ratios=["avg_order_value"])


@register("stream_lifecycle", O.with_streamed(f"""
SELECT event_id, order_id, event_type, event_timestamp,
  last_value(shipping_province IGNORE NULLS) OVER w AS shipping_province,
  last_value(shipping_city IGNORE NULLS) OVER w AS shipping_city,
  last_value(payment_method IGNORE NULLS) OVER w AS payment_method, previous_status,
  CASE WHEN previous_status IS NULL AND event_type <> 'order_created' THEN 'first_event_not_created'
       WHEN (previous_status = 'created' AND event_type NOT IN ('order_item_added', 'order_confirmed', 'order_cancelled'))
         OR (previous_status = 'confirmed' AND event_type NOT IN ('order_shipped', 'order_cancelled'))
         OR (previous_status = 'shipped' AND event_type NOT IN ('order_delivered'))
         OR previous_status IN ('delivered', 'cancelled') THEN 'transition_not_allowed' END AS violation
FROM (
  SELECT *, last_value(status IGNORE NULLS) OVER (PARTITION BY order_id ORDER BY event_timestamp, kafka_offset
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_status
  FROM (SELECT *, {O.STATUS_SQL} AS status FROM streamed)
)
WINDOW w AS (PARTITION BY order_id ORDER BY event_timestamp, kafka_offset ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def stream_lifecycle(spark, sf_dir):
    """O-41 and O-42 on a stream: keyed state per order fills regions and
    judges transitions over several micro-batches of files in any order."""
    from orderlens.streaming.lifecycle import lifecycle_events

    store = _streamed(spark, sf_dir, outputs=("lifecycle",), files=4)
    return _ntz(lifecycle_events(store), "event_timestamp").select(
        "event_id", "order_id", "event_type", "event_timestamp", "shipping_province", "shipping_city", "payment_method",
        "previous_status", "violation")


@register("stream_order_state", O.with_streamed(f"""
SELECT order_id,
       arg_max(status, event_timestamp) FILTER (WHERE status IS NOT NULL) AS current_status,
       round(arg_max(total_amount, event_timestamp), 2) AS last_total,
       arg_max_null(customer_id, event_timestamp) AS customer_id,
       min(event_timestamp) AS first_event_time, max(event_timestamp) AS last_event_time,
       count(*) AS event_count
FROM (SELECT *, {O.STATUS_SQL} AS status FROM streamed) GROUP BY order_id"""))
def stream_order_state(spark, sf_dir):
    """O-40 on a stream: the last state that the update-mode aggregation
    wrote of every order, over several micro-batches."""
    from orderlens.streaming.lifecycle import live_order_state

    store = _streamed(spark, sf_dir, outputs=("order_state",), files=4)
    return _round(_ntz(live_order_state(store), "first_event_time", "last_event_time"), money=["last_total"])
