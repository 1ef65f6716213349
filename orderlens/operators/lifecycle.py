"""Event-sourced order state: current state (O-40), region backfill (O-41),
illegal transitions (O-42), active orders (O-43)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens import schemas as S
from orderlens.functions.columns import as_of_column, lifecycle_status, timestamp_type_of
from orderlens.operators.sequence import prior_non_null


def event_order(df: DataFrame, ts: str = "event_timestamp") -> list[str]:
    """Replay order of an order's events: time, then broker offset (one
    order's messages share a partition), then event id."""
    return [c for c in (ts, "kafka_offset", "event_id") if c in df.columns]


def _ordering(df: DataFrame, ts: str) -> Column:
    return F.struct(*[F.col(c) for c in event_order(df, ts)])


def current_order_state(df: DataFrame, as_of=None, ts: str = "event_timestamp") -> DataFrame:
    """Per order: status after replaying its events (order_item_added
    leaves it unchanged), last total, customer, first/last event time and
    event count. One aggregation with partial (map-side) merge; no sort of
    an order's events. ``as_of`` replays only events at or before it."""
    if as_of is not None:
        df = df.filter(F.col(ts) <= as_of_column(as_of, like=timestamp_type_of(df, ts)))
    order = _ordering(df, ts)
    status = lifecycle_status("event_type")
    return df.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        F.max_by(status, F.when(status.isNotNull(), order)).alias("current_status"),
        F.max_by(F.col("payload.total_amount"), order).alias("last_total"),
        F.max_by(F.col("customer_id"), order).alias("customer_id"),
        F.min(ts).alias("first_event_time"),
        F.max(ts).alias("last_event_time"),
        F.count("*").alias("event_count"),
    )


def is_active(status: Column | str = "current_status") -> Column:
    s = F.col(status) if isinstance(status, str) else status
    return ~F.coalesce(s.isin(*S.TERMINAL_STATUSES), F.lit(False))


def active_orders(df: DataFrame, as_of=None, ts: str = "event_timestamp") -> DataFrame:
    """One row: orders whose replayed status is not delivered/cancelled."""
    state = current_order_state(df, as_of=as_of, ts=ts)
    return state.agg(
        F.count_if(is_active()).alias("active_orders"),
        F.count("*").alias("total_orders"),
    )


def backfill_region(df: DataFrame, chunk: str = "1 day", ts: str = "event_timestamp") -> DataFrame:
    """Fill NULL shipping province / city / payment method from the order's
    latest earlier event that carries one (opt-in: the reference leaves them
    NULL on shipped/delivered/cancelled events). Enriched input."""
    cols = ["shipping_province", "shipping_city", "payment_method"]
    filled = prior_non_null(df, "order_id", event_order(df, ts), cols, chunk=chunk, include_current=True,
                            suffix="_filled")
    for c in cols:
        filled = filled.withColumn(c, F.col(f"{c}_filled")).drop(f"{c}_filled")
    return filled


def illegal_transitions(df: DataFrame, chunk: str = "1 day", ts: str = "event_timestamp", keep_legal: bool = False) -> DataFrame:
    """Events not allowed after the order's previous status: the first event
    of an order must be order_created; then created -> item_added /
    confirmed / cancelled; confirmed -> shipped / cancelled; shipped ->
    delivered; delivered and cancelled are terminal. The previous status is
    the last non-NULL status before the event (item_added has none).
    Events without an order id belong to no order and are left out.
    ``keep_legal`` keeps the allowed events too, with a NULL violation."""
    with_status = df.filter(F.col("order_id").isNotNull()).withColumn("_status", lifecycle_status("event_type"))
    prior = prior_non_null(with_status, "order_id", event_order(df, ts), ["_status"], chunk=chunk)
    prev = F.col("_status_prior")
    allowed = None
    for status, nxt in S.ALLOWED_TRANSITIONS.items():
        ok = F.col("event_type").isin(*nxt) if nxt else F.lit(False)
        allowed = (F.when if allowed is None else allowed.when)(prev == status, ok)
    allowed = allowed.otherwise(F.lit(False))
    violation = F.when(prev.isNull() & (F.col("event_type") != "order_created"), F.lit("first_event_not_created")).when(
        prev.isNotNull() & ~allowed, F.lit("transition_not_allowed")
    )
    judged = prior.withColumns({"previous_status": prev, "violation": violation}).drop("_status", "_status_prior")
    return judged if keep_legal else judged.filter(F.col("violation").isNotNull())
