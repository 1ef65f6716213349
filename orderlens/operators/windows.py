"""Windowed order metrics: tumbling (O-30), sliding (O-31), sink shape (O-04)
and distinct counts that a stream accepts (O-77).

Everything is built from *panes*: the widest slices that every window is made
of (for 5 minutes sliding by 2, one minute). Events are grouped once, into
partials per (pane, region, order) and (pane, region, customer). A window
combines the partials of its panes, so sliding multiplies partials, not
events; a tumbling window is one pane. The distinct counts are then plain
counts over (window, region): every level carries sums and counts only (never
an average or a collected set), so every level is pre-aggregated on the map
side, a hot region never lies whole in one task, and the same plan runs on a
stream, which refuses ``count_distinct``.

``approx=True`` keeps one row per (pane, region) instead, with a mergeable
sketch for each distinct count: state that does not grow with orders or
customers, for wide windows. At ``SKETCH_BITS`` = 12 the standard error of a
count is about 1.6 %.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.columns import interval_seconds

SKETCH_BITS = 12


def pane_of(width: str, slide: str | None = None) -> str:
    """Width of the panes of windows of ``width`` sliding by ``slide``."""
    return f"{math.gcd(interval_seconds(width), interval_seconds(slide or width))} seconds"


def _facts(df: DataFrame, region_col: str, ts: str) -> DataFrame:
    """What the metrics need of an event, named once."""
    created = F.col("event_type") == "order_created"
    return df.select(
        F.col(ts).alias("at"), F.col(region_col).alias("region"), F.col("order_id").alias("order"),
        F.when(created, F.col("customer_id")).alias("buyer"),
        F.when(created, F.col("payload.total_amount")).alias("sale"),
        (F.col("event_type") == "order_cancelled").cast("int").alias("cancelled"))


def _sums() -> dict[str, Column]:
    """A partial's sums, each of what an event adds; combining panes adds them up."""
    return {"events": F.lit(1), "cancellations": F.coalesce("cancelled", F.lit(0)), "sales": F.col("sale"),
            "n_sales": F.col("sale").isNotNull().cast("int")}


def _entity_panes(facts: DataFrame, pane: str) -> DataFrame:
    """One partial per (pane, region, order) with the sums, and one per (pane,
    region, customer of a created order) with none: each distinct count has
    rows of its own, so an order whose events name several customers, or no
    one, counts once."""
    whose = F.inline(F.array(F.struct(F.lit(True).alias("by_order"), F.col("order").alias("entity")),
                             F.struct(F.lit(False).alias("by_order"), F.col("buyer").alias("entity"))))
    rows = facts.select("*", whose).filter("by_order OR entity IS NOT NULL")
    return rows.groupBy(F.window("at", pane).alias("window"), "region", "by_order", "entity").agg(
        *[F.sum(F.when(F.col("by_order"), c)).alias(name) for name, c in _sums().items()])


def _sketch_panes(facts: DataFrame, pane: str) -> DataFrame:
    """One partial per (pane, region): the sums and two sketches."""
    return facts.groupBy(F.window("at", pane).alias("window"), "region").agg(
        *[F.sum(c).alias(name) for name, c in _sums().items()],
        F.hll_sketch_agg("order", SKETCH_BITS).alias("orders"), F.hll_sketch_agg("buyer", SKETCH_BITS).alias("buyers"))


def _combined(panes: DataFrame, pane: str, width: str, slide: str | None, keys: list[str], more: list[Column]) -> DataFrame:
    """Panes -> windows, where a window is more than one pane."""
    if interval_seconds(pane) == interval_seconds(width):
        return panes
    windows = F.window(F.window_time("window"), width, slide or width).alias("window")
    return panes.groupBy(windows, *keys).agg(*[F.sum(name).alias(name) for name in _sums()], *more)


def window_facts(df: DataFrame, width: str, slide: str | None = None, ts: str = "event_timestamp",
                 region_col: str = "shipping_province", approx: bool = False, pane: str | None = None) -> DataFrame:
    """Per (window, region): events, cancellations, sales, n_sales, and the
    distinct orders and buyers. ``pane`` (a divisor of width and slide) sets
    the panes that are merged; without it they are as wide as can be."""
    facts, pane = _facts(df, region_col, ts), pane or pane_of(width, slide)
    if interval_seconds(pane_of(width, slide)) % interval_seconds(pane):
        raise ValueError(f"windows of {width} sliding by {slide or width} are not made of panes of {pane}")
    if approx:
        merged = _combined(_sketch_panes(facts, pane), pane, width, slide, ["region"],
                           [F.hll_union_agg(c).alias(c) for c in ("orders", "buyers")])
        return merged.withColumns({c: F.hll_sketch_estimate(c) for c in ("orders", "buyers")})
    partials = _combined(_entity_panes(facts, pane), pane, width, slide, ["region", "by_order", "entity"], [])
    return partials.groupBy("window", "region").agg(
        *[F.sum(name).alias(name) for name in _sums()],
        F.count(F.when(F.col("by_order"), F.col("entity"))).alias("orders"),
        F.count(F.when(~F.col("by_order"), F.col("entity"))).alias("buyers"))


def _revenue() -> Column:
    return F.coalesce("sales", F.lit(0.0))


def tumbling_metrics(df: DataFrame, window: str = "1 minute", ts: str = "event_timestamp",
                     region_col: str = "shipping_province", approx: bool = False, pane: str | None = None) -> DataFrame:
    """O-30 per (window, region): event_count, order_count (distinct orders,
    any type), total_revenue (order_created totals), avg_order_value (NULL
    without orders), unique_customers (distinct ordering customers),
    cancelled_count, cancellation_rate = round(cancelled / events, 4). In
    batch and, with a watermark, on a stream."""
    return window_facts(df, window, None, ts, region_col, approx, pane).select(
        "window", "region", F.col("events").alias("event_count"), F.col("orders").alias("order_count"),
        _revenue().alias("total_revenue"), F.try_divide("sales", "n_sales").alias("avg_order_value"),
        F.col("buyers").alias("unique_customers"), F.col("cancellations").alias("cancelled_count"),
        F.round(F.col("cancellations") / F.col("events"), 4).alias("cancellation_rate"))


def sliding_metrics(df: DataFrame, window: str = "5 minutes", slide: str = "2 minutes", ts: str = "event_timestamp",
                    region_col: str = "shipping_province", approx: bool = False) -> DataFrame:
    """O-31 per (sliding window, region); each event counts in every window
    that contains it (2 or 3 for 5 min / 2 min)."""
    return window_facts(df, window, slide, ts, region_col, approx).select(
        "window", "region", F.col("orders").alias("sliding_order_count"), _revenue().alias("sliding_total_revenue"),
        F.try_divide("sales", "n_sales").alias("sliding_avg_order_value"), F.col("buyers").alias("sliding_unique_customers"))


# ---------------------------------------------------------------------------
# O-04 sink shape
# ---------------------------------------------------------------------------
METRIC_COLUMNS = (
    "region", "event_count", "order_count", "total_revenue", "avg_order_value",
    "unique_customers", "cancelled_count", "cancellation_rate",
)
SLIDING_COLUMNS = (
    "region", "sliding_order_count", "sliding_total_revenue", "sliding_avg_order_value", "sliding_unique_customers",
)


def flatten_window(df: DataFrame, columns=METRIC_COLUMNS, window_col: str = "window") -> DataFrame:
    """window struct -> window_start / window_end + the metric columns."""
    return df.select(
        F.col(f"{window_col}.start").alias("window_start"),
        F.col(f"{window_col}.end").alias("window_end"),
        *columns,
    )


def metrics_rows(metrics: DataFrame) -> DataFrame:
    return flatten_window(metrics, METRIC_COLUMNS)


def sliding_rows(metrics: DataFrame) -> DataFrame:
    return flatten_window(metrics, SLIDING_COLUMNS)
