"""Monitoring queries computed on Spark from order events (O-50..O-57).

Each is an aggregate over event time relative to an ``as_of`` instant, so
the same numbers a live dashboard shows can be recomputed for any moment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens import schemas as S
from orderlens.functions.columns import as_of_column, epoch_micros, interval_seconds, timestamp_type_of
from orderlens.operators.lifecycle import current_order_state, is_active


def _created():
    return F.col("event_type") == "order_created"


def _cancelled():
    return F.col("event_type") == "order_cancelled"


def _total():
    return F.col("payload.total_amount")


def latency_ms(processing: str = "processing_time", ts: str = "event_timestamp"):
    return (epoch_micros(processing) - epoch_micros(ts)) / 1000.0


def kpis(df: DataFrame, as_of=None, ts: str = "event_timestamp", rate_window_s: int = 60,
         total_window_s: int = 3600) -> DataFrame:
    """One row of headline numbers at ``as_of``:
    events_per_second = events in the last minute / max(elapsed, 1), where
    elapsed is as_of minus the first of those events (60 with one event);
    orders / revenue / cancellations in the last hour and
    cancellation_rate = round(cancellations / orders, 4) (0 without orders;
    orders are the denominator here, unlike the window metrics);
    total_events_processed in the last hour; active_orders (replayed status
    not terminal); avg_processing_latency_ms of the latest event of the last
    hour. Only the order states read further back than that hour.

    Two aggregations (the event counters, and order states) each end in one
    row; they are combined by a union and a one-row merge, not a join.
    """
    ref = as_of_column(as_of, like=timestamp_type_of(df, ts))
    upto = df.filter(F.col(ts) <= ref)
    ref_us = epoch_micros(ref)
    t_us = epoch_micros(ts)
    in_min = t_us >= ref_us - rate_window_s * 1_000_000
    in_hour = t_us >= ref_us - total_window_s * 1_000_000
    has_latency = "processing_time" in df.columns
    recent = upto.filter(F.col(ts) >= ref - F.expr(f"INTERVAL {int(total_window_s)} SECONDS"))
    counters = recent.agg(
        F.count_if(in_min).alias("_n_min"),
        F.min(F.when(in_min, t_us)).alias("_first_min_us"),
        F.count_if(in_hour & _created()).alias("orders_last_hour"),
        F.sum(F.when(in_hour & _created(), _total())).alias("revenue_last_hour"),
        F.count_if(in_hour & _cancelled()).alias("cancellations_last_hour"),
        F.count_if(in_hour).alias("total_events_processed"),
        (F.max_by(latency_ms(), F.struct("processing_time", ts)) if has_latency else F.lit(None).cast("double"))
        .alias("avg_processing_latency_ms"),
        F.max(ref_us).alias("_ref_us"),
    )
    elapsed = F.when(F.col("_n_min") > 1, (F.col("_ref_us") - F.col("_first_min_us")) / 1e6).otherwise(
        F.lit(float(rate_window_s))
    )
    counters = counters.select(
        F.when(F.col("_n_min") == 0, F.lit(0.0))
        .otherwise(F.col("_n_min") / F.greatest(elapsed, F.lit(1.0)))
        .alias("events_per_second"),
        "orders_last_hour",
        F.coalesce(F.col("revenue_last_hour"), F.lit(0.0)).alias("revenue_last_hour"),
        F.when(F.col("orders_last_hour") > 0,
               F.round(F.col("cancellations_last_hour") / F.col("orders_last_hour"), 4))
        .otherwise(F.lit(0.0)).alias("cancellation_rate"),
        "total_events_processed",
        "avg_processing_latency_ms",
        F.lit(None).cast("long").alias("active_orders"),
    )
    states = current_order_state(upto, ts=ts).agg(F.count_if(is_active()).alias("active_orders"))
    states = states.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in counters.schema.fields
                             if f.name != "active_orders"], "active_orders")
    merged = counters.unionByName(states)
    return merged.agg(*[F.max(c).alias(c) for c in counters.columns])


def kpis_by_hour(df: DataFrame, window: str = "1 hour", ts: str = "event_timestamp") -> DataFrame:
    """The last-hour KPIs evaluated at every hour boundary (tumbling hours):
    orders, revenue, cancellations and cancellation_rate per orders."""
    agg = df.groupBy(F.window(ts, window).alias("window")).agg(
        F.count_if(_created()).alias("orders"),
        F.sum(F.when(_created(), _total())).alias("revenue"),
        F.count_if(_cancelled()).alias("cancellations"),
    )
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "orders",
        F.coalesce(F.col("revenue"), F.lit(0.0)).alias("revenue"),
        "cancellations",
        F.when(F.col("orders") > 0, F.round(F.col("cancellations") / F.col("orders"), 4))
        .otherwise(F.lit(0.0))
        .alias("cancellation_rate"),
    )


def kpi_alerts(kpi_rows: DataFrame, threshold: float = S.KPI_CANCELLATION_ALERT_RATE) -> DataFrame:
    """O-57: KPI rows whose cancellation rate is above the threshold."""
    return kpi_rows.filter(F.col("cancellation_rate") > threshold).withColumn(
        "alert", F.lit("high_cancellation_rate")
    )


def revenue_trend(df: DataFrame, as_of=None, bucket: str = "5 minutes", buckets: int = 60,
                  ts: str = "event_timestamp") -> DataFrame:
    """O-51: revenue and order count of order_created events per bucket,
    for the last ``buckets`` buckets, of which the one that holds as_of is
    counted up to it (buckets without orders are absent)."""
    ref = as_of_column(as_of, like=timestamp_type_of(df, ts))
    seconds = interval_seconds(bucket)
    step = seconds * 1_000_000
    last = F.ceil(epoch_micros(ref) / F.lit(step)) * F.lit(step)  # where the bucket of as_of ends
    start = F.timestamp_micros((last - F.lit(buckets * step)).cast("long")).cast(timestamp_type_of(df, ts))
    orders = df.filter(_created() & (F.col(ts) >= start) & (F.col(ts) < ref))
    agg = orders.groupBy(F.window(ts, bucket).alias("window")).agg(
        F.sum(_total()).alias("revenue"), F.count("*").alias("order_count")
    )
    return agg.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      "revenue", "order_count")


def orders_by_region(df: DataFrame, top: int = 15, region_col: str = "shipping_province") -> DataFrame:
    """O-52: order count and revenue per region, top ``top`` by orders
    (ties by region name). Partial aggregation, then a bounded top-k."""
    agg = df.filter(_created() & F.col(region_col).isNotNull()).groupBy(F.col(region_col).alias("region")).agg(
        F.count("*").alias("order_count"), F.sum(_total()).alias("revenue")
    )
    return agg.orderBy(F.desc("order_count"), F.asc("region")).limit(top)


def event_type_distribution(df: DataFrame) -> DataFrame:
    """O-53: events per type."""
    return df.groupBy("event_type").agg(F.count("*").alias("event_count"))


def hourly_pattern(df: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """O-54: average order_created events per hour of day, over the days
    present in the input (a day without orders in an hour counts 0).

    One global aggregate (24 conditional counts and the distinct day count,
    all merged map-side) unpivoted to 24 rows: no window, no join."""
    hour = F.hour(ts)
    counts = [F.count_if(_created() & (hour == h)).alias(f"h{h:02d}") for h in range(24)]
    row = df.agg(F.count_distinct(F.to_date(ts)).alias("days"), *counts)
    long = row.unpivot("days", [f"h{h:02d}" for h in range(24)], "slot", "orders")
    return long.select(
        F.substring("slot", 2, 2).cast("int").alias("hour"),
        "orders",
        "days",
        (F.col("orders") / F.when(F.col("days") > 0, F.col("days"))).alias("avg_orders"),
    )


def recent_events(df: DataFrame, n: int = 100, ts: str = "event_timestamp") -> DataFrame:
    """O-55: the newest ``n`` events (ties by event id). Per-partition top-n
    then a merge of n rows per partition: never a full sort."""
    return df.orderBy(F.desc(ts), F.desc("event_id")).limit(n)


def latency_bands(df: DataFrame, processing: str = "processing_time", ts: str = "event_timestamp") -> DataFrame:
    """O-56: processing latency in ms and its band (ok < 100 <= warn < 300
    <= bad); alert above 300 ms."""
    lat = latency_ms(processing, ts)
    band = F.when(lat < S.LATENCY_WARN_MS, F.lit("ok")).when(lat < S.LATENCY_BAD_MS, F.lit("warn")).otherwise(
        F.lit("bad")
    )
    return df.withColumns({"latency_ms": lat, "latency_band": band, "latency_alert": lat > S.LATENCY_BAD_MS})
