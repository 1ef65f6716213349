"""Late data (O-72): events that came after their window had closed.

The raw side keeps every event, the windows drop late ones inside the stateful
operator, where no row can be looked at. Both sides are tables, so what was
dropped follows from them: of a closed window, order_events holds all events
and order_metrics says how many were counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.tables.store import COMMIT_COLUMN, HOUR_COLUMN, TableStore


def late_counts(store: TableStore, width: str, since_hour: str | None = None) -> DataFrame:
    """(window_start, window_end, region, kept, counted, late) of every closed
    window that lost events: kept = counted + late.

    Windows up to the newest one that order_metrics holds are closed. A window
    of which every event was late is not in order_metrics at all. ``width`` is
    that of the tumbling stream; ``since_hour`` ('yyyy-MM-dd-HH') prunes both
    tables. Counts are pre-aggregated before they are joined."""
    events, metrics = store.read("order_events"), store.read("order_metrics")
    if since_hour is not None:
        events, metrics = events.filter(F.col(HOUR_COLUMN) >= since_hour), metrics.filter(F.col(HOUR_COLUMN) >= since_hour)
    kept = events.groupBy(F.window("event_timestamp", width).alias("window"), F.col("shipping_province").alias("region")).agg(
        F.count(F.lit(1)).alias("n"))
    both = kept.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "region",
                       F.col("n").alias("kept"), F.lit(0).cast("long").alias("counted"))
    both = both.unionByName(metrics.select("window_start", "window_end", "region", F.lit(0).cast("long").alias("kept"),
                                           F.col("event_count").alias("counted")))
    sums = both.groupBy("window_start", "window_end", "region").agg(F.sum("kept").alias("kept"), F.sum("counted").alias("counted"))
    newest = metrics.agg(F.max("window_end").cast("string")).first()[0]  # one value
    closed = F.col("window_end") <= F.lit(newest).cast("timestamp")
    return sums.withColumn("late", F.col("kept") - F.col("counted")).filter(closed & (F.col("late") > 0))


def late_events(store: TableStore, width: str, since_hour: str | None = None) -> DataFrame:
    """The order_events rows that their window did not count: of each window
    in ``late_counts`` as many as it lost, the last to arrive (by commit; in
    one micro-batch by event id). Only windows that lost events are ordered."""
    lost = late_counts(store, width, since_hour).select("window_start", "region", "late")
    events = store.read("order_events")
    if since_hour is not None:
        events = events.filter(F.col(HOUR_COLUMN) >= since_hour)
    rows = events.withColumns({"window_start": F.window("event_timestamp", width)["start"], "region": F.col("shipping_province")})
    arrival = Window.partitionBy("window_start", "region").orderBy(F.col(COMMIT_COLUMN).desc(), F.col("event_id").desc())
    found = rows.join(lost.select(F.col("window_start").alias("_start"), F.col("region").alias("_region"), "late"),
                      (F.col("window_start") == F.col("_start")) & F.col("region").eqNullSafe(F.col("_region")))
    return found.withColumn("_place", F.row_number().over(arrival)).filter("_place <= late").drop("_place", "_start", "_region", "late")
