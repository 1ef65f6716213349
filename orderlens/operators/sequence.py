"""Skew-safe per-key sequence helpers.

A window ``PARTITION BY key ORDER BY ts`` sends every row of a key to one
task. When one key can hold a large share of all rows, these helpers split
the key by time bucket first, so the largest unit of work is one key within
one bucket, and join the pieces with a small per-(key, bucket) summary.
Both are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.columns import epoch_micros, interval_seconds


def bucket_of_micros(t: Column, width_us: int) -> Column:
    """floor(t / width) with exact integer arithmetic (t in microseconds)."""
    return ((t - F.pmod(t, F.lit(width_us))) / F.lit(width_us)).cast("long")


def time_bucket(ts: Column | str, width_us: int) -> Column:
    return bucket_of_micros(epoch_micros(ts), width_us)


def count_in_trailing_range(
    df: DataFrame, key: str, ts: str, row_id: str, width: str, out: str = "count_in_range"
) -> DataFrame:
    """For every row: the number of rows of the same key whose time lies in
    [ts - width, ts] (both ends included, ties included) — the result of
    ``count(*) OVER (PARTITION BY key ORDER BY ts RANGE width PRECEDING)``.

    Rows are bucketed by ``width``. The range of a row in bucket b covers
    rows of bucket b up to ts (a running count in bucket b) plus rows of
    bucket b-1 at or after ts - width. The second part comes from a probe
    row placed in bucket b-1: bucket total minus the real rows sorted
    before the probe. Partitions are (key, bucket), so a hot key is spread
    over its buckets; the two partial counts meet in an aggregation by
    ``row_id`` (unique per row).
    """
    width_us = interval_seconds(width) * 1_000_000
    base = df.select(F.col(key).alias("_k"), epoch_micros(ts).alias("_t"), F.col(row_id).alias("_id")).filter(
        F.col("_k").isNotNull() & F.col("_t").isNotNull()
    ).distinct()  # a row delivered again counts once
    base = base.withColumn("_b", bucket_of_micros(F.col("_t"), width_us))
    real = base.select("_k", "_b", "_t", "_id", F.lit(1).alias("_real"))
    probe = base.select(
        "_k", (F.col("_b") - 1).alias("_b"), (F.col("_t") - F.lit(width_us)).alias("_t"), "_id", F.lit(0).alias("_real")
    )
    # One sort serves both frames: ordered by (time, real), the RANGE frame of
    # a real row (its peers share time and real=1) holds every real row at or
    # before its time; the ROWS frame of a probe (probes sort first at equal
    # time) holds exactly the real rows strictly before it.
    part = Window.partitionBy("_k", "_b")
    upto_peers = part.orderBy("_t", "_real").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    strictly_before = part.orderBy("_t", "_real").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = real.unionByName(probe).withColumns(
        {
            "_upto": F.sum("_real").over(upto_peers),
            "_before": F.sum("_real").over(strictly_before),
            "_total": F.sum("_real").over(part),
        }
    )
    part_count = F.when(F.col("_real") == 1, F.col("_upto")).otherwise(F.col("_total") - F.col("_before"))
    counts = both.groupBy("_id").agg(F.sum(part_count).alias(out))
    return df.join(counts, df[row_id] == counts["_id"], "left").drop("_id")


def distinct_in_trailing_range(
    df: DataFrame, key: str, item: str, ts: str, row_id: str, width: str, out: str = "distinct_in_range"
) -> DataFrame:
    """For every row: the number of distinct ``item`` values among the rows of
    the same key whose time lies in [ts - width, ts] (both ends included) —
    ``count(DISTINCT item) OVER (PARTITION BY key ORDER BY ts RANGE width
    PRECEDING)``, which Spark refuses.

    An item counts by its first occurrence in the range, and that is one of
    two kinds. A *fresh* occurrence has none before it within ``width``: it is
    counted wherever it lies in the range. Any other follows its previous one
    at a distance of at most ``width``: it is the first in the range exactly
    if the interval between the two crosses the range's left edge. So the
    count is the fresh occurrences in the range plus the intervals open at its
    left edge, and both are running counts.

    Rows are bucketed by ``width`` as in ``count_in_trailing_range``: the left
    edge lies in the bucket before the row's, and an interval reaches at most
    into the next bucket, where it is carried in. Partitions are (key,
    bucket) and (key, item, bucket); equal times of an item are collapsed
    first. Rows with a NULL key, item or time get NULL.
    """
    width_us = interval_seconds(width) * 1_000_000
    base = df.select(F.col(key).alias("_k"), F.col(item).alias("_o"), epoch_micros(ts).alias("_t"), F.col(row_id).alias("_id")).filter(
        F.col("_k").isNotNull() & F.col("_o").isNotNull() & F.col("_t").isNotNull())
    points = base.select("_k", "_o", "_t", bucket_of_micros(F.col("_t"), width_us).alias("_b")).distinct()
    ends = points.groupBy("_k", "_o", (F.col("_b") + 1).alias("_b")).agg(F.max("_t").alias("_end"))
    before = F.lag("_t").over(Window.partitionBy("_k", "_o", "_b").orderBy("_t"))
    points = points.withColumn("_p", before).join(ends, ["_k", "_o", "_b"], "left")
    points = points.withColumn("_p", F.coalesce("_p", "_end"))
    points = points.withColumn("_near", F.coalesce(F.col("_p") >= F.col("_t") - width_us, F.lit(False)))
    left = bucket_of_micros(F.col("_p"), width_us)
    nothing, one = F.lit(0), F.lit(1)

    def mark(bucket, time, order, fresh, opened):
        """A row of the sweep; at equal times a left edge (0) comes before
        what happens then (1), a range's right edge (2) after it."""
        return F.struct(bucket.alias("_b"), time.alias("_t"), order.alias("_ord"), fresh.alias("_fresh"), opened.alias("_open"))

    happened = F.when(~F.col("_near"), F.array(mark(F.col("_b"), F.col("_t"), one, one, nothing))).otherwise(
        F.filter(F.array(
            mark(left, F.col("_p"), one, nothing, one),
            mark(F.col("_b"), F.col("_t"), one, nothing, F.lit(-1)),
            F.when(left != F.col("_b"), mark(F.col("_b"), F.lit(-(1 << 62)), one, nothing, one)),  # carried in
        ), lambda m: m.isNotNull()))
    sweep = points.select("_k", F.inline(happened)).withColumn("_at", F.lit(None).cast("long"))
    asked = base.select("_k", "_t").distinct().withColumn("_b", bucket_of_micros(F.col("_t"), width_us))
    edges = asked.select("_k", F.col("_t").alias("_at"), F.inline(F.array(
        mark(F.col("_b"), F.col("_t"), F.lit(2), nothing, nothing),
        mark(F.col("_b") - 1, F.col("_t") - width_us, F.lit(0), nothing, nothing))))
    part = Window.partitionBy("_k", "_b")
    upto = part.orderBy("_t", "_ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = sweep.unionByName(edges).withColumns(
        {"_upto": F.sum("_fresh").over(upto), "_opened": F.sum("_open").over(upto), "_total": F.sum("_fresh").over(part)})
    share = F.when(F.col("_ord") == 2, F.col("_upto")).otherwise(F.col("_total") - F.col("_upto") + F.col("_opened"))
    counts = swept.filter("_at is not null").groupBy("_k", "_at").agg(F.sum(share).alias(out))
    each = base.join(counts.withColumnRenamed("_at", "_t"), ["_k", "_t"])
    return df.join(each.select("_id", out).distinct(), df[row_id] == F.col("_id"), "left").drop("_id")


def prior_non_null(
    df: DataFrame,
    key: str,
    order_by: list[str],
    columns: list[str],
    chunk: str = "1 day",
    include_current: bool = False,
    suffix: str = "_prior",
) -> DataFrame:
    """For every row and every column c: the last non-NULL c among the rows
    of the same key ordered before it (``include_current`` also looks at the
    row itself) — ``last(c, ignorenulls) OVER (PARTITION BY key ORDER BY ...
    ROWS UNBOUNDED PRECEDING AND 1 PRECEDING)``, computed in two levels:

    1. within (key, time chunk): a running last-non-NULL;
    2. per (key, chunk): the chunk's last non-NULL value (partial
       aggregation), carried forward across chunks over one row per chunk;
    3. the carry joins back on (key, chunk) and fills what level 1 left NULL.
    ``order_by[0]`` must be the event time.
    """
    width_us = interval_seconds(chunk) * 1_000_000
    ts = order_by[0]
    rows = df.withColumn("_chunk", time_bucket(ts, width_us))
    in_chunk = Window.partitionBy(key, "_chunk").orderBy(*order_by)
    frame = in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow if include_current else -1)
    rows = rows.withColumns({f"_loc_{c}": F.last(c, ignorenulls=True).over(frame) for c in columns})

    ordering = F.struct(*[F.col(c) for c in order_by])
    summary = df.withColumn("_chunk", time_bucket(ts, width_us)).groupBy(key, "_chunk").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordering)).alias(f"_end_{c}") for c in columns]
    )
    across = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        key, "_chunk", *[F.last(f"_end_{c}", ignorenulls=True).over(across).alias(f"_car_{c}") for c in columns]
    )
    joined = rows.join(carry, [key, "_chunk"], "left")
    return joined.withColumns(
        {f"{c}{suffix}": F.coalesce(F.col(f"_loc_{c}"), F.col(f"_car_{c}")) for c in columns}
    ).drop("_chunk", *[f"_loc_{c}" for c in columns], *[f"_car_{c}" for c in columns])
