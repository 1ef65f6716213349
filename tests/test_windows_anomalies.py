import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens.operators import anomalies as A
from orderlens.operators import windows as W
from orderlens.operators.enrich import enrich_orders
from orderlens.plans import batch as B
from tests.helpers import events

SF = "/root/testdata/sf0.001"


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_tumbling_boundaries_and_semantics(spark):
    rows = [
        {"event_id": "1", "ts": "2024-01-01 00:00:00", "total": 10.0, "province": "P", "order_id": "o1", "customer_id": "c1"},
        {"event_id": "2", "ts": "2024-01-01 00:00:59.999999", "event_type": "order_confirmed", "total": 10.0,
         "province": "P", "order_id": "o1", "customer_id": "c1"},
        {"event_id": "3", "ts": "2024-01-01 00:01:00", "total": 20.0, "province": "P", "order_id": "o2", "customer_id": "c2"},
        {"event_id": "4", "ts": "2024-01-01 00:00:30", "event_type": "order_cancelled", "total": 9.0,
         "order_id": "o3", "customer_id": "c3"},  # region NULL, only cancellations
    ]
    m = W.metrics_rows(W.tumbling_metrics(enrich_orders(events(spark, rows)), "1 minute"))
    got = {(r.window_start.minute, r.region): r for r in m.collect()}
    first = got[(0, "P")]
    assert (first.event_count, first.order_count, first.total_revenue, first.avg_order_value) == (2, 1, 10.0, 10.0)
    assert (first.unique_customers, first.cancelled_count, first.cancellation_rate) == (1, 0, 0.0)
    assert got[(1, "P")].event_count == 1
    null_region = got[(0, None)]
    assert null_region.avg_order_value is None and null_region.cancellation_rate == 1.0
    assert null_region.total_revenue == 0.0


def test_sliding_membership(spark):
    rows = [{"event_id": "1", "ts": "2024-01-01 00:03:30", "total": 1.0, "province": "P"},
            {"event_id": "2", "ts": "2024-01-01 00:04:30", "total": 1.0, "province": "P"}]
    s = W.sliding_rows(W.sliding_metrics(enrich_orders(events(spark, rows))))
    got = sorted((r.window_start.minute, r.sliding_order_count) for r in s.collect())
    # 00:03:30 lies in the windows starting 00:00 and 00:02 ([23:58, 00:03) ends before it);
    # 00:04:30 in those starting 00:00, 00:02 and 00:04
    assert got == [(0, 2), (2, 2), (4, 1)]


def test_panes_equal_count_distinct(spark):
    """Tumbling and sliding windows, from panes of any width, against Spark's
    own exact distinct counts per window."""
    ev = B.valid_enriched(spark, SF).persist()
    created = F.col("event_type") == "order_created"
    for width, slide in (("1 hour", None), ("1 minute", None), ("5 minutes", "2 minutes"), ("6 hours", "90 minutes")):
        window = F.window("event_timestamp", width, slide) if slide else F.window("event_timestamp", width)
        want = ev.groupBy(window.alias("window"), F.col("shipping_province").alias("region")).agg(
            F.count("*"), F.count_if(F.col("event_type") == "order_cancelled"),
            F.round(F.sum(F.when(created, F.col("payload.total_amount"))), 2), F.count_distinct("order_id"),
            F.count_distinct(F.when(created, F.col("customer_id"))))
        want = sorted(map(repr, (tuple(r) for r in want.collect())))
        for pane in {"1 minute": (None, "10 seconds")}.get(width, (None, "1 minute")):
            got = W.window_facts(ev, width, slide, pane=pane).select(
                "window", "region", "events", "cancellations", F.round("sales", 2), "orders", "buyers")
            assert sorted(map(repr, (tuple(r) for r in got.collect()))) == want, (width, slide, pane)
    ev.unpersist()
    with pytest.raises(ValueError):
        W.window_facts(ev, "5 minutes", "2 minutes", pane="2 minutes")


def test_sketches_stay_within_their_error(spark):
    """Distinct counts by sketches per pane, merged to hours and days; sums
    and counts stay exact."""
    n = 60_000
    ev = spark.range(n).select(
        F.expr("timestamp_seconds(1704067200 + id % 86400)").alias("event_timestamp"), F.lit("order_created").alias("event_type"),
        F.expr("concat('o', id % 50000)").alias("order_id"), F.expr("concat('c', id % 7000)").alias("customer_id"),
        F.lit("P").alias("shipping_province"), F.expr("named_struct('total_amount', 1.0D)").alias("payload"))
    for width, pane in (("1 day", "1 hour"), ("1 day", None), ("6 hours", "1 hour")):
        exact = {r["window"]: r for r in W.window_facts(ev, width).collect()}
        rows = W.window_facts(ev, width, approx=True, pane=pane).collect()
        assert len(rows) == len(exact)
        for r in rows:
            e = exact[r["window"]]
            assert (r["events"], r["sales"], r["n_sales"]) == (e["events"], e["sales"], e["n_sales"])
            for c in ("orders", "buyers"):
                assert abs(r[c] - e[c]) <= 4 * 0.016 * e[c] + 1  # four standard errors
    small = W.tumbling_metrics(ev.filter("1 = 0"), "1 hour", approx=True)
    assert small.count() == 0


def test_large_orders_and_spikes_thresholds(spark):
    rows = [
        {"event_id": "1", "total": 2000.0, "ts": "2024-01-01 00:00:00"},
        {"event_id": "2", "total": 2000.01, "ts": "2024-01-01 00:00:00"},
        {"event_id": "3", "total": 3000.0, "ts": "2024-01-01 00:00:00", "event_type": "order_shipped"},
    ]
    got = [r.event_id for r in A.large_orders(enrich_orders(events(spark, rows))).collect()]
    assert got == ["2"]
    # region A: 3 of 10 cancelled (0.3, not flagged); region B: 31 of 100 (0.31, flagged)
    spike_rows = []
    for region, n, k in (("A", 10, 3), ("B", 100, 31)):
        for i in range(n):
            spike_rows.append({"event_id": f"{region}{i}", "ts": "2024-01-01 00:00:10", "province": region,
                               "event_type": "order_cancelled" if i < k else "order_created", "total": 1.0})
    s = A.cancellation_spikes(enrich_orders(events(spark, spike_rows))).collect()
    assert [(r.region, r.total_events, r.cancelled) for r in s] == [("B", 100, 31)]
    assert abs(s[0].cancel_rate - 0.31) < 1e-12


def _brute_rapid(rows, n, width_s):
    out = set()
    for r in rows:
        c = sum(1 for o in rows if o[1] == r[1] and 0 <= (r[2] - o[2]).total_seconds() <= width_s)
        if c > n:
            out.add((r[0], c))
    return out


def test_rapid_fire_exact_with_hot_customer(spark):
    import random

    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        cust = "hot" if i % 3 == 0 else f"c{rnd.randrange(20)}"
        t = base + dt.timedelta(seconds=rnd.randrange(0, 3 * 3600))
        rows.append((f"e{i:04d}", cust, t))
    # exact boundary: 5 minutes apart, and ties at the same instant
    rows += [("b1", "edge", base), ("b2", "edge", base + dt.timedelta(minutes=5)),
             ("b3", "edge", base + dt.timedelta(minutes=5)), ("b4", "edge", base + dt.timedelta(minutes=10))]
    df = events(spark, [{"event_id": e, "customer_id": c, "ts": t, "total": 1.0} for e, c, t in rows])
    for n, width, width_s in ((5, "5 minutes", 300), (1, "5 minutes", 300), (20, "1 hour", 3600)):
        got = {(r.event_id, r.orders_in_window) for r in A.rapid_fire(df, n=n, window=width).collect()}
        assert got == _brute_rapid(rows, n, width_s)


def test_anomalies_union_shape(spark):
    rows = [{"event_id": "1", "total": 2500.0, "ts": "2024-01-01 00:00:00", "province": "P"},
            {"event_id": "2", "total": 5.0, "ts": "2024-01-01 00:00:00", "event_type": "order_cancelled"}]
    ev = enrich_orders(events(spark, rows))
    out = A.anomalies(large=A.large_orders(ev), spikes=A.cancellation_spikes(ev), detected_at="2024-01-02 00:00:00")
    from orderlens.schemas import ORDER_ANOMALIES_SCHEMA

    assert out.columns == ORDER_ANOMALIES_SCHEMA.fieldNames()
    got = sorted(((r.anomaly_type, r.region, r.total_amount, r.cancel_rate) for r in out.collect()), key=repr)
    assert got == [("cancellation_spike", None, None, 1.0), ("large_order", "P", 2500.0, None)]
