import datetime as dt
import random

from orderlens.operators import lifecycle as L
from orderlens.operators.enrich import enrich_orders
from orderlens.operators.sequence import count_in_trailing_range, distinct_in_trailing_range, prior_non_null
from tests.helpers import events

T0 = dt.datetime(2024, 1, 1, 23, 0)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_order_lifecycles(spark):
    rows = [
        # o1: full happy path
        *[{"order_id": "o1", "event_type": t, "ts": at(i), "total": 10.0 + i, "event_id": f"o1-{i}"}
          for i, t in enumerate(["order_created", "order_item_added", "order_confirmed", "order_shipped",
                                 "order_delivered"])],
        # o2: created -> cancelled
        {"order_id": "o2", "event_type": "order_created", "ts": at(0), "event_id": "o2-0", "total": 1.0},
        {"order_id": "o2", "event_type": "order_cancelled", "ts": at(1), "event_id": "o2-1", "total": 1.0},
        # o3: shipped without created, then an event after delivered
        {"order_id": "o3", "event_type": "order_shipped", "ts": at(0), "event_id": "o3-0", "total": 1.0},
        {"order_id": "o3", "event_type": "order_delivered", "ts": at(1), "event_id": "o3-1", "total": 1.0},
        {"order_id": "o3", "event_type": "order_confirmed", "ts": at(2), "event_id": "o3-2", "total": 1.0},
        # o4: equal timestamps, broker offset decides; only item_added after created
        {"order_id": "o4", "event_type": "order_created", "ts": at(0), "event_id": "o4-b", "offset": 1, "total": 1.0},
        {"order_id": "o4", "event_type": "order_item_added", "ts": at(0), "event_id": "o4-a", "offset": 2, "total": 2.0},
    ]
    df = events(spark, rows)
    state = {r.order_id: r for r in L.current_order_state(df).collect()}
    assert state["o1"].current_status == "delivered" and state["o1"].last_total == 14.0
    assert state["o1"].event_count == 5 and state["o1"].first_event_time == at(0)
    assert state["o2"].current_status == "cancelled"
    assert state["o3"].current_status == "confirmed"
    assert state["o4"].current_status == "created" and state["o4"].last_total == 2.0
    active = L.active_orders(df).first()
    assert (active.active_orders, active.total_orders) == (2, 4)
    assert L.active_orders(df, as_of=at(0)).first().active_orders == 4  # replay up to a past instant

    bad = {(r.event_id, r.previous_status, r.violation) for r in L.illegal_transitions(df, chunk="1 hour").collect()}
    assert bad == {("o3-0", None, "first_event_not_created"), ("o3-2", "delivered", "transition_not_allowed")}


def test_backfill_region(spark):
    rows = [
        {"order_id": "o1", "event_type": "order_created", "ts": at(0), "province": "P", "city": "C", "payment": "bizum"},
        {"order_id": "o1", "event_type": "order_shipped", "ts": at(90)},  # crosses an hour chunk
        {"order_id": "o1", "event_type": "order_confirmed", "ts": at(100), "province": "Q", "city": "D"},
        {"order_id": "o1", "event_type": "order_delivered", "ts": at(200)},
        {"order_id": "o2", "event_type": "order_shipped", "ts": at(5)},
    ]
    out = L.backfill_region(enrich_orders(events(spark, rows)), chunk="1 hour")
    got = sorted(((r.order_id, r.event_timestamp, r.shipping_province, r.payment_method) for r in out.collect()),
                 key=repr)
    assert got == [
        ("o1", at(0), "P", "bizum"), ("o1", at(90), "P", "bizum"), ("o1", at(100), "Q", "bizum"),
        ("o1", at(200), "Q", "bizum"), ("o2", at(5), None, None),
    ]


def test_helpers_match_brute_force_with_hot_key(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(800):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(15)}"
        t = T0 + dt.timedelta(seconds=rnd.randrange(0, 4 * 86400))
        val = rnd.choice([None, None, "a", "b", "c"])
        rows.append((f"r{i:04d}", key, t, val, i))
    df = spark.createDataFrame(rows, "rid string, k string, t timestamp, v string, off long")

    # prior_non_null vs brute force
    got = {r.rid: r.v_prior for r in prior_non_null(df, "k", ["t", "off"], ["v"], chunk="1 day").collect()}
    for rid, k, t, v, off in rows:
        earlier = sorted((o[2], o[4], o[3]) for o in rows if o[1] == k and (o[2], o[4]) < (t, off) and o[3] is not None)
        assert got[rid] == (earlier[-1][2] if earlier else None), rid

    # count_in_trailing_range vs brute force
    counts = {r.rid: r.count_in_range for r in count_in_trailing_range(df, "k", "t", "rid", "2 hours").collect()}
    for rid, k, t, v, off in rows:
        exp = sum(1 for o in rows if o[1] == k and 0 <= (t - o[2]).total_seconds() <= 7200)
        assert counts[rid] == exp, rid


def test_distinct_items_in_a_trailing_range(spark):
    """Against a count of every pair: items that occur again and again, ties,
    a hot key, gaps of exactly the width, NULLs."""
    rnd = random.Random(8)
    rows = []
    for i in range(700):
        key = rnd.choice(["hot", "hot", "k1", "k2", None])
        t = T0 + dt.timedelta(minutes=rnd.choice([rnd.randrange(0, 600), 60 * rnd.randrange(0, 10)]))
        rows.append((f"r{i}", key, rnd.choice([None, *(f"o{k}" for k in range(9))]), None if i % 50 == 7 else t))
    df = spark.createDataFrame(rows, "rid string, k string, o string, t timestamp").repartition(3)
    for minutes in (1, 5, 60, 240):
        got = {r.rid: r.n for r in distinct_in_trailing_range(df, "k", "o", "t", "rid", f"{minutes} minutes", out="n").collect()}
        assert len(got) == len(rows)
        for rid, k, o, t in rows:
            known = k is not None and o is not None and t is not None
            want = len({p for _, q, p, u in rows if q == k and p is not None and u is not None
                        and dt.timedelta(0) <= t - u <= dt.timedelta(minutes=minutes)}) if known else None
            assert got[rid] == want, (rid, minutes)


def test_rapid_fire_counts_orders_not_events(spark):
    from orderlens.operators.anomalies import rapid_fire

    rows = [{"event_id": f"e{i}", "order_id": f"o{i % 3}", "customer_id": "c1", "ts": T0 + dt.timedelta(seconds=i), "total": 1.0}
            for i in range(9)]  # three orders, each created three times
    assert rapid_fire(events(spark, rows), n=5).count() == 0
    assert {r.orders_in_window for r in rapid_fire(events(spark, rows), n=2).collect()} == {3}
