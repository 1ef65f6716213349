"""Keyed stream state: region backfill, transitions and live order state equal
the batch operators, whatever order events arrive in."""

import datetime as dt
import json
import os
import random
import time

import pytest

from orderlens import schemas as S
from orderlens.operators import lifecycle as B
from orderlens.operators.enrich import enrich_orders
from orderlens.sources.raw import read_raw_files
from orderlens.streaming import lifecycle as L
from orderlens.streaming.jobs import OrderStreams, StreamSettings, valid_event_stream
from orderlens.tables.store import TableStore

CHECK = {"as_of": "2024-03-01 00:00:00", "max_age": "120 days"}
T0 = dt.datetime(2024, 1, 1, 10, 0)
TYPES = list(S.STATUS_BY_EVENT)
COLUMNS = ["event_id", "order_id", "shipping_province", "shipping_city", "payment_method"]


def message(i, kind, order, minutes, province=None, payment=None):
    payload = {"total_amount": 5.0 + i, "payment_method": payment}
    if province is not None:
        payload["shipping_address"] = {"province": province, "city": f"{province}-city"}
    body = {"event_id": f"e{i:04d}", "event_type": kind, "order_id": order, "customer_id": f"c{i % 3}",
            "timestamp": (T0 + dt.timedelta(minutes=minutes)).isoformat() + "+00:00", "payload": payload}
    return (order.encode(), json.dumps(body).encode(), "t", 0, i, T0)


class Run:
    """A folder of message files and a stream over it that can go on."""

    def __init__(self, spark, folder, **settings):
        self.spark, self.folder, self.n = spark, folder, 0
        self.store = TableStore(spark, root=os.path.join(folder, "t"))
        self.settings = StreamSettings(trigger={"availableNow": True}, outputs=("lifecycle", "order_state"), check_kwargs=CHECK, **settings)

    def add(self, messages):
        path = os.path.join(self.folder, "src", f"{self.n:03d}")
        self.spark.createDataFrame(messages, S.RAW_SCHEMA).coalesce(1).write.parquet(path)
        self.n += 1

    def drain(self):
        raw = read_raw_files(self.spark, os.path.join(self.folder, "src", "*"), max_files_per_trigger=1)
        jobs = OrderStreams(self.spark, raw, self.store, self.settings, checkpoint_dir=os.path.join(self.folder, "c"))
        jobs.start()
        jobs.await_termination(timeout=120)
        assert not any(q.isActive for q in jobs.queries) and all(q.exception() is None for q in jobs.queries)

    def events(self):
        """Every distinct event so far, enriched, in batch (ordered by time and id, as the stream does)."""
        raw = read_raw_files(self.spark, os.path.join(self.folder, "src", "*"), streaming=False)
        return enrich_orders(valid_event_stream(raw, CHECK)).dropDuplicates(["event_id"]).drop("kafka_offset")

    def check(self):
        """Streamed results equal the batch operators over all events so far."""
        ev = self.events().persist()
        got = L.lifecycle_events(self.store)
        assert sorted(map(str, got.select(COLUMNS).collect())) == sorted(map(str, B.backfill_region(ev).select(COLUMNS).collect()))
        columns = ["event_id", "order_id", "event_type", "previous_status", "violation"]
        want = sorted(map(str, B.illegal_transitions(ev).select(columns).collect()))
        assert sorted(map(str, L.live_transitions(self.store).select(columns).collect())) == want
        ev.unpersist()
        return len(want)


def shuffled(seed, orders, events):
    rnd = random.Random(seed)
    out = []
    for i in range(events):
        kind = rnd.choice(TYPES)
        address = rnd.choice([None, None, "P", "Q", "R", ""])
        out.append(message(i, kind, f"o{rnd.randrange(orders)}", rnd.randrange(60 * 24 * 20), address, rnd.choice([None, "card", "cash"])))
    rnd.shuffle(out)
    return out


def test_shuffled_events_equal_batch_after_every_restart(spark, tmp_dir):
    run = Run(spark, tmp_dir)
    messages = shuffled(1, 12, 160)
    for part in range(2):
        run.add(messages[part::4])
        run.add(messages[part + 2 :: 4] + messages[part::16])  # some delivered again
        run.drain()  # a new stream over the same checkpoint
        assert run.check() > 20
        own = run.events()
        assert run.store.read("order_lifecycle_expired").count() == 0
        state = {r.order_id: r for r in L.live_order_state(run.store).collect()}
        for r in B.current_order_state(own).collect():
            live = state.pop(r.order_id)
            assert (live.current_status, live.last_total, live.first_event_time, live.last_event_time) == (
                r.current_status, r.last_total, r.first_event_time, r.last_event_time)
        assert not state
        assert tuple(L.live_active_orders(run.store).first()) == tuple(B.active_orders(own).first())


def test_late_events_change_what_was_judged(spark, tmp_dir):
    run = Run(spark, tmp_dir)
    day = 60 * 24
    run.add([message(1, "order_created", "o1", 0, "P"), message(2, "order_shipped", "o2", 6), message(3, "order_created", "o3", 1)])
    run.add([message(4, "order_shipped", "o1", 9 * day), message(5, "order_confirmed", "o3", 2, "Q")])
    run.add([message(6, "order_shipped", "o3", 10 * day), message(7, "order_created", "o2", 5, "R")])
    run.add([message(8, "order_confirmed", "o1", 8 * day, "S"), message(9, "order_created", "o4", 0, "T")])
    run.drain()
    got = {r.event_id: (r.shipping_province, r.violation) for r in L.lifecycle_events(run.store).collect()}
    assert got == {"e0001": ("P", None), "e0002": ("R", "transition_not_allowed"), "e0003": (None, None), "e0004": ("S", None),
                   "e0005": ("Q", None), "e0006": ("Q", None), "e0007": ("R", None), "e0008": ("S", None), "e0009": ("T", None)}
    run.check()
    # only what changed is written again: e0004 when e0008 came, e0002 when e0007 came
    assert run.store.read("order_lifecycle").count() == 9 + 2


def test_orders_that_left_the_state_are_judged_from_their_stored_events(spark, tmp_dir):
    run = Run(spark, tmp_dir, order_expiry="2 seconds", clock_slack="0 seconds")
    run.add([message(1, "order_created", "o1", 0, "P", "card"), message(2, "order_created", "o2", 0, "Q")])
    run.drain()
    time.sleep(3)
    run.add([message(3, "order_created", "o3", 1, "R")])
    run.drain()
    time.sleep(3)
    run.add([message(4, "order_created", "o4", 1)])  # by now o1 and o2 have rested
    run.drain()
    assert {"o1", "o2"} <= {r.order_id for r in run.store.read("order_lifecycle_expired").collect()}
    run.add([message(5, "order_shipped", "o1", 30)])
    run.add([message(6, "order_confirmed", "o1", 20, "S"), message(7, "order_delivered", "o2", 5)])  # e0006 is before e0005
    run.drain()
    run.check()
    got = {r.event_id: (r.shipping_province, r.payment_method, r.violation) for r in L.lifecycle_events(run.store).collect()}
    assert got["e0005"] == ("S", "card", None) and got["e0007"] == ("Q", None, "transition_not_allowed")


def test_events_before_the_folded_ones_take_the_exact_path(spark, tmp_dir):
    run = Run(spark, tmp_dir, order_expiry="1 hour")  # folds what is an hour older than the order's newest event
    run.add([message(1, "order_created", "o1", 10, "P"), message(2, "order_confirmed", "o1", 20), message(3, "order_shipped", "o1", 300)])
    run.add([message(4, "order_item_added", "o1", 290)])  # within the hour: by the state
    run.add([message(5, "order_created", "o1", 5, "Q"), message(6, "order_delivered", "o1", 310)])  # before the folded ones
    run.add([message(7, "order_confirmed", "o1", 15, "R"), message(8, "order_created", "o2", 0)])
    run.drain()
    run.check()
    got = {r.event_id: r.shipping_province for r in L.lifecycle_events(run.store).collect()}
    assert got["e0002"] == got["e0003"] == got["e0006"] == "R" and got["e0001"] == "P"


def test_a_retried_micro_batch_changes_nothing(spark, tmp_dir):
    store = TableStore(spark, root=os.path.join(tmp_dir, "t"))
    store.create_tables()
    rows = [("event", f"e{k}", "order_created", "o1", 10**15 + k, None, "P", None, None, "P", None, None, None) for k in range(5)]
    rows += [("missed", "e9", "order_shipped", "o2", 10**15, None, None, None, None, None, None, None, None)]
    for _ in range(2):
        L.write_judged(spark.createDataFrame(rows, L.JUDGED), 3, store)
    assert store.read("order_lifecycle").count() == 6
    (missed,) = L.lifecycle_events(store).filter("order_id = 'o2'").collect()
    assert missed.violation == "first_event_not_created"


def test_outputs_need_their_own_parquet_tables(spark, tmp_dir):
    store = TableStore(spark, root=tmp_dir, provider="iceberg")
    for name in ("lifecycle", "order_state"):
        with pytest.raises(ValueError, match=name):
            OrderStreams(spark, None, store, StreamSettings(outputs=(name,))).start()




def test_an_order_asks_the_state_store_little():
    """Two calls for an order that is known, three for a new one; the timer is
    set again only when it is due."""
    from types import SimpleNamespace as N

    calls, kept = [], {}

    class State:
        def exists(self):
            calls.append("exists")
            return "v" in kept

        def get(self):
            calls.append("get")
            return kept.get("v")

        def update(self, value):
            calls.append("update")
            kept["v"] = value

        def clear(self):
            calls.append("clear")
            kept.clear()

    class Handle:
        def getValueState(self, name, schema):
            return State()

        def listTimers(self):
            calls.append("list")
            return iter(())

        def deleteTimer(self, at):
            calls.append("delete")

        def registerTimer(self, at):
            calls.append(f"timer {at}")

    def row(i, arrived):
        return N(t=i, event_id=f"e{i}", event_type="order_created", own_city=None, own_province=None, own_payment=None, arrived_ms=arrived)

    def taken():
        out = calls[:]
        calls.clear()
        return out

    orders = L.order_processor(1_000_000)
    orders.init(Handle())
    assert len(list(orders.handleInputRows(("o",), iter([row(1, 100)]), None))) == 1 and taken() == ["get", "update", "timer 1100"]
    assert len(list(orders.handleInputRows(("o",), iter([row(2, 700)]), None))) == 1 and taken() == ["get", "update"]

    def expire(at, watermark):
        return list(orders.handleExpiredTimer(("o",), N(getCurrentWatermarkInMs=lambda: watermark), N(getExpiryTimeInMs=lambda: at)))

    assert expire(1100, 1200) == [] and taken() == ["get", "timer 1700"]
    (gone,) = expire(1700, 1701)
    assert (gone.kind, gone.order_id, gone.t) == ("expired", "o", 1_700_000) and taken() == ["get", "clear"] and not kept
