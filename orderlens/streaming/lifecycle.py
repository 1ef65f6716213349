"""The order life cycle on a stream: region backfill (O-41), illegal
transitions (O-42) and the live state of every order (O-40, O-43).

``judged_events`` keeps the events of an order as keyed state
(``transformWithState``). An event that arrives late is put where it belongs
and the events after it are judged again; what is emitted is every new event
and every event whose judgement changed. ``write_judged`` appends these rows to
the order_lifecycle table, whose last row per event is valid
(``TableStore.read_latest``). Reading it back gives what the batch operators
give over all events, whatever order they arrived in.

State is bounded by ``expiry``:

* an order no event of which has arrived for so long leaves the state, and its
  id goes to the order_lifecycle_expired table;
* of an order that never rests, events older than its newest by more than
  ``expiry`` are folded into one carried row.

What misses the state (an event before the folded ones, or of an order that
left) is judged exactly by the batch operators, over the order's stored events:
``write_judged`` finds such orders by the expired ids and by the rows marked
as missed. An order that missed once is judged this way until it has rested.

``order_states`` is an update-mode aggregation: its sink table order_state
holds a row per order and micro-batch that changed it, the last one valid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from orderlens import schemas as S
from orderlens.functions.columns import epoch_micros, interval_seconds
from orderlens.operators.lifecycle import backfill_region, current_order_state, illegal_transitions, is_active
from orderlens.tables.sinks import conform
from orderlens.tables.store import COMMIT_COLUMN, TableStore, commit_id

OWN = ("own_city", "own_province", "own_payment")
FILLED = ("shipping_city", "shipping_province", "payment_method")
EVENT_COLUMNS = ("event_id", "event_type", "order_id", "event_timestamp", *OWN)

EVENT_STATE = T.StructType([T.StructField("t", T.LongType())] + [
    T.StructField(c, T.StringType()) for c in ("event_id", "event_type", *OWN)])
ORDER_STATE = T.StructType([
    T.StructField("events", T.ArrayType(EVENT_STATE)),
    # what the folded events leave behind: the last of them, the values and the status after it
    T.StructField("folded", T.StructType([T.StructField("t", T.LongType())] + [
        T.StructField(c, T.StringType()) for c in ("event_id", *FILLED, "status")])),
    T.StructField("missed", T.BooleanType()),
    T.StructField("arrived_ms", T.LongType()),  # when its newest events arrived
])
JUDGED = ("kind string, event_id string, event_type string, order_id string, t long, own_city string, own_province string, "
          "own_payment string, shipping_city string, shipping_province string, payment_method string, previous_status string, "
          "violation string")


def order_processor(expiry_us: int) -> StatefulProcessor:
    """The stateful processor. It is built in a function and uses nothing of
    this module but its arguments, so Python workers need no copy of the
    library."""
    status_of, allowed = dict(S.STATUS_BY_EVENT), {k: tuple(v) for k, v in S.ALLOWED_TRANSITIONS.items()}
    order_state, expiry_ms = ORDER_STATE, expiry_us // 1000

    class Orders(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.order = handle.getValueState("order", order_state)

        def replay(self, folded, events):
            """Judgement of each event in order, and what they leave behind."""
            city, province, payment, status = folded[2:] if folded else (None,) * 4
            out = []
            for t, event_id, kind, own_city, own_province, own_payment in events:
                city = city if own_city is None else own_city
                province = province if own_province is None else own_province
                payment = payment if own_payment is None else own_payment
                violation = None
                if status is None:
                    violation = None if kind == "order_created" else "first_event_not_created"
                elif kind not in allowed.get(status, ()):
                    violation = "transition_not_allowed"
                out.append((city, province, payment, status, violation))
                status = status_of.get(kind) or status
                folded = (t, event_id, city, province, payment, status)
            return out, folded

        def handleInputRows(self, key, rows, timerValues):
            got = self.order.get()
            events = [tuple(e) for e in got[0]] if got and got[0] else []
            folded = tuple(got[1]) if got and got[1] is not None else None
            missed = bool(got and got[2])
            seen, new = {e[:2] for e in events}, {}
            for r in rows:
                at, arrived = (r.t, r.event_id), r.arrived_ms
                if at in seen or at in new:
                    continue  # delivered again
                new[at] = (r.t, r.event_id, r.event_type, r.own_city, r.own_province, r.own_payment)
                missed = missed or (folded is not None and at <= folded[:2])
            if missed:
                for e in new.values():
                    yield Row(kind="missed", event_id=e[1], event_type=e[2], order_id=key[0], t=e[0], own_city=e[3], own_province=e[4],
                              own_payment=e[5], shipping_city=None, shipping_province=None, payment_method=None,
                              previous_status=None, violation=None)
                events, folded = [], None
            elif new:
                before = dict(zip((e[:2] for e in events), self.replay(folded, events)[0]))
                events = sorted([*events, *new.values()], key=lambda e: e[:2])
                for e, judged in zip(events, self.replay(folded, events)[0]):
                    if before.get(e[:2]) != judged:
                        yield Row(kind="event", event_id=e[1], event_type=e[2], order_id=key[0], t=e[0], own_city=e[3],
                                  own_province=e[4], own_payment=e[5], shipping_city=judged[0], shipping_province=judged[1],
                                  payment_method=judged[2], previous_status=judged[3], violation=judged[4])
                old = [e for e in events if e[0] < events[-1][0] - expiry_us]
                if old:
                    folded, events = self.replay(folded, old)[1], events[len(old):]
            self.order.update((events, folded, missed, arrived))
            if got is None:  # an order has one timer; where events came since, it is set again when it is due
                self.handle.registerTimer(arrived + expiry_ms)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            due = self.order.get()[3] + expiry_ms
            if due > max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()):
                self.handle.registerTimer(due)
                return
            self.order.clear()
            yield Row(kind="expired", event_id=None, event_type=None, order_id=key[0], t=due * 1000,
                      own_city=None, own_province=None, own_payment=None, shipping_city=None, shipping_province=None,
                      payment_method=None, previous_status=None, violation=None)

        def close(self):
            pass

    return Orders()


def judged_events(enriched: DataFrame, expiry: str = S.ORDER_EXPIRY, clock_slack: str = "1 hour") -> DataFrame:
    """Rows of ``JUDGED`` from a stream of valid, enriched events. Needs the
    RocksDB state store. Events of one time are in the order of their ids.

    The watermark is on the time of the micro-batch, not of the event: no
    event is ever late for it, and wrong event times expire nothing.
    ``clock_slack`` is by how much the clock may go back between two runs of
    the stream; an order leaves that much later. All events of an order in a
    micro-batch meet in one task, as keyed state must; its size is what
    ``expiry`` leaves of the order."""
    narrow = enriched.select(
        "event_id", "event_type", "order_id", epoch_micros("event_timestamp").alias("t"),
        *(F.col(c).alias(o) for o, c in zip(OWN, FILLED)), F.current_timestamp().alias("arrived"))
    narrow = narrow.withColumn("arrived_ms", F.unix_millis("arrived")).withWatermark("arrived", clock_slack)
    return narrow.groupBy("order_id").transformWithState(
        order_processor(interval_seconds(expiry) * 1_000_000), JUDGED, "Update", "EventTime")


def judge_whole(events: DataFrame) -> DataFrame:
    """The order_lifecycle rows of whole orders by the batch operators.
    ``events``: ``EVENT_COLUMNS``, every event of each order once."""
    named = events.withColumns({c: F.col(o) for o, c in zip(OWN, FILLED)})
    filled = backfill_region(named)
    judged = illegal_transitions(named, keep_legal=True).select("order_id", "event_id", "previous_status", "violation")
    return conform(filled.join(judged, ["order_id", "event_id"]), S.ORDER_LIFECYCLE_SCHEMA)


def write_judged(batch: DataFrame, batch_id: int, store: TableStore) -> None:
    """One micro-batch of ``judged_events`` into order_lifecycle and
    order_lifecycle_expired.

    Orders that missed the state or had left it are judged whole: their
    stored events (this table's own, joined by the ids of these orders) and
    those of the batch. Without expired orders or misses nothing is read."""
    rows = batch.withColumn("event_timestamp", F.timestamp_micros("t")).persist()
    try:
        earlier = F.col(COMMIT_COLUMN) < commit_id("lifecycle", batch_id)
        gone = store.read("order_lifecycle_expired").filter(earlier).select("order_id").distinct()
        told = rows.filter("kind <> 'expired'")
        missing = rows.filter("kind = 'missed'").select("order_id")
        back = told.select("order_id").join(gone, "order_id", "left_semi")
        exact = missing.unionByName(back).distinct().persist()
        out = conform(told, S.ORDER_LIFECYCLE_SCHEMA)
        if not exact.isEmpty():
            stored = (store.read_latest("order_lifecycle", ["order_id", "event_id"], before=commit_id("lifecycle", batch_id))
                      .join(exact, "order_id", "left_semi").select(*EVENT_COLUMNS))
            fresh = told.join(exact, "order_id", "left_semi").select(*EVENT_COLUMNS)
            whole = stored.unionByName(fresh).dropDuplicates(["order_id", "event_id"])
            out = out.join(exact, "order_id", "left_anti").unionByName(judge_whole(whole))
        store.write("order_lifecycle", out, "lifecycle", batch_id)
        expired = rows.filter("kind = 'expired'").select("order_id", F.col("event_timestamp").alias("expired_at"))
        store.write("order_lifecycle_expired", expired, "lifecycle", batch_id)
        exact.unpersist()
    finally:
        rows.unpersist()


def lifecycle_events(store: TableStore) -> DataFrame:
    """The streamed events as last judged: filled region and payment method
    (O-41), previous status and violation (O-42, NULL where allowed)."""
    return store.read_latest("order_lifecycle", ["order_id", "event_id"]).select(*S.ORDER_LIFECYCLE_SCHEMA.fieldNames())


def live_transitions(store: TableStore) -> DataFrame:
    """O-42 over the streamed events."""
    return lifecycle_events(store).filter(F.col("violation").isNotNull()).select(
        "event_id", "order_id", "event_type", "event_timestamp", "previous_status", "violation")


# ---------------------------------------------------------------------------
# O-40, O-43: live state of every order
# ---------------------------------------------------------------------------
def order_states(enriched: DataFrame) -> DataFrame:
    """O-40 as an update-mode aggregation: the state of every order that a
    micro-batch changes. One small row of state per order."""
    return current_order_state(enriched)


def write_states(batch: DataFrame, batch_id: int, store: TableStore) -> None:
    store.write("order_state", conform(batch, S.ORDER_STATE_SCHEMA), "state", batch_id)


def live_order_state(store: TableStore) -> DataFrame:
    """O-40 over the streamed events: the last state written of every order."""
    return store.read_latest("order_state", ["order_id"]).select(*S.ORDER_STATE_SCHEMA.fieldNames())


def live_active_orders(store: TableStore) -> DataFrame:
    """O-43: the gauge over the live states."""
    return live_order_state(store).agg(F.count_if(is_active()).alias("active_orders"), F.count("*").alias("total_orders"))
