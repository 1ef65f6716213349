"""Stream tests: stream equals batch, late data, restart, retried batch."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from orderlens import schemas as S
from orderlens.operators import windows as W
from orderlens.plans import batch as B
from orderlens.sources.raw import read_raw_files
from orderlens.sources.testdata import raw_messages
from orderlens.streaming.jobs import OrderStreams, StreamSettings, process_events_batch, valid_event_stream
from orderlens.streaming.late import late_counts, late_events
from orderlens.tables.store import TableStore

CHECK = {"as_of": "2024-01-02 00:00:00", "max_age": "2 days"}


def _msg(i, ts, etype="order_created", total=10.0, province="P", order=None):
    body = {"event_id": f"e{i}", "event_type": etype, "order_id": order or f"o{i}", "customer_id": f"c{i % 3}",
            "timestamp": ts.isoformat() + "+00:00",
            "payload": {"total_amount": total, "currency": "EUR",
                        "shipping_address": {"province": province, "city": "C"}}}
    return (f"o{i}".encode(), json.dumps(body).encode(), S.DEFAULT_TOPIC, 0, i, ts)


def _write_file(spark, src, name, msgs):
    spark.createDataFrame(msgs, S.RAW_SCHEMA).coalesce(1).write.parquet(os.path.join(src, name))


def _run(spark, src, root, settings, files_per_trigger=1):
    stream = read_raw_files(spark, os.path.join(src, "*"), max_files_per_trigger=files_per_trigger)
    store = TableStore(spark, root=os.path.join(root, "tables"))
    jobs = OrderStreams(spark, stream, store, settings, checkpoint_dir=os.path.join(root, "streams"))
    jobs.start()
    jobs.process_all_available()
    jobs.stop()
    return store


def _settings(**kw):
    base = dict(trigger={"availableNow": True}, check_kwargs=CHECK, detected_at="2024-01-02 00:00:00")
    base.update(kw)
    return StreamSettings(**base)


def test_late_data_kept_raw_dropped_from_windows(spark, tmp_dir):
    t = dt.datetime(2024, 1, 1, 10, 0)
    src = os.path.join(tmp_dir, "src")
    _write_file(spark, src, "f1", [_msg(1, t)])  # on time, moves the clock
    _write_file(spark, src, "f2", [_msg(2, t + dt.timedelta(minutes=5))])  # filler
    _write_file(spark, src, "f3", [_msg(3, t - dt.timedelta(minutes=20))])  # beyond the 10 min watermark
    _write_file(spark, src, "f4", [_msg(4, t + dt.timedelta(hours=2))])  # far ahead, closes windows
    store = _run(spark, src, tmp_dir, _settings())
    raw_ids = sorted(r.event_id for r in store.read("order_events").collect())
    assert raw_ids == ["e1", "e2", "e3", "e4"]
    starts = sorted(r.window_start for r in store.read("order_metrics").collect())
    assert starts == [t, t + dt.timedelta(minutes=5)]
    # what the windows dropped is told apart: kept = counted + late + still open
    (lost,) = late_counts(store, "1 minute").collect()
    assert (lost.window_start, lost.region, lost.kept, lost.counted, lost.late) == (t - dt.timedelta(minutes=20), "P", 1, 0, 1)
    assert [r.event_id for r in late_events(store, "1 minute").collect()] == ["e3"]
    counted = store.read("order_metrics").agg(F.sum("event_count")).first()[0]
    assert len(raw_ids) == counted + 1 + 1  # e3 late, the window of e4 open
    assert late_counts(store, "1 minute", since_hour="2024-01-01-10").count() == 0


def test_late_events_of_a_window_that_counted_others(spark, tmp_dir):
    from orderlens.operators.enrich import enrich_orders
    from orderlens.tables.sinks import conform, order_events_rows
    from tests.helpers import events

    store = TableStore(spark, root=os.path.join(tmp_dir, "t"))
    t = "2024-01-01 10:00:0"
    for batch in range(3):  # one window, one event a micro-batch and region; the third is late
        rows = [{"event_id": f"e{batch}{r}", "ts": f"{t}{batch}", "total": 1.0, "province": r, "order_id": "o", "customer_id": "c",
                 "processing": f"{t}9"} for r in ("P", None)]
        store.write("order_events", order_events_rows(enrich_orders(events(spark, rows))), "events", batch)
    two = [(dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 10, 1), r, 2, 1) for r in ("P", None)]
    closed = spark.createDataFrame(two, "window_start timestamp, window_end timestamp, region string, event_count long, order_count long")
    none = {c: F.lit(None) for c in S.ORDER_METRICS_SCHEMA.fieldNames() if c not in closed.columns}
    store.write("order_metrics", conform(closed.withColumns(none), S.ORDER_METRICS_SCHEMA), "tumbling", 5)
    assert sorted((r.region or "", r.kept, r.counted, r.late) for r in late_counts(store, "1 minute").collect()) == [("", 3, 2, 1), ("P", 3, 2, 1)]
    assert sorted(r.event_id for r in late_events(store, "1 minute").collect()) == ["e2None", "e2P"]


def test_restart_and_retry_add_nothing_twice(spark, tmp_dir):
    t = dt.datetime(2024, 1, 1, 10, 0)
    src = os.path.join(tmp_dir, "src")
    _write_file(spark, src, "f1", [_msg(i, t + dt.timedelta(seconds=i)) for i in range(5)])
    _write_file(spark, src, "f2", [_msg(i, t + dt.timedelta(minutes=3, seconds=i)) for i in range(5, 9)])
    store = _run(spark, src, tmp_dir, _settings())
    assert store.read("order_events").count() == 9
    _write_file(spark, src, "f3", [_msg(i, t + dt.timedelta(hours=1, seconds=i)) for i in range(9, 12)])
    store = _run(spark, src, tmp_dir, _settings())  # restart from the checkpoints
    assert store.read("order_events").count() == 12
    assert store.read("order_events").select("event_id").distinct().count() == 12
    metrics = store.read("order_metrics")
    assert metrics.groupBy("window_start", "region").count().filter("count > 1").count() == 0
    # a micro-batch that is re-run (same batch id) replaces its output
    batch = spark.createDataFrame([_msg(99, t)], S.RAW_SCHEMA)
    process_events_batch(batch, 500, store, _settings())
    process_events_batch(batch, 500, store, _settings())
    assert store.read("order_events").filter("event_id = 'e99'").count() == 1
    quality = store.read("order_quality").filter(F.col("commit") == "quality-000000000500").collect()
    assert [(q.records_checked, q.records_valid) for q in quality] == [(1, 1)]


def test_empty_batch(spark, tmp_dir):
    store = TableStore(spark, root=os.path.join(tmp_dir, "tables"))
    empty = spark.createDataFrame([], S.RAW_SCHEMA)
    process_events_batch(empty, 0, store, _settings())
    q = store.read("order_quality").first()
    assert q.records_checked == 0 and q.quarantine_rate is None


@pytest.mark.parametrize("width", ["1 hour"])
def test_stream_equals_batch_on_closed_windows(spark, tmp_dir, width):
    sf = "/root/testdata/sf0.001"
    raw = raw_messages(spark, sf).withColumn("d", F.dayofmonth("timestamp"))
    src = os.path.join(tmp_dir, "src")
    days = sorted(r.d for r in raw.select("d").distinct().collect())
    for d in days:  # one file per day, in time order
        raw.filter(F.col("d") == d).drop("d").coalesce(1).write.parquet(os.path.join(src, f"day{d:02d}"))
    check = dict(B.CHECK_ARGS)
    store = _run(spark, src, tmp_dir, _settings(check_kwargs=check, tumbling=width), files_per_trigger=4)
    streamed = store.read("order_metrics").drop("committed_at", "commit", "event_hour")

    # the same raw messages in batch (malformed bodies included), same parse and checks
    valid = valid_event_stream(raw_messages(spark, sf), check)
    batch = W.metrics_rows(W.tumbling_metrics(valid, width))
    max_ts = valid.agg(F.max("event_timestamp")).first()[0]
    closed = batch.filter(F.col("window_end") <= F.lit(max_ts - dt.timedelta(minutes=10)))

    def rows(df, columns, money, mean):
        df = df.withColumns({money: F.round(money, 2), mean: F.round(mean, 4),
                             "window_start": F.col("window_start").cast("timestamp_ntz")})
        return sorted((tuple(r[c] for c in ("window_start",) + columns) for r in df.collect()), key=repr)

    shape = (W.METRIC_COLUMNS, "total_revenue", "avg_order_value")
    s_rows, b_rows = rows(streamed, *shape), rows(closed, *shape)
    assert len(b_rows) > 50
    assert s_rows == b_rows

    sliding = W.sliding_rows(W.sliding_metrics(valid)).filter(F.col("window_end") <= F.lit(max_ts - dt.timedelta(minutes=10)))
    shape = (W.SLIDING_COLUMNS, "sliding_total_revenue", "sliding_avg_order_value")
    s_rows, b_rows = rows(store.read("order_metrics_sliding"), *shape), rows(sliding, *shape)
    assert len(b_rows) > 50
    assert s_rows == b_rows
