import json
import os

import pytest
from pyspark.sql import functions as F

from orderlens.operators import anomalies as A
from orderlens.operators.enrich import enrich_orders
from orderlens.operators.parse import parse_events
from orderlens.sources.raw import kafka_options, read_raw_files, read_raw_kafka
from orderlens.streaming.jobs import OrderStreams, StreamSettings
from orderlens.tables.store import TableStore
from tests.helpers import events


def test_kafka_options_and_missing_connector(spark):
    opts = kafka_options("broker:9092")
    assert opts == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "orders.created",
                    "startingOffsets": "latest", "failOnDataLoss": "false"}
    extra = kafka_options("b:1", extra={"kafka.security.protocol": "SASL_SSL"}, max_offsets_per_trigger=None)
    assert "maxOffsetsPerTrigger" not in extra and extra["kafka.security.protocol"] == "SASL_SSL"
    with pytest.raises(Exception, match="(?i)kafka"):
        read_raw_kafka(spark, opts)  # the connector is not on this class path


def test_text_and_json_file_sources(spark, tmp_dir):
    lines = [json.dumps({"event_id": f"e{i}", "event_type": "order_created", "order_id": f"o{i}",
                         "customer_id": "c", "timestamp": "2024-01-01T10:00:00+00:00",
                         "payload": {"total_amount": 5.0 + i}}) for i in range(3)]
    path = os.path.join(tmp_dir, "dump")
    os.makedirs(path)
    with open(os.path.join(path, "events.jsonl"), "w") as f:
        f.write("\n".join(lines) + "\n")
    batch = parse_events(read_raw_files(spark, path, fmt="text", streaming=False))
    assert sorted(r.payload.total_amount for r in batch.collect()) == [5.0, 6.0, 7.0]
    stream = read_raw_files(spark, path, fmt="text", streaming=True, max_files_per_trigger=1)
    assert stream.isStreaming and stream.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]


def test_runner_stops_everything_and_raises_on_failure(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    with open(os.path.join(src, "a.jsonl"), "w") as f:
        f.write('{"order_id": "o1"}\n')
    stream = read_raw_files(spark, src, fmt="text", max_files_per_trigger=1)
    jobs = OrderStreams(spark, stream, TableStore(spark, root=os.path.join(tmp_dir, "t")),
                        StreamSettings(trigger={"availableNow": True}), checkpoint_dir=os.path.join(tmp_dir, "c"))

    def boom(batch, batch_id):
        raise ValueError("sink down")

    jobs._start(stream, "failing_sink", boom)
    jobs._start(stream, "idle_sink", lambda b, i: None)
    with pytest.raises(RuntimeError, match="failing_sink"):
        jobs.await_termination(timeout=120)
    assert not any(q.isActive for q in jobs.queries)


def test_rapid_fire_stream_equals_batch(spark, tmp_dir):
    import datetime as dt
    import random

    from orderlens import schemas as S

    rng = random.Random(3)
    t = dt.datetime(2024, 1, 1, 10, 50)
    parts = [[] for _ in range(4)]
    for i in range(90):  # orders arrive in any order: some late, some repeated in a later batch
        body = {"event_id": f"e{i}", "event_type": "order_created", "order_id": f"o{i}", "customer_id": rng.choice(["c1", "c1", "c2", "c3"]),
                "timestamp": (t + dt.timedelta(seconds=rng.randrange(1800))).isoformat() + "+00:00",
                "payload": {"total_amount": 1.0, "shipping_address": {"province": "P"}}}
        msg = (b"k", json.dumps(body).encode(), "t", 0, i, t)
        first = rng.randrange(4)
        for part in {first, rng.randrange(first, 4)} if i % 9 == 0 else {first}:
            parts[part].append(msg)
    for k, part in enumerate(parts):
        spark.createDataFrame(part, S.RAW_SCHEMA).coalesce(1).write.parquet(os.path.join(tmp_dir, "src", str(k)))
    check = {"as_of": "2024-01-02 00:00:00", "max_age": "2 days"}
    src = os.path.join(tmp_dir, "src", "*")
    store = TableStore(spark, root=os.path.join(tmp_dir, "t"))
    settings = StreamSettings(trigger={"availableNow": True}, outputs=("events", "rapid_fire"), check_kwargs=check,
                              rapid_fire=(5, "5 minutes"), detected_at="2024-01-02 00:00:00")
    jobs = OrderStreams(spark, read_raw_files(spark, src, max_files_per_trigger=1), store, settings,
                        checkpoint_dir=os.path.join(tmp_dir, "c"))
    jobs.start()
    jobs.process_all_available()
    jobs.stop()
    got = [(r.order_id, r.customer_id, r.region) for r in store.read("order_anomalies").filter("anomaly_type = 'rapid_fire'").collect()]
    from orderlens.streaming.jobs import valid_event_stream

    batch = A.rapid_fire(valid_event_stream(read_raw_files(spark, src, streaming=False), check), 5, "5 minutes").collect()
    assert len(batch) > 10
    assert sorted(got) == sorted((r.order_id, r.customer_id, "P") for r in batch)  # each once
    with pytest.raises(ValueError, match="rapid_fire"):
        OrderStreams(spark, None, store, StreamSettings(outputs=("rapid_fire",))).start()


def test_unknown_payload_fields_survive(spark):
    import datetime as dt

    from orderlens import schemas as S
    from orderlens.streaming.jobs import valid_event_stream
    from orderlens.tables.sinks import order_events_rows

    t = dt.datetime(2024, 1, 1, 10, 0)
    body = {"event_id": "e1", "event_type": "order_created", "order_id": "o1", "customer_id": "c", "timestamp": t.isoformat() + "+00:00",
            "payload": {"total_amount": 5.0, "shipping_address": {"province": "P"}, "gift_wrap": True}}
    raw = spark.createDataFrame([(b"o1", json.dumps(body).encode(), "t", 0, 1, t)], S.RAW_SCHEMA)
    batch = valid_event_stream(raw, {"as_of": "2024-02-01 00:00:00", "max_age": "60 days"})
    (stored,) = order_events_rows(enrich_orders(batch)).collect()
    assert json.loads(stored.payload)["gift_wrap"] is True


def test_dirty_input_edges(spark):
    import datetime as dt

    from orderlens.functions.columns import as_of_column, parse_iso_timestamp
    from orderlens.operators.lifecycle import illegal_transitions
    from orderlens.operators.windows import tumbling_metrics

    aware = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone(dt.timedelta(hours=5)))
    texts = ["10:30:00", "2025", "2025-01-15T10:30:00+00:00", "2025-01-15T10:30:00.123Z", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(
        "i", parse_iso_timestamp("t").isNotNull().alias("ok"), as_of_column(aware).cast("string").alias("at")).orderBy("i").collect()
    assert [r.ok for r in got] == [False, False, True, True, False] and got[0]["at"] == "2024-01-01 07:00:00"
    with pytest.raises(ValueError):
        read_raw_kafka(spark, kafka_options("b:1"), streaming=False)

    rows = [{"event_id": f"e{i}", "order_id": o, "customer_id": c, "event_type": k, "ts": "2024-01-01 10:00:00", "total": 1.0,
             "province": "P"} for i, (o, c, k) in enumerate([("o1", "c1", "order_created"), ("o1", None, "order_confirmed"),
                                                              ("o2", None, "order_created"), (None, "c3", "order_shipped"),
                                                              (None, "c1", "order_shipped")])]
    ev = events(spark, rows)
    assert illegal_transitions(ev).collect() == []
    enriched = enrich_orders(ev)
    both = [f(enriched).select("window", "order_count", "unique_customers", "total_revenue", "event_count").collect()
            for f in (tumbling_metrics, lambda df: tumbling_metrics(df, pane="10 seconds"))]
    assert both[0] == both[1] and both[0][0].order_count == 2
    again = events(spark, [{"event_id": f"e{i % 3}", "order_id": f"o{i % 3}", "customer_id": "c", "ts": "2024-01-01 10:00:00", "total": 1.0}
                           for i in range(12)])
    assert A.rapid_fire(again, n=2).count() == 3 and A.rapid_fire(again, n=3).count() == 0


def test_every_query_finishes_and_outputs_agree(spark, tmp_dir):
    import datetime as dt

    from orderlens import schemas as S

    t = dt.datetime(2024, 1, 1, 10, 0)
    msgs = []
    for i, (kind, customer) in enumerate([("order_created", "c"), (None, "c"), ("order_created", None), ("order_created", "d")]):
        body = {"event_id": f"e{i}", "event_type": kind, "order_id": f"o{i}", "customer_id": customer,
                "timestamp": (t + dt.timedelta(seconds=i)).isoformat() + "+00:00", "payload": {"total_amount": 5.0}}
        msgs.append((b"k", json.dumps(body).encode(), "t", 0, i, t))
    for part in range(4):
        spark.createDataFrame(msgs[part : part + 1], S.RAW_SCHEMA).coalesce(1).write.parquet(os.path.join(tmp_dir, "src", str(part)))
    store = TableStore(spark, root=os.path.join(tmp_dir, "t"))
    settings = StreamSettings(trigger={"availableNow": True}, outputs=("events", "metrics"),
                              check_kwargs={"as_of": "2024-01-02 00:00:00", "max_age": "2 days"})
    jobs = OrderStreams(spark, read_raw_files(spark, os.path.join(tmp_dir, "src", "*"), max_files_per_trigger=1), store, settings,
                        checkpoint_dir=os.path.join(tmp_dir, "c"))
    jobs.start()
    jobs.await_termination(timeout=240)
    assert sorted(r.event_id for r in store.read("order_events").collect()) == ["e0", "e3"]
    q = store.read("order_quality").agg(F.sum("records_checked"), F.sum("records_valid"), F.sum("records_invalid")).first()
    assert tuple(q) == (4, 2, 2)  # as many as are stored and quarantined
    held = store.read("order_quarantine")
    assert [r.failure_reason for r in held.collect()] == ["sink_not_null"] * 2
    assert sorted(r.event_timestamp for r in held.collect()) == [t + dt.timedelta(seconds=1), t + dt.timedelta(seconds=2)]

    # replayed from the table; a repair gives the lost fields back
    from orderlens.operators.quality import replay_quarantine

    def repair(df):
        return df.withColumns({"event_type": F.coalesce("event_type", F.lit("order_created")),
                               "customer_id": F.coalesce("customer_id", F.lit("c"))})

    fixed = replay_quarantine(held, repair=repair, strict=True, **settings.check_kwargs).collect()
    assert sorted((r.event_id, r.event_type, r.customer_id, r.previous_failure_reason) for r in fixed) == [
        ("e1", "order_created", "c", "sink_not_null"), ("e2", "order_created", "c", "sink_not_null")]


def test_program_creates_tables_and_drains_files(spark, tmp_dir):
    from orderlens.__main__ import arguments, main

    os.makedirs(os.path.join(tmp_dir, "in"))
    bodies = [{"event_id": f"e{i}", "event_type": "order_created", "order_id": f"o{i}" if i else None, "customer_id": "c",
               "timestamp": "2024-01-01T10:00:00+00:00", "payload": {"total_amount": 5.0}} for i in range(4)]
    with open(os.path.join(tmp_dir, "in", "a.jsonl"), "w") as f:
        f.write("\n".join(map(json.dumps, bodies)))
    store = main(["--checkpoint-dir", tmp_dir, "--files", os.path.join(tmp_dir, "in"), "--format", "text",
                  "--available-now", "--max-age", "36500 days"], spark)
    assert sorted(r.event_id for r in store.read("order_events").collect()) == ["e1", "e2", "e3"]
    assert [r.failure_reason for r in store.read("order_quarantine").collect()] == ["null_order_id"]
    assert store.read("order_metrics_sliding").count() == 0  # created, no window closed yet
    with pytest.raises(SystemExit):
        arguments().parse_args(["--checkpoint-dir", tmp_dir])  # a source is needed


def test_raw_files_can_be_read_by_several_tasks(spark, tmp_dir, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    from orderlens.sources import testdata as T

    rows = spark.range(4000).selectExpr(
        "CAST(CAST(id AS STRING) AS BINARY) AS key", "CAST(repeat(sha2(CAST(id AS STRING), 256), 4) AS BINARY) AS value", "'t' AS topic",
        "0 AS partition", "id AS offset", "current_timestamp() AS timestamp").coalesce(1)
    monkeypatch.setattr(T, "raw_messages", lambda *_, **__: rows)
    monkeypatch.setattr(T, "ROW_GROUP_BYTES", 1 << 17)
    path = T.write_raw_files(spark, "unused", f"{tmp_dir}/raw")
    (file,) = glob.glob(f"{path}/*.parquet")
    assert pq.ParquetFile(file).num_row_groups > 1 and spark.read.parquet(path).count() == 4000
