import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from orderlens import schemas as S
from orderlens.operators import monitor as M
from orderlens.operators.enrich import enrich_orders
from orderlens.tables.sinks import conform, order_events_rows
from orderlens.tables.store import TableStore
from tests.helpers import events

T0 = dt.datetime(2024, 1, 1, 12, 0)


def _enriched(spark, n, start=T0, step_s=60):
    rows = [{"event_id": f"e{i:03d}", "ts": start + dt.timedelta(seconds=i * step_s), "total": float(i),
             "processing": (start + dt.timedelta(seconds=i * step_s, milliseconds=50 * i)).isoformat(sep=" "),
             "order_id": f"o{i}", "customer_id": "c1"} for i in range(n)]
    return enrich_orders(events(spark, rows))


def test_commits_as_of_snapshots_expire_compact(spark, tmp_dir):
    store = TableStore(spark, root=os.path.join(tmp_dir, "t"))
    ev = order_events_rows(_enriched(spark, 30))
    store.write("order_events", ev.filter("event_id < 'e010'"), "events", 0, committed_at="2024-01-01 00:00:00")
    store.write("order_events", ev.filter("event_id >= 'e010' AND event_id < 'e020'"), "events", 1,
                committed_at="2024-01-02 00:00:00")
    store.write("order_events", ev.filter("event_id >= 'e020'"), "events", 2, committed_at="2024-01-03 00:00:00")
    store.write("order_events", ev.filter("event_id >= 'e020'"), "events", 2, committed_at="2024-01-03 00:00:00")
    assert store.read("order_events").count() == 30  # the retried commit replaced itself
    assert store.read_as_of("order_events", "2024-01-02 12:00:00").count() == 20
    assert store.read_as_of("order_events", commit="events-000000000000").count() == 10
    snaps = sorted((r.commit, r.rows) for r in store.snapshots("order_events").collect())
    assert [n for _, n in snaps] == [10, 10, 10]
    # hour partitions prune: the filter reaches the folder listing
    plan = store.read("order_events").filter(F.col("event_hour") == "2024-01-01-12")._jdf.queryExecution()
    scan = plan.executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_hour" in scan and "2024-01-01-12" in scan
    before = sorted(r.event_id for r in store.read("order_events").collect())

    # as of a commit: what any writer had committed by then
    store.write("order_events", ev.filter("event_id = 'e000'"), "a-writer", 0, committed_at="2024-01-08 00:00:00")
    assert store.read_as_of("order_events", commit="events-000000000001").count() == 20
    assert store.read_as_of("order_events", commit="a-writer-000000000000").count() == 31
    for call in (store.expire_snapshots, store.compact):
        with pytest.raises(NotImplementedError):
            call("order_events")
    assert sorted(r.event_id for r in store.read("order_events").collect()) == sorted([*before, "e000"])



def test_commit_log_retries_and_not_null(spark, tmp_dir):
    store = TableStore(spark, root=os.path.join(tmp_dir, "t"))
    ev = order_events_rows(_enriched(spark, 30, step_s=600))  # five hours
    assert store.write("order_events", ev, "events", 0, committed_at="2024-01-01 00:00:00") == 30
    assert store.write("order_events", ev.filter("1 = 0"), "events", 1, committed_at="2024-01-02 00:00:00") == 0
    log = {r.commit: (r.committed_at, r.rows) for r in store.snapshots("order_events").collect()}
    assert log == {"events-000000000000": (dt.datetime(2024, 1, 1), 30), "events-000000000001": (dt.datetime(2024, 1, 2), 0)}
    assert store.read_as_of("order_events", commit="events-000000000001").count() == 30
    # a retry that has rows of fewer hours leaves nothing of its first attempt
    assert store.write("order_events", ev.filter("event_id < 'e003'"), "events", 0) == 3
    assert sorted(r.event_id for r in store.read("order_events").collect()) == ["e000", "e001", "e002"]
    assert [r.rows for r in store.snapshots("order_events").orderBy("commit").collect()] == [3, 0]
    # listing opens no data file; an as-of read prunes by the log
    opened = store.snapshots("order_events").inputFiles()
    assert opened and all("/_commits/order_events/" in f for f in opened)
    plan = store.read_as_of("order_events", "2024-01-02 12:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    # hours are the outer folders
    assert {p.split("=")[0] for p in os.listdir(store.path("order_events")) if "=" in p} == {"event_hour"}
    # NULL in a NOT NULL column fails the write, and the commit is not listed
    empty = spark.createDataFrame([(None,) * 5], S.ORDER_QUALITY_SCHEMA.simpleString()[7:-1].replace(":", " "))
    with pytest.raises(Exception, match="NOT NULL"):
        store.write("order_quality", empty, "quality", 0)
    assert store.snapshots("order_quality").count() == 0


def test_an_append_only_sink_takes_a_batch_once(spark, tmp_dir):
    from orderlens.tables.ledger import AppendLedger

    sink = os.path.join(tmp_dir, "sink")
    rows = spark.range(5)
    for _ in range(3):  # the micro-batch is run again, by a new process too
        ledger = AppendLedger(spark, os.path.join(tmp_dir, "ledger"))
        ledger.append_once("topic", "quarantine-000000000007", lambda: rows.write.mode("append").parquet(sink))
    assert spark.read.parquet(sink).count() == 5
    assert ledger.append_once("topic", "quarantine-000000000008", lambda: rows.write.mode("append").parquet(sink))
    assert spark.read.parquet(sink).count() == 10
    with pytest.raises(ZeroDivisionError):  # a failed append is not recorded
        ledger.append_once("topic", "quarantine-000000000009", lambda: 1 // 0)
    assert ledger.append_once("topic", "quarantine-000000000009", lambda: None)


def test_schema_evolution_and_ddl(spark, tmp_dir):
    store = TableStore(spark, root=os.path.join(tmp_dir, "t"))
    ev = order_events_rows(_enriched(spark, 3))
    store.write("order_events", ev, "events", 0)
    with pytest.raises(ValueError, match="channel"):
        store.write("order_events", ev.withColumn("channel", F.lit("web")), "events", 1)
    store.add_column("order_events", "channel", "string")
    store.write("order_events", ev.withColumn("channel", F.lit("web")), "events", 1)
    store.write("order_events", ev, "events", 2)
    got = store.read("order_events").select("channel").collect()
    assert sorted(r.channel or "NULL" for r in got) == ["NULL"] * 6 + ["web"] * 3
    ddl = TableStore(spark, root=os.path.join(tmp_dir, "t"), provider="iceberg").ddl("order_events")
    assert "PARTITIONED BY (hours(event_timestamp))" in ddl and "`event_id` string NOT NULL" in ddl
    created = store.create_tables()
    assert set(created) == set(S.TABLES)
    assert store.read("order_events").count() == 9  # creating again leaves rows alone
    assert store.read("order_anomalies").count() == 0 and store.snapshots("order_anomalies").count() == 0
    store.write("order_anomalies", spark.createDataFrame([], S.ORDER_ANOMALIES_SCHEMA), "large_orders", 0)
    assert store.read("order_anomalies").count() == 0


def test_kpis_and_monitor_queries(spark):
    ev = _enriched(spark, 40)  # one order per minute, 12:00 .. 12:39
    as_of = "2024-01-01 12:39:00"
    k = M.kpis(ev, as_of=as_of).first()
    # last 60 s holds the events at 12:38 and 12:39: 2 / 60 s elapsed
    assert abs(k.events_per_second - 2 / 60) < 1e-9
    assert k.orders_last_hour == 40 and k.total_events_processed == 40
    assert k.revenue_last_hour == sum(range(40)) and k.cancellation_rate == 0.0
    assert k.active_orders == 40
    assert abs(k.avg_processing_latency_ms - 50 * 39) < 1e-6
    one = M.kpis(ev, as_of="2024-01-01 12:00:30").first()
    assert abs(one.events_per_second - 1 / 60) < 1e-9  # one event: divided by the whole minute

    trend = M.revenue_trend(ev, as_of="2024-01-01 12:20:00", bucket="5 minutes", buckets=2).orderBy("window_start")
    assert [(r.window_start.minute, r.order_count) for r in trend.collect()] == [(10, 5), (15, 5)]
    cut = M.revenue_trend(ev, as_of="2024-01-01 12:22:00", bucket="5 minutes", buckets=2).orderBy("window_start")
    assert [(r.window_start.minute, r.order_count) for r in cut.collect()] == [(15, 5), (20, 2)]
    hp = {r.hour: r for r in M.hourly_pattern(ev).collect()}
    assert len(hp) == 24 and hp[12].avg_orders == 40.0 and hp[3].avg_orders == 0.0
    assert [r.event_id for r in M.recent_events(ev, 3).collect()] == ["e039", "e038", "e037"]
    bands = {r.event_id: (r.latency_band, r.latency_alert) for r in M.latency_bands(ev).collect()}
    # latency of e<i> is 50 * i ms: 100 is warn, 300 is bad without alert, 350 alerts
    assert bands["e001"] == ("ok", False) and bands["e002"] == ("warn", False)
    assert bands["e006"] == ("bad", False) and bands["e007"] == ("bad", True)


def test_orders_by_region_ties(spark):
    rows = [{"event_id": f"{r}{i}", "ts": T0, "province": r, "total": 1.0}
            for r, n in (("B", 2), ("A", 2), ("C", 1)) for i in range(n)]
    top = M.orders_by_region(enrich_orders(events(spark, rows)), top=2).collect()
    assert [(r.region, r.order_count) for r in top] == [("A", 2), ("B", 2)]
    assert conform(enrich_orders(events(spark, rows)).withColumn("payload", F.to_json("payload")),
                   S.ORDER_EVENTS_SCHEMA).columns == S.ORDER_EVENTS_SCHEMA.fieldNames()
