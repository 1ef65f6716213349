"""Structured Streaming jobs (O-70..O-77) over a raw-message stream.

Layout (each query has its own name and checkpoint under the shared root):

* ``order_events_batch`` — one ``foreachBatch`` that parses and checks a
  micro-batch once (persisted), then writes valid enriched events, the
  quarantine, the micro-batch quality row and the per-event large-order
  anomalies. Stateless, so it needs no watermark; late events are kept.
* ``order_metrics`` / ``order_metrics_sliding`` — tumbling and sliding
  window metrics with an event-time watermark, exact distinct counts from
  panes, append mode.
  The metrics writer also emits the cancellation spikes among the closed
  windows (same grouping), so no extra stateful query re-reads the stream.

* ``order_lifecycle`` / ``order_state`` (opt-in) — the events of every order
  judged in order and the live state of every order, see
  ``streaming.lifecycle``.

Sinks write through ``TableStore.write`` keyed by (query, batch_id), so a
micro-batch re-run after a failure replaces its own output: restart from
the checkpoint adds nothing twice. The Kafka quarantine can only be appended to
and goes through a ledger.
"""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderlens import schemas as S
from orderlens.functions.columns import interval
from orderlens.operators import anomalies as A
from orderlens.operators import quality as Q
from orderlens.operators import windows as W
from orderlens.operators.enrich import enrich_orders
from orderlens.operators.parse import parse_events
from orderlens.session import checkpoint_root
from orderlens.streaming import lifecycle as L
from orderlens.tables.ledger import AppendLedger
from orderlens.tables.sinks import conform, not_null_violation, order_events_rows
from orderlens.tables.store import COMMIT_COLUMN, HOUR_COLUMN, TableStore, commit_id, hour_key

log = logging.getLogger("orderlens.streaming")

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass
class StreamSettings:
    watermark: str = S.WATERMARK_DELAY
    tumbling: str = "1 minute"
    sliding: tuple[str, str] = ("5 minutes", "2 minutes")
    approx: bool = False  # distinct counts of the windows by sketches (exact is the default)
    # Width of the cancellation-spike rule. At the width of ``tumbling`` the
    # spikes come from its closed windows, else from a query of their own.
    spike_window: str = "1 minute"
    trigger: dict = field(default_factory=lambda: {"processingTime": "10 seconds"})
    check_kwargs: dict = field(default_factory=dict)  # as_of / max_age / future_tolerance / strict
    large_order_threshold: float = S.LARGE_ORDER_THRESHOLD
    spike_threshold: float = S.CANCELLATION_SPIKE_RATE
    quarantine_kafka: dict | None = None  # Kafka sink options; None -> quarantine table
    detected_at: object = None  # fixed instant for tests; None -> batch time
    # "rocksdb" keeps window state off the JVM heap with changelog
    # checkpoints (large state on a cluster); None keeps the session's choice.
    state_store: str | None = None
    # State partitions of the windowed queries. They are fixed in the
    # checkpoint at the first start, so size them for peak volume
    # (e.g. a few per executor core); None keeps spark.sql.shuffle.partitions.
    state_partitions: int | None = None
    # Which outputs to start: "events" (the shared foreachBatch), "metrics"
    # (tumbling + spikes), "sliding", and opt-in "rapid_fire" (a part of
    # "events": the exact detector over the stored orders around a batch),
    # "lifecycle" (region backfill and transitions of every event within its
    # order) and "order_state" (live state of every order).
    outputs: tuple[str, ...] = ("events", "metrics", "sliding")
    order_expiry: str = S.ORDER_EXPIRY  # of the life-cycle state
    clock_slack: str = "1 hour"  # by which the clock may go back between two runs
    rapid_fire: tuple[int, str] = (S.RAPID_FIRE_ORDERS, S.RAPID_FIRE_WINDOW)


def event_stream(raw: DataFrame) -> DataFrame:
    """Parsed events; event time is TIMESTAMP (watermarks refuse NTZ)."""
    parsed = parse_events(raw)
    return parsed.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


def checked_events(raw: DataFrame, check_kwargs: dict) -> DataFrame:
    """Parsed events with their check result. What order_events cannot store
    (NULL in a NOT NULL column) fails here, before every output, so the
    tables, the quarantine, the quality row and the metrics agree."""
    checked = Q.check_events(event_stream(raw), **check_kwargs)
    result = F.col("quality_check_result")
    unstorable = (result == Q.VALID) & not_null_violation(S.ORDER_EVENTS_SCHEMA)
    return checked.withColumn("quality_check_result", F.when(unstorable, F.lit("sink_not_null")).otherwise(result))


def valid_event_stream(raw: DataFrame, check_kwargs: dict) -> DataFrame:
    valid, _ = Q.split_checked(checked_events(raw, check_kwargs))
    return enrich_orders(valid)


# ---------------------------------------------------------------------------
# Micro-batch writer for every stateless output
# ---------------------------------------------------------------------------
def write_quarantine(invalid: DataFrame, store: TableStore, batch_id: int, settings: StreamSettings) -> int:
    """O-07: quarantine records to Kafka (when configured) or to the
    order_quarantine table (key, value, failure_reason, event_timestamp).
    Returns their number."""
    if settings.quarantine_kafka:
        topic = settings.quarantine_kafka.get("topic", S.QUARANTINE_TOPIC)
        to_topic = Q.quarantine_messages(invalid).write.format("kafka").options(**settings.quarantine_kafka)
        AppendLedger(store.spark, f"{store.root}/_appended").append_once(
            topic, commit_id("quarantine", batch_id), lambda: to_topic.option("topic", topic).save())
        return invalid.count()
    return store.write("order_quarantine", Q.quarantine_rows(invalid, settings.detected_at), "quarantine", batch_id)


def write_rapid_fire(enriched: DataFrame, store: TableStore, batch_id: int, settings: StreamSettings) -> None:
    """O-34 for the orders this micro-batch adds, which order_events already
    holds. Only the hours within a window's width of the batch are read, and
    of these only the batch's customers."""
    n, width = settings.rapid_fire
    created = enriched.filter((F.col("event_type") == "order_created") & F.col("customer_id").isNotNull())
    ts, gap = F.col("event_timestamp"), interval(width)
    lo, hi = created.agg(F.min(ts - gap).cast("string"), F.max(ts + gap).cast("string")).first()
    if lo is None:
        return
    lo, hi = F.lit(lo).cast("timestamp"), F.lit(hi).cast("timestamp")
    hour = F.col(HOUR_COLUMN)
    around = (store.read("order_events")
              .filter((hour >= hour_key(lo)) & (hour <= hour_key(hi)) & ts.between(lo, hi))
              .filter(F.col("event_type") == "order_created")
              .join(created.select("customer_id").distinct(), "customer_id", "left_semi")
              .withColumn("payload", F.from_json("payload", S.PAYLOAD_TYPE)))
    is_new = F.col(COMMIT_COLUMN) == commit_id("events", batch_id)
    rapid = A.new_rapid_fire(around, is_new, n, width)
    store.write("order_anomalies", A.anomalies(rapid=rapid, detected_at=settings.detected_at), "rapid_fire", batch_id)


def process_events_batch(batch: DataFrame, batch_id: int, store: TableStore, settings: StreamSettings) -> None:
    """All stateless outputs of one micro-batch from one parse."""
    checked = checked_events(batch, settings.check_kwargs).persist()
    try:
        valid, invalid = Q.split_checked(checked)
        enriched = enrich_orders(valid)
        n_valid = store.write("order_events", order_events_rows(enriched), "events", batch_id)
        n_invalid = write_quarantine(invalid, store, batch_id, settings)
        stamp = settings.detected_at
        quality = Q.quality_row(store.spark, n_valid, n_invalid, check_timestamp=stamp)  # what was stored, counted by the writes
        store.write("order_quality", conform(quality, S.ORDER_QUALITY_SCHEMA), "quality", batch_id)
        large = A.large_orders(enriched, settings.large_order_threshold)
        store.write("order_anomalies", A.anomalies(large=large, detected_at=stamp), "large_orders", batch_id)
        if "rapid_fire" in settings.outputs:
            write_rapid_fire(enriched, store, batch_id, settings)
    finally:
        checked.unpersist()


# ---------------------------------------------------------------------------
# Stateful aggregations
# ---------------------------------------------------------------------------
def tumbling_stream(valid: DataFrame, settings: StreamSettings) -> DataFrame:
    wm = valid.withWatermark("event_timestamp", settings.watermark)
    return W.metrics_rows(W.tumbling_metrics(wm, settings.tumbling, approx=settings.approx))


def sliding_stream(valid: DataFrame, settings: StreamSettings) -> DataFrame:
    wm = valid.withWatermark("event_timestamp", settings.watermark)
    return W.sliding_rows(W.sliding_metrics(wm, *settings.sliding, approx=settings.approx))


def spikes_stream(valid: DataFrame, settings: StreamSettings) -> DataFrame:
    wm = valid.withWatermark("event_timestamp", settings.watermark)
    return A.cancellation_spikes(wm, settings.spike_threshold, settings.spike_window)


def write_metrics_batch(batch: DataFrame, batch_id: int, store: TableStore, settings: StreamSettings) -> None:
    """Closed tumbling windows -> order_metrics, and the cancellation spikes
    among them -> order_anomalies. Spikes group by the same (window, region)
    as the metrics, so they come from these rows instead of a second
    stateful query that would read and parse the stream again."""
    rows = conform(batch, S.ORDER_METRICS_SCHEMA).persist()
    try:
        store.write("order_metrics", rows, "tumbling", batch_id)
        if settings.spike_window == settings.tumbling:
            spikes = A.spikes_from_metrics(rows, settings.spike_threshold)
            store.write("order_anomalies", A.anomalies(spikes=spikes, detected_at=settings.detected_at), "spikes",
                        batch_id)
    finally:
        rows.unpersist()


def _table_writer(store: TableStore, table: str, source: str, shape):
    def write(batch: DataFrame, batch_id: int) -> None:
        store.write(table, shape(batch), source, batch_id)

    return write


# ---------------------------------------------------------------------------
# Runner (O-73..O-76)
# ---------------------------------------------------------------------------
@dataclass
class OrderStreams:
    spark: SparkSession
    raw: DataFrame
    store: TableStore
    settings: StreamSettings = field(default_factory=StreamSettings)
    checkpoint_dir: str | None = None
    queries: list[StreamingQuery] = field(default_factory=list)

    def _checkpoint(self, name: str) -> str:
        root = self.checkpoint_dir or f"{checkpoint_root(self.spark)}/streams"
        return f"{root.rstrip('/')}/{name}"

    def _start(self, df: DataFrame, name: str, fn, mode: str = "append") -> StreamingQuery:
        q = (df.writeStream.queryName(name).outputMode(mode)
             .option("checkpointLocation", self._checkpoint(name))
             .trigger(**self.settings.trigger).foreachBatch(fn).start())
        self.queries.append(q)
        return q

    def start(self) -> list[StreamingQuery]:
        """Create missing tables, then start every query (unique names, own
        checkpoints)."""
        s, store = self.settings, self.store
        if "rapid_fire" in s.outputs and ("events" not in s.outputs or store.provider != "parquet"):
            raise ValueError("rapid_fire reads the parquet order_events table that the events output writes")
        for name in ("lifecycle", "order_state"):
            if name in s.outputs and store.provider != "parquet":
                raise ValueError(f"{name} reads its own parquet table")
        store.create_tables()
        if s.state_store == "rocksdb":
            self.spark.conf.set(STATE_PROVIDER, ROCKSDB)
            self.spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        if s.state_partitions:
            self.spark.conf.set("spark.sql.shuffle.partitions", str(int(s.state_partitions)))
        if "events" in s.outputs:
            self._start(self.raw, "order_events_batch",
                        lambda b, i: process_events_batch(b, i, store, s))
        valid = valid_event_stream(self.raw, s.check_kwargs)
        if "metrics" in s.outputs:
            self._start(tumbling_stream(valid, s), "order_metrics",
                        lambda b, i: write_metrics_batch(b, i, store, s))
            if s.spike_window != s.tumbling:
                self._start(spikes_stream(valid, s), "cancellation_spikes",
                            _table_writer(store, "order_anomalies", "spikes",
                                          lambda b: A.anomalies(spikes=b, detected_at=s.detected_at)))
        if "sliding" in s.outputs:
            self._start(sliding_stream(valid, s), "order_metrics_sliding",
                        _table_writer(store, "order_metrics_sliding", "sliding",
                                      lambda b: conform(b, S.ORDER_METRICS_SLIDING_SCHEMA)))
        if "order_state" in s.outputs:
            self._start(L.order_states(valid), "order_state", lambda b, i: L.write_states(b, i, store), "update")
        if "lifecycle" in s.outputs:
            # keyed state needs RocksDB; a query keeps what it was started with
            before = self.spark.conf.get(STATE_PROVIDER, None)
            self.spark.conf.set(STATE_PROVIDER, ROCKSDB)
            try:
                self._start(L.judged_events(valid, s.order_expiry, s.clock_slack), "order_lifecycle",
                            lambda b, i: L.write_judged(b, i, store), "update")
            finally:
                if before is None:
                    self.spark.conf.unset(STATE_PROVIDER)
                else:
                    self.spark.conf.set(STATE_PROVIDER, before)
        return self.queries

    def process_all_available(self) -> None:
        for q in self.queries:
            q.processAllAvailable()

    def await_termination(self, timeout: float | None = None) -> None:
        """Block until every query has ended (one that drains its input first
        leaves the others running), or one has failed: then the rest are
        stopped and its error is raised. At ``timeout`` all are stopped."""
        # Wait on these queries only: the session-wide awaitAnyTermination
        # also returns for queries other code ran (and stopped) earlier.
        end = None if timeout is None else time.monotonic() + timeout
        try:
            while any(q.isActive for q in self.queries) and all(q.exception() is None for q in self.queries):
                if end is not None and time.monotonic() >= end:
                    break
                time.sleep(0.5)
        finally:
            failed = [q for q in self.queries if q.exception() is not None]
            self.stop()
            if failed:
                raise RuntimeError(f"stream {failed[0].name} failed: {failed[0].exception()}")

    def run(self) -> None:
        """Start everything and block; SIGINT / SIGTERM stop all queries
        (the process then exits cleanly), a failed query stops the rest and
        its error is raised."""
        import signal

        def _stop(signum, frame):  # noqa: ARG001
            log.info("signal %s: stopping %d queries", signum, len(self.queries))
            self.stop()

        previous = {sig: signal.signal(sig, _stop) for sig in (signal.SIGINT, signal.SIGTERM)}
        try:
            self.start()
            self.await_termination()
        finally:
            for sig, handler in previous.items():
                signal.signal(sig, handler)

    def stop(self) -> None:
        for q in self.queries:
            try:
                q.stop()
            except Exception as e:  # keep stopping the others
                log.warning("stopping %s: %s", q.name, e)
