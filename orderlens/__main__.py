"""The pipeline as a program: ``python -m orderlens --checkpoint-dir DIR``
creates the tables and runs every stream until it is stopped (or, with
``--available-now``, until the input is drained)."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from orderlens import schemas as S
from orderlens.session import build_session, pin_session
from orderlens.sources.raw import kafka_options, read_raw_files, read_raw_kafka
from orderlens.streaming.jobs import OrderStreams, StreamSettings
from orderlens.tables.store import TableStore


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="orderlens", description=__doc__)
    p.add_argument("--checkpoint-dir", required=True, help="shared, durable folder for stream checkpoints and tables")
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--brokers", help="Kafka bootstrap servers")
    source.add_argument("--files", help="folder or glob of raw message files")
    p.add_argument("--topic", default=S.DEFAULT_TOPIC)
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--format", default="parquet", choices=("parquet", "json", "text"), help="of --files")
    p.add_argument("--provider", default="parquet", choices=("parquet", "iceberg"))
    p.add_argument("--catalog", default="orders", help="Iceberg catalog")
    p.add_argument("--trigger", default="10 seconds")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--max-age", default=S.MAX_EVENT_AGE, help="older events are quarantined")
    p.add_argument("--outputs", default="events,metrics,sliding", help="also: rapid_fire, lifecycle, order_state")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> TableStore:
    a = arguments().parse_args(argv)
    spark = pin_session(spark or build_session(conf={"spark.checkpoint.dir": a.checkpoint_dir}))
    if a.files:
        raw = read_raw_files(spark, a.files, fmt=a.format, topic=a.topic)
    else:
        raw = read_raw_kafka(spark, kafka_options(a.brokers, a.topic, a.starting_offsets))
    trigger = {"availableNow": True} if a.available_now else {"processingTime": a.trigger}
    root = a.checkpoint_dir.rstrip("/")
    store = TableStore(spark, root=f"{root}/tables", provider=a.provider, catalog=a.catalog)
    settings = StreamSettings(trigger=trigger, check_kwargs={"max_age": a.max_age}, outputs=tuple(a.outputs.split(",")))
    OrderStreams(spark, raw, store, settings, checkpoint_dir=f"{root}/streams").run()
    return store


if __name__ == "__main__":
    main()
