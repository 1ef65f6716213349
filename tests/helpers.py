"""Build parsed-shape event frames from plain Python rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from orderlens import schemas as S

EVENT_ROW = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("event_timestamp", T.TimestampType()),
        T.StructField("payload", S.PAYLOAD_TYPE),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("processing_time", T.TimestampType()),
    ]
)

PAYLOAD_FIELDS = S.PAYLOAD_TYPE.fieldNames()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def payload(total=None, province=None, city=None, items=None, payment=None, status=None, currency="EUR"):
    address = None if province is None and city is None else (None, city, province, None, "ES")
    return (items, total, currency, address, payment, status, None, None, None, None)


def events(spark, rows: list[dict]):
    """rows: dicts with any of event_id, event_type, order_id, customer_id,
    ts (str), total, province, city, items, payment, offset, processing."""
    out = []
    for i, r in enumerate(rows):
        when = r.get("ts")
        out.append(
            (
                r.get("event_id", f"e{i:05d}"),
                r.get("event_type", "order_created"),
                r.get("order_id", f"o{i}"),
                r.get("customer_id", "c1"),
                ts(when) if isinstance(when, str) else when,
                payload(r.get("total"), r.get("province"), r.get("city"), r.get("items"), r.get("payment"),
                        r.get("status")) if not r.get("no_payload") else None,
                r.get("offset", i),
                ts(r["processing"]) if r.get("processing") else None,
            )
        )
    return spark.createDataFrame(out, EVENT_ROW)
