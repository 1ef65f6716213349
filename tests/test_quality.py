import datetime as dt
import math

from orderlens.operators import quality as Q
from tests.helpers import events, ts

AS_OF = "2024-06-01 12:00:00"


def reasons(spark, rows, **kw):
    df = Q.check_events(events(spark, rows), as_of=kw.pop("as_of", AS_OF), **kw)
    return [r.quality_check_result for r in df.orderBy("event_id").collect()]


def test_reference_cases_against_now(spark):
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [
        {"event_id": "a", "ts": now, "total": 50.0},
        {"event_id": "b", "ts": now, "total": 50.0, "order_id": None},
        {"event_id": "c", "ts": now, "total": 50.0, "event_type": "invalid_type"},
        {"event_id": "d", "ts": now, "total": 999999.0, "event_type": "order_shipped"},
    ]
    df = Q.check_events(events(spark, rows))  # as_of = query time
    got = {r.event_id: r.quality_check_result for r in df.collect()}
    assert got == {"a": "valid", "b": "null_order_id", "c": "invalid_event_type", "d": "revenue_out_of_bounds"}
    valid, invalid = Q.apply_quality_checks(events(spark, rows))
    assert valid.count() == 1 and invalid.count() == 3
    assert "failure_reason" in invalid.columns and "quality_check_result" not in valid.columns


def test_rule_edges(spark):
    t = "2024-06-01 11:00:00"
    rows = [
        {"event_id": "01", "ts": t, "total": 0.0},  # created, 0 -> rule 2
        {"event_id": "02", "ts": t, "total": 0.0, "event_type": "order_shipped"},  # -> rule 4
        {"event_id": "03", "ts": t, "total": 0.01},
        {"event_id": "04", "ts": t, "total": 50000.0},
        {"event_id": "05", "ts": t, "total": 50000.01},
        {"event_id": "06", "ts": t, "total": math.nan},  # NaN above every number
        {"event_id": "07", "ts": t, "total": None},  # created without total
        {"event_id": "08", "ts": t, "total": None, "event_type": "order_shipped"},
        {"event_id": "09", "ts": t, "total": 5.0, "order_id": ""},  # empty id passes
        {"event_id": "10", "ts": t, "total": 5.0, "event_type": None},  # NULL type not rejected
        {"event_id": "11", "ts": None, "total": 5.0},  # NULL time passes
        {"event_id": "12", "ts": "2024-06-01 12:05:00", "total": 5.0},  # exactly +5 min
        {"event_id": "13", "ts": "2024-06-01 12:05:00.000001", "total": 5.0},
        {"event_id": "14", "ts": "2024-05-31 12:00:00", "total": 5.0},  # exactly -24 h
        {"event_id": "15", "ts": "2024-05-31 11:59:59.999999", "total": 5.0},
        {"event_id": "16", "ts": t, "total": 5.0, "order_id": None, "event_type": "bogus"},  # first wins
        {"event_id": "17", "ts": t, "no_payload": True},  # created, NULL payload -> rule 2
    ]
    assert reasons(spark, rows) == [
        "invalid_total_amount", "revenue_out_of_bounds", "valid", "valid", "revenue_out_of_bounds",
        "revenue_out_of_bounds", "invalid_total_amount", "valid", "valid", "valid", "valid", "valid",
        "timestamp_in_future", "valid", "timestamp_too_old", "null_order_id", "invalid_total_amount",
    ]


def test_strict_mode(spark):
    rows = [
        {"event_id": "1", "event_type": None, "ts": "2024-06-01 11:00:00", "total": 5.0},
        {"event_id": "2", "ts": None, "total": 5.0},
    ]
    assert reasons(spark, rows, strict=True) == ["null_event_type", "null_event_timestamp"]


def test_rule_list(spark):
    items_bad = [("p1", "x", 0, 1.0, 0.0)]
    items_ok = [("p1", "x", 2, 1.0, 2.0)]
    rows = [
        {"event_id": "1", "ts": "2024-06-01 11:00:00", "total": 5.0, "items": items_bad},
        {"event_id": "2", "ts": "2024-06-01 11:00:00", "total": 5.0, "items": items_ok},
        {"event_id": "3", "ts": "2024-06-01 11:00:00", "total": 60000.0, "items": None},
        {"event_id": "4", "ts": "2024-06-03 11:00:00", "total": 60000.0, "order_id": None},
    ]
    out = Q.apply_rules(events(spark, rows), as_of=AS_OF).orderBy("event_id").collect()
    assert [r.failed_rule for r in out] == ["positive_quantity", None, "reasonable_revenue", "no_null_order_ids"]
    assert [r.failure_severity for r in out] == ["critical", None, "warning", "critical"]
    assert out[3].failed_rules == ["no_null_order_ids", "reasonable_revenue", "timestamp_not_future"]
    valid, bad = Q.split_by_rules(events(spark, rows), as_of=AS_OF)
    assert valid.count() == 1 and bad.count() == 3
    valid, bad = Q.split_by_rules(events(spark, rows), as_of=AS_OF, quarantine=("critical",))
    assert valid.count() == 2


def test_contract(spark):
    uid = "123e4567-e89b-12d3-a456-426614174000"
    rows = [
        {"event_id": uid, "order_id": uid, "ts": "2024-06-01 11:00:00", "total": 5.0, "payment": "paypal",
         "items": [("p", "n", 1, 1.0, 1.0)]},
        {"event_id": "x", "order_id": uid, "ts": "2024-06-01 11:00:00", "total": -1.0, "payment": "cash",
         "items": [("p", None, 0, -1.0, 1.0)]},
    ]
    out = Q.contract_violations(events(spark, rows)).orderBy("event_id").collect()
    assert out[0].contract_violations == []
    assert out[1].contract_violations == [
        "event_id_not_uuid", "item_field_missing", "item_quantity_below_1", "item_price_negative",
        "total_negative", "payment_method_not_allowed",
    ]


def test_contract_tells_malformed_from_missing_timestamps(spark):
    import json

    from orderlens import schemas as S
    from orderlens.operators.parse import parse_events

    bodies = [{"timestamp": t} if t != "absent" else {} for t in ("2024-01-01T10:00:00Z", "2024-01-01", "10:00", "soon", None, "absent")]
    raw = spark.createDataFrame([(b"k", json.dumps(b).encode(), "t", 0, i, None) for i, b in enumerate(bodies)], S.RAW_SCHEMA)
    got = Q.contract_violations(parse_events(raw)).orderBy("kafka_offset").collect()
    found = [[v for v in r.contract_violations if "timestamp" in v] for r in got]
    assert found == [[], ["timestamp_malformed"], ["timestamp_malformed"], ["timestamp_malformed"], ["missing_timestamp"], ["missing_timestamp"]]


def test_items_total(spark):
    rows = [
        {"event_id": "1", "total": 3.0, "items": [("a", "A", 1, 1.0, 1.0), ("b", "B", 1, 2.0, 2.0)]},
        {"event_id": "2", "total": 3.5, "items": [("a", "A", 1, 1.0, 1.0), ("b", "B", 1, 2.0, 2.0)]},
        {"event_id": "3", "total": 0.0, "items": [("a", "A", 0, 0.0, 0.0)]},
        {"event_id": "4", "total": 3.5, "event_type": "order_shipped", "items": [("a", "A", 1, 1.0, 1.0)]},
    ]
    got = [r.event_id for r in Q.items_total_mismatch(events(spark, rows)).orderBy("event_id").collect()]
    assert got == ["2", "3"]


def test_reconcile_order_lines_hot_order(spark):
    # one order holds most lines: pre-aggregation keeps the result exact
    lines = [("ORD-1", i, 1, 1.0, 1.0) for i in range(3000)] + [("ORD-2", 0, 1, 5.0, 5.0)]
    lines_df = spark.createDataFrame(lines, "order_id string, line int, quantity int, unit_price double, subtotal double")
    heads = spark.createDataFrame([("ORD-1", "c", 3000.0), ("ORD-2", "c", 4.0), ("ORD-3", "c", 1.0)],
                                  "order_id string, customer_id string, total_amount double")
    out = {r.order_id: r for r in Q.reconcile_order_lines(heads, lines_df).collect()}
    assert set(out) == {"ORD-2", "ORD-3"}
    assert out["ORD-3"].line_count == 0 and out["ORD-3"].items_total == 0.0


def test_quality_metrics_and_empty_batch(spark):
    rows = [{"event_id": str(i), "ts": "2024-06-01 11:00:00", "total": 5.0 if i else None} for i in range(4)]
    checked = Q.check_events(events(spark, rows), as_of=AS_OF)
    m = Q.quality_metrics(checked, check_timestamp=AS_OF).first()
    assert (m.records_checked, m.records_valid, m.records_invalid, m.quarantine_rate) == (4, 3, 1, 0.25)
    empty = Q.quality_metrics(checked.limit(0), check_timestamp=AS_OF).first()
    assert empty.records_checked == 0 and empty.quarantine_rate is None
    assert Q.quarantine_alerts(Q.quality_metrics(checked, check_timestamp=AS_OF)).count() == 1


def test_quarantine_round_trip_and_replay(spark):
    raw = spark.createDataFrame(
        [
            (b"ORD-9", b'{"event_id":"e1","event_type":"order_created","customer_id":"c",'
                       b'"timestamp":"2024-06-01T11:00:00+00:00","payload":{"total_amount":10.0}}',
             "t", 0, 1, ts("2024-06-01 11:00:00")),
            (b"ORD-8", b"{broken", "t", 0, 2, ts("2024-06-01 11:00:00")),
        ],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp",
    )
    from orderlens.operators.parse import parse_events

    checked = Q.check_events(parse_events(raw), as_of=AS_OF)
    _, invalid = Q.split_checked(checked)
    msgs = Q.quarantine_messages(invalid)
    assert sorted(r.key or "NULL" for r in msgs.collect()) == ["NULL", "NULL"]
    replayed = Q.replay_quarantine(msgs, repair=Q.order_id_from_key, strict=True, as_of=AS_OF)
    rows = replayed.collect()
    assert [(r.event_id, r.order_id, r.previous_failure_reason) for r in rows] == [("e1", "ORD-9", "null_order_id")]
    # without the repair nothing comes back; malformed stays quarantined
    assert Q.replay_quarantine(msgs, strict=True, as_of=AS_OF).count() == 0


def test_observed_quality_metrics(spark):
    from pyspark.sql import Observation

    rows = [{"event_id": str(i), "ts": "2024-06-01 11:00:00", "total": 5.0 if i % 3 else None} for i in range(9)]
    obs = Observation("quality")
    checked = Q.observe_quality(Q.check_events(events(spark, rows), as_of=AS_OF), obs)
    # a later filter does not hide rows from the observation: it sits below it
    assert checked.filter("quality_check_result = 'valid'").count() == 6
    assert obs.get == {"records_checked": 9, "records_valid": 6, "records_invalid": 3}
