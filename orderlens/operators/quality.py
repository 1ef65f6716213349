"""Data quality: validity split (O-12), rule lists (O-13), the event contract
(O-14), item/total reconciliation (O-15), quality metrics (O-33), quarantine
alerts (O-17), quarantine messages (O-07) and replay (O-18).

All checks are single projections or filters of built-in expressions; the
metrics are one conditional aggregate (partial aggregation map-side, no join).
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens import schemas as S
from orderlens.functions.columns import as_of_column, interval, timestamp_type_of

VALID = "valid"

# Reasons, in evaluation order (first match wins).
REASONS = (
    "null_order_id",
    "invalid_total_amount",
    "invalid_event_type",
    "revenue_out_of_bounds",
    "timestamp_in_future",
    "timestamp_too_old",
)


def _time_bounds(df: DataFrame, as_of, future_tolerance: str, max_age: str, ts: str):
    ref = as_of_column(as_of, like=timestamp_type_of(df, ts))
    return ref + interval(future_tolerance), ref - interval(max_age)


def quality_reason(
    df: DataFrame,
    as_of=None,
    max_age: str = S.MAX_EVENT_AGE,
    future_tolerance: str = S.FUTURE_TOLERANCE,
    strict: bool = False,
    ts: str = "event_timestamp",
) -> Column:
    """First failing reason of an event, or 'valid'.

    Three-valued logic is kept: a NULL event_type is not rejected by the
    type rule and a NULL timestamp passes both time rules. ``strict=True``
    adds malformed_json, null_event_type and null_event_timestamp, which
    the sink's NOT NULL columns would otherwise reject later.
    """
    total = F.col("payload.total_amount")
    event_type = F.col("event_type")
    latest, earliest = _time_bounds(df, as_of, future_tolerance, max_age, ts)
    chain = None

    def add(cond: Column, reason: str):
        nonlocal chain
        chain = (F.when if chain is None else chain.when)(cond, F.lit(reason))

    if strict and "raw_value" in df.columns:
        add(F.col("raw_value").isNotNull() & F.col("event_id").isNull() & event_type.isNull()
            & F.col("customer_id").isNull() & F.col("payload").isNull(), "malformed_json")
    add(F.col("order_id").isNull(), "null_order_id")
    add((event_type == "order_created") & (total.isNull() | (total <= 0)), "invalid_total_amount")
    add(~event_type.isin(*S.VALID_EVENT_TYPES), "invalid_event_type")
    add(total.isNotNull() & ((total < S.MIN_REVENUE) | (total > S.MAX_REVENUE)), "revenue_out_of_bounds")
    add(F.col(ts) > latest, "timestamp_in_future")
    add(F.col(ts) < earliest, "timestamp_too_old")
    if strict:
        add(event_type.isNull(), "null_event_type")
        add(F.col(ts).isNull(), "null_event_timestamp")
    return chain.otherwise(F.lit(VALID))


def check_events(df: DataFrame, **kwargs) -> DataFrame:
    """``df`` plus ``quality_check_result`` (a reason or 'valid')."""
    return df.withColumn("quality_check_result", quality_reason(df, **kwargs))


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    valid = checked.filter(F.col("quality_check_result") == VALID).drop("quality_check_result")
    invalid = checked.filter(F.col("quality_check_result") != VALID).withColumnRenamed(
        "quality_check_result", "failure_reason"
    )
    return valid, invalid


def apply_quality_checks(df: DataFrame, **kwargs) -> tuple[DataFrame, DataFrame]:
    """O-12: (valid, invalid); invalid carries ``failure_reason``.

    When both outputs are consumed, persist the checked frame (as the
    streaming ``foreachBatch`` does) so the source is parsed once.
    """
    return split_checked(check_events(df, **kwargs))


# ---------------------------------------------------------------------------
# O-13 rule lists
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Rule:
    """One declarative check. ``check`` is one of not_null, greater_than,
    in_list, between, not_future, not_older_than."""

    name: str
    field: str
    check: str
    severity: str = "critical"
    value: float | None = None
    values: tuple = ()
    min: float | None = None
    max: float | None = None
    tolerance_seconds: int = 0
    max_age_seconds: int = 0


# Logical field -> column. Item fields are checked over every element of
# payload.items (the rule fails if any item fails).
FIELD_COLUMNS = {
    "event_id": "event_id",
    "event_type": "event_type",
    "order_id": "order_id",
    "customer_id": "customer_id",
    "timestamp": "event_timestamp",
    "total_amount": "payload.total_amount",
    "currency": "payload.currency",
    "payment_method": "payload.payment_method",
}
ITEM_FIELDS = ("product_id", "product_name", "quantity", "unit_price", "subtotal")

# Fixed rule list: the documented quality rules plus the age rule the
# streaming check applies (24 hours).
DEFAULT_RULES = (
    Rule("no_null_order_ids", "order_id", "not_null", "critical"),
    Rule("positive_quantity", "quantity", "greater_than", "critical", value=0),
    Rule("valid_event_type", "event_type", "in_list", "critical", values=S.VALID_EVENT_TYPES),
    Rule("reasonable_revenue", "total_amount", "between", "warning", min=0.01, max=50000.00),
    Rule("timestamp_not_future", "timestamp", "not_future", "warning", tolerance_seconds=300),
    Rule("timestamp_not_too_old", "timestamp", "not_older_than", "warning", max_age_seconds=86400),
)


def with_max_age(rules, max_age_seconds: int):
    """The rule list with every not_older_than rule set to a new age."""
    return tuple(replace(r, max_age_seconds=max_age_seconds) if r.check == "not_older_than" else r for r in rules)


def _rule_fails(rule: Rule, value: Column, ref: Column) -> Column:
    if rule.check == "not_null":
        return value.isNull()
    if rule.check == "greater_than":
        return value <= F.lit(rule.value)
    if rule.check == "in_list":
        return ~value.isin(*rule.values)
    if rule.check == "between":
        return (value < F.lit(rule.min)) | (value > F.lit(rule.max))
    if rule.check == "not_future":
        return value > ref + F.expr(f"INTERVAL {int(rule.tolerance_seconds)} SECONDS")
    if rule.check == "not_older_than":
        return value < ref - F.expr(f"INTERVAL {int(rule.max_age_seconds)} SECONDS")
    raise ValueError(f"unknown check kind {rule.check!r}")


def rule_failure(rule: Rule, ref: Column) -> Column:
    """TRUE when the rule definitely fails; unknown (NULL) counts as pass,
    except for not_null."""
    if rule.field in ITEM_FIELDS:
        cond = F.exists("payload.items", lambda x: _rule_fails(rule, x[rule.field], ref))
    else:
        cond = _rule_fails(rule, F.col(FIELD_COLUMNS.get(rule.field, rule.field)), ref)
    return F.coalesce(cond, F.lit(False))


def apply_rules(df: DataFrame, rules=DEFAULT_RULES, as_of=None, ts: str = "event_timestamp") -> DataFrame:
    """Adds ``failed_rule`` / ``failure_severity`` (first failing rule, list
    order) and ``failed_rules`` (all failing rules)."""
    ref = as_of_column(as_of, like=timestamp_type_of(df, ts))
    fails = [(r, rule_failure(r, ref)) for r in rules]
    first_name = first_sev = None
    for r, cond in fails:
        first_name = (F.when if first_name is None else first_name.when)(cond, F.lit(r.name))
        first_sev = (F.when if first_sev is None else first_sev.when)(cond, F.lit(r.severity))
    every = F.array_compact(F.array(*[F.when(cond, F.lit(r.name)) for r, cond in fails]))
    return df.withColumns({"failed_rule": first_name, "failure_severity": first_sev, "failed_rules": every})


def split_by_rules(df: DataFrame, rules=DEFAULT_RULES, as_of=None, quarantine=("critical", "warning")):
    """(valid, quarantined) under a rule list; severities in ``quarantine``
    send the event to quarantine (both do by default, as the coded checks)."""
    ruled = apply_rules(df, rules, as_of)
    bad = F.col("failure_severity").isin(*quarantine)
    return ruled.filter(~F.coalesce(bad, F.lit(False))), ruled.filter(bad)


# ---------------------------------------------------------------------------
# O-14 event contract
# ---------------------------------------------------------------------------
UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def contract_clauses(timestamp_text: Column | None = None) -> list[tuple[str, Column]]:
    """(clause, violated?) for the published event contract, in order.
    ``timestamp_text``: the timestamp as the message has it; with it a
    date-time that does not parse is told from one that is missing."""
    p = "payload"
    no_time = F.col("event_timestamp").isNull()
    given = timestamp_text.isNotNull() if timestamp_text is not None else F.lit(False)
    items = F.col(f"{p}.items")
    pm = F.col(f"{p}.payment_method")
    cur = F.col(f"{p}.currency")
    return [
        ("missing_event_id", F.col("event_id").isNull()),
        ("missing_event_type", F.col("event_type").isNull()),
        ("missing_order_id", F.col("order_id").isNull()),
        ("missing_customer_id", F.col("customer_id").isNull()),
        ("missing_timestamp", no_time & ~given),
        ("timestamp_malformed", no_time & given),
        ("missing_payload", F.col(p).isNull()),
        ("event_id_not_uuid", ~F.col("event_id").rlike(UUID_PATTERN)),
        ("order_id_not_uuid", ~F.col("order_id").rlike(UUID_PATTERN)),
        ("event_type_not_allowed", ~F.col("event_type").isin(*S.VALID_EVENT_TYPES)),
        ("item_field_missing", F.exists(items, lambda x: x.product_id.isNull() | x.product_name.isNull()
                                        | x.quantity.isNull() | x.unit_price.isNull() | x.subtotal.isNull())),
        ("item_quantity_below_1", F.exists(items, lambda x: x.quantity < 1)),
        ("item_price_negative", F.exists(items, lambda x: (x.unit_price < 0) | (x.subtotal < 0))),
        ("total_negative", F.col(f"{p}.total_amount") < 0),
        ("currency_not_eur", cur != S.CONTRACT_CURRENCY),
        ("payment_method_not_allowed", ~pm.isin(*S.PAYMENT_METHODS)),
    ]


def contract_violations(df: DataFrame) -> DataFrame:
    """Adds ``contract_violations``: array of violated clause names. The
    timestamp's text is taken from ``raw_value`` where the events carry it."""
    text = F.get_json_object("raw_value", "$.timestamp") if "raw_value" in df.columns else None
    arr = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in contract_clauses(text)]))
    return df.withColumn("contract_violations", arr)


# ---------------------------------------------------------------------------
# O-15 items versus totals
# ---------------------------------------------------------------------------
def items_total_mismatch(df: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """order_created events whose items do not add up to the total, or that
    hold an item with quantity <= 0 or unit price <= 0. Row-wise over the
    nested array (no shuffle)."""
    items = F.col("payload.items")
    items_sum = F.aggregate(items, F.lit(0.0), lambda acc, x: acc + F.coalesce(x.subtotal, F.lit(0.0)))
    bad_items = F.size(F.filter(items, lambda x: (x.quantity <= 0) | (x.unit_price <= 0)))
    out = df.filter(F.col("event_type") == "order_created").withColumns(
        {"items_total": F.round(items_sum, 2), "bad_item_count": F.coalesce(bad_items, F.lit(0))}
    )
    diff = F.abs(F.col("items_total") - F.col("payload.total_amount"))
    return out.filter((diff >= tolerance) | (F.col("bad_item_count") > 0))


def reconcile_order_lines(headers: DataFrame, lines: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """O-15 over flat order lines (the scalable form for line tables).

    Lines are pre-aggregated per order (partial aggregation map-side, so an
    order with very many lines never travels as one group) and then joined
    1:1 to the order headers. Orders without lines count a sum of 0.
    """
    per_order = lines.groupBy("order_id").agg(
        F.sum("subtotal").alias("items_total_raw"),
        F.count("*").alias("line_count"),
        F.count_if((F.col("quantity") <= 0) | (F.col("unit_price") <= 0)).alias("bad_item_count"),
    )
    joined = headers.join(per_order, "order_id", "left").select(
        "order_id",
        "customer_id",
        "total_amount",
        F.round(F.coalesce("items_total_raw", F.lit(0.0)), 2).alias("items_total"),
        F.coalesce("line_count", F.lit(0)).alias("line_count"),
        F.coalesce("bad_item_count", F.lit(0)).alias("bad_item_count"),
    )
    diff = F.abs(F.col("items_total") - F.col("total_amount"))
    return joined.filter((diff >= tolerance) | (F.col("bad_item_count") > 0))


# ---------------------------------------------------------------------------
# O-33 quality metrics, O-17 alert
# ---------------------------------------------------------------------------
def quality_metrics(checked: DataFrame, check_timestamp=None, by: list | None = None) -> DataFrame:
    """records_checked / valid / invalid and quarantine_rate in one pass.

    ``checked`` carries ``quality_check_result``. Without ``by`` this is one
    row (per micro-batch in streaming); ``by`` groups, e.g. by a batch id.
    An empty input gives rate NULL instead of a division error.
    """
    valid = F.col("quality_check_result") == VALID
    aggs = [
        F.count("*").alias("records_checked"),
        F.count_if(valid).alias("records_valid"),
        F.count_if(~valid).alias("records_invalid"),
    ]
    out = checked.groupBy(*(by or [])).agg(*aggs)
    ts = as_of_column(check_timestamp) if check_timestamp is not None else F.current_timestamp()
    return out.withColumns(
        {
            "check_timestamp": ts,
            "quarantine_rate": F.round(F.try_divide(F.col("records_invalid"), F.col("records_checked")), 4),
        }
    )


def quality_row(spark: SparkSession, valid: int, invalid: int, check_timestamp=None) -> DataFrame:
    """The row of ``quality_metrics`` from counts that are known already: a
    micro-batch's writes report how many events they stored."""
    ts = as_of_column(check_timestamp) if check_timestamp is not None else F.current_timestamp()
    checked = F.lit(valid + invalid).cast("long")
    return spark.range(1).select(
        ts.alias("check_timestamp"), checked.alias("records_checked"), F.lit(valid).cast("long").alias("records_valid"),
        F.lit(invalid).cast("long").alias("records_invalid"),
        F.round(F.try_divide(F.lit(invalid).cast("long"), checked), 4).alias("quarantine_rate"))


def observe_quality(checked: DataFrame, observation="order_quality") -> DataFrame:
    """O-33 without an extra pass: the counts ride along as observed metrics
    of whatever action consumes ``checked``. On a stream they appear per
    micro-batch in ``StreamingQueryProgress.observedMetrics`` under the
    given name; in batch pass a ``pyspark.sql.Observation`` and read
    ``observation.get`` after the action."""
    valid = F.col("quality_check_result") == VALID
    return checked.observe(
        observation,
        F.count(F.lit(1)).alias("records_checked"),
        F.count_if(valid).alias("records_valid"),
        F.count_if(~valid).alias("records_invalid"),
    )


def quarantine_alerts(quality: DataFrame, threshold: float = S.QUARANTINE_ALERT_RATE) -> DataFrame:
    """Quality rows whose quarantine rate is above the threshold (strict)."""
    return quality.filter(F.col("quarantine_rate") > threshold)


# ---------------------------------------------------------------------------
# O-07 quarantine messages, O-18 replay
# ---------------------------------------------------------------------------
def quarantine_messages(invalid: DataFrame) -> DataFrame:
    """Kafka-shaped quarantine records: key = order_id, value = the whole
    invalid row as JSON (with ``failure_reason`` and ``raw_value``)."""
    return invalid.select(
        F.col("order_id").cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in invalid.columns])).alias("value"),
    )


def quarantine_rows(invalid: DataFrame, quarantined_at=None) -> DataFrame:
    """Quarantine records as order_quarantine rows."""
    return invalid.select(
        F.col("order_id").cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in invalid.columns])).alias("value"),
        "failure_reason",
        F.col("event_timestamp").cast("timestamp").alias("event_timestamp"),
        as_of_column(quarantined_at).cast("timestamp").alias("quarantined_at"),
    )


# What a replay needs of the row stored in a quarantine record.
QUARANTINED_FIELDS = ("message_key STRING, raw_value STRING, kafka_topic STRING, kafka_partition INT, "
                      "kafka_offset BIGINT, kafka_timestamp TIMESTAMP, failure_reason STRING")


def replay_quarantine(
    quarantined: DataFrame,
    repair: Callable[[DataFrame], DataFrame] | None = None,
    **check_kwargs,
) -> DataFrame:
    """Re-run parse + checks on quarantined records; emit the rows now valid.

    ``quarantined`` holds quarantine records (key, value JSON). The original
    message text is re-parsed, so fields lost by the first parse come back;
    ``repair`` may fix rows before the checks (e.g. take a missing order id
    from the message key).
    """
    from orderlens.operators.parse import parse_events

    raw = quarantined.select(F.from_json("value", QUARANTINED_FIELDS).alias("row")).select(
        F.col("row.message_key").cast("binary").alias("key"),
        F.col("row.raw_value").cast("binary").alias("value"),
        F.col("row.kafka_topic").alias("topic"),
        F.col("row.kafka_partition").alias("partition"),
        F.col("row.kafka_offset").alias("offset"),
        F.col("row.kafka_timestamp").alias("timestamp"),
        F.col("row.failure_reason").alias("previous_failure_reason"),
    )
    reparsed = parse_events(raw, carry=("previous_failure_reason",))
    if repair is not None:
        reparsed = repair(reparsed)
    valid, _ = apply_quality_checks(reparsed, **check_kwargs)
    return valid


def order_id_from_key(df: DataFrame) -> DataFrame:
    """Replay repair: a missing order id is taken from the message key
    (producers key each message by its order id)."""
    return df.withColumn("order_id", F.coalesce(F.col("order_id"), F.col("message_key")))
