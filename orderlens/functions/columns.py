"""Column builders shared by the operators.

Everything here returns a ``Column`` made of built-in functions, so it stays
inside whole-stage codegen and works the same in batch and in streaming.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import schemas as S


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def timestamp_type_of(df: DataFrame, column: str) -> T.DataType:
    """Data type of a (possibly nested) timestamp column of ``df``."""
    return df.select(F.col(column)).schema.fields[0].dataType


def as_of_column(as_of, like: T.DataType | None = None) -> Column:
    """Reference instant for time rules.

    ``None`` means the query's start time (``current_timestamp()``, fixed per
    micro-batch), never a driver clock frozen when the plan was built. A
    string or datetime is taken as UTC. ``like`` casts to the event column's
    type (TIMESTAMP or TIMESTAMP_NTZ) so the comparison needs no zone shift.
    """
    if as_of is None:
        c = F.current_timestamp()
    elif isinstance(as_of, Column):
        c = as_of
    elif isinstance(as_of, _dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(_dt.timezone.utc)
        c = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    else:
        c = F.lit(str(as_of)).cast("timestamp_ntz")
    if like is not None:
        c = c.cast(like)
    return c


def parse_iso_timestamp(c: Column | str) -> Column:
    """ISO-8601 text to an instant; NULL for text that does not parse.

    Accepts with and without fraction, ``+00:00`` and ``Z`` offsets. Date,
    ``T`` and time must all be there: the cast alone would take a bare time
    for today and a bare year for 1 January. A
    fixed pattern with a mandatory fraction would reject whole-second
    timestamps (and raise under ANSI mode).
    """
    text = col_of(c)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}"), F.try_to_timestamp(text))


def revenue_bucket(total: Column | str) -> Column:
    total = col_of(total)
    expr = F.when(total.isNull(), F.lit(S.REVENUE_BUCKET_UNKNOWN))
    for bound, label in S.REVENUE_BUCKETS:
        expr = expr.when(total < bound, F.lit(label))
    return expr.otherwise(F.lit(S.REVENUE_BUCKET_TOP))


def is_weekend(ts: Column | str) -> Column:
    """Saturday or Sunday (dayofweek 7 or 1); False when the time is NULL."""
    return F.coalesce(F.dayofweek(col_of(ts)).isin(1, 7), F.lit(False))


def lifecycle_status(event_type: Column | str = "event_type") -> Column:
    """Status an event moves its order to; NULL keeps the previous status."""
    et = col_of(event_type)
    expr = None
    for name, status in S.STATUS_BY_EVENT.items():
        if status is None:
            continue
        expr = (F.when if expr is None else expr.when)(et == name, F.lit(status))
    return expr


def interval(text: str) -> Column:
    return F.expr(f"INTERVAL {_interval_sql(text)}")


def _interval_sql(text: str) -> str:
    amount, unit = text.split()
    return f"'{amount}' {unit.rstrip('s').upper()}"


def interval_seconds(text: str) -> int:
    amount, unit = text.split()
    unit = unit.rstrip("s").lower()
    factor = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}[unit]
    return int(amount) * factor


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ column."""
    return F.unix_micros(col_of(ts).cast("timestamp"))
