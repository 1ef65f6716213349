"""Sink projections: rows in the shape of each output table (O-03..O-07)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import schemas as S


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df`` to exactly the columns of ``schema``.

    TIMESTAMP columns accept TIMESTAMP_NTZ input (batch adapter data) and
    are cast with the session time zone (UTC)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def order_events_rows(enriched: DataFrame) -> DataFrame:
    """O-03: enriched events as order_events rows; the payload is stored as
    JSON text. When the raw message is at hand its payload object is kept
    verbatim, so fields the parse schema does not know survive (schema
    evolution by the producers); otherwise the parsed struct is serialized."""
    text = F.to_json("payload")
    if "raw_value" in enriched.columns:
        text = F.coalesce(F.get_json_object("raw_value", "$.payload"), text)
    return conform(enriched.withColumn("payload", text), S.ORDER_EVENTS_SCHEMA)


def not_null_violation(schema: T.StructType) -> Column:
    """TRUE when a row has NULL in a column the table declares NOT NULL.

    Parquet tables do not enforce NOT NULL, so writers route such rows to
    quarantine instead of storing them (or failing the whole batch)."""
    conds = [F.col(f.name).isNull() for f in schema.fields if not f.nullable]
    # Only the NOT NULL columns are read, so a frame in another shape with
    # the same column names (the parsed events) can be checked too.
    out = F.lit(False)
    for c in conds:
        out = out | c
    return out

