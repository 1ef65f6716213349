"""Batch plans over the driver tables.

The fixed check parameters below make results deterministic (no wall clock):
the data spans 2024-01-01..30, so the age rule uses 31 days instead of the
streaming default of 24 hours (which would reject nearly every row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlens.operators.enrich import enrich_orders
from orderlens.operators.quality import check_events, split_checked
from orderlens.sources.testdata import order_events

# Fixed values of the deterministic batch runs.
AS_OF = "2024-01-31 00:00:00"
MAX_AGE = "31 days"
FUTURE_TOLERANCE = "5 minutes"
CHECK_ARGS = {"as_of": AS_OF, "max_age": MAX_AGE, "future_tolerance": FUTURE_TOLERANCE}


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter events with ``quality_check_result``."""
    return check_events(order_events(spark, sf_dir), **CHECK_ARGS)


def valid_and_invalid(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split_checked(checked(spark, sf_dir))


def valid_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid events with the enrichment columns: the input of every
    window, anomaly, lifecycle and monitoring query."""
    valid, _ = valid_and_invalid(spark, sf_dir)
    return enrich_orders(valid)
