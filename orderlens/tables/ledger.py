"""Appends that a retry must not repeat (O-76): sinks that can neither
overwrite nor name what they hold, such as a Kafka topic."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass
class AppendLedger:
    """Which commits a sink has taken, as one marker folder each under
    ``root`` (a shared folder). A micro-batch that is run again after its
    append was recorded adds nothing. A crash between the append and its
    record is the one case that repeats rows: the sink gives no way to see it."""

    spark: SparkSession
    root: str

    def append_once(self, sink: str, commit: str, append: Callable[[], None]) -> bool:
        """Run ``append`` unless the sink has taken ``commit``; True if it ran."""
        jvm = self.spark.sparkContext._jvm
        marker = jvm.org.apache.hadoop.fs.Path(f"{self.root.rstrip('/')}/{sink}/{commit}")
        fs = marker.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(marker):
            return False
        append()
        fs.mkdirs(marker)
        return True
