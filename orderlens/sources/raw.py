"""Raw message sources (O-01 Kafka, O-02 files), batch or streaming.

Every source yields the Kafka record shape (key, value, topic, partition,
offset, timestamp); the parser does not care which one it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens import schemas as S


def kafka_options(
    bootstrap_servers: str,
    topic: str = S.DEFAULT_TOPIC,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = False,
    extra: dict | None = None,
) -> dict[str, str]:
    """Options of the Kafka source, without a rate limit unless the caller
    sets one (a backlog must not age past the quality rules). Credentials and security settings go in
    ``extra`` (``kafka.``-prefixed), taken from configuration, never code."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    opts.update(extra or {})
    return opts


def read_raw_kafka(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """O-01: Kafka records. Needs the spark-sql-kafka connector on the class
    path; without it Spark raises when the query is defined."""
    reader = spark.readStream if streaming else spark.read
    opts = dict(options)
    if not streaming:
        opts.pop("maxOffsetsPerTrigger", None)
        if opts.get("startingOffsets") == "latest":
            raise ValueError("a batch read cannot start at 'latest': name 'earliest' or explicit offsets")
    return reader.format("kafka").options(**opts).load().select(*S.RAW_SCHEMA.fieldNames())


def read_raw_files(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    streaming: bool = True,
    max_files_per_trigger: int | None = None,
    topic: str = S.DEFAULT_TOPIC,
) -> DataFrame:
    """O-02: raw messages from files.

    ``parquet`` / ``json``: files already in the record shape. ``text``:
    one JSON message body per line (an event dump); key, partition and
    offset are NULL and the broker time is the read time.
    """
    reader = spark.readStream if streaming else spark.read
    if max_files_per_trigger and streaming:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if fmt == "text":
        lines = reader.format("text").load(path)
        return lines.select(
            F.lit(None).cast("binary").alias("key"),
            F.col("value").cast("binary").alias("value"),
            F.lit(topic).alias("topic"),
            F.lit(None).cast("int").alias("partition"),
            F.lit(None).cast("long").alias("offset"),
            F.current_timestamp().alias("timestamp"),
        )
    return reader.format(fmt).schema(S.RAW_SCHEMA).load(path)
