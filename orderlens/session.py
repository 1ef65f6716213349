"""Session helpers: time zone, AQE and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library relies on. UTC matters: hour and
# day-of-week of an instant depend on the session time zone.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # A filter on a parsed field is pushed below the parse; with per-field
    # schema pruning every pushed copy re-parses the JSON text. Without it,
    # the copies are the same expression and codegen evaluates it once.
    "spark.sql.optimizer.enableJsonExpressionOptimization": "false",
    # A whole-stage method above 8000 bytes of bytecode is never JIT-compiled
    # by HotSpot and runs interpreted (2-3x slower on the wide event
    # projections); such stages fall back to per-operator code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

def pin_session(spark: SparkSession) -> SparkSession:
    """The one setting that results depend on, in a session a caller built;
    settings that only affect speed stay as the caller has them."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "orderlens",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's base settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession, allow_local_fallback: bool = False) -> str:
    """Shared folder for checkpoints and written tables.

    Read from ``spark.checkpoint.dir`` (a cluster names a shared, durable
    folder there). Only when it is unset and ``allow_local_fallback`` is
    true (tests, local runs) is a fresh local folder created and set.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir")
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # unset SQL-side
            root = None
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current.rstrip("/")
        if not allow_local_fallback:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder"
            )
        root = tempfile.mkdtemp(prefix="orderlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")
