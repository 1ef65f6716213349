"""Shared helpers: durable intermediate results, connected components."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which driver and
    executors share. A local session that names none gets a fresh one; a
    cluster session without it is an error."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        root = tempfile.mkdtemp(prefix="llm-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder: later uses read it
    back and a lost executor costs no recomputation beyond it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Like ``saved``, as a Parquet table of its own under ``llm-tables`` in
    the shared folder: smaller than a checkpoint and read by column. The
    folder is left to its owner to clear once the result is written."""
    path = f"{shared_folder(df.sparkSession)}/llm-tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a long, b long) as (id, root): every
    node that has an edge to another node, with the smallest id it reaches.

    Alternates two star contractions until nothing changes. Each round is two
    grouped minima joined back to the edges, so a hot node is a skewed join
    side (split by AQE), never a collected group. Self loops and nulls are
    ignored; no edges give no rows."""
    e = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = saved(e)
    before = None
    for _ in range(max_rounds):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        e = saved(small)
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    return e.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("id"), F.col("b").alias("root"))).distinct()


def ship(spark: SparkSession) -> SparkSession:
    """Give the Python workers this subpackage (once a context), so that it
    need not be installed on them."""
    sc = spark.sparkContext
    if not any(name.endswith("_llm.zip") for name in sc.listFiles):
        here = pathlib.Path(__file__).resolve().parent
        target = pathlib.Path(tempfile.mkdtemp()) / f"{here.parent.name}_llm.zip"
        with zipfile.ZipFile(target, "w") as z:
            z.writestr(zipfile.ZipInfo(f"{here.parent.name}/"), "")
            z.writestr(zipfile.ZipInfo(f"{here.parent.name}/llm/"), "")
            for f in sorted(here.glob("*.py")):
                z.write(f, f"{here.parent.name}/llm/{f.name}")
        sc.addPyFile(str(target))
    return spark
