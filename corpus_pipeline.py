"""Corpus pipeline: documents judged by the quality classifier, one document
kept of each near-duplicate group, repeated passages cut out, and what is left
packed into token sequences. Each stage works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import ngram_join, packing, quality, substring
from orderlens.llm.common import ship, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives at least 0.5; it learns from the
    labels of its training fold. Texts that are null or empty are scored like
    any other. Columns stay as they are, one named score included."""
    labels = ship(spark).read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    weights = quality.fit(docs, labels.where(~quality.in_fold(F.col("doc_id"), 3, 1)), "quality")
    name = "score"
    while name in docs.columns:
        name += "_"
    return quality.score(docs, weights, keep=tuple(docs.columns), name=name).where(F.col(name) >= 0.5).drop(name)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id. Rows
    without words or id are in no group and stay; rows that share an id stay
    or go together."""
    joined = ngram_join.join_components(docs.select("doc_id", "text"))
    gone = joined.where("doc_id <> component_id").select("doc_id").distinct()
    ship(spark)
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages (n_chars follows); a text without any
    stays as it is, and every row stays with its other columns."""
    ship(spark)
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    cut = substring.cut_repeats(docs, keep=rest)
    whole = cut.select("doc_id", F.col("kept_text").alias("text"), *(F.col(f"kept.`{c}`") for c in rest))
    if "n_chars" in docs.columns:
        whole = whole.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return whole.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' pieces in sequences of 2048 tokens."""
    ship(spark)
    return packing.pack(packing.token_pieces(docs, packing.public_vocabulary()))


STAGES = [("quality classifier", quality_stage), ("n-gram Jaccard join", near_duplicate_stage),
          ("substring dedup", substring_stage), ("best-fit packing", packing_stage)]
ORACLE_SQL = None  # a trained classifier and packing have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
