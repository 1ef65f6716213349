"""Quality classifier: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader (FTRL-proximal) updates, scored as sparse dot
products.

Features of a text: 1- and 2-grams of its words (lower-cased), and 1- and
2-grams of the words' shapes (runs of upper-case, lower-case, digit and other
letters; symbols stand for themselves), each hashed to ``2**bits`` weights.
Shapes, and a mark for a word that repeats the one before, let the model
judge words it has never seen. Counts are damped (log) and each of the two
families is scaled to length one, so long texts weigh as much as short ones.

Training uses a bounded sample of labelled rows (``max_rows``, by a hash of
the id: stable and unbiased); scoring reads every whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.words import BASE, BYTE_CODE, LOWER, U, Words, mix, poly, words_of

BITS = 18
MAX_ROWS = 6000
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[65:91], SHAPE[97:123], SHAPE[48:58], SHAPE[128:] = 65, 97, 48, 97


def shape_hashes(words: Words) -> np.ndarray:
    """Hash of each word's shape: its byte classes with runs written once."""
    kind = SHAPE[words.data]
    keep = np.ones(len(kind), bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[words.starts] = True
    at = np.zeros(len(kind) + 1, np.int64)
    np.cumsum(keep, out=at[1:])
    return mix(poly(BYTE_CODE[kind[keep]], at[words.starts], at[words.ends]) ^ U(0xA5A5A5A5))


def text_features(words: Words, bits: int = BITS):
    """Per row of the chunk: (sorted feature numbers, values)."""
    plain = mix(poly(BYTE_CODE[LOWER[words.data]], words.starts, words.ends))
    shape = shape_hashes(words)
    mask = U((1 << bits) - 1)
    same = np.zeros(len(plain), bool)
    same[1:] = plain[1:] == plain[:-1]
    pair = np.zeros_like(plain)
    pair[1:] = mix(plain[:-1] * U(BASE) + plain[1:])
    turn = np.zeros_like(shape)
    turn[1:] = mix(shape[:-1] * U(BASE) + shape[1:] + same[1:].astype(U))
    for i in range(words.rows):
        lo, hi = words.ptr[i], words.ptr[i + 1]
        parts_i, parts_v = [np.zeros(1, np.int64)], [np.ones(1, np.float32)]
        if hi > lo:
            for one, two in ((plain, pair), (shape, turn)):
                f = np.concatenate([one[lo:hi], two[lo + 1 : hi]]) & mask
                idx, n = np.unique(f.astype(np.int64), return_counts=True)
                v = np.log1p(n)
                parts_i.append(idx + 1)
                parts_v.append((v / np.sqrt((v * v).sum())).astype(np.float32))
        yield words.first + i, np.concatenate(parts_i), np.concatenate(parts_v)


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = 5, alpha: float = 0.5,
               beta: float = 1.0, l1: float = 0.02, l2: float = 0.05) -> np.ndarray:
    """Weights from (features, values, label) rows, in the order given.
    Without rows all weights are 0 (every score is 0.5)."""
    size = (1 << bits) + 1
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    for _ in range(epochs):
        for idx, val, label in rows:
            zi, ni = z[idx], n[idx]
            wi = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(ni)) / alpha + l2))
            g = (1.0 / (1.0 + np.exp(-np.clip(float(wi @ val), -35, 35))) - label) * val
            np.add.at(z, idx, g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * wi)
            np.add.at(n, idx, g * g)
    np.divide(np.where(np.abs(z) <= l1, 0.0, np.sign(z) * l1 - z), (beta + np.sqrt(n)) / alpha + l2, out=w)
    return w


def sample_rows(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text",
                max_rows: int = MAX_ROWS, bits: int = BITS) -> DataFrame:
    """(turn, label, idx, val): features of the texts of at most ``max_rows``
    rows of ``labels`` (doc_id, label 0 or 1; other labels and null ids are
    left out; null texts are empty), in the order of learning.

    The sampled ids (bounded by ``max_rows``, hence the broadcast) pick the
    texts; features are made where the texts lie. Rows that share a sampled
    id count against the same bound, which a top-k keeps: the first
    ``max_rows`` by hash of the id, label and features."""
    ids = (labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
           .select(F.xxhash64(F.lit(17), F.col(doc_id)).alias("turn"), F.col(doc_id).alias("id"),
                   F.col(label).cast("int").alias("label"))
           .orderBy("turn", "id", "label").limit(max_rows))
    picked = (docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
              .join(F.broadcast(ids), "id").select("turn", "text", "label"))

    def features(batches):
        for b in batches:
            turn, lab = b.column(0), b.column(2)
            for words in words_of(b.column(1), lower=False):
                got = list(text_features(words, bits))
                rows = slice(words.first, words.first + words.rows)
                yield pa.RecordBatch.from_arrays(
                    [turn[rows], lab[rows], pa.array([i.tobytes() for _, i, _ in got], pa.binary()),
                     pa.array([v.tobytes() for _, _, v in got], pa.binary())], ["turn", "label", "idx", "val"])

    return picked.mapInArrow(features, "turn long, label int, idx binary, val binary").orderBy("turn", "label", "idx").limit(max_rows)


def fit(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text",
        max_rows: int = MAX_ROWS, bits: int = BITS) -> np.ndarray:
    """Weights learned from ``sample_rows``: one task runs the sequential
    updates over the bounded sample and returns the weights."""

    def learn(batches):
        rows = [(np.frombuffer(i, np.int64), np.frombuffer(v, np.float32), y)
                for b in batches for y, i, v in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array([train_ftrl(rows, bits).tobytes()], pa.binary())], ["w"])

    sample = sample_rows(docs, labels, label, doc_id, text, max_rows, bits)
    got = sample.mapInArrow(learn, "w binary").collect()
    return np.frombuffer(got[0]["w"], np.float64) if got else np.zeros((1 << bits) + 1)


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", bits: int = BITS, keep: tuple[str, ...] = ("doc_id",),
          name: str = "score") -> DataFrame:
    """Columns ``keep`` of every row with ``name`` (0 to 1, higher: label 1
    likelier), the score of its whole text; null and empty texts score by the
    bias. ``name`` must be none of ``keep``."""
    shipped = docs.sparkSession.sparkContext.broadcast(weights)  # 2**bits doubles: a fixed size
    cols = [F.col(f"`{c}`") for c in keep]
    if text not in keep:
        cols.append(F.col(f"`{text}`").cast("string"))
    at = keep.index(text) if text in keep else len(keep)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*cols[: len(keep)]).schema)

    def run(batches):
        w = shipped.value
        for b in batches:
            for words in words_of(b.column(at), lower=False):
                out = np.array([w[i] @ v for _, i, v in text_features(words, bits)])
                rows = slice(words.first, words.first + words.rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(k)[rows] for k in range(len(keep))] + [pa.array(1 / (1 + np.exp(-np.clip(out, -700, 700))))],
                    [*keep, name])

    return docs.select(*cols).mapInArrow(run, f"{kinds}, `{name}` double")


def in_fold(doc_id: Column, mod: int, rest: int) -> Column:
    """crc32 of the id as text leaves ``rest`` modulo ``mod``; null ids: false."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % mod == rest, F.lit(False))
