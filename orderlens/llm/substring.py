"""Substring dedup: Rabin-Karp hashes of all windows of ``window`` words,
counted in Spark; covered words of repeated windows are cut out.

A corpus has about as many windows as words, so they are counted in *runs*.
Every window has an anchor: the smallest hash among its ``gram``-word grams
(the leftmost of equal ones). Consecutive windows with one anchor are a run,
and the Rabin-Karp hash of the run's words stands for all its windows. Equal
windows have equal anchor hashes, hence:

1. A run whose anchor hash occurs once holds no repeated window of another
   run and drops out (anchors counted, then joined).
2. Runs with equal hashes hold the same windows: all but those of the smallest
   document are repeats (runs counted).
3. Only runs that share an anchor hash but differ themselves are taken apart:
   the windows of one run of each hash are counted one by one.
4. Repeats within a document are found where its text is.

No step collects the places of a hash: counts and minima are pre-aggregated
and joined back as skewed join sides.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import stored
from orderlens.llm.words import U, Words, mix, signed, span_hashes, window_hashes, words_of

WINDOW, GRAM = 20, 5


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of each ``width`` consecutive grams, leftmost of
    equal ones (by doubling spans)."""
    value, place, span = grams, np.arange(len(grams)), 1
    while span < width:
        step = min(span, width - span)
        n = len(value) - step
        right = value[step:] < value[:n]
        value = np.where(right, value[step:], value[:n])
        place = np.where(right, place[step:], place[:n])
        span += step
    return place


def runs_of(words: Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, run hash, row in the chunk, first window, windows) of the
    runs of a chunk, of equal ones in a row only the first."""
    starts, owner = window_starts(words, window)
    if not len(starts):
        return tuple(np.zeros(0, t) for t in (U, U, np.int64, np.int64, np.int64))
    grams = window_hashes(words.hashes, gram)
    at = anchors(grams, window - gram + 1)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    lo = starts[first]
    # the place of the anchor counts: it says which windows of the words are meant
    run = mix(span_hashes(words.hashes, lo, lo + count - 1 + window) ^ mix((at[first] - lo).astype(U)))
    _, pick = np.unique(mix(run ^ mix(owner[first].astype(U))), return_index=True)
    pick.sort()
    first = first[pick]
    return grams[at[first]], run[pick], owner[first], lo[pick] - words.ptr[owner[first]], count[pick]


def window_starts(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows in the chunk, and their rows."""
    owner = words.owner()
    starts = np.arange(max(0, len(owner) - window + 1))
    starts = starts[owner[starts] == owner[starts + window - 1]] if len(starts) else starts
    return starts, owner[starts]


def repeated_inside(hashes: np.ndarray) -> np.ndarray:
    """Windows whose hash an earlier window of the same text has."""
    _, first = np.unique(hashes, return_index=True)
    again = np.ones(len(hashes), bool)
    again[first] = False
    return np.flatnonzero(again)


def with_variant(docs: DataFrame) -> DataFrame:
    """``docs`` (id, text, ...) with ``variant``: 0, or a hash of the text where
    rows with different texts share the id. Word positions hold for one id
    and variant. A constant costs the shuffles next to nothing, and without
    such ids (the usual case) no text is shuffled to find them."""
    own = F.xxhash64("text")
    many = stored(docs.groupBy("id").agg(F.min(own).alias("a"), F.max(own).alias("b")).where("a <> b")
                  .select("id", F.lit(True).alias("many")))
    if many.isEmpty():
        return docs.withColumn("variant", F.lit(0).cast("long"))
    return docs.join(many, "id", "left").withColumn("variant", F.when(F.col("many"), own).otherwise(0)).drop("many")


def repeated_runs(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(id, variant, spans array<struct<start, windows>>): the windows of each
    text that a document with a smaller id has too. ``docs``: id (not null),
    text, variant."""
    id_type = docs.schema["id"].dataType.simpleString()

    def find_runs(batches):
        for b in batches:
            for words in words_of(b.column(1), lower=False):
                anchor, run, owner, start, count = runs_of(words, window, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(anchor)), pa.array(signed(run)), *(b.column(k).take(pa.array(owner + words.first)) for k in (0, 2)),
                     pa.array(start << 16 | count)], ["anchor", "run", "id", "variant", "place"])

    found = docs.select("id", "text", "variant").mapInArrow(find_runs, f"anchor long, run long, id {id_type}, variant long, place long")
    shared = found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    runs = stored(found.join(shared, "anchor").select(
        "anchor", "run", "id", "variant", F.expr("cast(place >> 16 as int)").alias("start"),
        F.expr("cast(place & 65535 as int)").alias("windows")))
    lead = runs.groupBy("run").agg(F.min("id").alias("lead"))
    led = runs.join(lead, "run")
    repeats = led.where("id > lead").select("id", "variant", "start", "windows")
    mixed = (runs.groupBy("anchor").agg(F.min("run").alias("a"), F.max("run").alias("b"))
             .where("a <> b").select("anchor"))
    split = (led.where("id = lead").join(mixed, "anchor").groupBy("id", "variant")
             .agg(F.collect_list(F.struct("start", "windows")).alias("spans")))  # at most a document's words

    def find_windows(batches):
        for b in batches:
            for words in words_of(b.column(1), lower=False):
                whole = window_hashes(words.hashes, window)
                for i in range(words.rows):
                    r = words.first + i
                    spans = b.column(3)[r].values
                    lo, count = (np.array(spans.field(k)) for k in (0, 1))
                    start = np.repeat(lo, count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
                    start = np.unique(start)  # spans come in any order; the first place of a hash is the one to report
                    got, pick = np.unique(whole[words.ptr[i] + start], return_index=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(got)), *(b.column(k).take(pa.array(np.full(len(got), r))) for k in (0, 2)),
                         pa.array(start[pick].astype(np.int32))], ["hash", "id", "variant", "start"])

    windows = (docs.join(split, ["id", "variant"]).select("id", "text", "variant", "spans")
               .mapInArrow(find_windows, f"hash long, id {id_type}, variant long, start int"))
    least = windows.groupBy("hash").agg(F.min("id").alias("lead"))
    single = windows.join(least, "hash").where("id > lead").select("id", "variant", "start", F.lit(1).alias("windows"))
    return (repeats.unionByName(single).groupBy("id", "variant")
            .agg(F.collect_list(F.struct("start", "windows")).alias("spans")))


def covered(words: Words, i: int, spans, whole: np.ndarray, window: int) -> np.ndarray:
    """Which words of row ``i`` of the chunk are cut: those of the repeated
    windows ``spans`` and of windows that repeat within the text."""
    lo, n = words.ptr[i], words.ptr[i + 1] - words.ptr[i]
    edge = np.zeros(n + 1, np.int64)
    if n >= window:
        own = repeated_inside(whole[lo : lo + n - window + 1])
        np.add.at(edge, own, 1)
        np.add.at(edge, own + window, -1)
        if spans is not None:
            start, count = (np.array(spans.field(k), np.int64) for k in (0, 1))
            np.add.at(edge, start, 1)
            np.add.at(edge, start + count - 1 + window, -1)
    return np.cumsum(edge[:-1]) > 0


def cut_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                gram: int = GRAM, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, kept_text, n_words, n_removed, kept_sha256 of every document
    (kept_text: the text as it was where nothing is cut; kept_sha256: of the
    kept words, always joined by one space).

    Words are runs of other than ASCII white space, unchanged. Cut is each
    word covered by a window of ``window`` words whose word sequence also
    starts in a document with a smaller id, or earlier in the same document;
    all windows are judged on the input. Kept words are joined by one space.

    Null and empty texts have no words; texts with fewer words than a window
    stay whole. Rows that share an id are of equal rank: neither loses words
    to the other, and each loses the repeats of its own text. Rows with a null id take no part in the comparison across
    documents (cut are only their own repeats). An empty table gives an empty
    result; of the other columns only ``keep`` are read, which each row carries
    along as the struct ``kept``."""
    carried = [F.struct(*(F.col(f"`{c}`") for c in keep)).alias("kept")] if keep else []
    own = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"), *carried)
    out = T.StructType([T.StructField("doc_id", own.schema["id"].dataType), T.StructField("kept_text", T.StringType()),
                        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                        T.StructField("kept_sha256", T.StringType()), *own.schema.fields[2:]])
    named = with_variant(own.where("id is not null"))
    spans = repeated_runs(named, window, gram)
    whole = named.join(spans, ["id", "variant"], "left").drop("variant").unionByName(
        own.where("id is null").withColumn("spans", F.lit(None).cast("array<struct<start:int,windows:int>>")))

    def cut(batches):
        for b in batches:
            for words in words_of(b.column(1), lower=False):
                yield _cut_chunk(b, words, window)

    return whole.select("id", "text", "spans", *(["kept"] if keep else [])).mapInArrow(cut, out)


def _cut_chunk(b: pa.RecordBatch, words: Words, window: int) -> pa.RecordBatch:
    whole = window_hashes(words.hashes, window)
    raw = words.data.tobytes()
    texts, n_words, n_removed, shas = [], [], [], []
    for i in range(words.rows):
        span = b.column(2)[words.first + i]
        gone = covered(words, i, span.values if span.is_valid else None, whole, window)
        at = np.flatnonzero(~gone) + words.ptr[i]
        kept = b" ".join(raw[s:e] for s, e in zip(words.starts[at].tolist(), words.ends[at].tolist()))
        text = b.column(1)[words.first + i]
        texts.append(kept if len(at) < len(gone) else text.as_buffer().to_pybytes() if text.is_valid else None)
        n_words.append(len(gone))
        n_removed.append(int(gone.sum()))
        shas.append(hashlib.sha256(kept).hexdigest())
    rows = slice(words.first, words.first + words.rows)
    return pa.RecordBatch.from_arrays(
        [b.column(0)[rows], pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()),
         pa.array(n_removed, pa.int64()), pa.array(shas), *(c[rows] for c in b.columns[3:])],
        ["doc_id", "kept_text", "n_words", "n_removed", "kept_sha256", *b.schema.names[3:]])
