"""Quality rules by compression bands: zstandard ratios (raw bytes / compressed
bytes) of whole documents and of fixed chunks reject repetitive or
incompressible text, with limits that depend on the length.

A short text compresses less than a long one of the same kind, so each length
has a band of its own (``BANDS``). Prose lies well inside it: a ratio above the
band means text that says the same again and again, one below it means
encoded or random data. Chunks find what the whole hides, such as a long
run of copied lines in a document that is otherwise fine.

Beside the ratios each text gets plain counts (words, symbols, repeated lines
and words). Every text is handled whole and for itself: no shuffle, nothing
kept between rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVEL = 3
CHUNK = 4096  # bytes; a last chunk under half of it belongs to the one before
BAD_CHUNKS = 0.25  # a larger share of chunks outside their band rejects the document
# (bytes below which the band holds, least ratio, largest ratio)
BANDS = ((1 << 10, 1.1, 3.0), (1 << 12, 1.25, 4.0), (1 << 14, 1.4, 5.0), (1 << 16, 1.5, 6.5), (float("inf"), 1.5, 8.0))
MIN_WORDS, MOST_REPEATED = 50, 50  # the base rules: words at least, per cent of words in repeated windows at most
REPEAT_WINDOW = 3
WHITE, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words covered by windows of ``window`` words that occur more than once."""
    if len(words) <= window:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    n = len(ids) - window + 1
    code = ids[:n]
    for k in range(1, window):  # exact: a pair (code so far, next word) gets its own number
        _, code = np.unique(code * len(numbers) + ids[k : k + n], return_inverse=True)
    again = np.bincount(code)[code] > 1
    covered = np.zeros(len(ids), bool)
    for k in range(window):
        covered[k : k + n] |= again
    return int(covered.sum())


def repeated_lines(raw: bytes) -> int:
    lines = [line for line in raw.split(b"\n") if not line.isspace() and line]
    return len(lines) - len(set(lines))


def ratio(raw: bytes, compressor: zstandard.ZstdCompressor) -> float:
    return len(raw) / len(compressor.compress(raw)) if raw else 0.0


def outside(size: int, value: float, bands: Sequence[tuple[float, float, float]]) -> int:
    """-1 below, 0 inside, 1 above the band of a text of ``size`` bytes."""
    least, most = next((lo, hi) for below, lo, hi in bands if size < below)
    return -1 if value < least else int(value > most)


def chunks_of(raw: bytes, size: int = CHUNK) -> list[bytes]:
    cuts = list(range(0, len(raw), size))
    if len(cuts) > 1 and len(raw) - cuts[-1] < size / 2:
        cuts.pop()
    return [raw[lo:hi] for lo, hi in zip(cuts, [*cuts[1:], len(raw)])]


def judge(text: str | None, compressor: zstandard.ZstdCompressor, bands: Sequence[tuple[float, float, float]] = BANDS,
          chunk: int = CHUNK, bad_chunks: float = BAD_CHUNKS) -> tuple:
    """The row of one text, in the order of ``COLUMNS``."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # of bytes: exactly at ASCII white space
    repeated = repeated_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeated > MOST_REPEATED * len(words)
    whole = ratio(raw, compressor)
    side = outside(len(raw), whole, bands) if raw else 0
    parts = [(len(p), ratio(p, compressor)) for p in chunks_of(raw, chunk)] if len(raw) > chunk else [(len(raw), whole)]
    sides = [outside(n, r, bands) for n, r in parts] if raw else []
    low, high = sides.count(-1), sides.count(1)
    reason = (("incompressible", "", "repetitive")[side + 1]
              or (("repetitive chunks" if high >= low else "incompressible chunks") if low + high > bad_chunks * len(sides) else None))
    return (len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), repeated_lines(raw), repeated,
            base_failed, not base_failed and reason is None, whole, len(sides), low + high, reason)


COLUMNS = (("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
           ("n_repeat_words", "long"), ("base_failed", "boolean"), ("kept", "boolean"), ("ratio", "double"),
           ("n_chunks", "long"), ("n_bad_chunks", "long"), ("reason", "string"))
ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "string": pa.string()}


def judge_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                bands: Sequence[tuple[float, float, float]] = BANDS, chunk: int = CHUNK, bad_chunks: float = BAD_CHUNKS) -> DataFrame:
    """doc_id and ``COLUMNS`` of every row, from its whole text.

    Words are maximal runs of other than ASCII white space, unchanged.
    word_chars counts their code points, n_symbols the characters
    ``#*$%&|<>``, n_dup_lines the lines (split at newlines) that hold a word
    and equal an earlier line, n_repeat_words the words in three-word windows
    that occur at least twice in the text (the first included).
    base_failed: under 50 words, or over half of them in such windows. kept:
    neither base_failed nor a reason of the compression bands: the whole text,
    or over ``bad_chunks`` of its chunks, lie outside the band of their length.

    Null and empty texts have no words, ratio 0, no chunk and no reason: they
    fail the base rules. Repeated rows and null ids are judged like all
    others; of the other columns none is read; an empty table gives an
    empty result."""
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for b in batches:
            rows = [judge(t.as_py(), compressor, bands, chunk, bad_chunks) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([r[k] for r in rows], ARROW[kind]) for k, (_, kind) in enumerate(COLUMNS))],
                ["doc_id", *(name for name, _ in COLUMNS)])

    return docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string")).mapInArrow(
        run, f"doc_id {id_type}, " + ", ".join(f"{name} {kind}" for name, kind in COLUMNS))
