"""Words of whole texts and their 64-bit hashes, for Arrow string columns.

A word is a maximal run of bytes other than space and 0x09-0x0D of the UTF-8
text. A batch is handled in chunks of about ``CHUNK`` bytes (a longer text is
a chunk of its own), so memory follows the chunk, not the batch.

A word's hash is the sum, modulo 2**64, of a random-looking value for each
(byte, place in the word), so no pattern of bytes makes two words agree but by
a chance of about 2**-64 (a polynomial modulo 2**64 would: words of a Thue-Morse
pattern of 1,024 bytes and over agree under every odd base). Windows and spans
of words are Rabin-Karp polynomials over these hashes; they are short (far
below 1,024 words), where no such pattern exists. Hashes stand for words
throughout.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1  # odd, so it has an inverse modulo 2**64
BASE_INV = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_CODE = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that scatters every input bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (BASE, BASE_INV):
        p = np.full(size, base, U)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def poly(codes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Polynomial hash of each span ``codes[lo:hi]``, not mixed."""
    up, down = _powers(1 << max(20, int(len(codes) + 1).bit_length()))
    prefix = np.zeros(len(codes) + 1, U)
    np.cumsum(codes * up[: len(codes)], out=prefix[1:])
    return (prefix[hi] - prefix[lo]) * down[lo]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word ``data[start:end]`` (see the head of the module)."""
    begin = np.zeros(len(data), np.int64)
    begin[starts] = starts
    place = np.arange(len(data)) - np.maximum.accumulate(begin)
    total = np.zeros(len(data) + 1, U)
    np.cumsum(mix(BYTE_CODE[data] + place.astype(U) * U(BASE)), out=total[1:])
    return mix((total[ends] - total[starts]) ^ mix((ends - starts).astype(U)))


@dataclass
class Words:
    """Words of the rows ``[first, first + len(ptr) - 1)`` of a batch: those
    of row ``first + i`` are ``ptr[i]:ptr[i + 1]``."""

    first: int
    data: np.ndarray  # bytes of the chunk, lower-cased where asked for
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    ptr: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.ptr) - 1

    def owner(self) -> np.ndarray:
        """Row (from 0 in the chunk) of each word."""
        return np.repeat(np.arange(self.rows), np.diff(self.ptr))


def words_of(column: pa.Array, lower: bool, chunk: int = CHUNK) -> Iterator[Words]:
    """Chunks of words of a string column, in row order; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + chunk, "right")) - 1)
        yield _chunk(lo, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], lower)
        lo = hi


def _chunk(first: int, data: np.ndarray, bounds: np.ndarray, lower: bool) -> Words:
    if lower:
        data = LOWER[data]
    size = len(data)
    word = np.zeros(size + 2, bool)
    word[1:-1] = ~SPACE[data]
    cut = np.zeros(size + 2, bool)  # a text begins at this byte
    cut[bounds[:-1] + 1] = True
    starts = np.flatnonzero(word[1:-1] & (~word[:-2] | cut[1:-1]))
    ends = np.flatnonzero(word[1:-1] & (~word[2:] | cut[2:])) + 1
    return Words(first, data, starts, ends, word_hashes(data, starts, ends), np.searchsorted(starts, bounds).astype(np.int64))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hash of every ``size`` consecutive word hashes (ignoring
    where texts end): one value per start, ``len - size + 1`` of them."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.zeros(n, U)
    for i in range(size):
        out *= U(BASE)
        out += hashes[i : i + n]
    return mix(out ^ U(size))


def span_hashes(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of each span ``hashes[lo:hi]`` (its length counts)."""
    return mix(poly(hashes, lo, hi) ^ mix((hi - lo).astype(U)))


def shingle_sets(words: Words, size: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """(row in the batch, sorted distinct ``size``-word shingle hashes) of
    each row; a text with fewer words gives its whole sequence as one
    shingle, a text without words an empty set."""
    whole = window_hashes(words.hashes, size)
    for i in range(words.rows):
        lo, hi = words.ptr[i], words.ptr[i + 1]
        if hi - lo >= size:
            yield words.first + i, np.unique(whole[lo : hi - size + 1])
        elif hi > lo:
            yield words.first + i, window_hashes(words.hashes[lo:hi], int(hi - lo))
        else:
            yield words.first + i, np.zeros(0, U)


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's signed long."""
    return x.view(np.int64)
