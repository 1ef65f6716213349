"""Cross-tokenizer alignment by whitespace-token anchors.

Two tokenizers cut the same bytes (a space and the text) into tokens. After
both have tokenised the whole text, the byte offsets at which a space-marked
token of each begins are candidate anchors; an anchor counts only where both
have a token end just before it, by the sums of their tokens' byte lengths.
Anchors split a document into windows of token ids, mostly single words.
How a window aligns depends on its ids alone, so alignments are memoised by
the pair of id tuples: a corpus repeats its words.

In a window, offsets where tokens of both end cut the tokens into groups;
tokens that share a byte are linked. Links are counted by id pair, per
document where the text is and over the corpus by Spark; each document then
gets the counts of its own pairs back by a join.
"""

from __future__ import annotations

import functools
import hashlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import stored
from orderlens.llm.packing import byte_bpe, public_vocabulary

MEMO = 400_000  # windows a task remembers before it starts anew
LONG = 64  # longer windows (in tokens) are aligned without being remembered
TEXTS, BYTES = 256, 1 << 20  # texts handled together: at most so many, of at most so many bytes (or a single one)


class Pieces:
    """Byte lengths, byte strings, space marks and printed ids of a vocabulary
    by id."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.size = [len(t) for t in tokens]
        self.name = [str(k) for k in range(len(tokens))]
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.spaced = np.array([t[:1] == b" " for t in tokens], bool)


@functools.lru_cache(maxsize=2)
def byte_level(ranks_path: str, pattern: str):
    """Encoder (texts -> id lists; special strings are plain text) and pieces
    of a byte-level BPE."""
    bpe = byte_bpe(ranks_path, pattern)
    return bpe.encode_ordinary, Pieces([bpe.decode_single_token_bytes(k) for k in range(len(bpe.token_byte_values()))])


@functools.lru_cache(maxsize=2)
def piece_level(model_path: str):
    """Encoder and pieces of a SentencePiece model: U+2581 is a space, <0xHH>
    the byte HH."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return functools.partial(model.encode, num_threads=1), Pieces(
        [bytes([int(model.id_to_piece(k)[3:5], 16)]) if model.is_byte(k) else model.id_to_piece(k).replace("▁", " ").encode()
         for k in range(model.get_piece_size())])


def windows_of(a: np.ndarray, b: np.ndarray, left: Pieces, right: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """First token of each window in ``a`` and in ``b``, and their ends."""
    at_a, at_b = np.flatnonzero(left.spaced[a]), np.flatnonzero(right.spaced[b])
    start_a = (np.cumsum(left.length[a]) - left.length[a])[at_a]
    start_b = (np.cumsum(right.length[b]) - right.length[b])[at_b]
    place = np.minimum(np.searchsorted(start_a, start_b), len(start_a) - 1)
    shared = start_a[place] == start_b  # the candidate offsets that are in both
    return np.append(at_a[place[shared]], len(a)), np.append(at_b[shared], len(b))


def window_keys(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> list[bytes]:
    """The ids of each window as bytes: those of ``a``, then those of ``b``
    (marked, so that no two windows have one key)."""
    n_a, n_b = np.diff(cut_a), np.diff(cut_b)
    ids = np.empty(len(a) + len(b), np.int32)
    ids[np.arange(len(a)) + np.repeat(cut_b[:-1], n_a)] = a
    ids[np.arange(len(b)) + np.repeat(cut_a[1:], n_b)] = b | 1 << 30
    raw, at = ids.tobytes(), (4 * (cut_a + cut_b)).tolist()
    return [raw[lo:hi] for lo, hi in zip(at, at[1:])]


def align_window(a: list[int], b: list[int], left: Pieces, right: Pieces) -> tuple[bytes, int, int, bytes]:
    """(groups as ``a1,a2|b1;...``, number of groups, of links, the links as
    64-bit codes a << 32 | b) of two token lists over the same bytes."""
    name_a, name_b = left.name, right.name
    if len(a) == 1 or len(b) == 1:  # one group, every pair linked
        links = [x << 32 | y for x in a for y in b]
        return f"{','.join([name_a[x] for x in a])}|{','.join([name_b[y] for y in b])}".encode(), 1, len(links), array("q", links).tobytes()
    size_a, size_b = left.size, right.size
    text, links, groups = [name_a[a[0]]], [], 0
    group_b = [name_b[b[0]]]
    rest_a, rest_b = iter(a), iter(b)
    x, y = next(rest_a), next(rest_b)
    gap = size_a[x] - size_b[y]  # how much further the token of a reaches
    while True:
        links.append(x << 32 | y)
        if gap > 0:
            y = next(rest_b)
            gap -= size_b[y]
            group_b.append(name_b[y])
        elif gap < 0:
            x = next(rest_a)
            gap += size_a[x]
            text.append("," + name_a[x])
        else:
            groups += 1
            text.append("|" + ",".join(group_b))
            x = next(rest_a, None)
            if x is None:
                return "".join(text).encode(), groups, len(links), array("q", links).tobytes()
            y = next(rest_b)
            gap = size_a[x] - size_b[y]
            text.append(";" + name_a[x])
            group_b = [name_b[y]]


class Aligner:
    """Alignments of documents, windows memoised by their id tuples."""

    def __init__(self, left: Pieces, right: Pieces):
        self.left, self.right, self.memo = left, right, {}

    def document(self, raw: bytes, a: list[int], b: list[int]) -> tuple:
        """(n_a, n_b, n_groups, n_links, groups_sha256, link codes, their
        times) of a document whose tokens must both spell ``raw``. (A
        byte-level BPE loses nothing, so its length tells.)"""
        left, right = self.left, self.right
        if b"".join(map(right.tokens.__getitem__, b)) != raw or sum(map(left.size.__getitem__, a)) != len(raw):
            return 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        ids_a, ids_b = np.array(a, np.int32), np.array(b, np.int32)
        cut_a, cut_b = windows_of(ids_a, ids_b, left, right)
        keys = window_keys(ids_a, ids_b, cut_a, cut_b)
        cut_a, cut_b, memo = cut_a.tolist(), cut_b.tolist(), self.memo
        found = list(map(memo.get, keys))
        for w, known in enumerate(found):
            if known is None:
                key = keys[w]
                got = memo.get(key)  # the same window may have come just before
                if got is None:
                    i, j, k, m = cut_a[w], cut_a[w + 1], cut_b[w], cut_b[w + 1]
                    got = align_window(a[i:j], b[k:m], left, right)
                    if j - i + m - k <= LONG:
                        if len(memo) >= MEMO:
                            memo.clear()
                        memo[key] = got
                found[w] = got
        texts, groups, links, codes = zip(*found)
        pairs, times = np.unique(np.frombuffer(b"".join(codes), np.int64), return_counts=True)
        return len(a), len(b), sum(groups), sum(links), hashlib.sha256(b";".join(texts)).hexdigest(), pairs, times


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def align_texts(docs: DataFrame, vocabulary: tuple[str, str], model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and links
    array<struct<pair, n>> (each linked id pair, a << 32 | b, with its times).

    Texts are tokenised whole: a space and the text by the byte-level BPE, the
    text by the model, which puts the space itself. Null and empty texts, and
    texts that either tokenizer doesn't spell byte for byte (a literal U+2581,
    say), have no tokens: counts 0, groups_sha256 ''. Every row is handled
    for itself, so repeated rows, null ids and extra columns do no harm."""
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        encode_a, left = byte_level(*vocabulary)
        encode_b, right = piece_level(model_path)
        aligner = Aligner(left, right)
        for batch in batches:
            for lo, hi in _slices(batch.column(1)):
                texts = [t or "" for t in batch.column(1)[lo:hi].to_pylist()]
                rows = [aligner.document(b" " + t.encode(), encode_a(" " + t), b) if t else aligner.document(b"", [1], [])
                        for t, b in zip(texts, encode_b(texts))]
                pairs = pa.StructArray.from_arrays([pa.array(np.concatenate([r[5] for r in rows])),
                                                    pa.array(np.concatenate([r[6] for r in rows]).astype(np.int32))], ["pair", "n"])
                ends = pa.array(np.cumsum([0, *(len(r[5]) for r in rows)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], *(pa.array([r[k] for r in rows], pa.int64()) for k in range(4)),
                     pa.array([r[4] for r in rows], pa.string()), pa.ListArray.from_arrays(ends, pairs)],
                    ["doc_id", *COUNTS, "groups_sha256", "links"])

    return docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string")).mapInArrow(
        run, f"doc_id {id_type}, " + ", ".join(f"{c} long" for c in COUNTS) + ", groups_sha256 string, links array<struct<pair:long,n:int>>")


def _slices(column: pa.Array):
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    lo, total = 0, 0
    for k, size in enumerate(sizes):
        if k > lo and (k - lo >= TEXTS or total + size > BYTES):
            yield lo, k
            lo, total = k, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes)


def count_pairs(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): how many links of the corpus hold each id pair,
    and whether no pair of its second id has more. The highest counts are one
    row an id of that vocabulary, which bounds the broadcast."""
    counts = stored(aligned.select(F.inline("links")).groupBy("pair").agg(F.sum("n").alias("count")))
    second = F.col("pair").bitwiseAND(0xFFFFFFFF).alias("second")
    highest = counts.groupBy(second).agg(F.max("count").alias("most"))
    return counts.withColumn("second", second).join(F.broadcast(highest), "second").select(
        "pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, vocabulary: tuple[str, str], model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count
    is the highest of their second id, ties included), count_sum (of the
    counts of its links) and groups_sha256.

    A document's links are counted by pair before anything is shuffled, so a
    frequent pair has at most a row a document (a skewed join side, split by
    AQE). The counts are joined by their pair at every size, never broadcast:
    nothing bounds their number; they are unique and spread evenly, so each
    task's share is the side to hash. An empty table gives an empty result."""
    aligned = stored(align_texts(docs, vocabulary, model_path, doc_id, text).withColumn("row", F.monotonically_increasing_id()))
    counts = stored(count_pairs(aligned))
    sums = (aligned.select("row", F.inline("links")).join(counts.hint("shuffle_hash"), "pair").groupBy("row")
            .agg(F.sum(F.col("n") * F.col("count")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("n"))).alias("n_best")))
    return aligned.drop("links").join(sums, "row", "left").select(
        "doc_id", *COUNTS, *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")), "groups_sha256")


def public_tokenizers_paths() -> tuple[tuple[str, str], str]:
    """The public byte-level vocabulary and the public SentencePiece model."""
    import public_tokenizers

    return public_vocabulary()[:2], public_tokenizers.path("piece_bpe_32k.model")
