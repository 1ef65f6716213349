"""Packing token sequences: bin completion branch-and-bound.

Texts become token ids (an end id closes each); only a text longer than a
sequence is cut. Which pieces share a sequence depends on their lengths alone,
so the search runs on the histogram of lengths (at most ``size`` entries,
however many documents): a *pattern* is one filling of a sequence, used as
often as its lengths last. Two quick packings come first, one of least-waste
fillings (each once chosen is kept) and one by best fit; where neither meets
the lower bound, the search branches over the undominated fillings of the
longest length. Spark makes the pieces, the histogram and each
piece's rank among those of its length; a rank then names sequence and place.
"""

from __future__ import annotations

import base64
import functools
import json
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import saved, shuffle_width
from orderlens.llm.words import U, mix

SIZE = 2048
SEARCH_NODES = 4000  # effort a pattern of the first packing; the best filling found so far stands beyond it
SEARCH_STEPS = 5_000_000  # effort of the whole branch-and-bound; the best packing found so far stands beyond it


Vocabulary = tuple[str, str, tuple[tuple[str, int], ...]]


@functools.lru_cache(maxsize=4)
def byte_bpe(ranks_path: str, pattern: str, added: tuple[tuple[str, int], ...] = ()) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(added))


def public_vocabulary() -> Vocabulary:
    """Ranks file, split pattern and added tokens (text, id) of the public 50k
    byte-level vocabulary."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json")) as f:
        added = tuple((t["content"], t["id"]) for t in json.load(f)["added_tokens"])
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added


def token_pieces(docs: DataFrame, vocabulary: Vocabulary, size: int = SIZE, end_id: int = 0,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32.

    The ids of a text are its byte-level BPE ids, where an added token's
    string in the text is that token, then ``end_id``; null and empty texts are the end id
    alone. A text of over ``size`` ids is cut into pieces of ``size``, of
    which the first may be shorter. Every row is handled for itself, so
    repeated rows, null ids and extra columns do no harm."""
    id_type = docs.schema[doc_id].dataType.simpleString()

    def cut(batches):
        bpe, added = byte_bpe(*vocabulary), [name for name, _ in vocabulary[2]]
        for b in batches:
            owner, rows = [], []
            for r, t in enumerate(b.column(1)):
                whole = t.as_py() or ""
                ids = bpe.encode(whole, allowed_special="all") if any(a in whole for a in added) else bpe.encode_ordinary(whole)
                ids.append(end_id)
                raw = memoryview(np.array(ids, "<u4").tobytes())
                lo, k = 0, 0
                while lo < len(ids):
                    hi = lo + ((len(ids) - lo - 1) % size + 1 if lo == 0 else size)
                    owner.append(r)
                    rows.append((k, lo, hi - lo, zlib.crc32(raw[4 * lo : 4 * hi])))
                    lo, k = hi, k + 1
            cols = np.array(rows, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(owner, pa.int64())), pa.array(cols[:, 0].astype(np.int32)),
                 *(pa.array(cols[:, c]) for c in (1, 2, 3))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(
        cut, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


def best_fit(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """Fill ``room`` by the longest length that still fits, again and again."""
    out: dict[int, int] = {}
    for x in lengths:
        if x <= room and (n := min(counts[x], room // x)) > 0:
            out[x], room = n, room - n * x
            if not room:
                break
    return out


def completion(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """The filling of ``room`` with the least waste, from ``lengths`` (longest
    first, ``counts`` left of each).

    Depth first over fillings in order of falling length, so that among equal
    ones the first found has the longest pieces: it dominates those that use
    shorter pieces in their place. The best-fit filling is the first
    incumbent; a branch is cut where even all it may still add wastes as much
    as the incumbent, and the search ends at a filling without waste or, past
    ``SEARCH_NODES``, at the incumbent."""
    best = best_fit(counts, lengths, room)
    least = room - sum(x * n for x, n in best.items())
    rest = [0] * (len(lengths) + 1)  # all that the lengths from here on may add
    for i in range(len(lengths) - 1, -1, -1):
        rest[i] = min(rest[i + 1] + lengths[i] * counts[lengths[i]], 1 << 40)
    nodes = 0
    stack = [(0, room, ())]
    while stack and least > 0:
        i, left, taken = stack.pop()
        nodes += 1
        if left < least:
            least, best = left, dict(taken)
        if nodes > SEARCH_NODES:
            break
        while i < len(lengths) and lengths[i] > left:
            i += 1
        if i == len(lengths) or left - min(rest[i], left) >= least:
            continue
        stack.append((i + 1, left, taken))  # without this length: looked at after those with it
        for n in range(1, min(counts[lengths[i]], left // lengths[i]) + 1):
            stack.append((i + 1, left - n * lengths[i], (*taken, (lengths[i], n))))
    return best


def plan_patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: pieces in one sequence}) until the histogram is used
    up, filling around the longest length left each time."""
    counts = {x: n for x, n in histogram.items() if n > 0}
    lengths = sorted(counts, reverse=True)
    out = []
    while lengths:
        top = lengths[0]
        counts[top] -= 1
        fill = completion(counts, [x for x in lengths if x <= size - top and counts[x] > 0], size - top)
        counts[top] += 1
        fill[top] = fill.get(top, 0) + 1
        times = min(counts[x] // n for x, n in fill.items())
        for x, n in fill.items():
            counts[x] -= n * times
        out.append((times, fill))
        lengths = [x for x in lengths if counts[x]]
    return out


def best_fit_decreasing(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, dict[int, int]]]:
    """The same, each filling by best fit alone: the incumbent of the whole."""
    counts = {x: n for x, n in histogram.items() if n > 0}
    out = []
    while lengths := sorted((x for x, n in counts.items() if n), reverse=True):
        fill = best_fit(counts, lengths, size)
        times = min(counts[x] // n for x, n in fill.items())
        for x, n in fill.items():
            counts[x] -= n * times
        out.append((times, fill))
    return out


def lower_bound(histogram: dict[int, int], size: int = SIZE) -> int:
    """Sequences that any packing needs: for each threshold k, pieces over
    size - k stand alone and the rest must hold the others of at least k."""
    n = np.zeros(size + 2, np.int64)  # pieces shorter than the index
    for x, c in histogram.items():
        n[x + 1] += c
    tokens = np.cumsum(n * (np.arange(size + 2) - 1))
    n = np.cumsum(n)
    half, k = size // 2 + 1, np.arange(size // 2 + 1)
    spare = size * (n[size - k + 1] - n[half]) - (tokens[size - k + 1] - tokens[half])
    small = tokens[half] - tokens[k]
    return max(-(-int(tokens[-1]) // size), int(n[-1] - n[half] + np.maximum(0, -(-(small - spare) // size)).max()))


def dominated(fill: dict[int, int], waste: int, free: int) -> bool:
    """Whether pieces of ``fill`` can be swapped for one longer piece of the
    bit set ``free`` (lengths left over) within ``waste``, or several for one
    that is as long, or a piece still fits."""
    one, more = 0, 0  # sums of one piece, of several
    for x, n in fill.items():
        for _ in range(n):
            more |= (more | one) << x
            one |= 1 << x
    for d in range(waste + 1):
        if free >> d & 1 or more << d & free or d and one << d & free:
            return True
    return False


def fillings(counts: dict[int, int], room: int, slack: int, effort: list[int]):
    """The undominated fillings of ``room`` that waste at most ``slack``, least
    waste first, then longest pieces first. ``effort[0]`` counts down."""
    lengths = sorted((x for x, n in counts.items() if n > 0 and x <= room), reverse=True)
    effort[0] -= 4 * len(lengths)
    reach, mask = [1] * (len(lengths) + 1), (1 << room + 1) - 1  # sums of the lengths from here on
    for i in range(len(lengths) - 1, -1, -1):
        sums, left, part = reach[i + 1], min(counts[lengths[i]], room // lengths[i]), 1
        while left:
            part = min(part, left)
            sums |= sums << part * lengths[i] & mask
            left, part = left - part, 2 * part
        reach[i] = sums
    for waste in range(min(slack, room) + 1):
        stack = [(0, room - waste, ())] if reach[0] >> room - waste & 1 else []
        while stack and effort[0] > 0:
            i, left, taken = stack.pop()
            effort[0] -= 1
            if left:
                x = lengths[i]
                for n in range(min(counts[x], left // x) + 1):
                    if reach[i + 1] >> left - n * x & 1:
                        stack.append((i + 1, left - n * x, (*taken, (x, n)) if n else taken))
                continue
            fill = dict(taken)
            effort[0] -= sum(fill.values())
            if not dominated(fill, waste, sum(1 << x for x in lengths if counts[x] > fill.get(x, 0))):
                yield fill


def sequences(patterns: list[tuple[int, dict[int, int]]]) -> int:
    return sum(times for times, _ in patterns)


def branch_and_bound(histogram: dict[int, int], size: int, best: list[tuple[int, dict[int, int]]],
                     steps: int = SEARCH_STEPS) -> list[tuple[int, dict[int, int]]]:
    """The fewest sequences, starting from the incumbent ``best``.

    Depth first: the longest length left is filled in every undominated way,
    each tried as often as it lasts, half as often and so on down to once,
    which leaves every number of times open to the levels below. Cut are
    branches whose sequences and lower bound do not beat the incumbent, and
    pieces left that were met before with as few sequences. The search ends
    at the lower bound, when nothing is left to try (the incumbent is then
    proven) or after ``steps``."""
    counts = {x: n for x, n in histogram.items() if n > 0}
    goal, fewest, effort = lower_bound(counts, size), sequences(best), [steps]
    code = {x: int(c) for x, c in zip(counts, mix(np.arange(1, len(counts) + 1).astype(U)))}
    met: dict[int, int] = {}
    path: list[tuple[int, dict[int, int]]] = []

    def put(times, fill, sign):
        for x, n in fill.items():
            counts[x] -= sign * n * times

    def children(used):
        top = max(x for x, n in counts.items() if n)
        slack = (fewest - 1 - used) * size - sum(x * n for x, n in counts.items())
        counts[top] -= 1
        ways = fillings(dict(counts), size - top, slack, effort)
        counts[top] += 1
        for fill in ways:
            fill[top] = fill.get(top, 0) + 1
            times = min(counts[x] // n for x, n in fill.items())
            while times:
                yield times, fill
                times //= 2

    levels = [children(0)] if fewest > goal else []
    used = 0
    while levels and fewest > goal and effort[0] > 0:
        step = next(levels[-1], None)
        if step is None:
            levels.pop()
            if path:
                put(*path[-1], -1)
                used -= path.pop()[0]
            continue
        put(*step, 1)
        path.append(step)
        used += step[0]
        effort[0] -= 50
        key = sum(code[x] * n for x, n in counts.items()) & (1 << 64) - 1
        if not any(counts.values()):
            if used < fewest:
                fewest, best = used, list(path)
        elif used + lower_bound(counts, size) < fewest and met.get(key, fewest) > used:
            met[key] = used
            levels.append(children(used))
            continue
        put(*path.pop(), -1)
        used -= step[0]
    return best


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, dict[int, int]]]:
    best = min(plan_patterns(histogram, size), best_fit_decreasing(histogram, size), key=sequences)
    return branch_and_bound(histogram, size, best)


def slots(patterns: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """Where the pieces of a length go, by rank: sorted keys ``length << 40 |
    first rank`` with the first sequence, pieces in a sequence and place."""
    rows, used, sequence = [], {}, 0
    for times, fill in patterns:
        place = 0
        for x in sorted(fill, reverse=True):
            rows.append((x << 40 | used.get(x, 0), sequence, fill[x], place))
            used[x] = used.get(x, 0) + fill[x] * times
            place += x * fill[x]
        sequence += times
    a = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"key": a[:, 0], "sequence": a[:, 1], "each": a[:, 2], "place": a[:, 3]}


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Adds sequence_id and offset to rows (doc_id, piece, start, length,
    ids_crc32): every piece in one sequence of at most ``size`` tokens,
    without gaps from 0. An empty table gives an empty result.

    To the driver come the counts of at most ``size`` distinct lengths. A
    length that a third of all pieces share is ranked in salted parts, whose
    sizes (lengths x parts rows) give each part its first rank."""
    pieces = saved(pieces)
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = slots(plan(histogram, size))
    parts = 4 * shuffle_width(pieces.sparkSession)
    salted = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = (salted.groupBy("length", "part").agg(F.count("*").alias("n"))
             .select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    own = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (salted.withColumn("own", F.row_number().over(own).cast("long") - 1).join(first, ["length", "part"])
              .select(*pieces.columns, (F.col("first") + F.col("own")).alias("rank")))

    def place(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            length, rank = t["length"].to_numpy(), t["rank"].to_numpy()
            at = np.searchsorted(table["key"], length << 40 | rank, "right") - 1
            turn = rank - (table["key"][at] & ((1 << 40) - 1))
            each = table["each"][at]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(table["sequence"][at] + turn // each),
                 pa.array(table["place"][at] + turn % each * length)], [*b.schema.names[:-1], "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")
