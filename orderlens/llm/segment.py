"""SentencePiece segmentations sampled without replacement (Gumbel top-k).

The lattice of a text has the pieces of a public SentencePiece vocabulary as
edges (characters outside it: their byte pieces); a segmentation's weight is
the sum of its pieces' log weights, Zipf's law over the merge rank. No piece
has a space mark after another character, so the lattice hangs together at
single nodes between *words*; log masses are exact, word by word.

The ``k`` segmentations of the largest Gumbel-perturbed log probability are
found by A-star over sets of segmentations: a set keeps the words before a
place, shuns some segmentations of the word there and leaves the rest open.
Its mass is known, so its perturbed maximum can be drawn (below its parent's)
without looking inside; the best set gives the next sample and is split at
every later word. The masses are exact bounds: nothing is enumerated.

All draws are hashes of (row key, sample, place): a row's samples do not
depend on partitions or batches. Work is shared by distinct words of a chunk.
"""

from __future__ import annotations

import functools
import hashlib
import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.words import BASE, U, mix, poly

SPACE_MARK, BYTE_UNIT = 0x2581, 0x110000  # units over BYTE_UNIT stand for single bytes
CHUNK_CHARS = 1 << 20


class Vocabulary:
    """Pieces of a model as a trie of unit hashes."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        ids = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        pieces = {i: sp.id_to_piece(i) for i in ids}
        self.known = np.zeros(BYTE_UNIT + 256, bool)
        self.known[[ord(p) for p in pieces.values() if len(p) == 1]] = True
        trie: dict[int, int] = {}
        for i, p in pieces.items():
            h = 0
            for j, ch in enumerate(p):
                h = self.step(h, ord(ch))
                trie.setdefault(h, -1)
            trie[h] = i
        for i in range(n):
            if sp.is_byte(i):
                trie[self.step(0, BYTE_UNIT + int(sp.id_to_piece(i)[3:5], 16))] = i
        keys = mix(np.array(list(trie), U))
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(list(trie.values()), np.int64)[order]
        self.bucket = np.searchsorted(self.keys, np.arange((1 << 20) + 1, dtype=U) << U(44)).astype(np.int32)
        self.bucket[-1] = len(self.keys)  # 1 << 64 is no 64-bit number
        units = np.arange(BYTE_UNIT + 256, dtype=U)
        self.alone = self.find(units + U(1))  # of each unit: its place as a piece or the start of one
        self.code = mix(units)
        self.weight = -np.log(np.arange(n) + 2.0)
        self.longest = max(map(len, pieces.values()))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash among the (mixed) keys, or -1: few keys share
        their upper 20 bits."""
        h = mix(h)
        slot = (h >> U(44)).astype(np.int64)
        at, end = self.bucket[slot], self.bucket[slot + 1]
        out = np.full(len(h), -1)
        open_ = np.flatnonzero(at < end)  # most buckets are empty
        while len(open_):
            place = at[open_]
            hit = self.keys[place] == h[open_]
            out[open_[hit]] = place[hit]
            at[open_] += 1
            open_ = open_[~hit & (place + 1 < end[open_])]
        return out

    @staticmethod
    def step(h: int, unit: int) -> int:
        return (h * BASE + unit + 1) % (1 << 64)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def units_of(texts: list[str], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of the texts, each after a space mark; which begin a word; and
    where the texts begin and end (in words). Empty texts have no units."""
    raw = np.frombuffer("".join(f" {t}" if t else "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    units = raw.astype(np.int64)
    units[units == 0x20] = SPACE_MARK
    bounds = np.concatenate([[0], np.cumsum([len(t) + 1 if t else 0 for t in texts])])
    strange = np.flatnonzero(~vocab.known[units])
    if len(strange):
        spelt = [chr(c).encode("utf-8", "surrogatepass") for c in units[strange]]
        times = np.ones(len(units), np.int64)
        times[strange] = [len(b) for b in spelt]
        at = np.concatenate([[0], np.cumsum(times)])
        units = np.repeat(units, times)
        where = np.repeat(at[strange], times[strange])
        where += np.arange(len(where)) - np.repeat(np.cumsum(times[strange]) - times[strange], times[strange])
        units[where] = BYTE_UNIT + np.frombuffer(b"".join(spelt), np.uint8).astype(np.int64)
        bounds = at[bounds]
    mark = units == SPACE_MARK
    begins = mark.copy()
    begins[1:] &= ~mark[:-1]
    begins[bounds[:-1][np.diff(bounds) > 0]] = True
    starts = np.flatnonzero(begins)
    return units, np.append(starts, len(units)), np.searchsorted(starts, bounds)


class Lattice:
    """Lattices of words laid one after another: ``units`` with the words'
    ``bounds``. Edges are sorted by their place; ``after`` is the log mass of
    what follows a place in its word."""

    def __init__(self, units: np.ndarray, bounds: np.ndarray, vocab: Vocabulary):
        n = len(units)
        end = np.repeat(bounds[1:], np.diff(bounds))
        place, h = np.arange(n), np.zeros(n, U)
        found = []
        for size in range(1, vocab.longest + 1):
            unit = units[place + size - 1]
            h = h * U(BASE) + (unit + 1).astype(U)
            at = vocab.alone[unit] if size == 1 else vocab.find(h)
            hit = at >= 0
            place, h, at = place[hit], h[hit], at[hit]
            piece = vocab.ids[at] >= 0
            found.append((place[piece], place[piece] + size, vocab.ids[at[piece]]))
            more = place + size < end[place]
            place, h = place[more], h[more]
            if not len(place):
                break
        start, stop, ids = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(start, kind="stable")
        start, self.stop, self.ids = start[order], stop[order], ids[order]
        self.next = np.where(self.stop == end[start], n, self.stop)  # n: the word's end, whose ``after`` is 0
        self.weight = vocab.weight[self.ids]
        size = np.bincount(start, minlength=n)
        self.ptr = np.concatenate([[0], np.cumsum(size)])
        self.after = np.zeros(n + 1)
        if not n:
            return
        # Places by the units left in their word, and the edges in that order:
        # a step takes one slice of each array.
        left = end - np.arange(n)
        longest = int(left.max())
        by_left = np.argsort(left.astype(np.uint16) if longest < 1 << 16 else left, kind="stable")
        sizes = size[by_left]
        first = np.concatenate([[0], np.cumsum(sizes)])
        edges = np.repeat(self.ptr[by_left] - first[:-1], sizes) + np.arange(first[-1])
        weight, follow = self.weight[edges], self.next[edges]
        cut = np.concatenate([[0], np.cumsum(np.bincount(left, minlength=longest + 1)[1:])])
        for a, b in zip(cut, cut[1:]):
            lo, hi = first[a], first[b]
            value = weight[lo:hi] + self.after[follow[lo:hi]]
            top = np.maximum.reduceat(value, first[a:b] - lo)
            value -= np.repeat(top, sizes[a:b])
            self.after[by_left[a:b]] = top + np.log(np.add.reduceat(np.exp(value, out=value), first[a:b] - lo))
        value = self.weight + self.after[self.next] - self.after[start]
        first = self.ptr[:-1]
        self.likely = np.maximum.reduceat(value, first)  # of each place: its likeliest edge
        hit = np.flatnonzero(value == self.likely[start])
        self.edge = np.zeros(n, np.int64)
        self.edge[start[hit][::-1]] = hit[::-1]
        self.likely = np.exp(self.likely)
        share = np.exp(value)  # of the other edges, scaled to one: found by ``key``
        share[self.edge] = 0
        total = np.concatenate([[0], np.cumsum(share)])
        base = total[first]
        rest = np.maximum(total[self.ptr[1:]] - base, 1e-300)
        self.key = start + np.minimum((total[1:] - base[start]) / rest[start], 1.0)

    def sample(self, places: np.ndarray, seeds: np.ndarray):
        """Segmentations of the words that begin at ``places``: (pieces of
        each, ids in order, log probability of each)."""
        n = np.zeros(len(places), np.int64)
        log_prob = -self.after[places]
        active, at, steps = np.arange(len(places)), places.copy(), []
        turn = 0
        while len(active):
            u = uniform(mix(seeds[active] + U(turn)))
            edge, likely = self.edge[at], self.likely[at]
            rare = np.flatnonzero(u >= likely)
            if len(rare):
                where = at[rare]
                found = np.searchsorted(self.key, where + (u[rare] - likely[rare]) / (1 - likely[rare]), "right")
                edge[rare] = np.clip(found, self.ptr[where], self.ptr[where + 1] - 1)
            steps.append((active, self.ids[edge]))
            n[active] += 1
            log_prob[active] += self.weight[edge]
            at = self.next[edge]
            go = np.flatnonzero(at < len(self.edge))
            active, at = active[go], at[go]
            turn += 1
        first = np.cumsum(n) - n
        ids = np.empty(n.sum(), np.int64)
        for turn, (who, what) in enumerate(steps):
            ids[first[who] + turn] = what
        return n, ids, log_prob

    def other(self, place: int, shunned: list[tuple[list[int], float]], seed: int) -> tuple[list[int], float]:
        """One segmentation of the word at ``place`` other than the shunned
        (ids, log probability), by the masses that these leave."""
        at, path, spent = place, [], 0.0
        whole, draws = float(self.after[place]), []
        while True:
            if len(path) == len(draws):
                draws += uniform(mix(U(seed) + np.arange(len(path), len(path) + 32, dtype=U))).tolist()
            lo, hi = int(self.ptr[at]), int(self.ptr[at + 1])
            ids, weights = self.ids[lo:hi].tolist(), self.weight[lo:hi].tolist()
            mass = [math.exp(spent - whole + w + x) for w, x in zip(weights, self.after[self.next[lo:hi]].tolist())]
            for other, log_prob in shunned:
                if len(other) > len(path) and other[: len(path)] == path and other[len(path)] in ids:
                    mass[ids.index(other[len(path)])] -= math.exp(log_prob)
            top = max(mass)
            mass = [m if m >= max(1e-13 * top, 0.0) else 0.0 for m in mass]
            u, e = draws[len(path)] * sum(mass), 0
            for i, m in enumerate(mass):
                if m:
                    e = i
                    if u < m:
                        break
                    u -= m
            path.append(ids[e])
            spent += weights[e]
            at = int(self.next[lo + e])
            if at == len(self.edge):
                return path, spent - whole


def uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> U(11)).astype(np.float64) + 0.5) * 2.0**-53


def top_k(lattice: Lattice, places: np.ndarray, first, seed: int, k: int):
    """Distinct sampled segmentations of one text, whose words lie at
    ``places`` of the lattice: [(ids, log_prob, perturbed, inclusion, its
    logarithm)], best
    first. ``first``: the first sample's (pieces of each word, ids,
    log_probs). Fewer than ``k`` where the text has fewer.

    A generator: it yields (places, seeds) of words to sample afresh and is
    sent what ``Lattice.sample`` gives for them, so that the texts of a chunk
    are sampled together; it returns the segmentations."""
    def drawn(sample: int, what: int, n: int) -> np.ndarray:
        salt = np.array([(seed + (sample << 48) + (what << 44)) % (1 << 64)], U)
        return uniform(mix(salt + np.arange(n, dtype=U)))

    pieces, ids, log_probs = first
    best = -np.log(-np.log(drawn(0, 1, 1)[0]))
    sets: list[tuple] = []  # (perturbed maximum, word that differs, sample whose words before it are kept)
    done, split = [], []  # samples; the word each was split at with the segmentations shunned there
    place, shunned = 0, []
    for turn in range(k):
        done.append((pieces, ids, log_probs, best))
        split.append((place, shunned))
        kept = np.concatenate([[0.0], np.cumsum(log_probs)])[:-1]
        open_mass = np.log(np.maximum(-np.expm1(np.minimum(log_probs, 0)), 1e-300))
        if len(log_probs) and turn:  # at the word that was split, earlier segmentations are shunned too
            rest = 1 - np.exp(log_probs[place]) - sum(np.exp(p) for _, p in shunned)
            open_mass[place] = np.log(rest) if rest > 1e-12 else -700
        mass = np.where(open_mass > -30, kept + open_mass, -np.inf)[place:]
        with np.errstate(over="ignore", divide="ignore"):
            high = mass - np.log(np.exp(mass - best) - np.log(drawn(turn, 2, len(mass))))
        top = np.argpartition(-high, k)[: k + 1] if len(high) > k + 1 else range(len(high))  # no more can be needed
        sets += [(high[i], place + i, turn) for i in top if high[i] > -np.inf]
        if not sets:
            best = -np.inf
            break
        sets.sort(key=lambda s: -s[0])
        best, place, source = sets[0]
        if turn == k - 1:
            break
        sets.pop(0)
        pieces0, ids0, logs0, _ = done[source]
        at = np.concatenate([[0], np.cumsum(pieces0)])
        shunned = [(ids0[at[place] : at[place + 1]].tolist(), logs0[place])]
        if source and split[source][0] == place:
            shunned += split[source][1]
        path, log_prob = lattice.other(int(places[place]), shunned, (seed + ((turn + 1) << 40)) % (1 << 64))
        tail = places[place + 1 :]
        salt = np.array([(seed + ((turn + 1) << 48)) % (1 << 64)], U)
        n, new, logs = yield tail, mix(salt + (np.arange(len(tail), dtype=U) << U(12)))
        pieces = np.concatenate([pieces0[:place], [len(path)], n])
        ids = np.concatenate([ids0[: at[place]], path, new]).astype(np.int64)
        log_probs = np.concatenate([logs0[:place], [log_prob], logs])
    limit = best if len(done) == k else -np.inf
    out = []
    for _, ids, log_probs, high in done:
        total = float(log_probs.sum())
        with np.errstate(over="ignore"):
            inclusion = 1.0 if limit == -np.inf else float(-np.expm1(-np.exp(total - limit)))
        # of a small one the logarithm is what is left: 1 - exp(-x) is x there
        log_inclusion = float(np.log(inclusion)) if inclusion > 1e-12 else total - limit
        out.append((ids, total, float(high), inclusion, log_inclusion))
    return out


def segment_chunk(texts: list[str], seeds: np.ndarray, vocab: Vocabulary, k: int):
    """top_k of each text of a chunk."""
    units, bounds, ptr = units_of(texts, vocab)
    if not len(units):
        return [[(np.zeros(0, np.int64), 0.0, 0.0, 1.0, 0.0)] for _ in texts]
    lo, hi = bounds[:-1], bounds[1:]
    code = mix(poly(vocab.code[units], lo, hi) ^ (hi - lo).astype(U))
    _, pick, word = np.unique(code, return_index=True, return_inverse=True)
    size = (hi - lo)[pick]
    new = np.concatenate([[0], np.cumsum(size)])
    flat = np.repeat(lo[pick] - new[:-1], size) + np.arange(new[-1])
    lattice = Lattice(units[flat], new, vocab)
    places = new[word]
    owner = np.repeat(np.arange(len(texts)), np.diff(ptr))
    turn = (np.arange(len(places)) - ptr[owner]).astype(U)
    n, ids, logs = lattice.sample(places, mix(seeds[owner] + (turn << U(12))))
    at = np.concatenate([[0], np.cumsum(n)])
    out = [[(np.zeros(0, np.int64), 0.0, 0.0, 1.0, 0.0)] for _ in texts]  # of an empty text
    going = {i: top_k(lattice, places[a:b], (n[a:b], ids[at[a] : at[b]], logs[a:b]), int(s), k)
             for i, (a, b, s) in enumerate(zip(ptr, ptr[1:], seeds)) if b > a}
    answers = dict.fromkeys(going)
    while going:
        asked = []
        for i, text in list(going.items()):
            try:
                asked.append((i, *text.send(answers[i])))
            except StopIteration as done:
                out[i] = done.value
                del going[i]
        if asked:
            n, ids, logs = lattice.sample(*(np.concatenate([a[c] for a in asked]) for c in (1, 2)))
            at, lo = np.concatenate([[0], np.cumsum(n)]), 0
            for i, tail, _ in asked:
                hi = lo + len(tail)
                answers[i], lo = (n[lo:hi], ids[at[lo] : at[hi]], logs[lo:hi]), hi
    return out


def chunks(texts: list[str], limit: int = CHUNK_CHARS):
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def sample_segmentations(docs: DataFrame, model: str, k: int = 2, key: str = "doc_id", text: str = "text",
                         with_ids: bool = False, seed: int = 0, check: bool = False) -> DataFrame:
    """Up to ``k`` distinct segmentations of each row's whole text: doc_id,
    sample (from 0, by falling perturbed value), n_pieces, ids_crc32 (of
    little-endian unsigned 32-bit ids), log_prob, perturbed, inclusion (the
    chance to be above the (k+1)-th perturbed value: 1 where there is none) and
    log_inclusion, which weights long texts too (the chance itself is 0 there);
    with ``with_ids`` also ids; with ``check`` every segmentation is decoded:
    decoded_sha256 (of the decoded text in UTF-8) and restored (it is the text).

    Draws are seeded by the row key, so rows of equal key and text get equal
    samples; a null key counts as the key 'null'. Null and empty texts have
    the empty segmentation alone. Decoding any of the ids gives the text back
    (a space mark in it as a space). Other columns are not read; an empty
    table gives an empty result."""
    kind = docs.schema[key].dataType.simpleString()
    extra = (", ids array<int>" if with_ids else "") + (", decoded_sha256 string, restored boolean" if check else "")

    def run(batches):
        vocab, spell = vocabulary(model), decoder(model)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            seeds = mix(b.column(2).to_numpy().view(U) ^ U(seed))
            for lo, hi in chunks(texts):
                found = segment_chunk(texts[lo:hi], seeds[lo:hi], vocab, k)
                rows = [(lo + i, s, len(x[0]), zlib.crc32(x[0].astype("<u4").tobytes()), *x[1:], x[0])
                        for i, some in enumerate(found) for s, x in enumerate(some)]
                cols = list(zip(*rows))
                arrays = [b.column(0).take(pa.array(cols[0])), pa.array(cols[1], pa.int32()),
                          *(pa.array(c, t) for c, t in zip(cols[2:8], (pa.int64(), pa.int64(), *[pa.float64()] * 4)))]
                if with_ids:
                    ends = np.cumsum([0, *cols[2]], dtype=np.int32)
                    arrays.append(pa.ListArray.from_arrays(ends, np.concatenate(cols[8]).astype(np.int32)))
                names = ["doc_id", "sample", "n_pieces", "ids_crc32", "log_prob", "perturbed", "inclusion", "log_inclusion",
                         "ids"][: len(arrays)]
                if check:
                    back = [(spell(row[-1].tolist()), texts[row[0]].replace(chr(SPACE_MARK), " ")) for row in rows]
                    arrays += [pa.array([hashlib.sha256(d.encode()).hexdigest() for d, _ in back], pa.string()),
                               pa.array([d == t for d, t in back], pa.bool_())]
                    names += ["decoded_sha256", "restored"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(F.col(key), F.col(text).cast("string"), F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("null")))).mapInArrow(
        run, f"doc_id {kind}, sample int, n_pieces long, ids_crc32 long, log_prob double, perturbed double, inclusion double, log_inclusion double{extra}")


@functools.lru_cache(maxsize=2)
def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


@functools.lru_cache(maxsize=2)
def spellings(path: str) -> list[bytes | None]:
    """Each piece's bytes in a text; None for the special ones (controls, the
    unknown one)."""
    sp = processor(path)

    def spelt(i):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            return None
        piece = sp.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace(chr(SPACE_MARK), " ").encode()

    return [spelt(i) for i in range(sp.get_piece_size())]


def decoder(path: str):
    """Function from valid piece ids to their text."""
    sp, words = processor(path), spellings(path)

    def text(ids: list[int]) -> str:
        try:
            spelt = b"".join([words[i] for i in ids]).decode()
        except (TypeError, UnicodeDecodeError):  # a special piece, or bytes that are no characters
            return sp.decode(ids)
        return spelt[1:] if spelt.startswith(" ") and not sp.is_byte(ids[0]) else spelt

    return text


def decode(ids: list[int], model: str) -> str:
    return processor(model).decode(ids)


def decode_ids(rows: DataFrame, model: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``rows`` with column ``out`` (added, or replaced): the text of the piece
    ids in ``ids``. No ids give the empty text, null or an id that is null or
    outside the vocabulary give null; other columns and repeated rows stay."""
    @F.pandas_udf("string")
    def text(col: pd.Series) -> pd.Series:
        spell, n = decoder(model), len(spellings(model))

        def one(x):
            if x is None:
                return None
            if not (isinstance(x, np.ndarray) and x.dtype.kind == "i"):  # with nulls, or no ids at all
                if any(i is None or i != i for i in x):
                    return None
                x = np.array(x, np.int64)
            if len(x) and not (0 <= x.min() and x.max() < n):
                return None
            return spell(x.tolist())

        return col.map(one)

    return rows.withColumn(out, text(F.col(ids).cast("array<int>")))
