"""Language-model scoring: a hashed maximum-entropy model with a class-factored
softmax, beside an add-one unigram base score.

P(word | history) = P(class | history) * P(word | class). The class of a word
is a hash of its last two bytes (the end of a text is a class of its own). The
class factor is a maximum-entropy model over hashed features of the history:
the word before (bigram), the two before (trigram) and the one before the last
(skip). The word factor has no history: (c + 1) / (all counts of the class +
its words + 1), which leaves an unseen word of the class the weight of one
count. Both factors sum to one.

Counts cover every training text. Gradients: every task goes once through its
texts with Adagrad steps from the common start; the tasks' weights are averaged
by how often each feature was met. Scoring is in sparse numpy batches.

log10(c + 1) of the ``HEAD`` most frequent tokens is broadcast (a fixed size);
the tokens of a text beyond them are joined with the table of counts.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import stored
from orderlens.llm.words import BASE, U, Words, mix, signed, words_of

CLASSES, FEATURES, KINDS = 32, 1 << 14, 3
HEAD = 1 << 18
BATCH, RATE = 4096, 0.3
END, START = mix(np.array([3, 5], U))
FLUSH = 1 << 20
CLASS_OF = (1 + mix(np.arange(1 << 16, dtype=U)) % U(CLASSES - 1)).astype(np.int64)  # of a word's last two bytes


class Tokens:
    """Tokens of a chunk: the words of each text, then one end."""

    def __init__(self, words: Words):
        self.first, self.rows = words.first, words.rows
        n = np.diff(words.ptr) + 1
        self.ptr = np.concatenate([[0], np.cumsum(n)])
        self.hash = np.insert(words.hashes, words.ptr[1:], END)
        self.owner = np.repeat(np.arange(words.rows), n)
        self.words = words

    @functools.cached_property
    def cls(self) -> np.ndarray:
        words = self.words
        last = words.data[words.ends - 1].astype(np.int64)
        last += words.data[np.maximum(words.ends - 2, words.starts)].astype(np.int64) << 8
        return np.insert(CLASS_OF[last], words.ptr[1:], 0)

    def features(self) -> np.ndarray:
        one, two = np.roll(self.hash, 1), np.roll(self.hash, 2)
        one[self.ptr[:-1]] = START
        two[self.ptr[:-1]] = START
        second = self.ptr[:-1] + 1
        two[second[second < len(two)]] = START
        kinds = (mix(one ^ U(11)), mix(mix(two * U(BASE) + one) ^ U(12)), mix(two ^ U(13)))
        return np.stack([k & U(FEATURES - 1) for k in kinds], axis=1).astype(np.int64)


def tokens_of(column: pa.Array):
    for words in words_of(column, lower=True):
        yield Tokens(words)


def class_weights(weights: np.ndarray, bias: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp(score - highest score) of every class for each row of features, and
    the rows' sums: their ratio is the probability of the class."""
    out = np.take(weights, features[:, 0], axis=0)
    out += np.take(weights, features[:, 1], axis=0)
    out += np.take(weights, features[:, 2], axis=0)
    out += bias
    out -= out.max(axis=1, keepdims=True)
    np.exp(out, out=out)
    return out, out.sum(axis=1)


class Learner:
    """Adagrad on one task's texts."""

    def __init__(self):
        self.w, self.w2 = np.zeros((FEATURES, CLASSES), np.float32), np.zeros((FEATURES, CLASSES), np.float32)
        self.b, self.b2 = np.zeros(CLASSES, np.float32), np.zeros(CLASSES, np.float32)
        self.met, self.seen = np.zeros(FEATURES, np.int64), 0

    def learn(self, features: np.ndarray, cls: np.ndarray) -> None:
        for lo in range(0, len(cls), BATCH):
            f, y = features[lo : lo + BATCH], cls[lo : lo + BATCH]
            g, total = class_weights(self.w, self.b, f)
            g /= total[:, None]
            g[np.arange(len(y)), y] -= 1
            flat = f.ravel()
            order = np.argsort(flat, kind="stable")
            at = flat[order]
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            step = np.add.reduceat(g[order // KINDS], first, axis=0)
            rows = at[first]
            n = np.diff(np.append(first, len(at)))
            step /= np.sqrt(n)[:, None]
            self.w2[rows] += step * step
            self.w[rows] -= RATE * step / np.sqrt(self.w2[rows] + 1e-6)
            self.met[rows] += n
            down = g.sum(axis=0) / np.sqrt(len(y))
            self.b2 += down * down
            self.b -= RATE * down / np.sqrt(self.b2 + 1e-6)
            self.seen += len(y)


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token, cls, c) over all rows of ``texts`` (text), summed in the task
    before the shuffle."""
    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged():
            h, c, n = (np.concatenate(x) for x in zip(*held))
            token, first, code = np.unique(h, return_index=True, return_inverse=True)
            return token, c[first], np.bincount(code, n, len(token)).astype(np.int64)

        def out(token, cls, n):
            for lo in range(0, len(token), 1 << 16):
                part = slice(lo, lo + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(signed(token[part])), pa.array(cls[part].astype(np.int32)),
                                                  pa.array(n[part])], ["token", "cls", "c"])

        for b in batches:
            for t in tokens_of(b.column(0)):
                token, first, n = np.unique(t.hash, return_index=True, return_counts=True)
                held.append((token, t.cls[first], n.astype(np.int64)))
                if sum(len(h[0]) for h in held) > FLUSH:
                    held = [merged()]
                    if len(held[0][0]) > FLUSH // 2:
                        yield from out(*held.pop())
        if held:
            yield from out(*merged())

    return (texts.mapInArrow(run, "token long, cls int, c long").groupBy("token")
            .agg(F.sum("c").alias("c"), F.min("cls").alias("cls")))


def train(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Class weights from all rows of ``texts`` (text): a task's weights come
    as FEATURES / 256 blocks, which are averaged by block."""
    def run(batches):
        learner = Learner()
        for b in batches:
            for t in tokens_of(b.column(0)):
                learner.learn(t.features(), t.cls)
        if learner.seen:
            for k in range(FEATURES // 256):
                met = learner.met[256 * k : 256 * (k + 1)]
                if met.any():
                    yield block(k, learner.w[256 * k : 256 * (k + 1)].astype(np.float64) * met[:, None], met)
            yield block(-1, learner.b[None].astype(np.float64) * learner.seen, np.array([learner.seen]))

    def block(k, total, met):
        return pa.RecordBatch.from_arrays(
            [pa.array([k], pa.int32()), pa.array([total.astype(np.float32).tobytes()], pa.binary()),
             pa.array([met.astype(np.int64).tobytes()], pa.binary())], ["block", "total", "met"])

    def add(batches):
        at, total, met = None, None, None
        for b in batches:
            for k, t, m in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                t, m = np.frombuffer(t.as_py(), np.float32).astype(np.float64), np.frombuffer(m.as_py(), np.int64)
                if k != at:
                    if at is not None:
                        yield block(at, total, met)
                    at, total, met = k, t.copy(), m.copy()
                else:
                    total += t
                    met += m
        if at is not None:
            yield block(at, total, met)

    schema = "block int, total binary, met binary"
    sums = texts.mapInArrow(run, schema).repartition("block").sortWithinPartitions("block").mapInArrow(add, schema)
    w, b = np.zeros((FEATURES, CLASSES)), np.zeros(CLASSES)
    for r in sums.collect():  # FEATURES x CLASSES numbers in all
        mean = np.frombuffer(r["total"], np.float32).reshape(-1, CLASSES) / np.maximum(1, np.frombuffer(r["met"], np.int64))[:, None]
        if r["block"] < 0:
            b = mean[0]
        else:
            w[256 * r["block"] : 256 * (r["block"] + 1)] = mean
    return w.astype(np.float32), b.astype(np.float32)


def score_texts(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every row; learned from the rows where ``held_out`` (a boolean column) is
    not true.

    Null and empty texts are the end token alone. Without training texts all
    counts are 0 and the classes are equally likely. Equal texts get equal
    scores; repeated rows, null ids and other columns do no harm; an empty
    table gives an empty result."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), held_out.alias("held_out"))
    seen = own.where(~F.col("held_out")).select("text")
    counts = stored(count_tokens(seen))
    weights, bias = train(seen)
    sums = counts.groupBy("cls").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()  # CLASSES rows
    n, v = sum(r["c"] for r in sums), sum(r["v"] for r in sums)
    whole = np.ones(CLASSES)
    for r in sums:
        whole[r["cls"]] = r["c"] + r["v"] + 1
    top = counts.orderBy(F.desc("c"), "token").limit(HEAD).select("token", "c").toArrow()
    token, c = top["token"].to_numpy().view(U), top["c"].to_numpy()
    order = np.argsort(token)
    model = docs.sparkSession.sparkContext.broadcast(
        (token[order], np.log10(c[order] + 1.0), weights, bias, np.log10(whole)))  # HEAD and FEATURES x CLASSES numbers

    def head(t: Tokens, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(tokens):
            return np.zeros(len(t.hash), np.int64), np.zeros(len(t.hash), bool)
        at = np.minimum(np.searchsorted(tokens, t.hash), len(tokens) - 1)
        return at, tokens[at] == t.hash

    def text_key(t: Tokens) -> np.ndarray:
        place = np.arange(len(t.hash)) - t.ptr[t.owner]
        return signed(np.add.reduceat(mix(t.hash ^ mix(place.astype(U))), t.ptr[:-1]))

    def tails(batches):
        tokens = model.value[0]
        for b in batches:
            for t in tokens_of(b.column(0)):
                rest = np.flatnonzero(~head(t, tokens)[1])
                pair = np.stack([t.owner[rest], signed(t.hash[rest])])
                order = np.lexsort((pair[1], pair[0]))
                pair = pair[:, order]
                first = np.flatnonzero(np.concatenate([[True], (pair[:, 1:] != pair[:, :-1]).any(axis=0)])) if len(rest) else order
                yield pa.RecordBatch.from_arrays(
                    [pa.array(text_key(t)[pair[0, first]]), pa.array(pair[1, first]),
                     pa.array(np.diff(np.append(first, len(rest))))], ["key", "token", "n"])

    def heads(batches):
        tokens, logs, w, bias_, whole_ = model.value
        for b in batches:
            for t in tokens_of(b.column(1)):
                at, known = head(t, tokens)
                gain = np.where(known, logs[at] if len(logs) else 0.0, 0.0)
                features = t.features()
                part = np.empty(len(t.cls))
                for lo in range(0, len(part), BATCH):
                    y = t.cls[lo : lo + BATCH]
                    each, total = class_weights(w, bias_, features[lo : lo + BATCH])
                    part[lo : lo + BATCH] = np.log(np.maximum(each[np.arange(len(y)), y], 1e-38)) - np.log(total)
                rows = slice(t.first, t.first + t.rows)
                each = [np.add.reduceat(x, t.ptr[:-1]) for x in (known.astype(np.int64), gain, part / np.log(10) - whole_[t.cls])]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[rows], b.column(2)[rows], pa.array(text_key(t)), pa.array(np.diff(t.ptr)),
                     *map(pa.array, each)], ["doc_id", "held_out", "key", "n_tokens", "known", "gain", "part"])

    rest = (own.select("text").mapInArrow(tails, "key long, token long, n long").join(counts.select("token", "c"), "token")
            .groupBy("key").agg(F.sum("n").alias("rest_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rest_gain")))
    scored = stored(own.select("doc_id", "text", "held_out").mapInArrow(
        heads, f"doc_id {id_type}, held_out boolean, key long, n_tokens long, known long, gain double, part double"))
    copies = scored.groupBy("key").agg(F.count("*").alias("copies"))  # every copy of a text sent its tail
    rest = rest.join(copies, "key").select("key", (F.col("rest_known") / F.col("copies")).cast("long").alias("rest_known"),
                                           (F.col("rest_gain") / F.col("copies")).alias("rest_gain"))
    gain = F.col("gain") + F.coalesce("rest_gain", F.lit(0.0))
    return scored.join(rest, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (gain - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))).alias("base_score"),
        (gain + F.col("part")).alias("score"))
