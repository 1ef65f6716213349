"""N-gram Jaccard join: sets of word shingles, linked from a similarity on.

Filtering by several global orders, candidates by their intersection:

* Equal sets are one *node* (so copies cost one comparison in all).
* Order ``r`` ranks tokens by an independent 64-bit hash; the *prefix* of a
  set under it is its ``PREFIX`` lowest tokens. Of two sets with Jaccard
  similarity >= 0.8 the first ``PREFIX`` tokens of their union are common ones
  with a chance of at least 0.8 each, so under every order the two prefixes
  share at least ``min(SHARED, ceil(0.8 n))`` tokens: always where the union
  has no more than ``PREFIX`` tokens, else but for a chance below 1e-12 (a
  binomial tail), which like the hash collisions behind every token is no
  case that occurs. Nothing else limits the candidates.
* Order 1 generates: within the prefixes tokens are ordered again by how many
  prefixes hold them, rarest first. Sets that share ``t`` of ``s`` tokens must
  share one of the ``s - t + 1`` rarest; tokens of one prefix only drop out at
  once, and with them all sets without ``t`` others. Buckets with the same
  members are one bucket.
* A pair is looked at in the bucket of its first common kept token. It must
  share enough tokens of the prefixes of *every* order before the whole sets
  are compared, exactly. Pairs already connected within the bucket are passed
  over: only the components count.
* A bucket of many or long sets is cut into blocks, and pairs of blocks are
  compared as tasks of bounded size.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import components, stored
from orderlens.llm.words import U, mix, shingle_sets, signed, words_of

PREFIX = 64
ORDERS = (U(0x9E6C63D0876A9A47), U(0xD1342543DE82EF95))  # beside order 1, the token's own value
BLOCK_SETS, BLOCK_TOKENS = 2048, 2_000_000


def shared_at_least(prefix: int = PREFIX, similarity: float = 0.8, chance: float = 1e-12) -> int:
    """Largest t with P(Binomial(prefix, similarity) < t) <= chance."""
    tail, t = 0.0, 0
    while True:
        tail += math.comb(prefix, t) * similarity**t * (1 - similarity) ** (prefix - t)
        if tail > chance:
            return t
        t += 1


SHARED = shared_at_least()


def needed(n):
    """Common prefix tokens that a partner of a set of ``n`` tokens needs."""
    return np.minimum(SHARED, -(-4 * np.asarray(n) // 5))


def node_of(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def shingle_table(docs: DataFrame, size: int) -> DataFrame:
    """(id, n, node, prefix) of ``docs`` (id, text): the set's size, its node
    and its prefix under order 1; node null for empty sets."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for words in words_of(b.column(1), lower=True):
                sets = [s for _, s in shingle_sets(words, size)]
                rows = slice(words.first, words.first + words.rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[rows], pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                     pa.array([signed(s[:PREFIX]) for s in sets], pa.list_(pa.int64()))], ["id", "n", "node", "prefix"])

    return docs.mapInArrow(run, f"id {id_type}, n long, node long, prefix array<long>")


def kept_tokens(nodes: DataFrame) -> DataFrame:
    """(node, rep, n, token) for the tokens under which a node is compared."""
    tokens = nodes.select("node", F.explode("prefix").alias("token"))
    spread = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    held = (tokens.join(spread, "token").groupBy("node")
            .agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("held")))  # at most PREFIX
    need = F.least(F.lit(SHARED), F.expr("cast((4 * n + 4) div 5 as int)"))
    return (held.join(nodes.select("node", "rep", "n"), "node").where(F.size("held") >= need)
            .select("node", "rep", "n", F.explode(F.slice("held", F.lit(1), F.size("held") - need + 1)).alias("x"))
            .select("node", "rep", "n", F.col("x.token").alias("token")))


def buckets(kept: DataFrame) -> DataFrame:
    """(node, rep, tokens array<struct<token, blocks>>): the buckets of each
    node; of buckets with the same members only one."""
    count = (kept.groupBy("token").agg(F.count("*").alias("sets"), F.sum("n").alias("tokens"),
                                       F.bit_xor(F.xxhash64("node")).alias("members")).where("sets > 1"))
    blocks = F.greatest(F.ceil(F.max("sets") / BLOCK_SETS), F.ceil(F.max("tokens") / BLOCK_TOKENS)).cast("int")
    one = count.groupBy("sets", "members").agg(F.min("token").alias("token"), blocks.alias("blocks"))
    return (kept.join(one.select("token", "blocks"), "token").groupBy("node", "rep")
            .agg(F.collect_list(F.struct("token", "blocks")).alias("tokens")))


def padded(rows: list[np.ndarray], width: int, pad: int) -> np.ndarray:
    out = np.full((len(rows), width), pad, np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def links_in(token: int, kept: list[np.ndarray], sets: list[np.ndarray], left: int,
             percent: int = 80) -> list[tuple[int, int]]:
    """Index pairs of linked sets of one bucket, enough to connect all that
    its links connect. With ``left`` > 0 only pairs across place ``left``.

    Sets are taken by how common their prefix tokens are here, the most
    typical first, each against all later ones not yet connected with it: a
    large group of near copies is connected by its first sets, and only what
    stays apart is compared on."""
    n = np.array([len(s) for s in sets])
    need = needed(n)
    ptr = np.concatenate([[0], np.cumsum(n)])
    values, code = np.unique(np.concatenate(sets), return_inverse=True)
    own = [code[ptr[i] : ptr[i + 1]] for i in range(len(sets))]
    pad = len(values)
    prefixes = [padded([c[:PREFIX] for c in own], PREFIX, pad)]
    for seed in ORDERS:
        rank = mix(values ^ seed)
        prefixes.append(padded([c[np.argpartition(rank[c], PREFIX)[:PREFIX]] if len(c) > PREFIX else c for c in own],
                               PREFIX, pad))
    earlier = [k[k < token] for k in kept]
    tokens, code_k = np.unique(np.concatenate(earlier), return_inverse=True)
    width = max(map(len, earlier))
    before = padded(np.split(code_k, np.cumsum([len(k) for k in earlier])[:-1]), width, len(tokens))
    mark, mark_k = np.zeros(pad + 1, bool), np.zeros(len(tokens) + 1, bool)
    often = np.bincount(prefixes[0].ravel(), minlength=pad + 1)
    often[pad] = 0
    turn = np.argsort(-often[prefixes[0]].sum(1), kind="stable")
    part, side = np.arange(len(sets)), np.arange(len(sets)) < left
    out = []
    for t, i in enumerate(turn[:-1]):
        js = turn[t + 1 :]
        js = js[part[js] != part[i]]
        if left:
            js = js[side[js] != side[i]]
        js = js[np.minimum(n[js], n[i]) * 100 >= np.maximum(n[js], n[i]) * percent]
        if width and len(js):  # a pair belongs to the bucket of its first common token
            mark_k[before[i]] = True
            mark_k[-1] = False
            js = js[~mark_k[before[js]].any(1)]
            mark_k[before[i]] = False
        for p in prefixes:
            if len(js):
                mark[p[i]] = True
                mark[pad] = False
                js = js[mark[p[js]].sum(1) >= np.maximum(need[js], need[i])]
                mark[p[i]] = False
        if not len(js):
            continue
        mark[own[i]] = True
        both = np.add.reduceat(mark[np.concatenate([own[j] for j in js])].astype(np.int64),
                               np.concatenate([[0], np.cumsum(n[js])[:-1]]))
        mark[own[i]] = False
        js = js[100 * both >= percent * (n[i] + n[js] - both)]
        out += [(int(i), int(j)) for j in js]
        part[np.isin(part, part[js])] = part[i]
    return out


def link_nodes(docs: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """(a, b): links between nodes by their representatives' ids, enough to
    connect every component. ``members``: buckets(); ``docs``: id, text."""
    id_type = docs.schema["id"].dataType.simpleString()
    row = pa.schema([("token", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("side", pa.int32()),
                     ("node", pa.int64()), ("kept", pa.binary()), ("tokens", pa.binary())])

    def deal(batches):
        for b in batches:
            for words in words_of(b.column(1), lower=True):
                for r, tokens in shingle_sets(words, size):
                    if node_of(tokens) != b.column(2)[r].as_py():
                        continue  # another row with the representative's id
                    held = b.column(3)[r].values
                    kept, blocks = held.field(0).to_pylist(), held.field(1).to_pylist()
                    rows = []
                    for token, k in zip(kept, blocks):
                        own = b.column(2)[r].as_py() % k
                        rows += [(token, min(own, o), max(own, o), int(own > o)) for o in range(k)]
                    m = len(rows)
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(c, f.type) for c, f in zip(zip(*rows), row)),
                         b.column(2)[slice(r, r + 1)].take(pa.array([0] * m)),
                         pa.array([np.array(sorted(kept), np.int64).tobytes()] * m, pa.binary()),
                         pa.array([tokens.tobytes()] * m, pa.binary()),
                         b.column(0)[slice(r, r + 1)].take(pa.array([0] * m))], [*row.names, "rep"])

    schema = f"token long, lo int, hi int, side int, node long, kept binary, tokens binary, rep {id_type}"
    dealt = docs.join(members.withColumnRenamed("rep", "id"), "id").select("id", "text", "node", "tokens").mapInArrow(deal, schema)
    dealt = (dealt.repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi", "side", "node"))

    def compare(batches):
        at, group = None, []
        for b in batches:
            cols = [b.column(c).to_pylist() for c in range(4)]
            kept, tokens, reps = b.column(5), b.column(6), b.column(7).to_pylist()
            for r, key in enumerate(zip(*cols[:3])):
                if key != at:
                    yield from found(at, group)
                    at, group = key, []
                group.append((cols[3][r], reps[r], np.frombuffer(kept[r].as_py(), np.int64),
                              np.frombuffer(tokens[r].as_py(), U)))
        yield from found(at, group)

    def found(key, group):
        if len(group) < 2:
            return
        left = sum(g[0] == 0 for g in group) if key[1] != key[2] else 0
        if key[1] != key[2] and left in (0, len(group)):
            return
        ids = [g[1] for g in group]
        pairs = links_in(key[0], [g[2] for g in group], [g[3] for g in group], left)
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i, _ in pairs]), pa.array([ids[j] for _, j in pairs])],
                                             ["a", "b"])

    return dealt.mapInArrow(compare, f"a {id_type}, b {id_type}")


def join_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    Words: A-Z lower-cased runs of other than ASCII white space of the whole
    text. Set: distinct ``size``-word shingles; fewer words are one shingle;
    null text or no words: an empty set, linked with nothing. Linked are rows
    with 100 * intersection >= 80 * union; component_id is the smallest
    doc_id reached. Every row is judged for itself, also where rows share an
    id. Rows without an id are linked with nothing and get no component. An
    empty table gives an empty result; other columns are not read."""
    own = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    sets = stored(shingle_table(own, size))
    named = sets.where("id is not null and node is not null")
    lead = named.groupBy("node").agg(F.min("id").alias("rep"))
    nodes = (named.join(lead, "node").where("id = rep").select("node", "rep", "n", "prefix").dropDuplicates(["node"]))
    kept = stored(kept_tokens(nodes))
    roots = components(link_nodes(own.where("id is not null"), buckets(kept), size))
    of_node = lead.join(roots.withColumnRenamed("id", "rep"), "rep", "left").select(
        "node", F.coalesce("root", "rep").alias("root"))
    return (sets.select("id", "n", "node").join(of_node, "node", "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).alias("component_id")))
