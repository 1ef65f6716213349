"""Nearest neighbours by collision counting.

Every vector (scaled to length one) has ``PROJECTIONS`` random projections,
and a block of rows keeps them as sorted arrays. Around a query's projections
windows widen step by step (virtual rehashing); a row in the windows of at
least ``COLLISIONS`` projections is verified by its exact cosine. A query is
done in a block when its k-th best is so near that rows as near would have
been verified at this width: a projection of a difference of length d is
normal with deviation d, so such a row falls into a window of half width
``SURE`` * d with a chance of 0.87 each, and into enough of the windows with a
chance of over 0.99.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import stored
from orderlens.llm.vectors import as_doubles, cosines, key_groups, matrix, takes_part, units

PROJECTIONS, COLLISIONS, SURE = 32, 23, 1.5
FIRST_WIDTH, WIDER = 0.3, 1.35
BASE_ROWS, QUERY_ROWS = 16_384, 2_048  # of a block


@functools.lru_cache(maxsize=8)
def directions(dim: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([41, dim])).standard_normal((dim, PROJECTIONS))


class SortedProjections:
    """The rows of a block with their projections as sorted arrays."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.unit = units(self.rows)
        at = self.unit @ directions(rows.shape[1])
        self.place = np.argsort(at, axis=0).T.copy()
        self.value = np.sort(at, axis=0).T.copy()

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the k nearest rows found, nearest first, ties to
        the smaller id; rows with the query's own id are left out."""
        unit = units(query[None])[0]
        at = unit @ directions(len(query))
        n = len(self.ids)
        hits = np.zeros(n, np.int64)
        done = self.ids == query_id
        score = np.full(n, -np.inf)
        width = FIRST_WIDTH
        lo = hi = np.array([np.searchsorted(v, x) for v, x in zip(self.value, at)])
        while not done.all():
            new_lo = [np.searchsorted(v, x - width, "left") for v, x in zip(self.value, at)]
            new_hi = [np.searchsorted(v, x + width, "right") for v, x in zip(self.value, at)]
            new = [p[s] for p, a, b, c, d in zip(self.place, new_lo, lo, hi, new_hi) for s in (slice(a, b), slice(c, d))]
            hits += np.bincount(np.concatenate(new), minlength=n)
            lo, hi = new_lo, new_hi
            due = np.flatnonzero((hits >= COLLISIONS) & ~done)
            score[due] = self.unit[due] @ unit
            done[due] = True
            verified = np.count_nonzero(score > -np.inf)
            if verified >= k:
                best = np.partition(score, n - k)[n - k]
                if np.sqrt(max(0.0, 2 - 2 * best)) * SURE <= width:
                    break
            width *= WIDER
        near = np.flatnonzero(score > -np.inf)
        if len(near) > k:
            near = near[score[near] >= np.partition(score[near], len(near) - k)[len(near) - k] - 1e-9]
        exact = cosines(self.rows[near], query)
        top = np.lexsort((self.ids[near], -exact))[:k]
        return self.ids[near[top]], exact[top]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the ``k`` nearest rows of
    ``vectors`` found for each row of ``queries`` (both: id, vector), by
    cosine in double precision, ties to the smaller id.

    Rows with a null id, and vectors that are null, empty, zero or hold null
    or non-finite components, take no part on either side; vectors of
    different lengths are not compared. A query's own id is no candidate.
    Queries with fewer than ``k`` candidates return all of them; rows that
    repeat an id count once, by their nearest. Empty tables give an empty
    result.

    Blocks of the rows meet blocks of the queries: blocks are by a hash of the
    id, so equal vectors do not pile up, and a task holds one block of rows
    and reads queries as they come."""
    def usable(df: DataFrame) -> DataFrame:
        return (df.select(F.col(vec_id).cast("long").alias("id"), as_doubles(F.col(vector)).alias("v"))
                .where(F.col("id").isNotNull() & takes_part(F.col("v"))).withColumn("dim", F.size("v")))

    base, asked = stored(usable(vectors)), stored(usable(queries))
    parts = max(1, -(-base.count() // BASE_ROWS))
    asks = max(1, -(-asked.count() // QUERY_ROWS))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def own(n: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    rows = base.select("dim", own(parts).alias("part"), every(asks).alias("ask"), F.lit(0).alias("role"), "id", "v")
    asked = asked.select("dim", every(parts).alias("part"), own(asks).alias("ask"), F.lit(1).alias("role"), "id", "v")
    dealt = (rows.unionByName(asked).repartition("dim", "part", "ask")
             .sortWithinPartitions("dim", "part", "ask", "role", "id"))

    def search(batches):
        at, held, index = None, [], None
        for key, b in key_groups(batches, 4):
            if key[:3] != at:
                at, held, index = key[:3], [], None
            ids, vectors_ = b.column(4).to_numpy(), matrix(b.column(5))
            if key[3] == 0:
                held.append((ids, vectors_))
                continue
            if not held:
                continue
            index = index or SortedProjections(*map(np.concatenate, zip(*held)))
            found = [index.search(q, v, k) for q, v in zip(ids, vectors_)]
            sizes = [len(i) for i, _ in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, sizes)), pa.array(np.concatenate([i for i, _ in found])),
                 pa.array(np.concatenate([s for _, s in found]))], ["query_id", "vec_id", "score"])

    found = dealt.mapInArrow(search, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
