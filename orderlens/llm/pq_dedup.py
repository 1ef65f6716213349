"""Embedding near-dedup by product quantisation.

Vectors scaled to length one lie in coarse cells (inverted lists); a row of a
list is its residual's subspace codes, with the distance ``e`` between the row
and what its codes stand for. A cosine of at least c is a distance of at most
``r = sqrt(2 - 2c)``, and both filters before the exact cosine keep all such
pairs:

* Probes: a partner within r of y can lie in the cell of centroid c only if y
  is within r of c's side of the plane between c and any other centroid (the
  ``RIVALS`` nearest to y are tried). All such cells are probed, however many.
* Codes: a partner's table-lookup distance from y is at most r + e.

The codebooks come from a bounded sample; every row is coded and compared.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import components, stored
from orderlens.llm.vectors import as_doubles, cosines, key_groups, matrix, takes_part, units

SAMPLE_ROWS = 8_192
LIST_ROWS, GROUP = 512, 16  # rows a cell aimed at; neighbouring cells dealt together
MOST_CELLS, SUBSPACES, CODES, RIVALS = 1_024, 8, 64, 8
BLOCK_ROWS, PROBES_AT_ONCE = 4_096, 256
SLACK = 1e-6


class Books(NamedTuple):
    cells: np.ndarray  # centroids
    codes: list[np.ndarray]  # codewords of each subspace
    cuts: np.ndarray  # where the subspaces begin and end

    def probes(self, rows: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """Own cell of each row, and which cells it must probe."""
        d = squared(rows, self.cells)
        apart = 2 * np.sqrt(squared(self.cells, self.cells))
        ok = np.ones(d.shape, bool)
        for rival in np.argsort(d, axis=1, kind="stable")[:, :RIVALS].T:
            ok &= d - d[np.arange(len(rows)), rival][:, None] <= apart[rival] * reach + SLACK
        return d.argmin(axis=1), ok

    def encode(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals, and how far what they stand for is off."""
        code = np.stack([squared(rest[:, a:b], book).argmin(axis=1)
                         for book, a, b in zip(self.codes, self.cuts, self.cuts[1:])], axis=1)
        stands = np.concatenate([book[c] for book, c in zip(self.codes, code.T)], axis=1)
        return code, np.sqrt(((rest - stands) ** 2).sum(axis=1))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(axis=1)[:, None] - 2 * a @ b.T + (b * b).sum(axis=1)[None], 0)


def k_means(rows: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    centres = rows[np.linspace(0, len(rows) - 1, min(k, len(rows))).astype(int)].copy()
    for _ in range(rounds):
        own = squared(rows, centres).argmin(axis=1)
        n = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, rows)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


def chained(centres: np.ndarray) -> np.ndarray:
    """Each centroid followed by the nearest one not yet listed."""
    d, order = squared(centres, centres), [0]
    d[:, 0] = np.inf
    while len(order) < len(centres):
        order.append(int(d[order[-1]].argmin()))
        d[:, order[-1]] = np.inf
    return centres[order]


def train(rows: np.ndarray, cells: int) -> Books:
    dim = rows.shape[1]
    centres = chained(k_means(rows, cells))
    rest = rows - centres[squared(rows, centres).argmin(axis=1)]
    cuts = np.unique(np.linspace(0, dim, min(SUBSPACES, dim) + 1).astype(int))
    return Books(centres, [k_means(rest[:, a:b], CODES) for a, b in zip(cuts, cuts[1:])], cuts)


def link(vectors: DataFrame, least: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding",
         label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Linked are vectors of equal, not null labels with a cosine of at least
    ``least``; n_links counts other rows, copies included. Vectors that are
    null, empty, zero or hold null or non-finite components, rows without a
    label or id, and vectors of different lengths are linked with nothing
    (n_links 0, component_id the own id). Rows that share an id are judged
    each for itself. An empty table gives an empty result.

    Equal vectors of a label are one class and compared once. Lists are split
    into blocks of ``BLOCK_ROWS`` rows by a hash; a task holds one block and
    reads its probes as they come. It counts links where they are found and
    passes on only links enough to connect, never all pairs of a group."""
    own = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"),
                         as_doubles(F.col(vector)).alias("v"))
    own = own.withColumn("ok", F.col("id").isNotNull() & F.col("label").isNotNull() & takes_part(F.col("v")))
    own = own.withColumn("h1", F.xxhash64("label", "v")).withColumn("h2", F.xxhash64(F.lit(1), "v", "label"))
    classes = stored(own.where("ok").groupBy("h1", "h2").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("v").alias("v")))
    roots, degrees = class_links(classes, least)
    of_class = (classes.select("h1", "h2", "rep", "copies").join(roots.withColumnRenamed("id", "rep"), "rep", "left")
                .join(degrees, ["h1", "h2"], "left"))
    return (own.join(of_class, ["h1", "h2"], "left")
            .select(F.col("id").alias("vec_id"),
                    F.when(F.col("ok"), F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(0).alias("n_links"),
                    F.when(F.col("ok"), F.coalesce("root", "rep")).otherwise(F.col("id")).alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id")))


def class_links(classes: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Components of the classes (id, root) and links of each (h1, h2, links)."""
    spark = classes.sparkSession
    sample = (classes.select("v").orderBy(F.xxhash64(F.lit(5), "rep")).limit(SAMPLE_ROWS).collect())
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(len(r["v"]), []).append(r["v"])
    cells = int(min(MOST_CELLS, max(1, classes.count() // LIST_ROWS)))
    books = {d: train(units(np.array(v)), min(cells, max(1, len(v) // 4))) for d, v in by_dim.items()}
    shipped = spark.sparkContext.broadcast(books)  # at most MOST_CELLS + CODES rows a dimension of the sample
    reach = float(np.sqrt(2 - 2 * least)) + SLACK

    def book(dim: int) -> Books:
        """The dimension's, or without any in the sample one cell at 0."""
        return shipped.value.get(dim) or Books(np.zeros((1, dim)), [np.zeros((1, dim))], np.array([0, dim]))

    def assign(batches):
        for (dim,), b in key_groups(batches, 1):
            cell, ok = book(dim).probes(units(matrix(b.column(1))), reach)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(cell.astype(np.int32)),
                 pa.array([np.unique(np.flatnonzero(p) // GROUP).astype(np.int32) for p in ok], pa.list_(pa.int32()))],
                [*b.schema.names, "cell", "groups"])

    label_type = classes.schema["label"].dataType.simpleString()
    columns = "dim int, v array<double>, h1 long, h2 long, rep long, copies long, label " + label_type
    dealt = stored(classes.select(F.size("v").alias("dim"), "v", "h1", "h2", "rep", "copies", "label")
                   .mapInArrow(assign, f"{columns}, cell int, groups array<int>")
                   .withColumn("group", F.expr(f"cast(cell div {GROUP} as int)")))
    size = dealt.groupBy("label", "dim", "group").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    held = dealt.drop("groups").join(size, ["label", "dim", "group"]).withColumn(
        "block", F.pmod("h1", "blocks").cast("int")).withColumn("role", F.lit(0))
    probes = (dealt.withColumn("group", F.explode("groups")).drop("groups").join(size, ["label", "dim", "group"])
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("role", F.lit(1)))
    key = ["label", "dim", "group", "block"]
    both = (held.unionByName(probes).select(*key, "role", "cell", "h1", "h2", "rep", "copies", "v").repartition(*key)
            .sortWithinPartitions(*key, "role", "cell", "h1", "h2"))

    def compare(batches):
        at, parts, lists = None, [], None
        for k, b in key_groups(batches, 5):
            if k[:4] != at:
                at, parts, lists = k[:4], [], None
            cell, *rows = (*(b.column(c).to_numpy() for c in (5, 6, 7, 8, 9)), matrix(b.column(10)))
            if k[4] == 0:
                parts.append((cell, *rows))
                continue
            if not parts:
                continue
            if lists is None:
                cells, *listed = map(np.concatenate, zip(*parts))
                lists = {c: List(book(at[1]), c, *(x[cells == c] for x in listed)) for c in np.unique(cells)}
            for lo in range(0, len(cell), PROBES_AT_ONCE):
                part = [c[lo : lo + PROBES_AT_ONCE] for c in rows]
                ok = book(at[1]).probes(units(part[-1]), reach)[1]
                for c, listed in lists.items():
                    if ok[:, c].any():
                        yield listed.probe(*(x[ok[:, c]] for x in part), reach, least)

    found = stored(both.mapInArrow(compare, "h1 long, h2 long, links long, a long, b long"))
    degrees = found.where("links is not null").groupBy("h1", "h2").agg(F.sum("links").alias("links"))
    return components(found.where("a is not null").select("a", "b")), degrees


class List:
    """One block of an inverted list."""

    def __init__(self, books: Books, cell: int, h1, h2, rep, copies, rows):
        self.books, self.centre = books, books.cells[cell]
        self.h1, self.h2, self.rep, self.copies, self.rows = h1, h2, rep, copies, rows
        self.code, self.off = books.encode(units(rows) - self.centre)
        self.part = np.arange(len(rows))

    def probe(self, h1, h2, rep, copies, rows, reach: float, least: float) -> pa.RecordBatch:
        """Links of the probes: their number with copies, and edges that
        connect what the links connect."""
        rest = units(rows) - self.centre
        far = np.zeros((len(rows), len(self.rows)))
        for m, (book, a, b) in enumerate(zip(self.books.codes, self.books.cuts, self.books.cuts[1:])):
            far += squared(rest[:, a:b], book)[:, self.code[:, m]]
        x, y = np.nonzero(np.sqrt(far) <= reach + self.off[None])
        other = (h1[x] != self.h1[y]) | (h2[x] != self.h2[y])
        x, y = x[other], y[other]
        exact = np.concatenate([np.zeros(0), *(cosines(rows[x[lo : lo + 8192]], self.rows[y[lo : lo + 8192]])
                                               for lo in range(0, len(x), 8192))])
        x, y = x[exact >= least], y[exact >= least]
        links = np.bincount(x, self.copies[y], len(rows)).astype(np.int64)
        edges = []
        for p in np.unique(x):
            mine = y[x == p]
            edges.append((int(rep[p]), int(self.rep[mine[0]])))
            joined = np.unique(self.part[mine])
            if len(joined) > 1:
                edges += [(int(self.rep[mine[0]]), int(self.rep[j])) for j in joined]
                self.part[np.isin(self.part, joined)] = joined[0]
        some = links > 0
        h1, h2, links = h1[some], h2[some], links[some]
        n, e = len(links), len(edges)
        return pa.RecordBatch.from_arrays(
            [pa.array([*h1.tolist(), *[None] * e], pa.int64()), pa.array([*h2.tolist(), *[None] * e], pa.int64()),
             pa.array([*links.tolist(), *[None] * e], pa.int64()),
             pa.array([*[None] * n, *(a for a, _ in edges)], pa.int64()),
             pa.array([*[None] * n, *(b for _, b in edges)], pa.int64())], ["h1", "h2", "links", "a", "b"])
