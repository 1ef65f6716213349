"""Vectors as rows: which take part, and how groups of rows reach tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def takes_part(vector: Column) -> Column:
    """Not null or empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column of doubles, all of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def cosines(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosine of each row with the row of ``others`` beside it (or the one
    vector ``others``), summed the same way whatever lies around it, so equal
    vectors get equal values. Scaled first: no overflow."""
    a = rows / np.abs(rows).max(axis=1, keepdims=True)
    b = others / np.abs(others).max(axis=-1, keepdims=True)
    return (a * b).sum(axis=-1) / (np.sqrt((a * a).sum(axis=-1)) * np.sqrt((b * b).sum(axis=-1)))


def units(rows: np.ndarray) -> np.ndarray:
    a = rows / np.abs(rows).max(axis=1, keepdims=True)
    return a / np.sqrt((a * a).sum(axis=1, keepdims=True))


def key_groups(batches, keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(key, slice of a batch) for rows sorted by the first ``keys`` columns;
    a key's rows may come in several slices, one after the other."""
    for b in batches:
        if b.num_rows == 0:
            continue
        cols = [b.column(k).to_pylist() for k in range(keys)]
        tuples = list(zip(*cols))
        lo = 0
        for hi in range(1, len(tuples) + 1):
            if hi == len(tuples) or tuples[hi] != tuples[lo]:
                yield tuples[lo], b.slice(lo, hi - lo)
                lo = hi


