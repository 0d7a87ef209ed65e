"""Columns of vectors: which take part, and Arrow batches of them as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racecast.llm.common import one_chunk


def finite(vector: Column) -> Column:
    """Whether a vector is there and has only finite components."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def usable(df: DataFrame, key: str, vector: str, zero: bool) -> DataFrame:
    """(id, vector as doubles) of the rows that take part: id not NULL, vector finite, and not zero unless ``zero``."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & finite(F.col("vector")))
    return rows if zero else rows.filter(F.exists("vector", lambda x: x != 0))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of ``width`` doubles; shorter vectors are followed by zeros."""
    column = one_chunk(column)
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]] if len(column) else np.zeros(0)
    sizes = np.diff(offsets)
    if len(column) and (sizes == width).all():
        return values.reshape(len(column), width).astype(np.float64)
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def lists(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as an Arrow column of lists of doubles."""
    n, width = rows.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(rows, np.float64).ravel()))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` smallest scores, ties to smaller ids, best first. ``ids`` ascend."""
    if len(scores) > k:
        limit = np.partition(scores, k - 1)[k - 1]
        at = np.flatnonzero(scores <= limit)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], scores[at]))][:k]


def ranked(found: DataFrame, order: Column, k: int) -> DataFrame:
    """The ``k`` best rows of each ``query_id`` with their ``rank`` from 1, ties to smaller ``vec_id``.

    ``found`` has at most ``k`` rows for each query and task, and Spark keeps the ``k`` best of each
    task before the shuffle.
    """
    from pyspark.sql import Window

    by = Window.partitionBy("query_id").orderBy(order, "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


Batches = Iterator[pa.RecordBatch]
