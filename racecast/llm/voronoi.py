"""Exact top-k inner products by a Voronoi join.

Pivots divide data and queries into groups. A summary of each data group (its smallest distances to
its pivot) bounds from below the k-th best score that any query of a query group will reach; a data
row goes to a query group only if its upper bound there reaches that. Each task then solves one
block of queries against one slice of the rows sent to their group.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from racecast.llm.common import Scratch
from racecast.llm.vectors import Batches, best, lists, matrix, ranked, usable

PIVOTS = 64
QUERY_BLOCK = 256
DATA_SLICE = 16_384
EXACT = float(2**53)


def lattice(df: DataFrame, key: str, vector: str, scale: float = 1024.0) -> DataFrame:
    """(id, vector) with each component x as floor(scale * x), for the rows that take part."""
    rows = usable(df, key, vector, zero=True)
    return rows.withColumn("vector", F.transform("vector", lambda x: F.floor(F.lit(scale) * x).cast("double")))


def _grouped(rows: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """Rows with the group of their nearest pivot, the distance to it, and their length."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            x = matrix(batch.column("vector"), width)
            square = (x**2).sum(axis=1)
            far = square[:, None] - 2 * x @ pivots.T + (pivots**2).sum(axis=1)
            group = far.argmin(axis=1)
            distance = np.sqrt(((x - pivots[group]) ** 2).sum(axis=1))
            columns = [batch.column("id"), lists(x), pa.array(group.astype(np.int32))]
            columns += [pa.array(distance), pa.array(np.sqrt(square))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "vector", "grp", "distance", "norm"])

    return rows.mapInArrow(run, "id long, vector array<double>, grp int, distance double, norm double")


def _solve(table: pa.Table, width: int, k: int) -> pa.Table:
    """The ``k`` best rows of a slice for each query of a block."""
    is_query = table.column("is_query").to_numpy()
    ids, x = table.column("id").to_numpy(), matrix(table.column("vector"), width)
    own, q = ids[is_query], x[is_query]
    order = np.argsort(ids[~is_query], kind="stable")
    ids, x = ids[~is_query][order], x[~is_query][order]
    out: list[tuple[np.ndarray, ...]] = []
    if len(own) and len(ids):
        if np.abs(q).max() * np.abs(x).max() * width < EXACT:
            scores = q @ x.T
        else:  # sums that doubles can't hold: whole numbers of any size
            whole = [np.array([[int(v) for v in row] for row in m], object) for m in (q, x)]
            scores = whole[0] @ whole[1].T
        for name, row in zip(own, scores):
            others = ids != name
            at = best(-row[others], ids[others], k)
            out.append((np.full(len(at), name), ids[others][at], row[others][at]))
    columns = [np.concatenate(c) if out else np.zeros(0) for c in (zip(*out) if out else ([], [], []))]
    return pa.table({n: pa.array(c.astype(np.int64)) for n, c in zip(("query_id", "vec_id", "score"), columns)})


def top_inner_products(
    data: DataFrame, queries: Column, scratch: Scratch, k: int = 10, pivots: int = PIVOTS,
    query_block: int = QUERY_BLOCK, data_slice: int = DATA_SLICE,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` highest inner products of every query.

    ``data`` is (id, vector) of whole numbers, as ``lattice`` gives them; ``queries``, a condition on
    ``id``, says which rows are queries. Candidates of a query are all rows with another id, ties go to
    the smaller id; shorter vectors count as followed by zeros. Rows that repeat an id are candidates
    each, but one query, with the smallest of their vectors. No rows or no queries give no rows. What
    reaches the driver is bounded by ``pivots`` and ``k``.
    """
    spark = data.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    asked = data.filter(queries).groupBy("id").agg(F.min("vector").alias("vector"))
    size = data.agg(F.max(F.size("vector")).alias("width"), F.count("*").alias("n")).first()
    n_queries = asked.count()
    if not size["n"] or not n_queries:
        return empty
    width = max(1, size["width"])
    chosen = data.orderBy(F.xxhash64("id"), "id", "vector").limit(pivots).select("vector").toArrow()
    points = np.unique(matrix(chosen.column("vector"), width), axis=0)
    grouped = scratch.keep(_grouped(data, points, width))
    q_points = points[: max(1, min(len(points), n_queries // query_block))]
    asked = scratch.keep(_grouped(asked, q_points, width))

    # Summaries: of each data group the k + 1 smallest distances, each id counted once in one group
    # (a query's own id may be one of them); of each query group its radius, its longest vector and its size.
    nearest = Window.partitionBy("grp").orderBy("distance")
    once = grouped.groupBy("id").agg(F.min(F.struct("distance", "grp")).alias("_least")).select("_least.*")
    near = once.withColumn("_r", F.row_number().over(nearest)).filter(F.col("_r") <= k + 1)
    near_rows = near.select("grp", "distance").toArrow()
    circles = asked.groupBy("grp").agg(
        F.max("distance").alias("radius"), F.max("norm").alias("norm"), F.count("*").alias("n")
    ).toArrow()
    groups = circles.column("grp").to_numpy()
    radius, norm = circles.column("radius").to_numpy(), circles.column("norm").to_numpy()
    blocks = -(-circles.column("n").to_numpy() // query_block)
    of, distance = near_rows.column("grp").to_numpy(), near_rows.column("distance").to_numpy()
    centres = q_points[groups]
    lengths = np.sqrt((points**2).sum(axis=1))
    floor = (centres @ points.T - radius[:, None] * lengths)[:, of] - norm[:, None] * distance
    rank = min(k + 1, floor.shape[1])
    bound = np.partition(floor, -rank, axis=1)[:, -rank] if floor.shape[1] > k else np.full(len(groups), -np.inf)
    # Room for rounding in the bounds; the scores themselves are exact.
    bound = bound - 1e-9 * (np.abs(bound) + norm * (lengths.max() + distance.max())) - 1e-6
    slices_ = max(1, -(-size["n"] // data_slice))

    def replicate(batches: Batches) -> Batches:
        """Each data row once for each block of a query group whose bound it reaches."""
        for batch in batches:
            x = matrix(batch.column("vector"), width)
            group, own = batch.column("grp").to_numpy(), batch.column("distance").to_numpy()
            direct = x @ centres.T + batch.column("norm").to_numpy()[:, None] * radius
            by_group = (centres @ points.T + radius[:, None] * lengths)[:, group].T + norm * own[:, None]
            row, to = np.nonzero(np.minimum(direct, by_group) >= bound)
            times = blocks[to]
            block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, to = np.repeat(row, times), np.repeat(to, times)
            taken = batch.take(pa.array(row))
            columns = [taken.column("id"), taken.column("vector")]
            columns += [pa.array(groups[to].astype(np.int32)), pa.array(block.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "vector", "grp", "block"])

    sent = grouped.mapInArrow(replicate, "id long, vector array<double>, grp int, block int")
    piece = F.pmod(F.xxhash64("id", "vector"), F.lit(slices_)).cast("int")
    sent = sent.select("id", "vector", "grp", "block", piece.alias("slice"), F.lit(False).alias("is_query"))
    n_blocks = reduce(
        lambda c, x: c.when(F.col("grp") == int(x[0]), int(x[1])), zip(groups, blocks), F.when(F.lit(False), 1)
    )
    block = F.pmod(F.xxhash64("id"), n_blocks.otherwise(1)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(slices_ - 1)))
    asked = asked.select("id", "vector", "grp", block.alias("block"), every.alias("slice"), F.lit(True).alias("is_query"))
    solved = sent.union(asked).groupBy("grp", "block", "slice").applyInArrow(
        lambda table: _solve(table, width, k), "query_id long, vec_id long, score long"
    )
    return ranked(solved, F.col("score").desc(), k).select("query_id", "rank", "vec_id", "score")
