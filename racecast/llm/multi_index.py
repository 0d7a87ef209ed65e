"""Approximate nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised by a codebook each; a pair of centroids is a cell, and every
vector is indexed in its cell. A query visits cells by the sum of its distances to the two centroids,
in rising order by a heap, until they hold the wanted share of all rows, and those rows are ranked by
their exact distance.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racecast.llm.common import Scratch
from racecast.llm.vectors import Batches, best, lists, matrix, ranked, usable

CENTROIDS = 64
SAMPLE = 4096
SHARE = 0.6
SLICE = 16_384
ROUNDS = 15


def codebook(rows: np.ndarray, size: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of ``rows`` by Lloyd's rounds from distinct rows spread over the sample."""
    distinct = np.unique(rows, axis=0)
    centres = distinct[np.unique(np.linspace(0, len(distinct) - 1, size).astype(int))]
    for _ in range(rounds):
        nearest = closest(rows, centres)
        n = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def closest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * rows @ centres.T).argmin(axis=1)


def visit(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: int) -> np.ndarray:
    """Cells, numbered by pairs of centroids, in rising order of ``first[i] + second[j]``.

    Stops when the visited cells hold ``wanted`` rows; ``counts`` is the rows of each pair.
    """
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    d, e = first[a].tolist(), second[b].tolist()
    table = counts[np.ix_(a, b)].tolist()
    heap = [(d[0] + e[0], 0, 0)]
    reached = [0] * len(d)  # of each row of the table of sums, how far it has been put on the heap
    held, out = 0, []
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        if table[i][j]:
            held += table[i][j]
            out.append((i, j))
        if j + 1 < len(e):
            heapq.heappush(heap, (d[i] + e[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(d) and not reached[i + 1]:
            reached[i + 1] = 1
            heapq.heappush(heap, (d[i + 1] + e[0], i + 1, 0))
    if not out:
        return np.zeros(0, np.int64)
    at = np.array(out)
    return a[at[:, 0]] * len(second) + b[at[:, 1]]


def _rerank(table: pa.Table, width: int, cells: int, k: int) -> pa.Table:
    """Exact distances of each query to the rows of its cells that are in this slice."""
    is_query = table.column("is_query").to_numpy()
    ids, x = table.column("id").to_numpy(), matrix(table.column("vector"), width)
    visits = table.column("visits").combine_chunks().filter(pa.array(is_query))
    own, q = ids[is_query], x[is_query]
    order = np.argsort(ids[~is_query], kind="stable")
    ids, x = ids[~is_query][order], x[~is_query][order]
    cell = table.column("cell").to_numpy(zero_copy_only=False)[~is_query][order].astype(np.int64)
    out: list[tuple[np.ndarray, ...]] = []
    for name, vector, wanted in zip(own, q, visits):
        visited = np.zeros(cells, bool)
        visited[np.asarray(wanted.values)] = True
        at = np.flatnonzero(visited[cell] & (ids != name))
        distance = np.sqrt(((x[at] - vector) ** 2).sum(axis=1))
        chosen = best(distance, ids[at], k)
        out.append((np.full(len(chosen), name), ids[at][chosen], distance[chosen]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0)] * 3
    kinds = (("query_id", np.int64), ("vec_id", np.int64), ("score", np.float64))
    return pa.table({n: pa.array(c.astype(t)) for (n, t), c in zip(kinds, columns)})


def nearest(
    df: DataFrame, key: str, vector: str, queries: Column, scratch: Scratch, k: int = 10, centroids: int = CENTROIDS,
    sample: int = SAMPLE, share: float = SHARE, slice_rows: int = SLICE,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows found for every query.

    ``queries`` is a condition on ``id``. Codebooks are fitted on at most ``sample`` rows, chosen by
    hash; every usable row is indexed, and a query looks at ``share`` of them or a cell more. Vectors
    that are NULL, zero or not finite take no part, nor do rows without id; shorter vectors count as
    followed by zeros. Ties go to the smaller id. Rows that repeat an id are candidates each, but one
    query, with the smallest of their vectors. No rows or queries give no rows. The driver sees the
    sample and the size of each cell, at most ``centroids`` squared.
    """
    spark = df.sparkSession
    data = usable(df, key, vector, zero=False)
    asked = data.filter(queries).groupBy("id").agg(F.min("vector").alias("vector"))
    size = data.agg(F.max(F.size("vector")).alias("width"), F.count("*").alias("n")).first()
    if not size["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, total = size["width"], size["n"]
    rows = data.orderBy(F.xxhash64("id"), "id", "vector").limit(sample).select("vector").toArrow()
    points = matrix(rows.column("vector"), width)
    half = -(-width // 2)
    books = codebook(points[:, :half], centroids), codebook(points[:, half:], centroids) if half < width else np.zeros((1, 0))
    shape = len(books[0]), len(books[1])

    def index(batches: Batches) -> Batches:
        for batch in batches:
            x = matrix(batch.column("vector"), width)
            cell = closest(x[:, :half], books[0]) * shape[1] + closest(x[:, half:], books[1])
            columns = [batch.column("id"), lists(x), pa.array(cell.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "vector", "cell"])

    entries = scratch.keep(data.mapInArrow(index, "id long, vector array<double>, cell int"))
    cells = entries.groupBy("cell").agg(F.count("*").alias("n")).toArrow()
    counts = np.zeros(shape[0] * shape[1], np.int64)
    counts[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    counts = counts.reshape(shape)

    # Cells with the same first centroid lie together; neighbours share a part until it is full, and
    # a full part is cut into slices by hash, so that a crowded cell is in many tasks.
    per_first = counts.sum(axis=1)
    part = (np.cumsum(per_first) - per_first) // slice_rows
    _, part = np.unique(part, return_inverse=True)
    pieces = -(-np.bincount(part, per_first).astype(np.int64) // slice_rows)
    of_first = [int(p) for p in part]
    wanted = max(k + 1, int(np.ceil(share * total)))

    def ask(batches: Batches) -> Batches:
        for batch in batches:
            q = matrix(batch.column("vector"), width)
            first = ((q[:, None, :half] - books[0][None]) ** 2).sum(axis=2)
            second = ((q[:, None, half:] - books[1][None]) ** 2).sum(axis=2)
            rows, parts, slices, visits = [], [], [], []
            for row in range(len(q)):
                seen = visit(first[row], second[row], counts, wanted)
                for p in np.unique(part[seen // shape[1]]):
                    own = seen[part[seen // shape[1]] == p].astype(np.int32)
                    for s in range(pieces[p]):
                        rows.append(row)
                        parts.append(p)
                        slices.append(s)
                        visits.append(own)
            taken = batch.take(pa.array(rows, pa.int64()))
            columns = [taken.column("id"), lists(q[rows]), pa.array(parts, pa.int32()), pa.array(slices, pa.int32())]
            columns += [pa.array(visits, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "vector", "part", "slice", "visits"])

    questions = asked.mapInArrow(ask, "id long, vector array<double>, part int, slice int, visits array<int>")
    questions = questions.select(
        "id", "vector", F.lit(None).cast("int").alias("cell"), "part", "slice", "visits", F.lit(True).alias("is_query")
    )
    first = (F.col("cell") / shape[1]).cast("int")
    to_part = F.element_at(F.array(*[F.lit(p) for p in of_first]), first + 1)
    to_pieces = F.element_at(F.array(*[F.lit(int(p)) for p in pieces]), F.col("part") + 1)
    listed = entries.withColumn("part", to_part)
    listed = listed.withColumn("slice", F.pmod(F.xxhash64("id", "vector"), to_pieces).cast("int"))
    listed = listed.select(
        "id", "vector", "cell", "part", "slice", F.array().cast("array<int>").alias("visits"), F.lit(False).alias("is_query")
    )
    found = listed.union(questions).groupBy("part", "slice").applyInArrow(
        lambda table: _rerank(table, width, shape[0] * shape[1], k), "query_id long, vec_id long, score double"
    )
    return ranked(found, F.col("score"), k).select("query_id", "rank", "vec_id", "score")
