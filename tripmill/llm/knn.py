"""Exact top-k search by inner product as a Voronoi join.

Vectors are turned into whole numbers. The largest inner product is the smallest distance once every
data vector gets one further component that brings all to one length, so the metric bounds apply:

1. A bounded sample of data vectors are the pivots. Each vector goes to the cell of its nearest pivot.
2. Summaries per cell: how far its queries reach from the pivot, and the ``k + 1`` smallest distances
   of its data.
3. From the summaries alone, each query cell gets a bound within which every one of its queries has
   ``k`` neighbours, and from that, for each data cell, the distances to the pivot at which a vector
   can still be within the bound.
4. A data vector is sent to just the query cells for which it lies in that range; cells are cut into
   blocks of bounded size on both sides, so a cell with a third of all vectors is many tasks.
5. Each pair of blocks is solved exactly with one matrix product; the best ``k`` per query and block
   are merged.

Bounds are widened for rounding, and scores are computed in whole numbers, so the result is exact
while scores stay below 2**53. What the driver holds is the pivots and a table of cell pairs, bounded
by ``max_pivots``.

Defined cases: vectors that are null, or hold a null or non-finite component, and rows without an id
take no part; shorter vectors count as padded with zeros; an empty vector scores 0 with all; rows
that share an id are never each other's neighbours; a repeated row is a neighbour as often as it
occurs; a query that is repeated is answered once. Fewer than ``k`` candidates give what there is.
Other columns are not read. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tripmill.llm.common import for_python, written
from tripmill.session import fresh_folder

# --- parameters -------------------------------------------------------------------------------------
SCALE = 64
K = 20
MAX_PIVOTS = 256
ROWS_PER_PIVOT = 4096
BLOCK = 2048

_ROUNDING = 1e-6


def whole(vector: Column, scale: int = SCALE) -> Column:
    """Components times ``scale``, rounded down; null if the vector takes no part."""
    parts = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    fit = vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fit, parts)


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    """Vectors as one matrix, short ones padded with zeros."""
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def _lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """One further component that brings all vectors to one length."""
    squares = np.einsum("ij,ij->i", vectors, vectors)
    return np.hstack([vectors, np.sqrt(np.maximum(longest - squares, 0.0))[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :]
               - 2.0 * (a @ b.T))
    return np.sqrt(np.maximum(squares, 0.0))


def _nearest(pivots: np.ndarray, longest: float, width: int, is_query: bool) -> Callable:
    """Add cell and distance to its pivot; queries have 0 as the further component."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if not len(rows):
                continue
            vectors = _matrix(rows["vector"], width)
            lifted = (np.hstack([vectors, np.zeros((len(vectors), 1))]) if is_query
                      else _lifted(vectors, longest))
            away = _distances(lifted, pivots)
            cell = away.argmin(axis=1)
            yield pd.DataFrame({
                "vec_id": rows["vec_id"], "vector": rows["vector"], "cell": cell.astype("int32"),
                "away": away[np.arange(len(cell)), cell]})
    return add


def reach(pivots: np.ndarray, far: np.ndarray, data_near: list[np.ndarray],
          k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query cell (row) and data cell (column), the least and the greatest distance from its own
    pivot at which a data vector can be among the ``k`` nearest of some query of the cell.

    ``far`` is the distance of a cell's farthest query (negative: no query), ``data_near`` the
    smallest distances of each data cell, in order.
    """
    n = len(pivots)
    between = _distances(pivots, pivots)
    low, high = np.full((n, n), np.inf), np.full((n, n), -np.inf)
    for i in range(n):
        if far[i] < 0:
            continue
        # No query of the cell is farther from a data vector than by way of the two pivots.
        ways = np.concatenate([far[i] + between[i, j] + near for j, near in enumerate(data_near)])
        bound = np.partition(ways, k)[k] if len(ways) > k else np.inf
        slack = _ROUNDING * (1.0 + far[i] + between[i])
        low[i] = between[i] - far[i] - bound - slack
        high[i] = between[i] + far[i] + bound + slack
    return low, high


def _solver(width: int, k: int) -> Callable:
    """The best ``k`` of a block of data for each query of a block."""
    def solve(key, queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(data):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        ids = data["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], _matrix(data["vector"], width)[order]
        found = []
        own = queries["vec_id"].to_numpy()
        asked = _matrix(queries["vector"], width)
        for begin in range(0, len(own), 256):
            scores = asked[begin:begin + 256] @ vectors.T
            part = own[begin:begin + 256]
            scores[ids[None, :] == part[:, None]] = -np.inf
            for query, row in zip(part, scores):
                if len(row) > k:
                    least = np.partition(row, len(row) - k)[len(row) - k]
                    take = np.flatnonzero(row >= least)
                    take = take[np.argsort(-row[take], kind="stable")[:k]]
                else:
                    take = np.argsort(-row, kind="stable")
                take = take[row[take] > -np.inf]
                found.append(np.column_stack([np.full(len(take), query), ids[take],
                                              row[take].astype("int64")]))
        rows = np.concatenate(found)
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])
    return solve


def top_k(embeddings: DataFrame, is_query: Column, k: int = K, scale: int = SCALE,
          max_pivots: int = MAX_PIVOTS, rows_per_pivot: int = ROWS_PER_PIVOT,
          block: int = BLOCK) -> DataFrame:
    """The ``k`` other rows with the highest inner product for every row that ``is_query`` picks:
    query_id, rank, vec_id, score."""
    spark = embeddings.sparkSession
    for_python(spark)
    usable = embeddings.where(F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), is_query.alias("_asks"),
        whole(F.col("embedding"), scale).alias("vector")).where(F.col("vector").isNotNull())
    rows = written(usable, fresh_folder(spark, "vectors"))
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    n, width, longest = rows.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.max(square)).first()
    result = StructType([StructField(c, LongType()) for c in ("query_id", "vec_id", "score")])
    n_pivots = max(1, min(max_pivots, -(-(n or 0) // rows_per_pivot)))
    # A seeded top-k: at most ``max_pivots`` vectors come to the driver.
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(7)), "vec_id").limit(n_pivots).toPandas()
    width, longest = int(width or 0), float(longest or 0.0)
    pivots = (_lifted(_matrix(sample["vector"], width), longest) if len(sample)
              else np.zeros((1, width + 1)))

    placed = "vec_id long, vector array<long>, cell int, away double"
    data = written(rows.select("vec_id", "vector").mapInPandas(
        _nearest(pivots, longest, width, False), placed), fresh_folder(spark, "cells"))
    queries = written(rows.where("_asks").select("vec_id", "vector").distinct().mapInPandas(
        _nearest(pivots, longest, width, True), placed), fresh_folder(spark, "asked"))

    far = np.full(len(pivots), -1.0)
    asked = np.zeros(len(pivots), dtype="int64")
    for row in queries.groupBy("cell").agg(F.max("away"), F.count(F.lit(1))).collect():
        far[row[0]], asked[row[0]] = row[1], row[2]
    # The k + 1 smallest distances of each cell, of different ids (one may be the query's own).
    once = data.groupBy("vec_id").agg(F.min(F.struct("away", "cell")).alias("_near")).select(
        "vec_id", "_near.*")
    ranked = once.select("cell", "away", F.row_number().over(
        Window.partitionBy("cell").orderBy("away", "vec_id")).alias("place"))
    near = [[] for _ in pivots]
    for cell, away in ranked.where(F.col("place") <= k + 1).select("cell", "away").collect():
        near[cell].append(away)
    held = np.zeros(len(pivots), dtype="int64")
    for cell, count in data.groupBy("cell").count().collect():
        held[cell] = count
    low, high = reach(pivots, far, [np.sort(np.array(x, dtype=float)) for x in near], k)

    pairs = [(i, j, float(low[i, j]), float(high[i, j]), int(-(-held[j] // block)),
              int(-(-asked[i] // block)))
             for i in range(len(pivots)) for j in range(len(pivots))
             if asked[i] and held[j] and high[i, j] > -np.inf]
    # At most max_pivots squared rows, made of the summaries above; Spark makes the blocks of them.
    ranges = F.broadcast(spark.createDataFrame(
        pairs, "asking int, cell int, low double, high double, parts int, slices int"))

    def each(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def dealt(salt: list, n: str) -> Column:
        return F.pmod(F.xxhash64("vec_id", *salt), F.col(n)).cast("int")

    sent = data.join(ranges, "cell").where(
        (F.col("away") >= F.col("low")) & (F.col("away") <= F.col("high"))).select(
        "asking", F.col("cell").alias("held_by"), dealt([], "parts").alias("part"),
        each("slices").alias("slice"), "vec_id", "vector")
    asking = queries.withColumnRenamed("cell", "asking").join(
        ranges.withColumnRenamed("cell", "held_by"), "asking").select(
        "asking", "held_by", each("parts").alias("part"),
        dealt([F.lit(1)], "slices").alias("slice"), "vec_id", "vector")
    unit = ("asking", "held_by", "part", "slice")
    local = asking.groupBy(*unit).cogroup(sent.groupBy(*unit)).applyInPandas(
        _solver(width, k), result)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
