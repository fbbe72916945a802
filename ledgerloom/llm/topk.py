"""Exact top-k search by inner product over a vector-approximation file.

The index is a table that holds, beside each vector, its cells: every component
quantised to ``BITS`` bits between the bounds of its dimension over all rows.
For one block of queries at a time,

1. a scan of the cells alone gives an upper and a lower bound of each score;
   the k-th largest lower bound over all rows is a floor that the k-th result
   cannot be below (k rows of each query and task leave a task, at most);
2. a second scan of the cells leaves out what cannot reach the floor and reads
   the exact vectors of the rest, best bound first, until no bound that is left
   can beat, or tie with, the k-th exact score found in the task;
3. the tasks' results, at most k for each query, are merged.

A block of queries has a bounded number of rows, so what is sent to the tasks
does not grow with the data; more queries make more blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import ship
from ledgerloom.operators.tables import stored

BITS = 6
SCALE = 256
QUERY_BLOCK = 4096
TILE = 1 << 20  # bounds computed at once


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, vec): floor(scale * x) of each component, without vectors that are null or not finite."""
    x = F.col(vector_col).cast("array<double>")
    whole = x.isNotNull() & F.forall(x, lambda v: F.coalesce(
        ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), F.lit(False)))
    return vectors.filter(whole & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("vec"))


def of_one_length(vectors: DataFrame) -> DataFrame:
    """The vectors that have as many components as most have, the longer ones of two lengths as common; none without one."""
    lengths = vectors.groupBy(F.size("vec").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.agg(F.max(F.struct("n", "length")).alias("most")).first()["most"]
    return vectors.filter((F.size("vec") == F.lit(most["length"] if most else 0)) & (F.size("vec") > 0))


def bounds(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of each dimension; as many rows as there are dimensions."""
    rows = vectors.select(F.posexplode("vec").alias("dim", "v")).groupBy("dim").agg(
        F.min("v").alias("low"), F.max("v").alias("high")).orderBy("dim").collect()
    return np.array([r["low"] for r in rows], np.int64), np.array([r["high"] for r in rows], np.int64)


def _steps(low: np.ndarray, high: np.ndarray, bits: int) -> np.ndarray:
    return np.maximum(1, -(-(high - low + 1) // (1 << bits)))


def index(vectors: DataFrame, bits: int = BITS) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The stored approximation file of (id, vec), and the lower edge and step of each dimension.

    ``cells`` and ``vec`` are separate columns of the table, so the first scan
    of a search reads the cells only.
    """
    ship(vectors.sparkSession)
    low, high = bounds(vectors)
    step = _steps(low, high, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            cells = ((x - low) // step).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c.tobytes() for c in cells], pa.binary()), batch.column(1)],
                names=["id", "cells", "vec"])

    table = vectors.mapInArrow(run, "id long, cells binary, vec array<long>")
    return stored(table, "cells"), low, step


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, 0), np.int64)


def _cell_matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, dims)


class Bounds:
    """Bounds of the scores of a block of queries with cells; exact in float64 below 2**53."""

    def __init__(self, queries: np.ndarray, low: np.ndarray, step: np.ndarray):
        q = queries.astype(np.float64)
        self.weights = (q * step).T.copy()
        self.base = q @ low.astype(np.float64)
        self.up = np.maximum(q, 0) @ (step - 1.0)
        self.down = np.minimum(q, 0) @ (step - 1.0)

    def of(self, cells: np.ndarray) -> np.ndarray:
        """Scores of the lower corners, rows by queries; the bounds are these plus ``down`` and ``up``."""
        return cells.astype(np.float64) @ self.weights + self.base


def _floors(ids: np.ndarray, block: Bounds, dims: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((k, len(ids)), -np.inf)
        rows = max(1, TILE // max(1, len(ids)))
        for batch in batches:
            own, cells = batch.column(0).to_numpy(), _cell_matrix(batch.column(1), dims)
            for a in range(0, len(own), rows):
                lower = block.of(cells[a:a + rows]) + block.down
                lower[own[a:a + rows, None] == ids[None, :]] = -np.inf
                both = np.concatenate([best, lower])
                best = np.partition(both, len(both) - k, axis=0)[-k:]
        q = np.tile(np.arange(len(ids)), k)
        real = np.isfinite(best.ravel())
        yield pa.RecordBatch.from_arrays(
            [pa.array(q[real].astype(np.int32)), pa.array(best.ravel()[real])], names=["q", "bound"])

    return run


def _search(ids: np.ndarray, queries: np.ndarray, block: Bounds, floor: np.ndarray, dims: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, TILE // max(1, len(ids)))
        for batch in batches:
            own, cells, exact = batch.column(0).to_numpy(), _cell_matrix(batch.column(1), dims), _matrix(batch.column(2))
            found: list[list[int]] = [[], [], []]
            for a in range(0, len(own), rows):
                upper = block.of(cells[a:a + rows]) + block.up
                some = own[a:a + rows]
                possible = (upper >= floor) & (some[:, None] != ids[None, :])
                for q in np.flatnonzero(possible.any(axis=0)).tolist():
                    at = np.flatnonzero(possible[:, q])
                    at = at[np.argsort(-upper[at, q], kind="stable")]
                    top: list[tuple[int, int]] = []  # (-score, id)
                    for r in at.tolist():
                        if len(top) == k and upper[r, q] < -top[-1][0]:
                            break  # certain: no bound that is left reaches the k-th score
                        top.append((-int(queries[q] @ exact[a + r]), int(some[r])))
                        top.sort()
                        del top[k:]
                    for score, vec in top:
                        for column, value in zip(found, (ids[q], vec, -score), strict=True):
                            column.append(int(value))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["query_id", "vec_id", "score"])

    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
           bits: int = BITS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query with other rows.

    ``is_query`` is a condition on ``id``. Vectors with a null or non-finite
    component take no part, nor do rows without an id, empty vectors, and vectors
    that have not as many components as most. Columns besides these two are not
    read. An empty table gives an empty result. Of equal scores the smaller id is first; rows
    that repeat an id are separate candidates but one query, that of the smallest
    vector, and no query finds rows with its own id. A query with fewer than k candidates gives fewer rows, a table
    without queries none.
    """
    ints = of_one_length(stored(scaled(vectors, id_col, vector_col), "vectors"))
    schema = "query_id long, vec_id long, score long"
    spark = vectors.sparkSession
    n_queries = ints.filter(is_query).count()
    if not n_queries:
        return _top(spark.createDataFrame([], schema), k).select("query_id", "rank", "vec_id", "score")
    table, low, step = index(ints, bits)
    n_blocks = -(-n_queries // query_block)
    asked = ints.filter(is_query).groupBy("id").agg(F.min("vec").alias("vec"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)))
    results = []
    for n in range(n_blocks):
        rows = asked.filter(F.col("block") == n).orderBy("id").collect()  # about query_block rows
        if not rows:
            continue
        ids = np.array([r["id"] for r in rows], np.int64)
        queries = np.array([r["vec"] for r in rows], np.int64)
        block = Bounds(queries, low, step)
        lower = table.select("id", "cells").mapInArrow(_floors(ids, block, len(low), k), "q int, bound double")
        least = Window.partitionBy("q").orderBy(F.col("bound").desc())
        kth = lower.withColumn("n", F.row_number().over(least)).filter(F.col("n") == k).select("q", "bound").collect()
        floor = np.full(len(ids), -np.inf)
        for r in kth:
            floor[r["q"]] = r["bound"]
        found = table.select("id", "cells", "vec").mapInArrow(
            _search(ids, queries, block, floor, len(low), k), schema)
        results.append(stored(_top(found, k), "found"))
    return reduce(DataFrame.unionByName, results).select("query_id", "rank", "vec_id", "score")
