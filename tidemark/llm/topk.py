"""Exact best inner products by Fagin's threshold algorithm over sorted lists per dimension.

Vectors become integers, floor(256 x), and are packed into blocks of bounded size, which are written once.
A task holds one block of vectors and one block of queries.  It sorts each dimension of its
block; a query walks all lists from the end that its sign prefers, scores what it has not met before, and
stops when the sum of the last seen parts is below the k-th best: no unseen vector can then reach or tie
it.  The best of each block are merged by rank.

Vectors that are null or hold null or non-finite parts, and rows without an id, take no part.  Shorter
vectors count as filled up with zeros.  Repeated rows are candidates each; queries that share an id are one
query, with the smallest of their vectors, and all rows of that id are its own.  Ties go to the
smaller id.  Scores beyond 64 bits stand at the limit of the type.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import cut

#: Rows of a block of vectors and of a block of queries.
BLOCK_ROWS, QUERY_ROWS = 4096, 1024
#: Lists are read to this depth first, then to a multiple of it.
FIRST_DEPTH, DEEPER = 16, 4
_EXACT = float(1 << 53)

_PACKED = "block long, n int, ids binary, data binary"


def _usable(ids: pa.Array, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and integer vectors (as exact doubles) of the rows that take part."""
    rows, keep = [], []
    for i, (key, vector) in enumerate(zip(ids.to_pylist(), vectors)):
        if key is None or not vector.is_valid or vector.values.null_count:
            continue
        x = np.floor(256.0 * np.asarray(vector.values, dtype=np.float64))
        if np.isfinite(x).all():
            rows.append(x)
            keep.append(key)
    width = max((len(x) for x in rows), default=0)
    data = np.zeros((len(rows), width))
    for i, x in enumerate(rows):
        data[i, :len(x)] = x
    return np.array(keep, dtype=np.int64), data


def pack(vectors: DataFrame, rows: int) -> DataFrame:
    """``id`` and ``vector`` rows as blocks of at most ``rows``, a row each; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                ids, data = _usable(part.column(0), part.column(1))
                if len(ids):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block], pa.int64()), pa.array([len(ids)], pa.int32()),
                         pa.array([ids.tobytes()], pa.binary()), pa.array([data.tobytes()], pa.binary())],
                        ["block", "n", "ids", "data"])
                    block += 1

    return vectors.mapInArrow(run, _PACKED)


def _matrix(n: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.float64).reshape(n, -1)


def _scores(block: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return (block @ query).astype(np.int64)
    q = [int(x) for x in query]
    low, high = -(1 << 63), (1 << 63) - 1
    return np.array([min(high, max(low, sum(a * int(b) for a, b in zip(q, row)))) for row in block],
                    dtype=np.int64)


class Lists:
    """One block of vectors with its sorted list per dimension."""

    def __init__(self, ids: np.ndarray, data: np.ndarray) -> None:
        self.ids, self.data = ids, data
        self.order = np.argsort(data, axis=0, kind="stable").astype(np.int32)
        self.peak = float(np.abs(data).max(initial=0.0))

    def best(self, key: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows of other ids, by score then id."""
        n, width = self.data.shape
        width = min(width, len(query))
        data, query = self.data[:, :width], query[:width]
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        exact = width * self.peak * float(np.abs(query).max(initial=0.0)) < _EXACT
        seen = np.zeros(n, dtype=bool)
        done = np.zeros(n, dtype=bool)
        scores = np.zeros(n, dtype=np.int64)
        depth = min(FIRST_DEPTH, n)
        while True:
            if depth < n:
                seen[self.order[n - depth:, up].ravel()] = True
                seen[self.order[:depth, down].ravel()] = True
            else:
                seen[:] = True
            fresh = np.flatnonzero(seen & ~done)
            scores[fresh] = _scores(data[fresh], query, exact)
            done[fresh] = True
            if depth >= n:
                break
            met = scores[done & (self.ids != key)]
            if len(met) >= k:
                last = np.zeros(width)
                last[up] = data[self.order[n - depth, up], up]
                last[down] = data[self.order[depth - 1, down], down]
                bound = _scores(last[None, :], query, exact)[0]
                if np.partition(met, len(met) - k)[len(met) - k] > bound:
                    break
            depth = min(n, depth * DEEPER)
        able = np.flatnonzero(done & (self.ids != key))
        if len(able) > k:
            floor = np.partition(scores[able], len(able) - k)[len(able) - k]
            able = able[scores[able] >= floor]
        top = able[np.lexsort((self.ids[able], -scores[able].astype(object)
                               if not exact else -scores[able]))[:k]]
        return self.ids[top], scores[top]


def search(vectors: DataFrame, is_query: Column, k: int, key: str = "vec_id",
           vector: str = "embedding", block_rows: int = BLOCK_ROWS,
           query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best rows for each row that ``is_query`` names."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"),
                          is_query.alias("asks"))
    blocks = cut(pack(rows.select("id", "vector"), block_rows))
    numbers = [r.block for r in blocks.select("block").collect()]  # one number a block
    asked = (rows.filter(F.col("asks") & F.col("id").isNotNull()).select("id", "vector")
             .filter(F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull()
                     & ~F.isnan(x) & (F.abs(x) < float("inf"))))
             .groupBy("id").agg(F.min("vector").alias("vector")))
    queries = cut(pack(asked, query_rows))
    met = (queries.select("block", F.col("n").alias("qn"), F.col("ids").alias("qids"),
                          F.col("data").alias("qdata"))
           .withColumn("block", F.explode(F.lit(numbers).cast("array<bigint>")))
           .join(blocks.hint("merge"), "block"))  # sizes are not known before the queries are dealt out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int | None, Lists | None] = (None, None)
        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch.column(i)[row].as_py() for i, name in enumerate(batch.schema.names)}
                if held[0] != one["block"]:
                    held = one["block"], Lists(np.frombuffer(one["ids"], dtype=np.int64),
                                               _matrix(one["n"], one["data"]))
                asking = np.frombuffer(one["qids"], dtype=np.int64)
                asked_for, ids, scores = [], [], []
                for q, x in zip(asking.tolist(), _matrix(one["qn"], one["qdata"])):
                    best, got = held[1].best(q, x, k)
                    asked_for.append(np.full(len(best), q))
                    ids.append(best)
                    scores.append(got)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x), pa.int64()) for x in (asked_for, ids, scores)],
                    ["query_id", "vec_id", "score"])

    found = (met.select("block", "n", "ids", "data", "qn", "qids", "qdata")
             .mapInArrow(run, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def report(vectors: DataFrame) -> DataFrame:
    """The five best of every row whose id is divisible by 50."""
    return search(vectors, F.col("vec_id") % 50 == 0, 5)
