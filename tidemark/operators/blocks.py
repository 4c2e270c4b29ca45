"""Exact vector joins in blocks.

Rows are assigned to the nearest of a bounded number of pivots (a *cell*), and each cell is cut by
hash into *blocks* of bounded size, so a cell that holds a third of all rows becomes
many blocks.  A cell meets only the cells that can hold a row within the wanted distance (triangle
inequality); what is left out provably holds no result.  Blocks are dealt to a bounded number of groups
on either side, and a task meets one left group with one right group, so a row travels at most as often
as there are groups of the other side, however many rows there are.  Tasks keep running results per left
row and emit those, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.runtime import cut

# rows a block, most pivots, and right blocks that one task streams past its left group at least; the same
# for every input size
ROWS, CELLS, BLOCKS_A_TASK = 2048, 256, 8
# most groups of left and of right blocks where most cells meet; groups at least where each cell meets its own only;
# meetings that a sweep is dealt to at least where there are right blocks enough, and most whose tasks are named
LEFT, RIGHT, APART, TASKS, NAMED = 24, 8, 64, 48, 4096
# entries of one working matrix of a task (left rows x right rows of a call), entries of the vectors of one exact
# comparison, and bytes of the vectors of a left group, which a task holds
MATRIX, GATHERED, HELD = 1 << 21, 1 << 20, 48 << 20


def matrix(column) -> np.ndarray:
    """Arrow list column to a 2-d array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(n, -1) if n else flat.reshape(0, 0), dtype=np.float64)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances by matrix product; small errors, so only used to pick candidates."""
    d = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :]
    both = x @ y.T
    both *= 2.0
    d -= both
    return np.maximum(d, 0.0, out=d)


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise distances; bitwise the same for (x, y) and (y, x)."""
    at = np.arange(len(x))
    return apart(x, y, at, at)


def apart(x: np.ndarray, y: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """:func:`exact` of the pairs (row, col); the vectors are gathered a bounded number at a time, however many pairs."""
    step = max(1, GATHERED // max(1, x.shape[1]))
    parts = [np.sqrt(((x[row[i:i + step]] - y[col[i:i + step]]) ** 2).sum(1)) for i in range(0, len(row), step)]
    return np.concatenate(parts) if parts else np.zeros(0)


def slack(x: np.ndarray, y: np.ndarray) -> float:
    """Bound on the error of a distance taken from :func:`squared`."""
    top = max(float(np.abs(x).max(initial=0.0)), float(np.abs(y).max(initial=0.0)), 1e-30)
    return 1e-6 * top * math.sqrt(max(1, x.shape[1]))


class Chunk:
    """Vectors and their squared lengths; in single precision a left and a right side whose product is squared distances."""

    def __init__(self, x: np.ndarray):
        self.x, self.squares = x, (x * x).sum(1)
        self.top = float(self.squares.max(initial=0.0))
        self.fits = self.top < 1e20  # not where some are no numbers

    @cached_property
    def as_left(self) -> np.ndarray:
        return np.column_stack([self.x, self.squares, np.ones(len(self.x))]).astype(np.float32)

    @cached_property
    def as_right(self) -> np.ndarray:
        return np.column_stack([-2.0 * self.x, np.ones(len(self.x)), self.squares]).astype(np.float32)


def rough(left: Chunk, right: Chunk) -> tuple[np.ndarray, Callable[[np.ndarray], np.ndarray]]:
    """Squared distances good enough to pick candidates, and the bound on these that stands for a bound on true ones.

    In single precision unless vectors are too long or too short for it.  An entry is off by ``error`` at most, and so
    may be the bound if it was taken from the entries; the function adds both.
    """
    top = max(left.top, right.top)
    if not (left.fits and right.fits and top > 1e-20):
        eps = slack(left.x, right.x)
        return squared(left.x, right.x), lambda bound: (np.sqrt(bound) + eps) ** 2
    # each of the terms, whose absolute values come to four times the greatest squared length at most, is rounded as often
    # as there are terms
    error = 2.0 ** -24 * (4 * left.x.shape[1] + 64) * top
    return left.as_left @ right.as_right.T, lambda bound: (bound + 2.0 * error).astype(np.float32)


@dataclass(frozen=True)
class Layout:
    pivots: np.ndarray
    radius: np.ndarray
    splits: tuple[int, ...]
    rows: int
    size: int = ROWS  # rows a block

    @property
    def cells(self) -> int:
        return len(self.splits)


def _nearest_pivot(pivots: np.ndarray, vector: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = matrix(batch.column(batch.schema.get_field_index(vector)))
            cell = squared(x, pivots).argmin(1)
            reach = exact(x, pivots[cell])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(reach)],
                names=[*batch.schema.names, "cell", "reach"])
    return run


def _with_cells(df: DataFrame, vector: str, pivots: np.ndarray) -> DataFrame:
    if len(pivots) <= 1:
        return df.withColumn("cell", F.lit(0)).withColumn("reach", F.lit(None).cast("double"))
    schema = T.StructType([*df.schema.fields, T.StructField("cell", T.IntegerType()),
                           T.StructField("reach", T.DoubleType())])
    return df.mapInArrow(_nearest_pivot(pivots, vector), schema)


def probe(df: DataFrame, layout: Layout, vector: str, probes: int) -> DataFrame:
    """Each row once for each of its ``probes`` nearest pivots, whose cell it is to search (``cell``)."""
    if layout.cells <= 1:
        return df.withColumn("cell", F.lit(0))
    pivots, many = layout.pivots, min(probes, layout.cells)
    kept = [f for f in df.schema.fields if f.name != "cell"]
    schema = T.StructType([*kept, T.StructField("cell", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            step = max(1, GATHERED // (many * max(1, pivots.shape[1])))
            for piece in (batch.slice(i, step) for i in range(0, batch.num_rows, step)):
                x = matrix(piece.column(piece.schema.get_field_index(vector)))
                near = squared(x, pivots)
                nearest = (np.argpartition(near, many - 1, axis=1)[:, :many] if many < layout.cells
                           else np.broadcast_to(np.arange(many), near.shape))
                yield pa.RecordBatch.from_arrays(
                    [*piece.take(pa.array(np.repeat(np.arange(len(x)), many))).columns,
                     pa.array(nearest.ravel().astype(np.int32))], schema=to_arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    to_arrow = to_arrow_schema(schema)
    return df.select(*[f.name for f in kept]).mapInArrow(run, schema)


def lay_out(df: DataFrame, ident: str, vector: str, rows_per_block: int = ROWS,
            pivots: np.ndarray | None = None, most_cells: int = CELLS) -> tuple[DataFrame, Layout]:
    """Rows with ``block`` and ``cell``, written out because every caller reads them repeatedly.

    A pivot a block, at most ``most_cells``: beyond that the cells grow, and blocks stay as they are.
    The driver sees only pivots and one statistics row a cell.  No rows make one empty cell.
    """
    if pivots is None:
        n = df.count()
        want = max(1, min(most_cells, math.ceil(n / rows_per_block)))
        # the smallest hashes: a fixed, arbitrary choice that needs no shuffle of the vectors
        rows = df.select(ident, vector).orderBy(F.xxhash64(ident), ident).limit(want).collect()
        pivots = (np.array([r[vector] for r in rows], dtype=np.float64).reshape(len(rows), -1)
                  if rows else np.zeros((1, 1)))
    placed = cut(_with_cells(df, vector, pivots))
    cells = max(1, len(pivots))
    splits, radius = [0] * cells, np.zeros(cells)
    stats = placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("reach").alias("r")).collect()
    for row in stats:
        splits[row["cell"]] = row["n"]
        radius[row["cell"]] = math.inf if row["r"] is None else row["r"]
    placed, parts = cut_cells(placed.drop("reach"), ident, splits, rows_per_block)
    return placed, Layout(pivots, radius, parts, sum(splits), rows_per_block)


def cut_cells(df: DataFrame, ident: str, counts: list[int],
              rows_per_block: int = ROWS) -> tuple[DataFrame, tuple[int, ...]]:
    """Cut cells of known row counts into blocks by hash: (rows with ``block``, blocks a cell)."""
    splits = tuple(math.ceil(n / rows_per_block) for n in counts)
    parts = F.element_at(F.array(*[F.lit(max(1, v)) for v in splits]), F.col("cell") + 1)
    block = F.pmod(F.xxhash64(ident), parts) * len(counts) + F.col("cell")
    return df.withColumn("block", block.cast("long")), splits


def gaps(left: Layout, right: Layout) -> np.ndarray:
    """Least possible distance between a row of a left cell and a row of a right cell."""
    if left.cells == 1 and right.cells == 1:
        return np.zeros((1, 1))
    apart = np.sqrt(squared(left.pivots, right.pivots))
    tol = slack(left.pivots, right.pivots)
    low = apart - left.radius[:, None] - right.radius[None, :] - tol
    return np.where(np.isfinite(low), np.maximum(low, 0.0), 0.0)


@dataclass(frozen=True)
class Meetings:
    """Which cells meet, and the groups that blocks are dealt to by their number."""

    left: Layout
    right: Layout
    allowed: np.ndarray
    groups: tuple[int, int]


def meetings(left: Layout, right: Layout, allowed: np.ndarray) -> Meetings:
    """The allowed cell pairs that have rows on both sides, and how many groups each side is dealt to.

    Where most cells meet, the groups are bounded; more only where a left group would not fit into a task.
    Where each cell meets its own only, groups keep to cells, so that a row seldom travels twice.
    """
    there = lambda lay: np.array(lay.splits) > 0
    allowed = allowed & there(left)[:, None] & there(right)[None, :]
    fits = max(ROWS, HELD // (8 * max(1, left.pivots.shape[1])))
    if left.cells == right.cells > 1 and not (allowed & ~np.eye(left.cells, dtype=bool)).any():
        parts = max(1, math.ceil(APART / left.cells), math.ceil(max(left.splits) * left.size / fits))
        return Meetings(left, right, allowed, (left.cells * parts, right.cells))
    blocks = [math.ceil(side.rows / side.size) for side in (left, right)]
    # as many on either side, so that rows travel least for so many meetings, until there are more blocks a group
    of_left = max(math.ceil(left.rows / fits), min(LEFT, blocks[0], max(RIGHT, math.ceil(blocks[0] / BLOCKS_A_TASK))))
    # few left rows travel more often, so that no few tasks meet all right ones
    of_right = min(RIGHT, max(math.ceil(blocks[1] / BLOCKS_A_TASK), min(blocks[1], math.ceil(TASKS / max(1, of_left)))))
    return Meetings(left, right, allowed, (max(1, of_left), max(1, of_right)))


def _dealt(layout: Layout, groups: int) -> np.ndarray:
    """Cells x groups: whether the group has a block of the cell."""
    out = np.zeros((layout.cells, groups), dtype=np.int64)
    for cell, many in enumerate(layout.splits):
        out[cell, np.unique((np.arange(min(many, groups)) * layout.cells + cell) % groups)] = 1
    return out


def _sent(df: DataFrame, layout: Layout, side: int, groups: tuple[int, int], meets: np.ndarray,
          columns: list[str]) -> DataFrame:
    """The rows once for each group of the other side that their cell ``meets``."""
    spark = df.sparkSession
    own, other = F.pmod(F.col("block"), F.lit(groups[side])), F.col("_other").cast("long")
    cell = F.pmod(F.col("block"), F.lit(layout.cells))
    # one row a cell; as an Arrow table it needs no job of its own
    there = np.flatnonzero(meets.any(1))
    where = F.broadcast(spark.createDataFrame(pa.table({
        "_cell": pa.array(there, pa.int64()),
        "_others": pa.array([np.flatnonzero(meets[i]) for i in there], pa.list_(pa.int32()))})))
    key = own * groups[1] + other if side == 0 else other * groups[1] + own
    return df.withColumn("_cell", cell.cast("long")).join(where, "_cell").withColumn(
        "_other", F.explode("_others")).select(key.alias("_key"), F.lit(side).alias("_side"), "_cell", *columns)


def _drive(kernel: Callable, columns: list[str], names: list[str], allowed: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, states = None, {}, None

        def ready() -> list:
            """(cell, kernel) of each ``ROWS`` rows of a left cell; what was held for them is let go."""
            made = []
            for cell in list(held):
                rows = pa.Table.from_batches(held.pop(cell))
                made += [(cell, kernel(rows.slice(i, ROWS))) for i in range(0, rows.num_rows, ROWS)]
            return made

        def finish():
            for _, state in states if states is not None else ready():
                out = state.result()
                if out is not None and len(out[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=names)

        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            key, side, cell = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            body = batch.select(columns)
            edges = np.flatnonzero((key[1:] != key[:-1]) | (side[1:] != side[:-1]) | (cell[1:] != cell[:-1])) + 1
            starts = np.concatenate([[0], edges]).astype(int)
            stops = np.concatenate([edges, [n]]).astype(int)
            for lo, hi in zip(starts, stops):
                if key[lo] != current:
                    yield from finish()
                    current, held, states = key[lo], {}, None
                piece = body.slice(lo, hi - lo)
                if side[lo] == 0:
                    held.setdefault(int(cell[lo]), []).append(piece)
                    continue
                if states is None:
                    states = ready()
                for at in range(0, piece.num_rows, MATRIX // ROWS):
                    part = piece.slice(at, MATRIX // ROWS)
                    for own, state in states:
                        if allowed[own, cell[lo]]:
                            state.update(part)
        yield from finish()
    return run


def sweep(left: DataFrame, right: DataFrame, met: Meetings, columns: list[str],
          kernel: Callable, schema: T.StructType | str) -> DataFrame:
    """Run ``kernel`` over the rows of each left group and, chunk by chunk, those of a right group that they meet.

    ``kernel(table)`` takes rows of one left cell; ``update(batch)`` one chunk; ``result()`` the output
    columns.  A left row may have a result of each right group, which the caller merges.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    groups = met.groups
    by_left, by_right = _dealt(met.left, groups[0]), _dealt(met.right, groups[1])
    allowed = met.allowed.astype(np.int64)
    own = _sent(left, met.left, 0, groups, allowed @ by_right > 0, columns)
    other = _sent(right, met.right, 1, groups, allowed.T @ by_left > 0, columns)
    meet = ((by_left.T @ allowed @ by_right) > 0).ravel()
    tasks, together = int(meet.sum()), own.unionByName(other)
    if 0 < tasks and len(meet) <= NAMED:
        # a meeting a task; by hash several would share one while others have none
        place = ",".join(map(str, np.maximum(np.cumsum(meet) - 1, 0)))
        together = together.repartitionById(tasks, F.expr(f"element_at(array({place}), cast(_key as int) + 1)"))
    else:
        together = together.repartition(max(1, min(tasks, 1024)), "_key")
    together = together.sortWithinPartitions("_key", "_side", "_cell")
    return together.mapInArrow(_drive(kernel, columns, schema.fieldNames(), met.allowed), schema)
