"""Truncated decomposition of a sparse matrix that is a table of entries (row, column, value).

Blocks of `k` + `spare` directions are multiplied by AᵀA, a few times in all, and AᵀA is
decomposed inside the space that they span. A pass reads the entries once: every task
multiplies its rows by the block, which it holds whole, and by themselves again, and Spark
adds up the tasks' sums by column. A block has a row per column of the matrix; the driver
holds `passes` of them and their products, whose size is set by parameters.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from datamill.session import ship

# A task takes about so many entries in every pass. It sends a sum for each column and direction,
# whatever it takes, so many small tasks would send more than they read.
ENTRIES_PER_TASK = 8_000_000
# Entries multiplied at once: 8 bytes for each of them and each direction.
AT_ONCE = 16_384
# Cells of rows written out with their zeros.
CELLS_AT_ONCE = 1 << 21
# Rows of the block whose sums travel together.
STRIP = 512
# Smaller singular values, as parts of the first, are rounding errors.
SMALLEST = 1e-6


class Decomposition(NamedTuple):
    """Falling singular values and the right singular vectors, one per column."""

    values: np.ndarray
    vectors: np.ndarray


def whole_rows(entries: DataFrame, total: int) -> DataFrame:
    """Entries (row, column, value) with all of a row in one task and in column order;
    `begins` marks the first of each row. At least as many parts as cores."""
    parts = max(entries.sparkSession.sparkContext.defaultParallelism, -(-total // ENTRIES_PER_TASK))
    place = F.row_number().over(Window.partitionBy("row").orderBy("column"))
    rows = entries.select("row", F.col("column").cast("int"), "value").repartition(parts, "row")
    return rows.withColumn("begins", place == 1)


def _whole(batches: Iterator[pa.RecordBatch], at_once: int) -> Iterator[pa.RecordBatch]:
    """The batches cut anew at row ends, of about `at_once` entries; a longer row is not cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, at_once):
            part = batch.slice(at, at_once)
            begins = np.flatnonzero(part.column("begins").to_numpy(zero_copy_only=False))
            if len(begins) and held:
                held.append(part.slice(0, begins[0]))
                yield pa.Table.from_batches(held).combine_chunks().to_batches(None)[0]
                held = []
                part = part.slice(begins[0])
                begins = begins - begins[0]
            if len(begins) > 1:
                yield part.slice(0, begins[-1])
                part = part.slice(begins[-1])
            held.append(part)
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches(None)[0]


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    column, value, begins = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("column", "value", "begins"))
    return column, value, np.flatnonzero(begins)


def _row_groups(begins: np.ndarray, entries: int, width: int) -> Iterator[tuple[int, np.ndarray, slice]]:
    """The rows of a batch in groups of at most `CELLS_AT_ONCE` cells of `width` columns: the
    number of rows, the row of each entry in its group, and the entries."""
    ends = np.append(begins, entries)
    step = max(1, CELLS_AT_ONCE // max(width, 1))
    for low in range(0, len(begins), step):
        own = ends[low : low + step + 1]
        yield len(own) - 1, np.repeat(np.arange(len(own) - 1), np.diff(own)), slice(own[0], own[-1])


def _strip(number: int, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["strip", "sums"]
    )


def times_gram(rows: DataFrame, block: np.ndarray) -> np.ndarray:
    """AᵀA·block for the matrix A of `rows` (from `whole_rows`), in one pass over them."""
    sent = rows.sparkSession.sparkContext.broadcast(block)
    width = block.shape[1]
    ship(rows.sparkSession)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        total, seen = np.zeros_like(own), np.zeros(len(own), bool)
        for batch in _whole(batches, AT_ONCE):
            column, value, begins = _columns(batch)
            # Rows of few columns in all are multiplied whole, zeros and all, which is quicker
            # than gathering a line of the block for each entry.
            used, place = np.unique(column, return_inverse=True)
            for rows_, row_of, cells in _row_groups(begins, len(column), len(used)):
                whole = np.zeros((rows_, len(used)))
                np.add.at(whole, (row_of, place[cells]), value[cells])
                total[used] += whole.T @ (whole @ own[used])
            seen[used] = True
        for strip in range(-(-len(own) // STRIP)):
            part = slice(strip * STRIP, (strip + 1) * STRIP)
            if seen[part].any():
                yield _strip(strip, total[part])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for strip, values in zip(batch.column("strip").to_pylist(), batch.column("sums")):
                part = np.frombuffer(values.as_buffer())
                sums[strip] = sums[strip] + part if strip in sums else part
        for strip, part in sums.items():
            yield _strip(strip, part)

    schema = "strip int, sums binary"
    parts = min(-(-len(block) // STRIP), max(rows.sparkSession.sparkContext.defaultParallelism, 1))
    # Strips meet in their own tasks, which hold one sum for each whatever the number of parts.
    table = rows.drop("row").mapInArrow(products, schema).repartition(parts, "strip").mapInArrow(added, schema)
    out = np.zeros_like(block)
    for row in table.collect():
        part = np.frombuffer(row.sums).reshape(-1, width)
        out[row.strip * STRIP : row.strip * STRIP + len(part)] = part
    sent.unpersist()
    return out


def decompose(rows: DataFrame, columns: int, k: int, spare: int = 20, passes: int = 4, seed: int = 7) -> Decomposition:
    """The leading `k` singular values and vectors of the matrix of `rows`, fewer where its
    rank is smaller, by `passes` passes over them.

    The first block is random, each further one is what a pass adds to all blocks so far
    (a block Lanczos iteration, held orthogonal), and AᵀA is decomposed in the space of all
    blocks. That is exact once they span all columns, at the latest for a matrix of at most
    `passes` · (`k` + `spare`) columns.
    """
    width = min(k + spare, columns)
    if width == 0:
        return Decomposition(np.empty(0), np.empty((columns, 0)))
    block = np.linalg.qr(np.random.default_rng(seed).standard_normal((columns, width)))[0]
    space, product = block, times_gram(rows, block)
    scale = np.linalg.norm(product)
    for _ in range(passes - 1):
        fresh = product[:, -block.shape[1] :]
        for _ in range(2):  # once more for the digits that the first time loses
            fresh = fresh - space @ (space.T @ fresh)
        block, left, _ = np.linalg.svd(fresh, full_matrices=False)
        block = block[:, left > SMALLEST * SMALLEST * scale][:, : columns - space.shape[1]]
        if not block.shape[1]:
            break
        space, product = np.hstack([space, block]), np.hstack([product, times_gram(rows, block)])
    inner = space.T @ product
    squares, turned = np.linalg.eigh((inner + inner.T) / 2)
    values = np.sqrt(np.maximum(squares[::-1], 0))[:k]
    kept = values > SMALLEST * max(values[0], np.finfo(float).tiny)
    vectors = (space @ turned[:, ::-1][:, :k])[:, kept]
    # The sign of a singular pair is free: make the largest entry of each vector positive.
    largest = np.abs(vectors).argmax(axis=0)
    return Decomposition(values[kept], vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])]))


def place_rows(rows: DataFrame, vectors: np.ndarray) -> DataFrame:
    """(row, weights): each row of the matrix times the vectors, made where the row is."""
    sent = rows.sparkSession.sparkContext.broadcast(vectors)
    width = vectors.shape[1]
    ship(rows.sparkSession)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole(batches, AT_ONCE):
            column, value, begins = _columns(batch)
            sums = np.add.reduceat(sent.value[column] * value[:, None], begins)
            at = np.arange(0, (len(begins) + 1) * width, width, dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(sums.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(begins)), lists], names=["row", "weights"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(placed, f"row {kind}, weights array<double>")


def best_rows(placed: DataFrame, n: int) -> DataFrame:
    """(row, place, weight): of (row, weights) from `place_rows`, the rows that may be among
    the `n` of largest weight at a place, ties with them included. Each task gives `n` and ties
    per place at most for each batch that brings some, so not every weight is ordered."""
    kind = placed.schema["row"].dataType.simpleString()
    ship(placed.sparkSession)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = None
        for batch in batches:
            if not batch.num_rows:
                continue
            weights = batch.column("weights").flatten().to_numpy().reshape(batch.num_rows, -1)
            if least is None:
                least = np.full(weights.shape[1], -np.inf)
            # A batch of n rows or more has n that are at least its n-th.
            if len(weights) >= n:
                least = np.maximum(least, np.partition(weights, len(weights) - n, axis=0)[len(weights) - n])
            row, place = np.nonzero(weights >= least)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(row)), pa.array(place), pa.array(weights[row, place])],
                names=["row", "place", "weight"],
            )

    return placed.mapInArrow(best, f"row {kind}, place long, weight double")
