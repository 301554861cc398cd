"""One pass over vector rows that returns sums by slot.

Iterative fits call :func:`sums_by_slot` once per iteration. Every task adds its rows up in matrix form and
emits a few pieces of the sums; Spark adds these up. The result has as many numbers as the model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

# Partial sums the driver may receive in one pass; a fit makes hundreds of passes.
DIRECT_BYTES = 128 << 10
# Partial sums in one row, and tasks that add such rows up.
PIECE_BYTES, ADDING_TASKS = 64 << 10, 8


def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The vector column of each batch as a matrix, followed by the other columns."""
    for batch in batches:
        if batch.num_rows:
            first = batch.column(0)
            x = first.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield [x, *[c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]]


def sums_by_slot(
    rows: DataFrame, partial: Callable[[Iterator[list[np.ndarray]]], np.ndarray], shape: tuple[int, int], partitions: int
) -> np.ndarray:
    """Run ``partial`` on every partition and add up the (slots x width) matrices it returns.

    The first column of ``rows`` is an array of doubles, the others are numbers. The matrices of few
    ``partitions`` are added on the driver when together they stay under DIRECT_BYTES; otherwise Spark
    adds them and only the total is returned. Either adds them in the order of the partitions.
    """
    height = max(1, PIECE_BYTES // (8 * max(1, shape[1])))

    def batch(piece: list[int], part: list[int], sums: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(part, pa.int32()), pa.array(sums, pa.binary())], names=NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.ascontiguousarray(partial(matrices(batches)), dtype=np.float64)
        part = TaskContext.get().partitionId()
        for piece, start in enumerate(range(0, len(sums), height)):
            yield batch([piece], [part], [sums[start:start + height].tobytes()])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for rows in batches:
            for piece, sums in zip(rows.column(0).to_pylist(), rows.column(2), strict=True):
                found = np.frombuffer(sums.as_buffer(), np.float64)
                total[piece] = total[piece] + found if piece in total else found.copy()
        for piece, found in total.items():
            yield batch([piece], [0], [found.tobytes()])

    schema = "piece int, part int, sums binary"
    parts = rows.mapInArrow(run, schema)
    if partitions > 1 and partitions * shape[0] * shape[1] * 8 > DIRECT_BYTES:
        pieces = -(-shape[0] // height)
        parts = parts.repartition(min(pieces, ADDING_TASKS), "piece").sortWithinPartitions("piece", "part").mapInArrow(add, schema)
    result = np.zeros(shape)
    found = parts.toArrow()
    for piece, sums in zip(found.column("piece").to_pylist(), found.column("sums").to_pylist(), strict=True):
        result[piece * height:(piece + 1) * height] += np.frombuffer(sums, np.float64).reshape(-1, shape[1])
    return result


NAMES = ["piece", "part", "sums"]
