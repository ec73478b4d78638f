"""Points as NumPy matrices inside Arrow batches, and their packed form for iterative jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fairstream.functions.groups import is_a

PACKED = "coords binary, flags binary"
# bytes per packed row, so that an Arrow batch of the default 10 000 rows stays near 40 MB
_ROW_BYTES = 4096
# packed rows that a task works on at once, so that its matrices stay near 1 MB, however large the
# batches are that it gets
_ROWS_AT_ONCE = 256

PointBatches = Iterator[tuple[np.ndarray, np.ndarray]]


def batch_matrix(coords: pa.Array, dim: int) -> np.ndarray:
    """An Arrow list column as an n x dim matrix, without copying the values."""
    values = coords.flatten()
    flat = values.to_numpy(zero_copy_only=False)
    offsets = coords.offsets.to_numpy()
    if coords.null_count or values.null_count or len(flat) != dim * len(coords) \
            or (np.diff(offsets) != dim).any():
        raise ValueError(
            f"point and centers differ in dimension or a coordinate is null: expected {dim}")
    return flat.reshape(len(coords), dim)


def bytes_of(column: pa.Array, dtype) -> np.ndarray:
    """All values of a binary column as one array, without copying."""
    first, last = column.offset, column.offset + len(column)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32)
    return np.frombuffer(data, np.uint8)[bounds[first]:bounds[last]].view(dtype)


def _read_rows(batches: Iterable[pa.RecordBatch], dim: int) -> PointBatches:
    for batch in batches:
        if batch.num_rows:
            yield (batch_matrix(batch.column(0), dim),
                   batch.column(1).to_numpy(zero_copy_only=False).astype(bool))


def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of packed rows in parts that are worked on at once."""
    for batch in batches:
        for i in range(0, batch.num_rows, _ROWS_AT_ONCE):
            yield batch.slice(i, _ROWS_AT_ONCE)


def _read_packed(batches: Iterable[pa.RecordBatch], dim: int) -> PointBatches:
    for batch in pieces(batches):
        yield (bytes_of(batch.column(0), np.float64).reshape(-1, dim),
               bytes_of(batch.column(1), np.bool_))


def is_packed(points: DataFrame) -> bool:
    return "flags" in points.columns


def map_points(points: DataFrame, dim: int, task: Callable[[PointBatches], Iterable],
               schema: str) -> DataFrame:
    """Run ``task`` once per partition over (coordinates, is-A flags) matrices."""
    if is_packed(points):
        return points.mapInArrow(lambda batches: task(_read_packed(batches, dim)), schema)
    rows = points.select("coords", is_a().alias("is_a"))
    return rows.mapInArrow(lambda batches: task(_read_rows(batches, dim)), schema)


def pack_points(points: DataFrame, dim: int) -> DataFrame:
    """Rows that hold a few kilobytes of points each.

    A job that reads the same points many times moves them to Python as whole byte blocks instead
    of value by value. Partitioning is kept.
    """
    size = max(1, _ROW_BYTES // (8 * dim))

    def pack(batches: PointBatches):
        for x, flag in batches:
            starts = range(0, len(x), size)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i:i + size].tobytes() for i in starts], pa.binary()),
                 pa.array([flag[i:i + size].tobytes() for i in starts], pa.binary())],
                ["coords", "flags"])

    return map_points(points, dim, pack, PACKED)
