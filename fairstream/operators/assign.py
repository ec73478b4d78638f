"""Nearest center of every point.

Centers are a small literal (K rows of D numbers), so no join and no shuffle is needed. While K*D
is small the distances are plain arithmetic inside whole-stage codegen; above that the generated
code would exceed the JVM's method limit, and NumPy over Arrow batches takes over.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairstream.functions.vectors import checked_coordinates, squared_distance
from fairstream.operators.blocks import batch_matrix

# measured: from about here the generated code grows past what the JIT compiles
MAX_EXPRESSION_TERMS = 24
MAX_CENTERS = 100_000
_BLOCK_CELLS = 1 << 17
_BLOCK_ROWS = 64  # at least, however many centers there are


def as_centers(centers: DataFrame | Sequence[Sequence[float]] | np.ndarray) -> np.ndarray:
    """Centers as a K x D array, from nested lists or a DataFrame ``(cid, coords)``.

    Centers travel to every task with the query, so more than ``MAX_CENTERS`` of them, in whatever
    form, are an error.
    """
    if isinstance(centers, DataFrame):
        rows = centers.select("cid", "coords").limit(MAX_CENTERS + 1).collect()
        rows.sort(key=lambda r: r["cid"])
        if len(rows) <= MAX_CENTERS and [r["cid"] for r in rows] != list(range(len(rows))):
            raise ValueError("cid must number the centers 0, 1, 2, ...")
        centers = [r["coords"] for r in rows]
    if len(centers) == 0:
        return np.empty((0, 0))
    if len(centers) > MAX_CENTERS:
        raise ValueError(f"more than {MAX_CENTERS} centers")
    if len({len(c) for c in centers}) != 1:
        raise ValueError("centers differ in dimension")
    result = np.asarray(centers, dtype=np.float64)
    if np.isnan(result).any():
        raise ValueError("a center has a NaN coordinate")
    return result


def centers_frame(spark: SparkSession, centers) -> DataFrame:
    """``(cid, coords)`` of centers given as an array or nested lists."""
    rows = as_centers(centers)
    return spark.createDataFrame(pa.table({
        "cid": pa.array(range(len(rows)), pa.int32()),
        "coords": pa.array(rows.tolist(), pa.list_(pa.float64()))}))


def fits_expressions(centers: np.ndarray) -> bool:
    return centers.size <= MAX_EXPRESSION_TERMS


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest center; the lowest index wins a tie."""
    return nearest_two(x, centers)[:2]


def nearest_two(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`nearest`, and a lower bound of the distance to every other center.

    The matrix-product form of the distance picks the candidate. Where a second center comes
    within its rounding error, the row is decided on exact differences.
    """
    k, dim = centers.shape
    cid = np.empty(len(x), dtype=np.int32)
    others = np.empty(len(x))
    origin = centers.mean(axis=0)  # near the data, so that little is lost to rounding
    shifted = centers - origin
    norms = (shifted * shifted).sum(axis=1)
    product = np.ascontiguousarray(-2.0 * shifted.T)
    slack = 16 * (dim + 4) * np.finfo(np.float64).eps
    step = max(_BLOCK_ROWS, _BLOCK_CELLS // k)
    for start in range(0, len(x), step):
        block = x[start:start + step] - origin
        rows = np.arange(len(block))
        score = block @ product
        score += norms
        best = score.argmin(axis=1)
        lowest = score[rows, best]
        score[rows, best] = np.inf
        length = np.einsum("ij,ij->i", block, block)
        margin = slack * (length + norms.max())
        second = score.min(axis=1)
        close = np.flatnonzero(~(second - lowest > margin)) if k > 1 else rows[:0]
        if len(close):
            best[close] = _exact_nearest(x[start + close], centers)
            second[close] = lowest[close]
        cid[start:start + step] = best
        others[start:start + step] = np.sqrt(np.maximum(second + length - margin, 0.0))
    gap = x - centers[cid]
    return cid, np.einsum("ij,ij->i", gap, gap), others


def _exact_nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    total = np.zeros((len(x), len(centers)))
    for d in range(centers.shape[1]):
        gap = x[:, d, None] - centers[:, d]
        total += gap * gap
    return total.argmin(axis=1)


def with_nearest_expressions(points: DataFrame, centers: np.ndarray, cid: str | None,
                             sqdist: str, coords: str = "coords") -> DataFrame:
    """Add the nearest center by arithmetic; ``cid=None`` when only the distance is wanted."""
    x = [f"_x{d}" for d in range(centers.shape[1])]
    names = [f"_d{i}" for i in range(len(centers))]
    out = points.withColumns(dict(zip(x, checked_coordinates(F.col(coords), len(x)))))
    out = out.withColumns({name: squared_distance([F.col(c) for c in x], center)
                           for name, center in zip(names, centers)})
    out = out.withColumn(sqdist, F.least(*names) if len(names) > 1 else F.col(names[0]))
    if cid is not None:
        index = F.lit(len(names) - 1)
        for i in reversed(range(len(names) - 1)):
            index = F.when(F.col(names[i]) == F.col(sqdist), F.lit(i)).otherwise(index)
        out = out.withColumn(cid, index)
    return out.drop(*x, *names)


def _nearest_udf(centers: np.ndarray):
    result = T.StructType([T.StructField("cid", T.IntegerType()),
                           T.StructField("sqdist", T.DoubleType())])

    @F.arrow_udf(result)
    def nearest_center(coords: pa.Array) -> pa.Array:
        cid, sqdist = nearest(batch_matrix(coords, centers.shape[1]), centers)
        return pa.StructArray.from_arrays([pa.array(cid), pa.array(sqdist)], ["cid", "sqdist"])

    return nearest_center


def assign(points: DataFrame, centers, coords: str = "coords") -> DataFrame:
    """Add ``cid`` and ``sqdist``: the nearest center's index and squared distance."""
    centers = as_centers(centers)
    if len(centers) == 0:
        raise ValueError("no centers")
    if fits_expressions(centers):
        return with_nearest_expressions(points, centers, "cid", "sqdist", coords)
    out = points.withColumn("_nearest", _nearest_udf(centers)(F.col(coords)))
    return out.withColumns({"cid": F.col("_nearest.cid"), "sqdist": F.col("_nearest.sqdist")}) \
        .drop("_nearest")
