"""Counts, means and dispersions per (cluster, group), in one pass over the points."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairstream.functions.groups import with_two_groups
from fairstream.operators.assign import (
    as_centers, centers_frame, fits_expressions, nearest, with_nearest_expressions,
)
from fairstream.operators.blocks import is_packed, map_points

MAX_SUM_COLUMNS = 32


def group_cluster_moments(points: DataFrame, centers) -> DataFrame:
    """``(cid, grp, n, mu, ssd)`` of every non-empty (cluster, group): size, mean point, and sum of
    squared distances to that mean.

    Each task reduces its points to at most 2K rows before the shuffle, so a cluster or group that
    holds most of the data costs no more than the others.
    """
    centers = as_centers(centers)
    if len(centers) == 0:
        raise ValueError("no centers")
    if not is_packed(points) and fits_expressions(centers):
        return _moments_by_expressions(points, centers)
    return _moments_by_arrow(points, centers)


def _moments_by_expressions(points: DataFrame, centers: np.ndarray) -> DataFrame:
    dims = range(centers.shape[1])
    x = F.col("coords")
    stats = with_nearest_expressions(with_two_groups(points), centers, "cid", "sqdist") \
        .groupBy("cid", "grp").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(x[d]).alias(f"_m{d}") for d in dims],
        *[F.var_pop(x[d]).alias(f"_v{d}") for d in dims],
    )
    spread = sum((F.col(f"_v{d}") for d in dims[1:]), F.col("_v0"))
    return stats.select("cid", "grp", "n", F.array(*[f"_m{d}" for d in dims]).alias("mu"),
                        (F.col("n") * spread).alias("ssd"))


def _sums(points: DataFrame, centers: np.ndarray) -> DataFrame:
    """``(cid, is_a, n, cost, ...)`` of every non-empty (cluster, group): size, sum of squared
    distances to the center, and from there on the vector sum of offsets from the center, which
    stay small and so lose no digits. Few coordinates add up fastest as columns of their own,
    ``o0, o1, ...``; many as one array ``offset``."""
    k, dim = centers.shape
    columns = [f"o{d}" for d in range(dim)] if dim <= MAX_SUM_COLUMNS else []

    def partial(batches):
        n = np.zeros(2 * k, dtype=np.int64)
        cost = np.zeros(2 * k)
        offset = np.zeros((2 * k, dim))
        for x, flag in batches:
            cid, sqdist = nearest(x, centers)
            key = 2 * cid + flag
            n += np.bincount(key, minlength=2 * k)
            cost += np.bincount(key, sqdist, minlength=2 * k)
            gap = x - centers[cid]
            for d in range(dim):
                offset[:, d] += np.bincount(key, gap[:, d], minlength=2 * k)
        used = np.flatnonzero(n)
        offsets = [pa.array(offset[used, d]) for d in range(dim)] if columns else [
            pa.array(offset[used].tolist(), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(
            [pa.array((used // 2).astype(np.int32)), pa.array(used % 2 == 1), pa.array(n[used]),
             pa.array(cost[used]), *offsets],
            ["cid", "is_a", "n", "cost", *(columns or ["offset"])])

    wide = ", ".join(f"{c} double" for c in columns) or "offset array<double>"
    groups = map_points(points, dim, partial,
                        f"cid int, is_a boolean, n long, cost double, {wide}") \
        .groupBy("cid", "is_a")
    if columns:
        return groups.sum("n", "cost", *columns).toDF("cid", "is_a", "n", "cost", *columns)
    return groups.agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"),
                      vector_to_array(Summarizer.sum(array_to_vector("offset"))).alias("offset"))


def _moments_by_arrow(points: DataFrame, centers: np.ndarray) -> DataFrame:
    # K rows that are on the driver already
    table = centers_frame(points.sparkSession, centers).withColumnRenamed("coords", "center")
    sums = _sums(points, centers)
    offset = "offset" if "offset" in sums.columns else F.array(*sums.columns[4:])
    shift = F.transform(offset, lambda o: o / F.col("n"))
    moved = F.aggregate("shift", F.lit(0.0), lambda acc, v: acc + v * v)
    return sums.join(F.broadcast(table), "cid").withColumn("shift", shift).select(
        "cid", F.when(F.col("is_a"), "A").otherwise("B").alias("grp"), "n",
        F.zip_with("center", "shift", lambda c, o: c + o).alias("mu"),
        F.greatest(F.col("cost") - F.col("n") * moved, F.lit(0.0)).alias("ssd"))


class Moments(NamedTuple):
    """The rows of :func:`group_cluster_moments` as arrays, in no particular order."""

    cid: np.ndarray
    is_a: np.ndarray
    n: np.ndarray
    mu: np.ndarray
    ssd: np.ndarray


def collect_moments(points: DataFrame, centers: np.ndarray) -> Moments:
    """The moments on the driver, for a loop: one aggregation that returns at most 2K rows."""
    rows = _sums(points, centers).collect()
    cid = np.array([r["cid"] for r in rows], dtype=np.int64)
    n = np.array([r["n"] for r in rows], dtype=float)
    cost = np.array([r["cost"] for r in rows])
    shift = np.array([r[4:] for r in rows], dtype=float).reshape(centers[cid].shape) / n[:, None]
    return Moments(cid, np.array([r["is_a"] for r in rows], dtype=bool), n, centers[cid] + shift,
                   np.maximum(cost - n * (shift * shift).sum(axis=1), 0.0))


def fair_cluster_params(moments: DataFrame) -> DataFrame:
    """Per cluster: ``alpha`` and ``beta``, its share of A and of B; ``mu_a`` and ``mu_b``, the
    group means; ``ell``, their distance (null when the cluster lacks a group); and on every row
    the group dispersions ``fixed_a`` and ``fixed_b``. Works on the 2K rows of the moments."""

    def of(group: str, value: Column) -> Column:
        return F.when(F.col("grp") == group, value)

    wide = moments.groupBy("cid").agg(
        F.coalesce(F.sum(of("A", F.col("n"))), F.lit(0)).alias("n_a"),
        F.coalesce(F.sum(of("B", F.col("n"))), F.lit(0)).alias("n_b"),
        F.sum(of("A", F.col("ssd"))).alias("s_a"), F.sum(of("B", F.col("ssd"))).alias("s_b"),
        F.max(of("A", F.col("mu"))).alias("mu_a"), F.max(of("B", F.col("mu"))).alias("mu_b"))
    gap = F.aggregate(F.zip_with("mu_a", "mu_b", lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                      lambda acc, v: acc + v)
    every = Window.partitionBy()  # at most K rows

    def over_all(column: str) -> Column:
        return F.sum(column).over(every)

    return wide.select(
        "cid", "mu_a", "mu_b",
        F.try_divide(F.col("n_a"), over_all("n_a")).alias("alpha"),
        F.try_divide(F.col("n_b"), over_all("n_b")).alias("beta"),
        F.sqrt(gap).alias("ell"),
        F.try_divide(over_all("s_a"), over_all("n_a")).alias("fixed_a"),
        F.try_divide(over_all("s_b"), over_all("n_b")).alias("fixed_b"))


def group_dispersion(moments: DataFrame) -> DataFrame:
    """``(grp, dispersion)``: the mean squared distance of a group's points to their own
    (cluster, group) mean, from the moments alone."""
    return moments.groupBy("grp").agg((F.sum("ssd") / F.sum("n")).alias("dispersion"))
