"""Standard and socially fair k-means."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairstream.operators.assign import as_centers
from fairstream.operators.moments import Moments, collect_moments, group_cluster_moments
from fairstream.operators.rounds import Loop

SEARCH_ROUNDS = 10


@contextmanager
def looped(points: DataFrame, dim: int, storage: StorageLevel | None) -> Iterator[Loop]:
    """The points for a loop: packed and persisted, or as they are when ``storage`` is None."""
    loop = Loop(points, dim, storage)
    try:
        yield loop
    finally:
        loop.close()


def kmeans_centers(points: DataFrame, k: int, max_iter: int, seed: int = 1, init_centers=None,
                   tol: float = 1e-4,
                   storage: StorageLevel | None = StorageLevel.MEMORY_AND_DISK) -> np.ndarray:
    """Centers of standard k-means on the coordinates, groups ignored.

    Starts from k-means|| (whose draws depend on the partitioning as well as the seed) or from
    ``init_centers``, and stops after ``max_iter`` rounds or once no center moves more than
    ``tol``. Fewer than ``k`` distinct points give fewer centers.

    Every round is one job over the points that returns a few numbers for each center. Most points
    are seen to keep their center by the triangle inequality, without distances to the others.
    Sums are exact, so from given ``init_centers`` the result is the same bit by bit under any
    partitioning, and a ``tol`` of 0 ends in the round that changes nothing.

    Meanwhile the points are kept packed at the ``storage`` level, by default a whole copy in the
    executors' memory and on their disks; with ``None`` every round reads the source instead and
    works out all distances, which is the way for data beyond those disks.
    """
    if init_centers is None:
        centers = kmeans_init(points, k, seed)
    else:
        centers = as_centers(init_centers)
        if len(centers) != k:
            raise ValueError(f"{len(centers)} starting centers for k = {k}")
    with looped(points, centers.shape[1], storage) as loop:
        for _ in range(max_iter):
            moved = _pooled_means(loop.moments(centers), centers)
            shift = ((moved - centers) ** 2).sum(axis=1).max()
            centers = moved
            if shift <= tol * tol:
                break
    return centers


def _pooled_means(moments: Moments, centers: np.ndarray) -> np.ndarray:
    """The mean point of each cluster over both groups; empty clusters keep their center."""
    weight = np.bincount(moments.cid, moments.n, minlength=len(centers))
    moved = centers.copy()
    for d in range(centers.shape[1]):
        total = np.bincount(moments.cid, moments.n * moments.mu[:, d], minlength=len(centers))
        np.divide(total, weight, out=moved[:, d], where=weight > 0)
    return moved


def kmeans_init(points: DataFrame, k: int, seed: int = 1) -> np.ndarray:
    """The k-means|| starting centers alone."""
    if k < 1:
        raise ValueError("k must be positive")
    if k == 1:
        return _mean_point(points)
    vectors = points.select(array_to_vector("coords").alias("features"))
    # "row" as coordinates are dense; "auto" would read all points once more to find that out
    model = KMeans(k=k, maxIter=0, seed=seed, initMode="k-means||", solver="row").fit(vectors)
    return np.asarray(model.clusterCenters())


def _mean_point(points: DataFrame) -> np.ndarray:
    # the library wants k > 1
    first = points.select(F.size("coords")).head()
    if first is None:
        raise ValueError("no points")
    dim = first[0]
    return _pooled_means(collect_moments(points, np.zeros((1, dim))), np.zeros((1, dim)))


def line_search(alpha: np.ndarray, beta: np.ndarray, ell: np.ndarray, fixed_a: float,
                fixed_b: float) -> np.ndarray:
    """How far each new center lies from its A-mean, on the segment to the B-mean, so that the
    worse-off group's cost is as low as possible: a bisection over the weight gamma of group A.

    Clusters without any point must be left out; they would make every comparison undefined.
    """
    gamma, step = 0.5, 0.25
    for _ in range(SEARCH_ROUNDS):
        pull = (1 - gamma) * beta
        x = pull * ell / (gamma * alpha + pull)
        cost_a = fixed_a + (alpha * x * x).sum()
        cost_b = fixed_b + (beta * (ell - x) ** 2).sum()
        if cost_a == cost_b:
            break
        gamma += step if cost_a > cost_b else -step
        step /= 2
    return x


def fair_line_search(params: DataFrame) -> DataFrame:
    """``(cid, x)`` for the rows of :func:`fair_cluster_params`; K rows, one group."""

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cid")
        x = line_search(pdf["alpha"].to_numpy(float), pdf["beta"].to_numpy(float),
                        pdf["ell"].fillna(0.0).to_numpy(float),
                        pdf["fixed_a"].iloc[0], pdf["fixed_b"].iloc[0])
        return pd.DataFrame({"cid": pdf["cid"], "x": x})

    columns = params.select("cid", "alpha", "beta", "ell", "fixed_a", "fixed_b")
    return columns.groupBy().applyInPandas(search, "cid int, x double")


def next_centers(moments: Moments, centers: np.ndarray) -> np.ndarray:
    """The fair update of the centers.

    A cluster without points keeps its center. One with a single group moves to that group's
    mean, and so does one whose two means coincide.
    """
    cid, is_a, n, mu, ssd = moments
    k = len(centers)
    count = np.zeros((2, k))
    mean = np.zeros((2, *centers.shape))
    group = np.where(is_a, 0, 1)
    count[group, cid] = n
    mean[group, cid] = mu
    sizes = count.sum(axis=1)
    if not sizes.all():
        raise ValueError("fair k-means needs at least one point of each group")
    fixed = [ssd[group == g].sum() / sizes[g] for g in (0, 1)]
    used = np.flatnonzero(count.sum(axis=0))
    both = count[:, used].all(axis=0)
    ell = np.where(both, np.sqrt(((mean[0, used] - mean[1, used]) ** 2).sum(axis=1)), 0.0)
    x = line_search(count[0, used] / sizes[0], count[1, used] / sizes[1], ell, *fixed)
    # share of the way from the A-mean to the B-mean
    share = np.where(count[0, used] == 0, 1.0, 0.0)
    np.divide(x, ell, out=share, where=both & (ell > 0))
    moved = centers.copy()
    moved[used] = (1 - share)[:, None] * mean[0, used] + share[:, None] * mean[1, used]
    return moved


def fair_kmeans_step(points: DataFrame, centers) -> DataFrame:
    """``(cid, coords)`` after one fair iteration from the given centers, lazily."""
    centers = as_centers(centers)

    def update(pdf: pd.DataFrame) -> pd.DataFrame:
        moved = next_centers(
            Moments(pdf["cid"].to_numpy(), (pdf["grp"] == "A").to_numpy(), pdf["n"].to_numpy(),
                    np.stack(pdf["mu"]), pdf["ssd"].to_numpy()), centers)
        return pd.DataFrame({"cid": range(len(moved)), "coords": list(moved)})

    # at most 2K rows in the single group
    return group_cluster_moments(points, centers).groupBy().applyInPandas(
        update, "cid int, coords array<double>")


def fair_kmeans(points: DataFrame, k: int | None = None, max_iter: int = 10, init_centers=None,
                seed: int = 1,
                storage: StorageLevel | None = StorageLevel.MEMORY_AND_DISK) -> np.ndarray:
    """Centers after exactly ``max_iter`` fair iterations, from ``init_centers`` or k-means||.

    Each iteration is one job over the points that returns at most 2K rows. The points are kept
    packed at the ``storage`` level meanwhile, by default a whole copy in the executors' memory and
    on their disks; with ``None`` every iteration reads the source.
    """
    if init_centers is None and k is None:
        raise ValueError("give k or init_centers")
    centers = kmeans_init(points, k, seed) if init_centers is None else as_centers(init_centers)
    if init_centers is not None and k not in (None, len(centers)):
        raise ValueError(f"{len(centers)} starting centers for k = {k}")
    with looped(points, centers.shape[1], storage) as loop:
        for _ in range(max_iter):
            centers = next_centers(loop.moments(centers), centers)
    return centers
