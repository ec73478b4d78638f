"""Group sizes, clustering objectives and per-cluster group counts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairstream.functions.groups import is_a, with_two_groups
from fairstream.operators.assign import (
    as_centers, centers_frame, fits_expressions, nearest, with_nearest_expressions,
)
from fairstream.operators.blocks import is_packed, map_points
from fairstream.operators.moments import group_cluster_moments


def group_sizes(points: DataFrame) -> DataFrame:
    """One row ``(n, n_a, n_b)``; an absent group counts 0, and n is the sum of the two."""
    return points.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_a()).alias("n_a"),
        F.count_if(~is_a()).alias("n_b"),
    )


def _costs(points: DataFrame, center_sets) -> tuple[DataFrame, list[str]]:
    """Rows ``(grp, n, cost0, cost1, ...)`` to be added up, and the names of the cost columns.

    Center set i gives ``cost{i}``, squared distances to its nearest center. With few centers there
    is a row per point, still inside codegen; with many, a row per group and task.
    """
    sets = [as_centers(c) for c in center_sets]
    if any(len(c) == 0 for c in sets):
        raise ValueError("no centers")
    if len({c.shape[1] for c in sets}) != 1:
        raise ValueError("center sets differ in dimension")
    costs = [f"cost{i}" for i in range(len(sets))]
    if not is_packed(points) and all(fits_expressions(c) for c in sets):
        points = with_two_groups(points)
        for name, centers in zip(costs, sets):
            points = with_nearest_expressions(points, centers, None, name)
        return points.select("grp", F.lit(1).cast("long").alias("n"), *costs), costs

    def partial(batches):
        total = np.zeros((1 + len(sets), 2))
        for x, flag in batches:
            group = flag.astype(np.int64)
            total[0] += np.bincount(group, minlength=2)
            for i, centers in enumerate(sets):
                total[1 + i] += np.bincount(group, nearest(x, centers)[1], minlength=2)
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(["BA"[g] for g in used], pa.string()),
             pa.array(total[0, used].astype(np.int64)), *[pa.array(t[used]) for t in total[1:]]],
            ["grp", "n", *costs])

    schema = "grp string, n long, " + ", ".join(f"{c} double" for c in costs)
    return map_points(points, sets[0].shape[1], partial, schema), costs


def group_costs(points: DataFrame, *center_sets) -> DataFrame:
    """Per group present in the data: ``n`` and, for each center set i, ``cost{i}``, the sum of
    squared distances to the nearest center. All sets are evaluated in one pass."""
    rows, costs = _costs(points, center_sets)
    return rows.groupBy("grp").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in costs])


def _fair(cost: str) -> Column:
    """The larger group mean; an absent group gives null, which ``greatest`` passes over."""

    def mean(group: Column) -> Column:
        return F.try_divide(F.sum(F.when(group, F.col(cost))), F.sum(F.when(group, F.col("n"))))

    return F.greatest(mean(is_a()), mean(~is_a()))


def standard_objective(points: DataFrame, centers) -> DataFrame:
    """One row ``delta``: the mean squared distance to the nearest center.

    0 without centers, null without points.
    """
    centers = as_centers(centers)
    if len(centers) == 0:
        return points.agg(F.lit(0.0).alias("delta"))
    rows, _ = _costs(points, [centers])
    return rows.agg(F.try_divide(F.sum("cost0"), F.sum("n")).alias("delta"))


def fair_objective(points: DataFrame, centers) -> DataFrame:
    """One row ``phi``: the larger of the two groups' mean squared distances.

    Only groups present in the data count. 0 without centers, null without points.
    """
    centers = as_centers(centers)
    if len(centers) == 0:
        return points.agg(F.lit(0.0).alias("phi"))
    rows, _ = _costs(points, [centers])
    return rows.agg(_fair("cost0").alias("phi"))


def compare_centers(points: DataFrame, standard, fair) -> DataFrame:
    """One row ``(phi_standard, phi_fair, ratio)`` from a single pass over the points."""
    rows, _ = _costs(points, [standard, fair])
    both = rows.agg(_fair("cost0").alias("phi_standard"), _fair("cost1").alias("phi_fair"))
    return both.withColumn("ratio", F.try_divide("phi_standard", "phi_fair"))


def cluster_stats(points: DataFrame, centers) -> DataFrame:
    """``(cid, center, n_a, n_b)`` of every cluster that holds a point, in cid order."""
    centers = as_centers(centers)
    if len(centers) == 0:
        return points.sparkSession.createDataFrame(
            [], "cid int, center array<double>, n_a long, n_b long")
    if not is_packed(points) and fits_expressions(centers):
        assigned = with_nearest_expressions(points, centers, "cid", "sqdist")
        counts = assigned.groupBy("cid").agg(
            F.count_if(is_a()).alias("n_a"), F.count_if(~is_a()).alias("n_b"))
    else:
        counts = group_cluster_moments(points, centers).groupBy("cid").agg(
            F.coalesce(F.sum(F.when(is_a(), F.col("n"))), F.lit(0)).alias("n_a"),
            F.coalesce(F.sum(F.when(~is_a(), F.col("n"))), F.lit(0)).alias("n_b"))
    table = centers_frame(points.sparkSession, centers).withColumnRenamed("coords", "center")
    # at most as many counts as centers on either side
    return counts.join(F.broadcast(table), "cid") \
        .select("cid", "center", "n_a", "n_b").orderBy("cid")
