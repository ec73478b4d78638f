"""Point sets on which standard k-means is unfair to the small group.

Every coordinate is a function of the point's id and the seed, so the result is the same for any
number of partitions and when a lost task runs again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _uniform(point_id: Column, seed: int, stream: int) -> Column:
    """A double in (0, 1) from the first 12 hex digits of an MD5 of seed, stream and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{stream}:"), point_id.cast("string")))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def _gaussian_pair(point_id: Column, seed: int) -> tuple[Column, Column]:
    """Two independent standard normal values (Box-Muller)."""
    radius = F.sqrt(F.lit(-2.0) * F.log(_uniform(point_id, seed, 1)))
    angle = F.lit(2 * math.pi) * _uniform(point_id, seed, 2)
    return radius * F.cos(angle), radius * F.sin(angle)


def _points(ids: DataFrame, center_x: Column, center_y: Column, radius: Column, seed: int,
            group: Column) -> DataFrame:
    gx, gy = _gaussian_pair(F.col("id"), seed)
    return ids.select(
        F.col("id").alias("point_id"),
        F.array(center_x + radius * gx, center_y + radius * gy).alias("coords"),
        group.alias("grp"),
    )


def fair_gap_points(spark: SparkSession, n: int, k: int, seed: int = 1, big_radius: float = 1.0,
                    small_radius: float = 0.0, y_a: float = 100.0, y_b: float = 0.0,
                    gap: float = 500.0) -> DataFrame:
    """``n - k`` points of A around (0, y_a), one of B at (0, y_b), and one of A at each of
    (gap, y_b), (2 gap, y_b), ... for the remaining ``k - 1``."""
    if k <= 0 or k > n:
        raise ValueError("k must be positive and at most n")
    crowd = n - k
    pid = F.col("id")
    in_crowd = pid < crowd
    return _points(
        spark.range(n),
        center_x=F.when(in_crowd, 0.0).otherwise((pid - crowd) * F.lit(gap)),
        center_y=F.when(in_crowd, y_a).otherwise(y_b),
        radius=F.when(in_crowd, big_radius).otherwise(small_radius),
        seed=seed,
        group=F.when(pid == crowd, "B").otherwise("A"),
    )


def fair_balanced_points(spark: SparkSession, n: int, k: int, seed: int = 1,
                         big_radius: float = 1.0, small_radius: float = 0.0, y_a: float = 100.0,
                         y_b: float = 0.0, gap: float = 500.0) -> DataFrame:
    """``k`` sites at x = 0, gap, 2 gap, ..., each with one point of B around y_b and the rest of
    its share of ``n`` in A around y_a. The first ``n mod k`` sites hold one point more."""
    if k <= 0 or n <= 2 * k:
        raise ValueError("k must be positive and n larger than 2 k")
    share, extra = divmod(n, k)
    pid = F.col("id")
    boundary = extra * (share + 1)
    large = pid < boundary
    site = F.when(large, F.expr(f"id div {share + 1}")).otherwise(
        F.lit(extra) + F.expr(f"(id - {boundary}) div {share}"))
    rank = F.when(large, pid % (share + 1)).otherwise((pid - boundary) % share)
    is_b = rank == 0
    return _points(
        spark.range(n),
        center_x=site * F.lit(gap),
        center_y=F.when(is_b, y_b).otherwise(y_a),
        radius=F.when(is_b, small_radius).otherwise(big_radius),
        seed=seed,
        group=F.when(is_b, "B").otherwise("A"),
    )
