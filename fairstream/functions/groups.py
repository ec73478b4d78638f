"""The two groups of labelled points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_a() -> Column:
    """Whether a point is of group A. Any other label, a null one too, means group B."""
    return F.coalesce(F.col("grp") == "A", F.lit(False))


def with_two_groups(points: DataFrame) -> DataFrame:
    """The points with ``grp`` A or B."""
    return points.withColumn("grp", F.when(is_a(), "A").otherwise("B"))
