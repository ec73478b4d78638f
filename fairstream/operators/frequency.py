"""Exact item frequencies and heavy hitters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairstream.operators.sketches import sketch_both, sketch_estimates


def item_counts(items: DataFrame) -> DataFrame:
    """``(item, cnt)``. Tasks count their own rows first, so a hot item is no hot partition."""
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("cnt"))


def distinct_items(items: DataFrame) -> DataFrame:
    return items.select("item").distinct()


def distinct_count(items: DataFrame) -> DataFrame:
    return items.agg(F.count_distinct("item").alias("distinct_items"))


def max_item(items: DataFrame) -> DataFrame:
    return items.agg(F.max("item").alias("max_item"))


def top_k_heavy_hitters(counts: DataFrame, k: int) -> DataFrame:
    """Every ``(item, cnt)`` whose count is at least the k-th largest: ties at the k-th place are
    all returned, and all items when there are fewer than ``k``. Order the result by item.

    The k-th count comes from a top-k per task and a merge, so the counts are never sorted whole.
    """
    if k < 1:
        raise ValueError("k must be positive")
    kth = counts.select("cnt").orderBy(F.desc("cnt")).limit(k).agg(F.min("cnt"))
    return counts.where(F.col("cnt") >= kth.scalar())


def hh_detail(counts: DataFrame, d: int, w: int, k: int, seed: int = 1) -> DataFrame:
    """``(item, cnt, cm, cs)`` of the heavy hitters: the true count and both estimates."""
    sketch = sketch_both(counts, d, w, seed, weight="cnt")
    return sketch_estimates(top_k_heavy_hitters(counts, k), sketch, d, w, seed)


def hh_avg_rel_error(detail: DataFrame) -> DataFrame:
    """One row ``(n_hitters, err_cm, err_cs)``: the mean of |count - estimate| / count over
    :func:`hh_detail` rows, null without any."""
    return detail.agg(
        F.count(F.lit(1)).alias("n_hitters"),
        F.avg(F.abs(F.col("cnt") - F.col("cm")) / F.col("cnt")).alias("err_cm"),
        F.avg(F.abs(F.col("cnt") - F.col("cs")) / F.col("cnt")).alias("err_cs"),
    )


def frequency_summary(counts: DataFrame, d: int, w: int, k: int, seed: int = 1) -> DataFrame:
    """One row: items processed, distinct items, heavy hitters, and both average errors."""
    totals = counts.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("processed"),
                        F.count(F.lit(1)).alias("distinct_items"))
    errors = hh_avg_rel_error(hh_detail(counts, d, w, k, seed))
    found = errors.select(F.struct("n_hitters", "err_cm", "err_cs")).scalar()
    return totals.withColumn("_errors", found).select("processed", "distinct_items", "_errors.*")
