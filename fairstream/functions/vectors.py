"""Expressions over ``array<double>`` coordinates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance(coordinates: Sequence[Column], center: Sequence[float]) -> Column:
    """Squared Euclidean distance to a literal center, as plain arithmetic inside codegen."""
    gaps = [x - F.lit(float(c)) for x, c in zip(coordinates, center)]
    return sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])


def checked_coordinates(coords: Column, dim: int) -> list[Column]:
    """The ``dim`` elements; any other number of them, or a null among them, is an error."""
    wrong = F.raise_error(F.lit(
        f"point and centers differ in dimension or a coordinate is null: expected {dim}"))
    elements = [F.get(coords, F.lit(d)) for d in range(dim)]
    return [F.coalesce(e, wrong) for e in elements[:-1]] + [
        F.when(elements[-1].isNotNull() & (F.size(coords) == dim), elements[-1]).otherwise(wrong)]
