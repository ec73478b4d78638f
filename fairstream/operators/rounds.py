"""Rounds of a clustering loop: assignment with triangle-inequality bounds, and exact sums.

A point keeps its center of an earlier round and a lower bound of its distance to all others. From
how far the centers have moved since, most points are seen to stay where they are after a single
distance, that to their own center. Sums are integers, so that they do not depend on the order of
the points or on how they are partitioned.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairstream.operators.assign import nearest_two
from fairstream.operators.blocks import PACKED, bytes_of, map_points, pack_points, pieces
from fairstream.operators.moments import Moments

#: Bits of a value in units of its grid, and the bits that are summed apart.
_BITS, _LOW, _WORD = 51, 26, 40
#: Relative room for rounding in comparisons of bounds.
_SLACK = 1e-9
_STATE = f"{PACKED}, cid binary, lower binary, looked long"
#: A round in which more than this share of the points needed all distances is followed by one that
#: notes bounds anew.
NOTE_ABOVE = 0.1
_SUMS = "key int, what int, high long, low long"


def largest_coordinate(points: DataFrame, dim: int) -> float:
    """The largest absolute coordinate, 0 without points."""

    def partial(batches):
        most = max((float(np.abs(x).max()) for x, _ in batches), default=0.0)
        yield pa.RecordBatch.from_arrays([pa.array([most])], ["most"])

    return map_points(points, dim, partial, "most double").agg(F.max("most")).first()[0] or 0.0


def grid(most: float) -> int:
    """The exponent s at which values up to ``most`` times 2^s have at most _BITS bits."""
    return _BITS - math.frexp(most)[1] if most > 0 else 0


class ExactSums:
    """Sums by key of values on a grid, in two integers each. Counts have a column of their own."""

    def __init__(self, keys: int, exponents: list[int]):
        self.keys = keys
        self.exponents = np.array(exponents)
        self.high = np.zeros((len(exponents), keys), np.int64)
        self.low = np.zeros((len(exponents), keys), np.int64)

    def add(self, key: np.ndarray, column: int, values: np.ndarray) -> None:
        whole = np.rint(np.ldexp(values, self.exponents[column])).astype(np.int64)
        high = whole >> _LOW
        # each product of a batch's size and 2^26 is exact in a double
        self.high[column] += np.bincount(key, high, self.keys).astype(np.int64)
        self.low[column] += np.bincount(key, whole - (high << _LOW), self.keys).astype(np.int64)

    def batch(self) -> pa.RecordBatch:
        """Rows of ``_SUMS`` for the keys in use; ``what`` is the column."""
        high, low = self.high + (self.low >> _LOW), self.low & ((1 << _LOW) - 1)
        what, key = np.nonzero((high != 0) | (low != 0))
        high, low = high[what, key], low[what, key]
        rest = _WORD - _LOW
        return pa.RecordBatch.from_arrays(
            [pa.array(key.astype(np.int32)), pa.array(what.astype(np.int32)),
             pa.array(high >> rest), pa.array(((high & ((1 << rest) - 1)) << _LOW) | low)],
            ["key", "what", "high", "low"])


class Loop:
    """The points of a loop and, per round, the moments of their clusters."""

    def __init__(self, points: DataFrame, dim: int, storage: StorageLevel | None):
        self.dim, self.storage = dim, storage
        self.points = points if storage is None else pack_points(points, dim).persist(storage)
        self.state, self.reference = None, None
        #: Points whose distances to all centers were worked out, in each round, and all points.
        self.looked: list[int] = []
        self.n = 0
        most = largest_coordinate(self.points, dim)
        self.exponents = [0, 0, grid(4 * dim * most * most), *[grid(most)] * dim]

    def close(self) -> None:
        for rows in (self.state, self.points):
            if rows is not None and self.storage is not None:
                rows.unpersist()

    def moments(self, centers: np.ndarray) -> Moments:
        """One job over the points. In the first round, and after one in which many points needed
        all distances, each point's center and bound are noted; later rounds compare with these."""
        if self.storage is None:
            return self._collect(self._sums(self.points, centers, None), centers)
        before = self.state
        if before is None or self.looked[-1] > NOTE_ABOVE * self.n:
            self._note(centers)
        found = self._collect(self._sums(self.state, centers, self.reference), centers)
        if before is not None and before is not self.state:
            before.unpersist()  # what was made from it is stored by now
        return found

    def _note(self, centers: np.ndarray) -> None:
        reference, dim = self.reference, self.dim

        def note(batches):
            bounds = _bounds(reference, centers)
            for x, flag, old in _read_state(batches, dim):
                cid, lower, looked = _settle(x, old, bounds, centers)
                starts = np.cumsum([0, *flag.lengths])
                parts = [(x[a:b], flag.values[a:b], cid[a:b].astype(np.int32), lower[a:b])
                         for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([p[k].tobytes() for p in parts], pa.binary()) for k in range(4)),
                     pa.array(np.add.reduceat(looked, starts[:-1], dtype=np.int64))],
                    ["coords", "flags", "cid", "lower", "looked"])

        source = self.points if self.state is None else self.state
        self.state = source.mapInArrow(note, _STATE).persist(self.storage)
        self.reference = centers.copy()

    def _sums(self, points: DataFrame, centers: np.ndarray, reference) -> DataFrame:
        k, dim, exponents = len(centers), self.dim, self.exponents
        noted = reference is not None and np.array_equal(reference, centers)

        def add(sums, x, flag, old, bounds):
            cid, _, looked = _settle(x, old, bounds, centers)
            key = 2 * cid + flag
            gap = x - centers[cid]
            cost = np.zeros(len(x))
            for d in range(dim):  # column by column, so that a point's cost is always the same
                cost += gap[:, d] * gap[:, d]
            sums.add(key, 0, np.ones(len(x)))
            sums.add(key, 1, looked.astype(float))
            sums.add(key, 2, cost)
            for d in range(dim):
                sums.add(key, 3 + d, x[:, d])

        def rows(batches):
            sums = ExactSums(2 * k, exponents)
            for x, flag in batches:
                add(sums, x, flag, None, None)
            yield sums.batch()

        def states(batches):
            sums, bounds = ExactSums(2 * k, exponents), _bounds(reference, centers)
            for x, flag, old in _read_state(batches, dim):
                add(sums, x, flag.values, old, bounds)
                if noted:  # the work of this round was done when it was noted
                    sums.add(np.zeros(1, np.int64), 1, np.array([float(old[2])]))
            yield sums.batch()

        parts = map_points(points, dim, rows, _SUMS) if reference is None \
            else points.mapInArrow(states, _SUMS)
        return parts.groupBy("key", "what").agg(F.sum("high").alias("high"),
                                                F.sum("low").alias("low"))

    def _collect(self, sums: DataFrame, centers: np.ndarray) -> Moments:
        total: dict[int, dict[int, int]] = {}
        for key, what, high, low in zip(*(c.to_pylist() for c in sums.toArrow().columns)):
            total.setdefault(key, {})[what] = (high << _WORD) + low
        keys = sorted(total)
        self.looked.append(sum(total[key].get(1, 0) for key in keys))
        keys = [key for key in keys if 0 in total[key]]
        n = [total[key][0] for key in keys]
        self.n = sum(n)

        def mean(key: int, what: int) -> float:
            """A quotient of integers, rounded once."""
            exponent = self.exponents[what]
            top, below = total[key].get(what, 0), total[key][0]
            return top / (below << exponent) if exponent >= 0 else (top << -exponent) / below

        mu = np.array([[mean(key, 3 + d) for d in range(self.dim)] for key in keys]) \
            .reshape(-1, self.dim)
        cid = np.array(keys, np.int64) // 2
        shift = ((mu - centers[cid]) ** 2).sum(axis=1)
        cost = np.array([mean(key, 2) for key in keys])
        n = np.array(n, float)
        return Moments(cid, np.array(keys, np.int64) % 2 == 1, n, mu,
                       np.maximum(n * (cost - shift), 0.0))


class _Flags:
    """Flags of several packed rows, and how many points each row holds."""

    def __init__(self, values: np.ndarray, lengths: np.ndarray):
        self.values, self.lengths = values, lengths


def _read_state(batches, dim: int):
    for batch in pieces(batches):
        x = bytes_of(batch.column(0), np.float64).reshape(-1, dim)
        flags = batch.column(1)
        lengths = np.array([len(f.as_buffer()) for f in flags])
        old = None if batch.num_columns < 4 else (
            bytes_of(batch.column(2), np.int32), bytes_of(batch.column(3), np.float64),
            np.sum(batch.column(4).to_numpy()))
        yield x, _Flags(bytes_of(flags, np.bool_), lengths), old


def _bounds(reference, centers: np.ndarray):
    """How far the other centers may have come closer to a point of each center since the reference,
    and half of each center's distance to the nearest other one; None without a reference."""
    if reference is None:
        return None
    moved = np.sqrt(((centers - reference) ** 2).sum(axis=1)) * (1 + _SLACK)
    most = np.sort(moved)[::-1]
    # the largest move but one's own
    closer = np.where(moved == most[0], most[1] if len(most) > 1 else 0.0, most[0])
    return closer, _half_gaps(centers)


def _settle(x: np.ndarray, old, bounds, centers: np.ndarray):
    """Each point's nearest center, a lower bound of the distance to the others, and whether its
    distances to all centers were needed."""
    if old is None:
        cid, _, lower = nearest_two(x, centers)
        return cid, lower, np.ones(len(x), bool)
    cid, lower, _ = old
    closer, half = bounds
    lower = lower - closer[cid]
    gap = x - centers[cid]
    own = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    needed = ~(own * (1 + _SLACK) < np.maximum(lower, half[cid]) * (1 - _SLACK))
    if needed.any():
        cid, lower = cid.copy(), lower.copy()
        cid[needed], _, lower[needed] = nearest_two(x[needed], centers)
    return cid, lower, needed


def _half_gaps(centers: np.ndarray) -> np.ndarray:
    """Half of each center's distance to the nearest other one; a point within it is at home."""
    half = np.full(len(centers), np.inf)
    step = max(1, (1 << 20) // max(1, centers.size))
    for i in range(0, len(centers), step):
        gap = ((centers[i:i + step, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
        gap[np.arange(len(gap)), i + np.arange(len(gap))] = np.inf
        half[i:i + step] = np.sqrt(gap.min(axis=1)) / 2
    return half
