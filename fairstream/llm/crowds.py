"""Comparison of all sets that share a list, without a row for each pair."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Members of a list that are compared with each other at once.
LIST_BLOCK = 1024
#: Tokens that one product of incidence matrices covers.
_TOKENS = 1 << 12


def block_pairs(members: DataFrame, columns: list[str]) -> DataFrame:
    """``list, here, there, same``: each two blocks of a list, as arrays of the named columns.

    ``members`` has ``list`` and ``node``. A list is split into blocks of about LIST_BLOCK nodes by
    a hash, so none is gathered as a whole; ``same`` marks a block that meets itself.
    """
    sizes = members.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / LIST_BLOCK).alias("blocks"))
    blocks = members.join(sizes, "list") \
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))) \
        .groupBy("list", "block").agg(F.collect_list(F.struct(*columns)).alias("here"))
    others = blocks.select("list", F.col("block").alias("other"), F.col("here").alias("there"))
    return blocks.join(others, "list").where("block <= other") \
        .select("list", "here", "there", (F.col("block") == F.col("other")).alias("same"))


def read_block(cell, column: str):
    """One column of a block as an Arrow array."""
    return cell.values.field(column)


def numbers(cell, column: str) -> np.ndarray:
    return read_block(cell, column).to_numpy(zero_copy_only=False)


def matrix(column, dtype="<u4") -> np.ndarray:
    """Binary cells of equal length, one below the other."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype).reshape(len(column), -1)


def common_tokens(here: list[np.ndarray], there: list[np.ndarray], i: np.ndarray,
                  j: np.ndarray) -> np.ndarray:
    """How many tokens the sets ``here[i]`` and ``there[j]`` have in common, for pairs i, j.

    Few pairs are intersected one by one. Many pairs have few different sets, whose incidence
    matrices over shared tokens are multiplied, some tokens at a time.
    """
    rows, i = np.unique(i, return_inverse=True)
    columns, j = np.unique(j, return_inverse=True)
    if len(i) < 2 * (len(rows) + len(columns)):
        return np.array([len(np.intersect1d(here[rows[a]], there[columns[b]], assume_unique=True))
                         for a, b in zip(i, j)], np.int64)
    x, y = ([sets[k] for k in some] for sets, some in ((here, rows), (there, columns)))
    tokens = np.intersect1d(np.concatenate(x), np.concatenate(y))
    total = np.zeros((len(x), len(y)), np.int64)
    sides = []
    for sets in (x, y):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        every = np.concatenate(sets)
        place = np.searchsorted(tokens, every)
        known = place < len(tokens)
        known[known] = tokens[place[known]] == every[known]
        order = np.argsort(place[known], kind="stable")
        sides.append((place[known][order], owner[known][order], len(sets)))
    for low in range(0, len(tokens), _TOKENS):
        parts = []
        for place, owner, n in sides:
            a, b = np.searchsorted(place, [low, low + _TOKENS])
            part = np.zeros((n, min(_TOKENS, len(tokens) - low)), np.float32)
            part[owner[a:b], place[a:b] - low] = 1
            parts.append(part)
        total += np.rint(parts[0] @ parts[1].T).astype(np.int64)
    return total[i, j]


class Forest:
    """Picks the links that connect what the links before did not, by union-find over components.

    What was connected is remembered up to MOST ends; then it begins anew, so that its size does not
    grow with the links.
    """

    MOST = 1 << 18

    def __init__(self):
        self._above: dict[int, int] = {}

    def _top(self, x: int) -> int:
        above = self._above
        while (up := above.setdefault(x, x)) != x:
            above[x] = x = above[up]
        return x

    def connecting(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of the links between the components a and b that connect something new."""
        if len(self._above) >= self.MOST:
            self._above.clear()
        found = []
        for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
            x, y = self._top(x), self._top(y)
            if x != y:
                self._above[x] = y
                found.append(i)
        return np.array(found, np.int64)


def first_of_each(owner: np.ndarray, comp: np.ndarray) -> np.ndarray:
    """Places of the first link of every owner to every component; others tell nothing new."""
    _, first = np.unique(np.stack((owner, comp), axis=1), axis=0, return_index=True)
    return first


def pair_batch(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))],
                                      ["a", "b"])
