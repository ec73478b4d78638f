"""Exact search for the largest inner products with M-trees."""

from __future__ import annotations

import heapq
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairstream.llm.common import stored

#: Entries of a node.
PAGE = 256
#: Distinct vectors of one tree, and queries of one block.
TREE_ROWS, BLOCK_ROWS = 8192, 256


class MTree:
    """A bulk-loaded M-tree over integer vectors.

    Vectors get one more coordinate that brings all to the same length, so that the largest inner
    product with a query is the smallest distance to it. Every entry of a node stores its distance
    to the node's own routing object; entries of inner nodes also a covering radius and a child.
    """

    def __init__(self, vectors: np.ndarray):
        x = vectors.astype(np.float64)
        squares = (x * x).sum(axis=1)
        self.top = float(squares.max(initial=0.0))
        # products of floating point numbers are exact as long as no sum can pass 2^53
        self.vectors, self.largest = vectors, float(np.abs(x).max(initial=0.0))
        self.points = np.column_stack([x, np.sqrt(np.maximum(0.0, self.top - squares))])
        # a node: its entries' rows, points, distances to the parent, radii, children (or None)
        self.nodes: list[tuple] = []
        self.root = self._load(np.arange(len(vectors)), None)

    def _distances(self, rows: np.ndarray, to) -> np.ndarray:
        if to is None:
            return np.zeros(len(rows))
        return np.sqrt(((self.points[rows] - self.points[to]) ** 2).sum(axis=1))

    def _node(self, rows, parent, radii=None, children=None) -> int:
        self.nodes.append((rows, self.points[rows], self._distances(rows, parent), radii, children))
        return len(self.nodes) - 1

    def _load(self, rows: np.ndarray, parent) -> int:
        if len(rows) <= PAGE:
            return self._node(rows, parent)
        fan = min(PAGE, -(-len(rows) // (PAGE // 2)))
        routing = rows[np.linspace(0, len(rows) - 1, fan).astype(int)]
        # squared distances by the product form: only used to choose, never to prune
        p = self.points
        nearest = ((p[routing] ** 2).sum(axis=1) - 2 * p[rows] @ p[routing].T).argmin(axis=1)
        groups = [rows[nearest == i] for i in range(fan)]
        if max(map(len, groups)) == len(rows):
            groups = np.array_split(rows, fan)
        kept, radii, children = [], [], []
        for i, group in enumerate(groups):
            if len(group):
                kept.append(routing[i])
                radii.append(self._distances(group, routing[i]).max())
                children.append(self._load(group, routing[i]))
        return self._node(np.array(kept), parent, np.array(radii), children)

    def search(self, query: np.ndarray, ids: list, own, k: int, stats: list | None = None):
        """The k best (score, id) with ties to the smaller id, ``own`` left out."""
        q = query.astype(np.float64)
        exact = self.largest * float(np.abs(q).max(initial=0.0)) * max(1, len(q)) < 2.0 ** 53
        length = float(q @ q)
        point = np.append(q, 0.0)
        slack = 1e-7 * (1.0 + float(np.sqrt(length + self.top)))
        best: list[tuple[int, int]] = []  # a heap of (score, -id)
        reach = np.inf
        queue = [(0.0, 0, self.root, None)]
        tick = 0
        while queue:
            bound, _, at, to_parent = heapq.heappop(queue)
            if bound > reach:
                break
            rows, points, apart, radii, children = self.nodes[at]
            if to_parent is not None and reach < np.inf:
                # |d(q, parent) - d(entry, parent)| is at most d(q, entry)
                least = np.abs(to_parent - apart)
                open_ = np.flatnonzero((least if children is None else least - radii) <= reach)
                if len(open_) < len(rows):
                    rows, points = rows[open_], points[open_]
                    if children is not None:
                        radii, children = radii[open_], [children[i] for i in open_]
            if stats is not None:
                stats[0] += len(rows)
            if not len(rows):
                continue
            products = points @ point
            if children is None:
                scores = products if exact else self.vectors[rows] @ query
                if len(best) == k:
                    worth = np.flatnonzero(scores >= best[0][0])
                    if not len(worth):
                        continue
                    rows, scores = rows[worth], scores[worth]
                for i in np.argsort(-scores, kind="stable"):
                    score = int(scores[i])
                    if len(best) == k and score < best[0][0]:
                        break
                    for one in ids[rows[i]]:
                        item = (score, -one)
                        if one == own:
                            continue
                        if len(best) < k:
                            heapq.heappush(best, item)
                        elif item > best[0]:
                            heapq.heapreplace(best, item)
                if len(best) == k:
                    reach = max(0.0, length + self.top - 2.0 * best[0][0]) ** 0.5 + slack
            else:
                # every point has the squared length ``top``
                to = np.sqrt(np.maximum(0.0, length + self.top - 2.0 * products))
                least = np.maximum(0.0, to - radii)
                for child, d, low in zip(children, to.tolist(), least.tolist()):
                    if low <= reach:
                        tick += 1
                        heapq.heappush(queue, (low, tick, child, d))
        return [(score, -i) for score, i in sorted(best, key=lambda b: (-b[0], -b[1]))]


def _packed(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _chunks(batches, rows: int):
    """The rows of Arrow batches in lists of at most so many, all vectors of one dimension."""
    waiting: dict[int, list] = {}
    for batch in batches:
        for ids, vector in zip(batch.column("ids").to_pylist(), batch.column("v").to_pylist()):
            same = waiting.setdefault(len(vector), [])
            same.append((ids, vector))
            if len(same) == rows:
                yield waiting.pop(len(vector))
    yield from waiting.values()


def _blocks(df: DataFrame, rows: int) -> DataFrame:
    """Rows ``ids array<long>, v array<long>`` as blobs of at most so many, with a number each."""

    def build(batches):
        for same in _chunks(batches, rows):
            vectors = np.array([v for _, v in same], dtype=np.int64).reshape(len(same), -1)
            ends = np.cumsum([len(i) for i, _ in same])
            blob = _packed(vectors=vectors, ends=ends, ids=np.array([j for i, _ in same for j in i],
                                                                     dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([vectors.shape[1]], pa.int32()), pa.array([blob], pa.binary())],
                ["dim", "blob"])

    return df.mapInArrow(build, "dim int, blob binary") \
        .withColumn("no", F.monotonically_increasing_id())


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``id long, v array<long>`` of the rows whose vectors are whole; v is floor(scale * x)."""
    x = F.col("x")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return vectors.select(vectors[id_col].cast("long").alias("id"),
                          vectors[vector_col].cast("array<double>").alias("x")) \
        .where(F.col("id").isNotNull() & x.isNotNull()).where(finite) \
        .select("id", F.transform(x, lambda e: F.floor(e * scale).cast("long")).alias("v"))


def top_inner_products(vectors: DataFrame, every: int = 50, k: int = 5, scale: float = 256.0,
                       id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k largest inner products of every query, which is each row whose id ``every`` divides.

    Equal vectors are one entry of a tree with their k + 1 smallest ids, so a vector that many rows
    share is no large group; these ids are all that a top k with ties to smaller ids can need. Each
    task bulk-loads trees of at most ``TREE_ROWS`` distinct vectors. Blocks of queries meet every
    tree, and the best of the trees are merged. A query's own id takes no part; a row that is
    repeated counts once; only vectors of the query's dimension are compared; rows with a null id
    are left out. Scores are 64-bit sums. Columns: ``query_id, rank, vec_id, score``.
    """
    rows = integer_vectors(vectors, id_col, vector_col, scale)
    # k + 1 smallest ids per distinct vector: the limit is applied by each task before the shuffle
    by_vector = Window.partitionBy("v").orderBy("id")
    entries = rows.withColumn("n", F.dense_rank().over(by_vector)).where(F.col("n") <= k + 1) \
        .groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    trees = stored(_blocks(entries, TREE_ROWS), "trees")
    queries = rows.where(F.col("id") % every == 0).dropDuplicates(["id", "v"]) \
        .select(F.array("id").alias("ids"), "v")
    blocks = stored(_blocks(queries, BLOCK_ROWS), "queries")
    # every tree by every block of its dimension: both sides are few, large rows
    numbers = blocks.groupBy("dim").agg(F.collect_list("no").alias("blocks"))
    pairs = trees.withColumnRenamed("blob", "tree").drop("no").join(numbers, "dim") \
        .select("tree", F.explode("blocks").alias("no")) \
        .join(blocks.select("no", "blob"), "no")

    def search(batches):
        for batch in batches:
            for tree_blob, block_blob in zip(batch.column("tree"), batch.column("blob")):
                stored_tree = np.load(io.BytesIO(tree_blob.as_py()))
                block = np.load(io.BytesIO(block_blob.as_py()))
                parts = np.split(stored_tree["ids"], stored_tree["ends"][:-1])
                ids, tree = [p.tolist() for p in parts], MTree(stored_tree["vectors"])
                found = [(int(own), i, score) for own, query in zip(block["ids"], block["vectors"])
                         for score, i in tree.search(query, ids, own, k)]
                columns = list(zip(*found)) or [()] * 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.mapInArrow(search, "query_id long, vec_id long, score long") \
        .distinct() \
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
