"""Near-duplicate documents: an inverted join of MinHash signature coordinates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairstream.llm import crowds
from fairstream.llm.common import stored, texts
from fairstream.llm.components import components
from fairstream.llm.jaccard_join import NO_KEY, needed_sets, node_number
from fairstream.llm.shingles import Shingler, grouped, mix

#: Words of a shingle. Sets link when 100 * intersection >= PER_CENT * union.
SHINGLE_WORDS, PER_CENT = 3, 85
#: Coordinates of a signature, and how many of them two sets must have in common to be compared.
#: Of linked sets, each coordinate is equal with a probability of at least 0.85, so that a link is
#: overlooked with a probability below 2e-9.
COORDINATES, MATCHES = 64, 35
#: A document is posted under so many coordinates: of any MATCHES common ones, at least one is
#: among the first so many of both, in whatever order all coordinate-value pairs are taken.
PREFIX = COORDINATES - MATCHES + 1
#: Counters of the sketch that orders coordinate-value pairs, rare ones first.
COUNTERS, BLOCK = 1 << 18, 1 << 12
#: Rounds in which every document is compared with one other at most, before all that is left.
ROUNDS = 3
#: Characters whose shingles are worked out at once.
AT_ONCE = 1 << 17
_SEEDS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64), 0x5EED)
_FACTORS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64), 0xFAC7) | np.uint64(1)


def signature(tokens: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over a set, 32 bits of it."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(tokens), 1 << 12):
        some = tokens[i:i + (1 << 12)]
        some = (some[None, :] ^ _SEEDS[:, None]) * _FACTORS[:, None]
        np.minimum(least, some.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def pairs_of(values: np.ndarray) -> np.ndarray:
    """Coordinate-value pairs as single numbers, for signatures one below the other."""
    coordinate = np.arange(COORDINATES, dtype=np.int64) << 32
    return coordinate | values.astype(np.int64)


def _counter(pairs: np.ndarray) -> np.ndarray:
    return (mix(pairs.view(np.uint64), 7) >> np.uint64(64 - COUNTERS.bit_length() + 1)) \
        .astype(np.int64)


def _sets(values: list[str], shingler: Shingler) -> Iterator[np.ndarray]:
    for _, data in grouped(values, AT_ONCE):
        yield from shingler.sets(data)


def describe(rows: DataFrame) -> DataFrame:
    """From ``key, text``: per row ``key, n, node, sig, bytes``. The node is a number of 64 bits
    that equal sets have in common; ``bytes`` has one byte of each coordinate of the signature."""

    def run(batches):
        shingler = Shingler(SHINGLE_WORDS)
        for batch in batches:
            sizes, nodes, signatures, short = [], [], [], []
            for tokens in _sets(texts(batch), shingler):
                sizes.append(len(tokens))
                if len(tokens):
                    nodes.append(node_number(tokens))
                    values = signature(tokens)
                    signatures.append(values.astype("<u4").tobytes())
                    short.append(values.astype(np.uint8).tobytes())
                else:
                    for column in (nodes, signatures, short):
                        column.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(signatures, pa.binary()), pa.array(short, pa.binary())],
                ["key", "n", "node", "sig", "bytes"])

    return rows.mapInArrow(run, "key long, n long, node long, sig binary, bytes binary")


def count_pairs(nodes: DataFrame) -> np.ndarray:
    """How many nodes share a counter of a coordinate-value pair; a sketch of fixed size."""

    def count(batches):
        counters = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            if batch.num_rows:
                found = _counter(pairs_of(crowds.matrix(batch.column("sig"))).ravel())
                counters += np.bincount(found, minlength=COUNTERS)
        if counters.any():
            blocks = counters.reshape(-1, BLOCK)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(blocks)), pa.int32()),
                 pa.array([np.minimum(b, 2 ** 32 - 1).astype("<u4").tobytes() for b in blocks],
                          pa.binary())], ["block", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts")):
                some = np.frombuffer(counts.as_py(), "<u4").astype(np.int64)
                sums[block] = sums[block] + some if block in sums else some
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()),
             pa.array([np.minimum(s, 2 ** 32 - 1).astype("<u4").tobytes()
                       for s in sums.values()], pa.binary())], ["block", "counts"])

    kind = "block int, counts binary"
    sketch = np.zeros(COUNTERS, np.uint32)
    for block, counts in nodes.select("sig").mapInArrow(count, kind).repartition("block") \
            .mapInArrow(add, kind).collect():  # COUNTERS numbers in all
        sketch[block * BLOCK:(block + 1) * BLOCK] = np.frombuffer(counts, "<u4")
    return sketch


def postings(nodes: DataFrame, sketch: np.ndarray) -> DataFrame:
    """``list, node``: each node under the PREFIX rarest of its coordinate-value pairs.

    The others, most of the long lists among them, are skipped; they count when two signatures are
    compared.
    """
    shared = nodes.sparkSession.sparkContext.broadcast(sketch)

    def run(batches):
        counters = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            pairs = pairs_of(crowds.matrix(batch.column("sig")))
            first = np.argpartition(_ranks(pairs, counters), PREFIX - 1, axis=1)[:, :PREFIX]
            node = np.repeat(batch.column("node").to_numpy(), PREFIX)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.take_along_axis(pairs, first, axis=1).ravel()), pa.array(node)],
                ["list", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "list long, node long")


def common_coordinates(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many coordinates each row of ``x`` has in common with the same row of ``y``."""
    return (x == y).sum(axis=1)


def matching(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of nodes with MATCHES common coordinates, as far as one byte of each
    tells, and fitting sizes."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (crowds.matrix(batch.column(c), np.uint8) for c in ("x", "y"))
                yield batch.select(["a", "b"]).filter(
                    pa.array(common_coordinates(x, y) >= MATCHES))

    ends = [nodes.select(F.col("node").alias(e), F.col("bytes").alias(s), F.col("n").alias(n))
            for e, s, n in (("a", "x", "n_a"), ("b", "y", "n_b"))]
    fits = 100 * F.least("n_a", "n_b") >= PER_CENT * F.greatest("n_a", "n_b")
    return pairs.join(ends[0], "a").join(ends[1], "b").where(fits) \
        .select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _ranks(pairs: np.ndarray, counters: np.ndarray) -> np.ndarray:
    """The place of coordinate-value pairs in one order of all: rare ones first, then by a hash."""
    flat = pairs.ravel()
    rank = (counters[_counter(flat)].astype(np.uint64) << np.uint64(32)) \
        | (mix(flat.view(np.uint64), 9) >> np.uint64(32))
    return rank.reshape(pairs.shape)


def _candidates(here, there, same: bool):
    """For each member of a block, the places in the other that are of another component, of
    fitting size, and have MATCHES coordinates in common with it."""
    (node, comp, n, sig), others = here, there
    for k in range(len(node)):
        fits = (others[1] != comp[k]) & (100 * np.minimum(others[2], n[k])
                                         >= PER_CENT * np.maximum(others[2], n[k]))
        if same:
            fits[:k + 1] = False
        left = np.flatnonzero(fits)
        equal = others[3][left] == sig[k]
        enough = equal.sum(axis=1) >= MATCHES
        yield k, left[enough], equal[enough]


def _block(cell, column: str = "sig", kind="<u4"):
    return (*(crowds.numbers(cell, c) for c in ("node", "comp", "n")),
            crowds.matrix(crowds.read_block(cell, column), kind))


def _with_candidates(here, there, same: bool) -> np.ndarray:
    """The nodes of two blocks that have a candidate in the other block.

    A member that is known to have one is compared only with those not known yet.
    """
    (node, comp, n, sig), others = here, there
    known = np.zeros(len(node), bool)
    known_there = known if same else np.zeros(len(others[0]), bool)
    for k in range(len(node)):
        fits = (others[1] != comp[k]) & (100 * np.minimum(others[2], n[k])
                                         >= PER_CENT * np.maximum(others[2], n[k]))
        if known[k]:
            fits &= ~known_there
        left = np.flatnonzero(fits)
        if len(left):
            left = left[(others[3][left] == sig[k]).sum(axis=1) >= MATCHES]
            known_there[left] = True
            known[k] |= len(left) > 0
    return np.unique(np.concatenate((node[known], others[0][known_there])))


def near_in_lists(members: DataFrame) -> DataFrame:
    """``list, node`` of the nodes that may have a candidate in a list, as far as one byte of each
    coordinate tells. Where they do not, whole signatures need not be looked at."""

    def run(batches):
        for batch in batches:
            lists, nodes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for number, x, y, same in zip(batch.column("list").to_pylist(), batch.column("here"),
                                          batch.column("there"), batch.column("same").to_pylist()):
                here, there = _block(x, "bytes", np.uint8), _block(y, "bytes", np.uint8)
                found = _with_candidates(here, there, same)
                nodes.append(found)
                lists.append(np.full(len(found), number))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in (lists, nodes)], ["list", "node"])

    return crowds.block_pairs(members, ["node", "comp", "n", "bytes"]) \
        .mapInArrow(run, "list long, node long").distinct()


def met_in_lists(members: DataFrame, sketch: np.ndarray) -> DataFrame:
    """``list, node`` of the nodes that meet a candidate in a list, once for each pair: where both
    are posted in several lists, the one of the lowest coordinate counts."""
    shared = members.sparkSession.sparkContext.broadcast(sketch)

    def prefix(sig):
        rank = _ranks(pairs_of(sig), shared.value)
        return rank <= np.partition(rank, PREFIX - 1, axis=1)[:, PREFIX - 1:PREFIX]

    def run(batches):
        for batch in batches:
            lists, nodes = [], []
            for number, x, y, same in zip(batch.column("list").to_pylist(), batch.column("here"),
                                          batch.column("there"), batch.column("same").to_pylist()):
                here, there = _block(x), _block(y)
                first, others = prefix(here[3]), prefix(there[3])
                found = []
                for k, left, equal in _candidates(here, there, same):
                    both = equal & first[k] & others[left]
                    left = left[both.any(axis=1) & (both.argmax(axis=1) == number >> 32)]
                    if len(left):
                        found += [here[0][k:k + 1], there[0][left]]
                if found:
                    nodes.append(np.unique(np.concatenate(found)))
                    lists.append(np.full(len(nodes[-1]), number))
            none = [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x or none)) for x in (lists, nodes)], ["list", "node"])

    return crowds.block_pairs(members, ["node", "comp", "n", "sig"]) \
        .mapInArrow(run, "list long, node long").distinct()


def links_in_lists(members: DataFrame) -> DataFrame:
    """Links ``a, b`` between members of a list: of those that a task finds, as many as connect all
    components that they link. Sets come with the members, and are compared block by block."""

    def run(batches):
        forest = crowds.Forest()
        for batch in batches:
            a, b = [], []
            for x, y, same in zip(batch.column("here"), batch.column("there"),
                                  batch.column("same").to_pylist()):
                here, there = _block(x), _block(y)
                pairs = [(k, left) for k, left, _ in _candidates(here, there, same) if len(left)]
                if not pairs:
                    continue
                i = np.repeat([k for k, _ in pairs], [len(left) for _, left in pairs])
                j = np.concatenate([left for _, left in pairs])
                sets = [[np.frombuffer(t.as_py(), np.uint64)
                         for t in crowds.read_block(cell, "tokens")] for cell in (x, y)]
                both = crowds.common_tokens(*sets, i, j)
                real = 100 * both >= PER_CENT * (here[2][i] + there[2][j] - both)
                i, j = i[real], j[real]
                first = crowds.first_of_each(i, there[1][j])
                i, j = i[first], j[first]
                new = forest.connecting(here[1][i], there[1][j])
                a.append(here[0][i[new]])
                b.append(there[0][j[new]])
            yield crowds.pair_batch(a, b)

    return crowds.block_pairs(members, ["node", "comp", "n", "sig", "tokens"]) \
        .mapInArrow(run, "a long, b long").distinct()


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PER_CENT * (len(a) + len(b) - both)


def sets_of(wanted: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """``node, tokens`` of the wanted nodes, worked out again from their texts."""
    keys = nodes.join(wanted, "node").select(F.coalesce("key", F.lit(NO_KEY)).alias("key"))
    return stored(needed_sets(rows, keys.distinct(), SHINGLE_WORDS)
                  .join(wanted, "node", "left_semi").dropDuplicates(["node"]), "sets")


def confirmed(pairs: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs whose full sets link."""
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), nodes, rows)

    def confirm(batches):
        for batch in batches:
            keep = [linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64))
                    for x, y in zip(batch.column("x"), batch.column("y"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b") \
        .select("a", "b", "x", "y").mapInArrow(confirm, "a long, b long")


def with_one_other(lists: DataFrame, turn: int) -> DataFrame:
    """Pairs ``a, b``: each node with the one that it has in common with most of its lists.

    Of each list, the node that comes first in an order of the turn stands for all; nodes of its
    component are left out.
    """
    order = F.xxhash64("node", F.lit(turn))
    first = lists.groupBy("list").agg(F.min(F.struct(order.alias("o"), "node", "comp")).alias("f"))
    first = first.select("list", F.col("f.node").alias("other"), F.col("f.comp").alias("of"))
    met = lists.join(first, "list").where(F.col("comp") != F.col("of")) \
        .groupBy("node", "other").agg(F.count(F.lit(1)).alias("met"))
    best = met.groupBy("node").agg(F.max(F.struct("met", "other")).alias("best"))
    return best.select(F.least("node", "best.other").alias("a"),
                       F.greatest("node", "best.other").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the id, ``n_shingles``, ``component_id`` and ``kept`` (id = component_id).

    Equal sets are one node. Every node is posted under the rarest PREFIX of the coordinate-value
    pairs of its MinHash signature; nodes that meet in a posting list are compared coordinate by
    coordinate, and pairs with at least MATCHES common ones are confirmed on their full sets. A
    link has that many with a probability above 1 - 2e-9.

    Links inside a component tell nothing new. So in each of a few turns, a node is compared with
    one other only, the one it meets most often among those that stand for its lists; lists whose
    nodes are all in one component by then are done. What is left is compared block by block, where
    a task takes two blocks of a list and gives links only. So a large group of near copies does
    not give all its pairs as rows.

    Null texts and texts without words have no shingles and are linked with nothing. Repeated rows
    get equal rows; a text whose id is null is linked like others, but its id is no component's
    smallest, alone it has a null component, and its ``kept`` is null. Very long texts have one
    signature like others. An empty table gives an empty result; other columns are not read. Sets
    are compared by hashes of 64 bits.
    """
    rows = docs.select(docs[id_col].cast("long").alias("key"),
                       docs[text_col].cast("string").alias("text"))
    described = stored(describe(rows), "described")
    # one document of each node stands for it
    nodes = stored(described.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("key").alias("key"), F.first("n").alias("n"), F.first("sig").alias("sig"),
        F.first("bytes").alias("bytes")), "nodes")
    sketch = count_pairs(nodes)
    posted = postings(nodes, sketch).withColumn("comp", F.col("node"))
    edges, labels = None, None
    for turn in range(ROUNDS + 1):
        if labels is not None:
            posted = lists.join(labels.withColumnRenamed("comp", "of"), "node", "left") \
                .withColumn("comp", F.coalesce("of", "node")).drop("of")
        several = posted.groupBy("list").agg(F.min("comp").alias("low"), F.max("comp").alias("up")) \
            .where("low <> up").select("list")
        lists = stored(posted.join(several, "list", "left_semi")
                       .select("list", "node", "comp"), "lists")
        if turn == ROUNDS or (turn > 0 and found.isEmpty()):
            break
        pairs = stored(matching(with_one_other(lists, turn), nodes), "pairs")
        found = stored(confirmed(pairs, nodes, rows), "links")
        edges = found if edges is None else edges.union(found)
        labels = components(edges)
    near = near_in_lists(lists.join(nodes.select("node", "n", "bytes"), "node"))
    members = stored(stored(near, "near").join(lists, ["list", "node"])
                     .join(nodes.select("node", "n", "sig"), "node"), "members")
    met = stored(met_in_lists(members, sketch), "met")
    members = met.join(members, ["list", "node"]) \
        .join(sets_of(met.select("node").distinct(), nodes, rows), "node")
    labels = components(edges.union(stored(links_in_lists(members), "links")))
    placed = nodes.select("node", "key").join(labels, "node", "left") \
        .withColumn("comp", F.coalesce("comp", "node"))
    names = placed.groupBy("comp").agg(F.min("key").alias("component_id"))
    of_nodes = stored(placed.join(names, "comp").select("node", "component_id"), "classes")
    result = described.select("key", "n", "node").join(of_nodes, "node", "left").select(
        F.col("key").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id"))
        .alias("component_id"))
    return result.withColumn("kept", F.col(id_col) == F.col("component_id"))
