"""Near-duplicate documents: a Jaccard join by prefixes under several global orders."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairstream.llm import crowds
from fairstream.llm.common import stored, texts
from fairstream.llm.components import components
from fairstream.llm.shingles import SHINGLE_WORDS, Shingler, grouped, mix

#: Sets link when PER_CENT is reached: 100 * intersection >= 75 * union.
PER_CENT = 75
#: Counters of the frequency sketch, and of one row of it.
COUNTERS, BLOCK = 1 << 20, 1 << 12
#: Seeds of the further global orders, by which candidates are filtered, the bits that hold the
#: prefix of a set under one of them, and the least and most that hold the parities of its tokens.
ORDERS = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
PREFIX_BITS, PARITY_BITS = 256, (256, 1 << 14)
#: Rows of a batch whose texts a task holds at once.
TEXTS_AT_ONCE = 512
#: Lists by which a set tells where it meets another, and the pairs whose lists are compared at once.
NAMED, AT_ONCE = 8, 1 << 16
#: Postings that a task gathers before it passes them on, and documents that share a token within
#: them from which on only one of them stands for all.
GATHERED, CROWD = 1 << 18, 16
#: Bits of the filter that keeps sets without candidates from being shuffled, at most.
MOST_FILTER_BITS = 1 << 28
#: What a posting says of its set: number, id that stands for it, component, size, place.
FIELDS = ("node", "own", "comp", "size", "pos")
#: What a member of a list brings to the comparison of all that is left.
MEMBER = ["node", "comp", "size", "pos", "bits", "names"]
#: Stands for a null id.
NO_KEY = -(1 << 63)


def prefix_length(n: int) -> int:
    """Two linked sets share one of so many first tokens, under any order of all tokens."""
    return n - (PER_CENT * n + 99) // 100 + 1


def node_number(tokens: np.ndarray) -> int:
    """The number of a set, the same for equal sets."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little",
                          signed=True)


def prefix_bits(tokens: np.ndarray) -> bytes:
    """The prefix of a set under each of the further orders, each as PREFIX_BITS bits.

    Sets whose bits of an order have none in common share no prefix token under it.
    """
    p = prefix_length(len(tokens))
    out = np.zeros((len(ORDERS), PREFIX_BITS), np.uint8)
    for bits, seed in zip(out, ORDERS):
        first = np.partition(mix(tokens, seed), p - 1)[:p]
        bits[(mix(first, 5) % np.uint64(PREFIX_BITS)).astype(np.int64)] = 1
    return np.packbits(out).tobytes()


def parity_bits(tokens: np.ndarray) -> bytes:
    """For each of some places whether an odd number of tokens falls there.

    Tokens that two sets share leave no difference, so their bits differ in at most as many places
    as the sets have tokens that are in one of them only. There are about two to four places for
    each token, a power of two, so those of a larger set can be folded to those of a smaller one.
    """
    least, most = PARITY_BITS
    n = min(most, max(least, 1 << (2 * len(tokens) - 1).bit_length()))
    places = (mix(tokens, 7) % np.uint64(n)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=n) & 1).tobytes()


class Bits:
    """What a column of ``prefix_bits`` and ``parity_bits``, joined, tells of its sets."""

    def __init__(self, column):
        upto = len(ORDERS) * PREFIX_BITS // 8
        every = column.to_pylist()
        self.prefixes = np.frombuffer(b"".join(x[:upto] for x in every), "<u8") \
            .reshape(len(every), len(ORDERS), PREFIX_BITS // 64)
        self._parities = [x[upto:] for x in every]
        self.places = np.array([8 * len(x) for x in self._parities], np.int64)

    def folded(self, rows: np.ndarray, places: int) -> np.ndarray:
        """The parities of some rows, which have so many places or more, in so many places."""
        out = np.zeros((len(rows), places // 64), np.uint64)
        for n in np.unique(self.places[rows]):
            some = np.flatnonzero(self.places[rows] == n)
            raw = b"".join(self._parities[k] for k in rows[some])
            out[some] = np.bitwise_xor.reduce(
                np.frombuffer(raw, "<u8").reshape(len(some), -1, places // 64), axis=1)
        return out


def may_link(x: Bits, y: Bits, i: np.ndarray, j: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the sets ``x[i]`` and ``y[j]``, of so many tokens together, may link by their bits.

    They share bits of the prefixes under every further order. Of two linked sets, no more than
    (100 - PER_CENT) / (100 + PER_CENT) of both sizes together is in one of them only.
    """
    may = np.zeros(len(i), bool)
    for low in range(0, len(i), AT_ONCE):
        part = slice(low, low + AT_ONCE)
        may[part] = (x.prefixes[i[part]] & y.prefixes[j[part]]).any(axis=2).all(axis=1)
    left = np.flatnonzero(may)
    places = np.minimum(x.places[i[left]], y.places[j[left]])
    for n in np.unique(places):
        of_n = left[places == n]
        rows, a = np.unique(i[of_n], return_inverse=True)
        columns, b = np.unique(j[of_n], return_inverse=True)
        ours, theirs = x.folded(rows, int(n)), y.folded(columns, int(n))
        step = max(1, 1024 * AT_ONCE // int(n))
        for low in range(0, len(of_n), step):
            part = slice(low, low + step)
            apart = np.bitwise_count(ours[a[part]] ^ theirs[b[part]]).sum(axis=1, dtype=np.int64)
            may[of_n[part]] = (100 + PER_CENT) * apart <= (100 - PER_CENT) * sizes[of_n[part]]
    return may


def _sets(batch, shingler: Shingler) -> Iterator[tuple[int, np.ndarray]]:
    for low in range(0, batch.num_rows, TEXTS_AT_ONCE):
        for first, data in grouped(texts(batch.slice(low, TEXTS_AT_ONCE))):
            for i, tokens in enumerate(shingler.sets(data)):
                yield low + first + i, tokens


def describe(rows: DataFrame) -> DataFrame:
    """From ``key, text``: per row ``key, n, node, bits``, and with a ``block`` the sketch's counters.

    ``bits`` marks the prefix tokens under the further orders, and the parities of all tokens. The
    sketch counts tokens by their first bits; it has a fixed size however many there are.
    """

    def run(batches):
        shingler, counters, waiting = Shingler(), np.zeros(COUNTERS, np.int64), []
        shift = np.uint64(64 - COUNTERS.bit_length() + 1)

        def count():
            if waiting:
                found = np.concatenate(waiting) >> shift
                counters[:] += np.bincount(found.astype(np.int64), minlength=COUNTERS)
                waiting.clear()

        def row(keys, sizes, nodes, bits, blocks, counts):
            return pa.RecordBatch.from_arrays(
                [keys, pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(bits, pa.binary()), pa.array(blocks, pa.int32()),
                 pa.array(counts, pa.binary())],
                ["key", "n", "node", "bits", "block", "counts"])

        held = 0
        for batch in batches:
            sizes, nodes, bits = [], [], []
            for _, tokens in _sets(batch, shingler):
                sizes.append(len(tokens))
                nodes.append(node_number(tokens) if len(tokens) else None)
                bits.append(prefix_bits(tokens) + parity_bits(tokens) if len(tokens) else None)
                waiting.append(tokens)
                held += len(tokens)
                if held >= COUNTERS:
                    count()
                    held = 0
            none = [None] * len(sizes)
            yield row(batch.column("key"), sizes, nodes, bits, none, none)
        count()
        if counters.any():
            blocks = counters.reshape(-1, BLOCK)
            none = [None] * len(blocks)
            yield row(pa.array(none, pa.int64()), none, none, none, list(range(len(blocks))),
                      [np.minimum(b, 2 ** 32 - 1).astype("<u4").tobytes() for b in blocks])

    return rows.mapInArrow(
        run, "key long, n long, node long, bits binary, block int, counts binary")


def collect_sketch(described: DataFrame) -> np.ndarray:
    """The counters of all tasks, added up block by block; the driver gets the fixed-size sums."""

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

    blocks = described.where(F.col("block").isNotNull()).select("block", "counts") \
        .repartition("block").mapInArrow(add, "block int, counts binary")
    sketch = np.zeros(COUNTERS, np.uint32)
    for block, counts in blocks.collect():
        sketch[block * BLOCK:(block + 1) * BLOCK] = np.frombuffer(counts, "<u4")
    return sketch


def _sorted(t: np.ndarray, d: np.ndarray, q: np.ndarray):
    """Postings by token and node, each once, and which of them is its token's first."""
    order = np.lexsort((d, t))
    t, d, q = t[order], d[order], q[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (d[1:] != d[:-1])
    t, d, q = t[new], d[new], q[new]
    first = np.ones(len(t), bool)
    first[1:] = t[1:] != t[:-1]
    return t, d, q, first


def shared_postings(rows: DataFrame, sketch: np.ndarray, ranges: int) -> DataFrame:
    """``token, node, pos`` for the prefix tokens that two different sets share.

    The first global order goes by a token's counter, rare before frequent, and then by its hash;
    ``pos`` is a token's place in it within the set. A task passes its postings on as one blob for each range of tokens. Where many of its sets share a
    token, these are passed on at random places, as it is known already that they are shared, and
    only one of them goes to the token's range; so a token of very many sets is no large group.
    """
    shared = rows.sparkSession.sparkContext.broadcast(sketch)
    bits = ranges.bit_length() - 1

    def gather(batches):
        shingler, counters = Shingler(), shared.value
        shift = np.uint64(64 - COUNTERS.bit_length() + 1)
        tokens, nodes, places, held, at = [], [], [], 0, 0

        def blobs(r, t, d, q, sure):
            order = np.argsort(r, kind="stable")
            r, t, d, q = r[order], t[order], d[order], q[order]
            cuts = np.flatnonzero(np.diff(r)) + 1
            firsts = np.concatenate(([0], cuts)) if len(r) else cuts
            parts = zip(*(np.split(x, cuts) for x in (t, d, q))) if len(r) else ()
            data = [b"".join(x.tobytes() for x in part) for part in parts]
            return pa.RecordBatch.from_arrays(
                [pa.array(r[firsts], pa.int32()), pa.array([sure] * len(data), pa.bool_()),
                 pa.array(data, pa.binary())], ["r", "sure", "data"])

        def pass_on():
            nonlocal tokens, nodes, places, held, at
            t, d, q, first = _sorted(*(np.concatenate(x) for x in (tokens, nodes, places)))
            tokens, nodes, places, held = [], [], [], 0
            of = np.cumsum(first) - 1
            crowded = np.bincount(of)[of] >= CROWD
            own = ~crowded | first
            yield blobs((t[own] >> np.uint64(64 - bits)).astype(np.int64), t[own], d[own], q[own],
                        False)
            if crowded.any():
                t, d, q = t[crowded], d[crowded], q[crowded]
                anywhere = (np.arange(len(t)) // 1024 + at) % ranges
                at += len(t) // 1024 + 1
                yield blobs(anywhere, t, d, q, True)

        seen: set[int] = set()
        for batch in batches:
            for _, some in _sets(batch, shingler):
                if not len(some):
                    continue
                node = node_number(some)
                if node in seen:
                    continue
                seen.add(node)
                order = np.lexsort((some, counters[(some >> shift).astype(np.int64)]))
                some = some[order[:prefix_length(len(some))]]
                tokens.append(some)
                nodes.append(np.full(len(some), node, np.int64))
                places.append(np.arange(len(some), dtype=np.int32))
                held += len(some)
                if held >= GATHERED:
                    yield from pass_on()
                    seen.clear()
        if held:
            yield from pass_on()

    def meet(batches):
        def postings(t, d, q):
            return pa.RecordBatch.from_arrays(
                [pa.array(t.astype(np.int64), pa.int64()), pa.array(d, pa.int64()),
                 pa.array(q, pa.int32())], ["token", "node", "pos"])

        def shared_of(parts):
            t, d, q, first = _sorted(*(np.concatenate(x) for x in zip(*parts)))
            of = np.cumsum(first) - 1
            several = np.bincount(of)[of] > 1 if len(of) else first
            return postings(t[several], d[several], q[several])

        now, parts = None, []
        for batch in batches:
            for r, sure, data in zip(batch.column("r").to_pylist(),
                                     batch.column("sure").to_pylist(), batch.column("data")):
                raw = data.as_py()
                n = len(raw) // 20
                part = (np.frombuffer(raw, np.uint64, n), np.frombuffer(raw, np.int64, n, 8 * n),
                        np.frombuffer(raw, np.int32, n, 16 * n))
                if sure:
                    yield postings(*part)
                    continue
                if r != now and parts:
                    yield shared_of(parts)
                    parts = []
                now = r
                parts.append(part)
        if parts:
            yield shared_of(parts)

    return rows.mapInArrow(gather, "r int, sure boolean, data binary") \
        .repartition("r").sortWithinPartitions("r") \
        .mapInArrow(meet, "token long, node long, pos int")


def _filter_bits(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of the keys, of a size that follows their number up to a fixed bound."""
    bits = min(MOST_FILTER_BITS, 1 << max(16, (16 * keys.count()).bit_length()))

    def build(batches):
        own = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for place in _places(batch.column("key").to_numpy(zero_copy_only=False), bits):
                np.bitwise_or.at(own, place >> 3, np.uint8(1) << (place & 7).astype(np.uint8))
        for i in range(0, len(own), 1 << 13):
            if own[i:i + (1 << 13)].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int64()), pa.array([own[i:i + (1 << 13)].tobytes()],
                                                         pa.binary())], ["at", "part"])

    def unite(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column("at").to_pylist(), batch.column("part")):
                some = np.frombuffer(part.as_py(), np.uint8)
                sums[i] = sums[i] | some if i in sums else some
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()),
             pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["at", "part"])

    parts = keys.mapInArrow(build, "at long, part binary").repartition("at") \
        .mapInArrow(unite, "at long, part binary")
    filter_ = np.zeros(bits // 8, np.uint8)
    for i, part in parts.collect():
        filter_[i:i + len(part)] = np.frombuffer(part, np.uint8)
    return filter_


def _places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(mix(keys.astype(np.int64).view(np.uint64), seed) & np.uint64(bits - 1))
            .astype(np.int64) for seed in (11, 12, 13)]


def needed_sets(rows: DataFrame, keys: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``node, tokens`` of the documents with the given keys, tokens as bytes of sorted numbers.

    The filter of the keys may let a few others pass, which meet no pair later.
    """
    shared = rows.sparkSession.sparkContext.broadcast(_filter_bits(keys))

    def run(batches):
        shingler, filter_ = Shingler(words), shared.value
        bits = 8 * len(filter_)
        for batch in batches:
            own = batch.column("key").fill_null(NO_KEY).to_numpy(zero_copy_only=False)
            wanted = np.ones(len(own), bool)
            for place in _places(own, bits):
                wanted &= (filter_[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
            found, data, held = [], [], 0
            for _, tokens in _sets(batch.filter(pa.array(wanted)), shingler):
                if not len(tokens):
                    continue
                found.append(node_number(tokens))
                data.append(tokens.tobytes())
                held += len(tokens)
                if held >= GATHERED:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found, pa.int64()), pa.array(data, pa.binary())],
                        ["node", "tokens"])
                    found, data, held = [], [], 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int64()), pa.array(data, pa.binary())], ["node", "tokens"])

    return rows.mapInArrow(run, "node long, tokens binary")


def likely_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that may link by the bits of ``nodes(node, size, bits)``."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    some = stored(nodes.select("node", "size", "bits").join(ends, "node", "left_semi"), "ends")

    def keep(batches):
        for batch in batches:
            row = np.arange(batch.num_rows)
            may = may_link(Bits(batch.column("x")), Bits(batch.column("y")), row, row,
                           batch.column("sizes").to_numpy(zero_copy_only=False))
            yield batch.select(["a", "b", "own_a", "own_b"]).filter(pa.array(may))

    return pairs.join(some.toDF("a", "size_a", "x"), "a").join(some.toDF("b", "size_b", "y"), "b") \
        .select("a", "b", "own_a", "own_b", "x", "y",
                (F.col("size_a") + F.col("size_b")).alias("sizes")) \
        .mapInArrow(keep, "a long, b long, own_a long, own_b long")


def shares_prefixes(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets share a prefix token under each of the further orders."""
    for seed in ORDERS:
        first = [np.partition(m, p - 1)[:p] for m, p in
                 ((mix(x, seed), prefix_length(len(x))) for x in (a, b))]
        if not len(np.intersect1d(*first)):
            return False
    return True


def links(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets link, by sizes, prefixes, and then their intersection."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < PER_CENT * large or not shares_prefixes(a, b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PER_CENT * (len(a) + len(b) - both)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of nodes whose sets link."""

    def run(batches):
        for batch in batches:
            keep = [links(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64))
                    for x, y in zip(batch.column("x"), batch.column("y"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], ["a", "b"]) \
                .filter(pa.array(keep, pa.bool_()))

    return pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b") \
        .select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def with_names(lists: DataFrame) -> DataFrame:
    """``lists`` with ``names``: the first NAMED lists of each node in the first global order."""
    first = lists.groupBy("node").agg(F.slice(
        F.array_sort(F.collect_list(F.struct("pos", "token"))), 1, NAMED).alias("first"))
    padded = F.concat(F.col("first.token"), F.array_repeat(F.lit(NO_KEY), NAMED))
    return lists.join(first.select("node", F.slice(padded, 1, NAMED).alias("names")), "node")


def _fitting(x, y, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the members of two blocks of a list that are of different components and fit by
    sizes and places."""
    comp, size, pos = ([crowds.numbers(cell, c) for cell in (x, y)]
                       for c in ("comp", "size", "pos"))
    rest = np.minimum((size[0] - pos[0])[:, None], (size[1] - pos[1])[None, :])
    fit = (100 + PER_CENT) * rest >= PER_CENT * (size[0][:, None] + size[1][None, :])
    fit &= comp[0][:, None] != comp[1][None, :]
    return np.nonzero(np.triu(fit, 1) if same else fit)


def _meeting(token: int, x, y, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the members of two blocks of a list that are candidates, and are so here.

    They fit and may link by their bits. Two sets that name a list in common meet in the first such
    list only, others in each list that they share.
    """
    i, j = _fitting(x, y, same)
    if not len(i):
        return i, j
    bits = [Bits(crowds.read_block(cell, "bits")) for cell in (x, y)]
    names = [crowds.read_block(cell, "names").flatten().to_numpy(zero_copy_only=False)
             .reshape(-1, NAMED) for cell in (x, y)]
    sizes = [crowds.numbers(cell, "size") for cell in (x, y)]
    kept = []
    for low in range(0, len(i), AT_ONCE):
        a, b = i[low:low + AT_ONCE], j[low:low + AT_ONCE]
        keep = may_link(*bits, a, b, sizes[0][a] + sizes[1][b])
        ours, theirs = names[0][a], names[1][b]
        common = np.stack([(theirs == ours[:, [c]]).any(axis=1) for c in range(NAMED)], axis=1)
        common &= ours != NO_KEY
        first = ours[np.arange(len(a)), common.argmax(axis=1)]
        kept.append(keep & (~common.any(axis=1) | (first == token)))
    kept = np.concatenate(kept)
    return i[kept], j[kept]


def _over_blocks(members: DataFrame, columns: list[str], pick):
    """The blocks of the members' lists, two by two, and a reader of the picked pairs in them."""

    def read(batch):
        for token, x, y, same in zip(batch.column("list").to_pylist(), batch.column("here"),
                                     batch.column("there"), batch.column("same").to_pylist()):
            i, j = pick(token, x, y, same)
            if len(i):
                yield token, x, y, i, j

    named = members.withColumnRenamed("token", "list")
    return crowds.block_pairs(named, columns), read


def _met(members: DataFrame, columns: list[str], pick) -> DataFrame:
    """``token, node`` of the members that are in a picked pair of a list."""
    blocks, read = _over_blocks(members, columns, pick)

    def run(batches):
        for batch in batches:
            tokens, nodes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for token, x, y, i, j in read(batch):
                found = np.unique(np.concatenate(
                    [crowds.numbers(x, "node")[np.unique(i)],
                     crowds.numbers(y, "node")[np.unique(j)]]))
                nodes.append(found)
                tokens.append(np.full(len(found), token))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(v)) for v in (tokens, nodes)], ["token", "node"])

    return blocks.mapInArrow(run, "token long, node long").distinct()


def near_in_lists(members: DataFrame) -> DataFrame:
    """``token, node`` of the members that some other fits by component, size and place."""
    return _met(members, ["node", "comp", "size", "pos"],
                lambda token, x, y, same: _fitting(x, y, same))


def met_in_lists(members: DataFrame) -> DataFrame:
    """``token, node`` of the members that meet a candidate in a list."""
    return _met(members, MEMBER, _meeting)


def links_in_lists(members: DataFrame) -> DataFrame:
    """Links ``a, b`` between members of a list: of those that a task finds, as many as connect all
    components that they link. Sets come with the members; a task gives links only."""
    blocks, read = _over_blocks(members, [*MEMBER, "tokens"], _meeting)

    def run(batches):
        forest = crowds.Forest()
        for batch in batches:
            a, b = [], []
            for _, x, y, i, j in read(batch):
                sets = [[np.frombuffer(t.as_py(), np.uint64)
                         for t in crowds.read_block(cell, "tokens")] for cell in (x, y)]
                both = crowds.common_tokens(*sets, i, j)
                union = crowds.numbers(x, "size")[i] + crowds.numbers(y, "size")[j] - both
                real = 100 * both >= PER_CENT * union
                i, j = i[real], j[real]
                comps = [crowds.numbers(cell, "comp") for cell in (x, y)]
                first = crowds.first_of_each(i, comps[1][j])
                i, j = i[first], j[first]
                new = forest.connecting(comps[0][i], comps[1][j])
                a.append(crowds.numbers(x, "node")[i[new]])
                b.append(crowds.numbers(y, "node")[j[new]])
            yield crowds.pair_batch(a, b)

    return blocks.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the id, ``n_shingles`` and ``component_id``.

    Equal sets are one node. Sets that may link share a prefix token under every global order:
    lists of the sets with a token under the first order give the candidates. Places in it, the
    prefixes under further orders and a bound on what two sets do not share filter them, all before
    sets are fetched, and what is left is verified. Links inside a
    component tell nothing new, so tokens first compare their sets with one of them, then with
    another for each token. Lists that still hold different components are compared block by block:
    the filters travel as bits with the members, and a task gives links only. So neither large groups of near copies nor crowds
    just below the threshold give all their pairs as rows, while every link counts.

    Null texts and texts without words have no shingles and are linked with nothing. Repeated rows
    get equal rows; a text whose id is null is linked like others, but its id is no component's
    smallest, and alone it has a null component. An empty table gives an empty result. Sets and
    tokens are compared by hashes of 64 bits.
    """
    rows = docs.select(docs[id_col].cast("long").alias("key"),
                       docs[text_col].cast("string").alias("text"))
    described = stored(describe(rows), "described")
    of_docs = described.where(F.col("block").isNull()).select("key", "n", "node", "bits")
    total = of_docs.agg(F.sum("n")).first()[0] or 0
    ranges = 1 << min(16, max(10, (total >> 20).bit_length()))
    # one document of each node stands for it
    nodes = stored(of_docs.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("key").alias("key"), F.max("n").alias("size"), F.first("bits").alias("bits")), "nodes")
    own = nodes.select("node", F.coalesce("key", F.lit(NO_KEY)).alias("own"), "size")
    # dealt by node once, for both the distinct rows and the join
    postings = stored(shared_postings(rows, collect_sketch(described), ranges)
                      .repartition("node").distinct().join(own, "node"), "postings")

    def fitting(pairs: DataFrame) -> DataFrame:
        """Pairs of different components that may link, each once, smaller node first.

        At the first token that two sets share, no more can be common than what either has from
        there on; a link needs PER_CENT / (100 + PER_CENT) of both sizes together.
        """
        rest = F.least(F.col("size_a") - F.col("pos_a"), F.col("size_b") - F.col("pos_b"))
        need = PER_CENT * (F.col("size_a") + F.col("size_b"))
        ends = [F.struct(F.col(f"node_{x}").alias("node"), F.col(f"own_{x}").alias("own"))
                for x in "ab"]
        return pairs.where((100 + PER_CENT) * rest >= need).where("comp_a <> comp_b") \
            .select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")) \
            .select(F.col("a.node").alias("a"), F.col("b.node").alias("b"),
                    F.col("a.own").alias("own_a"), F.col("b.own").alias("own_b")).distinct()

    def member(name: str) -> DataFrame:
        return postings_now.select("token", *(F.col(c).alias(f"{c}_{name}")
                                              for c in FIELDS))

    postings_now = postings.withColumn("comp", F.col("node"))
    edges = done = None
    for turn in ("least", "any"):
        rank = F.col("node") if turn == "least" else F.xxhash64("node", "token")
        hubs = postings_now.groupBy("token").agg(
            F.min(F.struct(rank.alias("rank"), *FIELDS)).alias("hub"))
        hubs = hubs.select("token", *(F.col(f"hub.{c}").alias(f"{c}_b") for c in FIELDS))
        pairs = fitting(member("a").join(hubs, "token"))
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        if edges is None or not pairs.isEmpty():
            done = pairs.select("a", "b") if done is None else done.union(pairs.select("a", "b"))
            pairs = stored(likely_pairs(pairs, nodes), "likely")
            keys = pairs.select(F.explode(F.array("own_a", "own_b")).alias("key")).distinct()
            sets = stored(needed_sets(rows, keys), "sets")
            pairs = pairs.select("a", "b")
            found = stored(verified(pairs, sets), "links")
            edges = found if edges is None else edges.union(found)
            labels = components(edges)
        placed = postings.join(labels, "node", "left") \
            .withColumn("comp", F.coalesce("comp", "node"))
        mixed = placed.groupBy("token").agg(F.min("comp").alias("low"),
                                            F.max("comp").alias("high"),
                                            F.count(F.lit(1)).alias("sets")) \
            .where("low <> high and sets > 2").select("token")
        postings_now = stored(placed.join(mixed, "token", "left_semi"), "postings")
    left = postings_now.select("token", "node", "comp", "size", "pos")
    near = left.join(near_in_lists(left), ["token", "node"])
    lists = stored(with_names(stored(near, "near"))
                   .join(nodes.select("node", "bits"), "node"), "lists")
    met = stored(met_in_lists(lists), "met")
    keys = met.join(own, "node").select(F.col("own").alias("key")).distinct()
    sets = stored(needed_sets(rows, keys).join(met, "node", "left_semi")
                  .dropDuplicates(["node"]), "sets")
    members = lists.join(met, ["token", "node"]).join(sets, "node")
    labels = components(edges.union(stored(links_in_lists(members), "links")))
    placed = nodes.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    names = placed.groupBy("comp").agg(F.min("key").alias("component_id"))
    of_nodes = stored(placed.join(names, "comp").select("node", "component_id"), "classes")
    return of_docs.join(of_nodes, "node", "left").select(
        F.col("key").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id"))
        .alias("component_id"))
