"""Near duplicates by MinHash signatures."""

import itertools
import random

import numpy as np
import pytest

from fairstream.llm import crowds, minhash_join
from fairstream.llm.queries import op12_minhash_join
from tests.llm.conftest import EDGES, prose


def shingle_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute(rows):
    sets, parent = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 85 * len(a | b):
            parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    out = []
    for i, ((key, _), s) in enumerate(zip(rows, sets)):
        of = least.get(root(i)) if s else key
        out.append((key, len(s), of, None if key is None or of is None else key == of))
    return sorted(out, key=str)


def edited(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(words)


def found(df):
    return sorted(map(tuple, minhash_join.near_duplicates(df).collect()), key=str)


@pytest.mark.parametrize("rounds", [1, 3])
def test_equals_brute_force(docs, monkeypatch, rounds):
    monkeypatch.setattr(crowds, "LIST_BLOCK", 16)
    monkeypatch.setattr(minhash_join, "ROUNDS", rounds)
    rng, rows = random.Random(3), []
    for group in range(10):
        base = prose(group, rng.randrange(5, 120))
        rows += [(rng.randrange(10 ** 6), edited(base, rng, rng.randrange(4))) for _ in range(6)]
    crowd = prose(99, 100)  # copies near the threshold, most pairs of them below it
    rows += [(10 ** 6 + i, edited(crowd, rng, rng.randrange(1, 5))) for i in range(80)]
    rows += [(2 * 10 ** 6 + i, crowd + " " + prose(300 + i, 40)) for i in range(20)]
    rows += [(3 * 10 ** 6, None), (3 * 10 ** 6 + 1, ""), (3 * 10 ** 6 + 2, "one two"),
             (3 * 10 ** 6 + 3, "ONE  two"), (None, crowd.upper()), (None, "alone here now")]
    rows += rows[:3]
    assert found(docs(*rows)) == brute(rows)


def test_edges_and_empty_table(docs):
    rows = [r[:2] for r in EDGES]
    assert found(docs(*rows)) == brute(rows)
    assert found(docs(*rows).where("doc_id = 12345")) == []


def test_common_tokens():
    rng = np.random.default_rng(1)
    for n in (3, 60):
        sets = [[np.unique(rng.integers(0, 9000, rng.integers(1, 6000)).astype(np.uint64))
                 for _ in range(n)] for _ in range(2)]
        i, j = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n)))
        plain = [len(np.intersect1d(sets[0][a], sets[1][b])) for a, b in zip(i, j)]
        assert crowds.common_tokens(*sets, i, j).tolist() == plain


def test_linked_sets_share_a_list():
    """Signatures with MATCHES common coordinates share one of their first PREFIX pairs."""
    rng = np.random.default_rng(2)
    counters = rng.integers(0, 50, minhash_join.COUNTERS)
    for _ in range(200):
        a, b = rng.integers(0, 2 ** 32, (2, 1, minhash_join.COORDINATES)).astype(np.uint32)
        same = rng.permutation(minhash_join.COORDINATES)[:minhash_join.MATCHES]
        b[:, same] = a[:, same]
        first = []
        for x in (a, b):
            pairs = minhash_join.pairs_of(x)
            rank = minhash_join._ranks(pairs, counters)[0]
            first.append(set(pairs[0][np.argsort(rank)[:minhash_join.PREFIX]].tolist()))
        assert first[0] & first[1]


def test_query(spark, docs, tmp_path):
    rows = [(1, prose(1, 80)), (2, prose(1, 80) + " x"), (3, prose(2, 80)), (4, "")]
    docs(*rows).write.parquet(f"{tmp_path}/documents.parquet")
    result = op12_minhash_join(spark, str(tmp_path))
    assert result.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, result.collect())) == brute(rows)


def test_a_task_gives_no_more_links_than_connect():
    """A crowd of sets that all link gives links in its number, not in its square."""
    n = 300
    a, b = (x.astype(np.int64) for x in np.triu_indices(n, 1))
    forest = crowds.Forest()
    assert len(forest.connecting(a[:1000], b[:1000])) + len(forest.connecting(a[1000:], b[1000:])) \
        == n - 1
    assert not len(forest.connecting(b, a))
    # a task that begins anew loses no connection
    forest.MOST = 2
    assert forest.connecting(np.array([1, n]), np.array([n, n + 1])).tolist() == [0, 1]


def test_links_of_a_crowd_connect_it(spark):
    rng = np.random.default_rng(3)
    rows = []
    for node in range(40):
        tokens = np.arange(200, dtype=np.uint64) * np.uint64(7) + np.uint64(1)
        tokens[rng.integers(0, 200, 2)] += np.uint64(1)
        tokens = np.unique(tokens)
        rows.append((5, node, node, len(tokens),
                     minhash_join.signature(tokens).astype("<u4").tobytes(), tokens.tobytes()))
    members = spark.createDataFrame(
        rows, "list long, node long, comp long, n long, sig binary, tokens binary")
    found = minhash_join.links_in_lists(members).collect()
    assert len(found) == 39  # 780 pairs link
    assert len({x for r in found for x in (r["a"], r["b"])}) == 40
