"""Near duplicates, fingerprints and exact search."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from fairstream.llm import crowds, fingerprints, jaccard_join, metric_tree
from fairstream.llm.components import components
from fairstream.llm.shingles import Shingler
from tests.llm.conftest import EDGES, prose

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = SPLIT.findall(lowered)
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def brute_components(rows):
    """(doc_id, set size, smallest linked id) by comparing all pairs."""
    sets = [shingle_set(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(((r[0], len(s), r[0] if not s else least.get(root(i)))
                   for i, (r, s) in enumerate(zip(rows, sets))), key=str)


def edited(text, seed, edits):
    words, rng = text.split(), random.Random(seed)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(words)


def found_components(df):
    return sorted((tuple(r) for r in jaccard_join.near_duplicates(df).collect()), key=str)


def test_shingle_hashes_stand_for_shingles():
    texts = [t or "" for _, t, *_ in EDGES] + [
        "A b  C\td e F", "a B c d E f", "a b", "a b c", "c b a", prose(3, 300)]
    found = Shingler().sets([t.encode() for t in texts])
    plain = [shingle_set(t) for t in texts]
    assert [len(f) for f in found] == [len(p) for p in plain]
    for (f, p), (g, q) in itertools.combinations(zip(found, plain), 2):
        assert len(np.intersect1d(f, g)) == len(p & q)


@pytest.mark.parametrize("crowd", [3, 16])
def test_components_equal_brute_force(docs, monkeypatch, crowd):
    monkeypatch.setattr(jaccard_join, "CROWD", crowd)
    rows, rng = [], random.Random(5)
    passage = prose(77, 60)
    for group in range(12):
        base = prose(group, rng.randrange(5, 120))
        for copy in range(rng.randrange(1, 9)):
            rows.append((rng.randrange(10 ** 6), edited(base, copy, rng.randrange(0, 5))))
    rows += [(10 ** 6 + i, passage + " " + prose(500 + i, 100)) for i in range(12)]
    rows += [(2 * 10 ** 6 + i, edited(passage, i, i % 3).upper()) for i in range(30)]
    rows += [(3 * 10 ** 6 + i, "The same few words") for i in range(5)]
    rng.shuffle(rows)
    assert found_components(docs(*rows)) == brute_components(rows)


def test_chains_of_links_are_one_component(docs):
    words = prose(1, 400).split()
    rows = [(i, " ".join(words[5 * i:5 * i + 200])) for i in range(40)]
    want = brute_components(rows)
    assert {c for _, _, c in want} == {0}
    assert found_components(docs(*rows)) == want


@pytest.mark.parametrize("block", [7, 1024])
def test_a_crowd_near_the_threshold(docs, monkeypatch, block):
    monkeypatch.setattr(crowds, "LIST_BLOCK", block)
    base = prose(8, 120)
    rows = [(i, edited(base, i, 2 + i % 3)) for i in range(90)]
    want = brute_components(rows)
    assert 5 < len({c for _, _, c in want}) < 90
    assert found_components(docs(*rows)) == want


def test_prefix_bits_lose_no_link():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 40, 300, 3000):
        tokens = rng.integers(0, 1 << 63, n + n // 3, np.uint64)
        some, other = tokens[:n], tokens[n // 9:n // 9 + n]
        both = len(np.intersect1d(some, other))
        assert 100 * both >= 75 * (2 * n - both)
        bits = [np.frombuffer(jaccard_join.prefix_bits(s), np.uint8).reshape(2, -1)
                for s in (some, other)]
        assert (bits[0] & bits[1]).any(axis=1).all()
    apart = [np.frombuffer(jaccard_join.prefix_bits(np.array([v], np.uint64)), np.uint8)
             for v in (1, 2)]
    assert not (apart[0] & apart[1]).any()


def both_bits(sets):
    return jaccard_join.Bits(pa.array(
        [jaccard_join.prefix_bits(s) + jaccard_join.parity_bits(s) for s in sets], pa.binary()))


def test_bits_reject_sets_that_share_too_little_and_no_linked_ones():
    rng = np.random.default_rng(4)
    for n in (1, 7, 40, 340, 3300, 30_000):
        tokens = rng.integers(0, 1 << 63, 3 * n, np.uint64)
        some = tokens[:n]
        # a seventh of n apart on either side is the most that links; of n and 3/4 n one holds the other
        others = [some, tokens[n // 7:n // 7 + n], some[:-(-3 * n // 4)], tokens[n // 2:n // 2 + n]]
        found = jaccard_join.may_link(
            both_bits([some]), both_bits(others), np.zeros(4, int), np.arange(4),
            np.array([n + len(o) for o in others]))
        assert found[:3].all()
        assert n < 7 or n > 10_000 or not found[3]


def test_crowds_of_long_sets_leave_no_members_to_fetch(docs, monkeypatch):
    met, find = [], jaccard_join.met_in_lists
    monkeypatch.setattr(jaccard_join, "met_in_lists", lambda m: met.append(find(m)) or met[-1])
    passage = prose(31, 500)
    rows = [(i, f"{passage} {prose(600 + i, 500)}") for i in range(30)]
    assert found_components(docs(*rows)) == brute_components(rows)
    assert met[0].count() == 0


def test_duplicates_of_edges(edge_docs, docs):
    assert found_components(edge_docs) == brute_components(EDGES)
    assert found_components(docs()) == []
    assert found_components(docs((1, None), (None, "a b"))) == [(1, 0, 1), (None, 1, None)]


def test_prefix_length_loses_no_pair():
    for n in range(1, 400):
        common = -(-75 * n // 100)
        assert jaccard_join.prefix_length(n) == n - common + 1


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(-60, 60), rng.randrange(-60, 60)) for _ in range(50)]
    edges += [(i, i + 1) for i in range(100, 160)]
    parent = {n: n for e in edges for n in e}
    for _ in range(len(parent)):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = {r.node: r.comp for r in components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == parent


# fingerprints

def brute_fingerprint_rows(rows):
    ordered = sorted({i for i, *_ in rows if i is not None}, reverse=True)
    if any(i is None for i, *_ in rows):
        ordered.append(None)
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, t or "")
    out = []
    for i, t, *_ in rows:
        t = t or ""
        after = texts[ordered[(ordered.index(i) + 1) % len(ordered)]]
        half = len(t) // 2
        new = t[:len(t) - half] + after[:half]
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest()))
    return sorted(out, key=str)


def test_edited_texts(edge_docs):
    found = fingerprints.fingerprints(edge_docs).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=str) \
        == brute_fingerprint_rows(EDGES)
    by_id = {r.doc_id: r for r in found}
    assert by_id[5].fingerprint == by_id[6].fingerprint
    assert by_id[6].near_next == 1.0 and by_id[1].fingerprint == ""
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)


def test_likeness_estimates_generalised_jaccard(docs):
    rows = []
    for i in range(60):
        base = prose(i, 120).split()
        keep = [120, 90, 60, 30][i % 4]
        rows.append((2 * i + 1, " ".join(base)))
        rows.append((2 * i, " ".join(base[:keep] + prose(900 + i, 120 - keep).split()) ))
    texts = dict(rows)
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs(*rows)).collect()}

    def jaccard(a, b):
        from collections import Counter
        a, b = Counter(a.split()), Counter(b.split())
        return sum((a & b).values()) / sum((a | b).values())

    near = [(got[2 * i + 1].near_next, jaccard(texts[2 * i + 1], texts[2 * i])) for i in range(60)]
    assert abs(np.mean([a - b for a, b in near])) < 0.04
    assert np.sqrt(np.mean([(a - b) ** 2 for a, b in near])) < 0.12


def test_following_goes_down_and_round(spark):
    ids = [5, -3, 100, 7, 7, 42]
    got = {r.key: r.next for r in fingerprints.following(
        spark.createDataFrame([(i,) for i in ids], "key long")).collect()}
    assert got == {100: 42, 42: 7, 7: 5, 5: -3, -3: 100}


def test_fingerprints_of_one_or_none(docs):
    assert fingerprints.fingerprints(docs()).collect() == []
    row, = fingerprints.fingerprints(docs((1, "ab cd"))).collect()
    assert row.near_next == 1.0 and row.n_chars == 5
    assert row.edited_sha256 == hashlib.sha256(b"ab ab").hexdigest()


def test_fingerprints_run_no_python(docs):
    plan = fingerprints.fingerprints(docs((1, "a"), (2, "b")))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# exact search

VECTORS = "vec_id long, embedding array<float>, label int, id string, v string, x string, n string"


def brute_top(rows, every=50, k=5):
    valid = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        valid[i] = np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)
    out = []
    for q in valid:
        if q % every == 0:
            scores = sorted((-int(valid[q] @ v), i) for i, v in valid.items()
                            if i != q and len(v) == len(valid[q]))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def searched(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, None, *"abcd") for i, v in rows], VECTORS).repartition(4)
    return sorted(tuple(r) for r in metric_tree.top_inner_products(df, **kw).collect())


@pytest.mark.parametrize("page, tree", [(256, 8192), (4, 50)])
def test_top_products_equal_brute_force(spark, monkeypatch, page, tree):
    monkeypatch.setattr(metric_tree, "PAGE", page)
    monkeypatch.setattr(metric_tree, "TREE_ROWS", tree)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=6) * (1 + i % 3)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[50][1]) for i in range(40)]              # one very common vector
    rows += [(2000 + i, [0.0] * 6) for i in range(10)]                # ties at zero
    rows += [(3000, None), (3050, [1.0, None] + [0.0] * 4), (3100, [float("nan")] * 6),
             (3150, [float("inf")] + [0.0] * 5), (3200, [1.0, 2.0]), (None, [1.0] * 6),
             (0, rows[0][1])]
    assert searched(spark, rows) == brute_top(rows)


def test_few_vectors(spark):
    assert searched(spark, []) == []
    assert searched(spark, [(50, [1.0])]) == []
    assert searched(spark, [(50, [1.0]), (3, [2.0])]) == [(50, 1, 3, 256 * 512)]


def test_bounds_save_products():
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(40, 8)) * 4000
    points = (centers[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 8)) * 50).astype(np.int64)
    tree, seen = metric_tree.MTree(points), [0]
    for q in range(0, 6000, 300):
        got = tree.search(points[q], [[i] for i in range(6000)], q, 5, seen)
        scores = points @ points[q]
        assert got == [(-s, i) for s, i in sorted((-int(scores[i]), i) for i in range(6000)
                                                  if i != q)[:5]]
    assert seen[0] < 20 * 6000 / 3
