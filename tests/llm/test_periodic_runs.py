"""Periodic runs of words."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from fairstream.llm import periodic_runs
from fairstream.llm.queries import op13_periodic_runs
from tests.llm.conftest import EDGES, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    found, n = {}, len(words)
    for q in range(n // periodic_runs.REPEATS, 0, -1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(periodic_runs.LEAST, periodic_runs.REPEATS * q):
                found[start, i + q] = q  # the smallest period comes last
            i += i == start
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_words(rng):
    words = []
    for _ in range(rng.randrange(6)):
        if rng.random() < 0.5:
            period = [f"p{rng.randrange(3)}" for _ in range(rng.randrange(1, 30))]
            words += (period * 200)[:rng.randrange(1, 200)]
        else:
            words += [f"w{rng.randrange(rng.choice([2, 3, 60]))}" for _ in range(rng.randrange(40))]
    return words


def test_transform_multiplies_polynomials():
    rng = np.random.default_rng(0)
    for prime, root in periodic_runs.PRIMES:
        t = periodic_runs.Transform(16, prime, root)
        a, b = rng.integers(0, prime, (2, 3, 16)).astype(np.uint64)
        got = t.inverse(t.forward(a) % t.p * (t.forward(b) % t.p) % t.p)
        for x, y, z in zip(a.tolist(), b.tolist(), got.tolist()):
            assert z == [sum(x[i] * y[(k - i) % 16] for i in range(16)) % prime
                         for k in range(16)]


@pytest.mark.parametrize("size", [2, 4, 16, 64])
def test_blocks_match_where_no_word_differs(size):
    rng, shifts = np.random.default_rng(size), size // 2 + 1
    here = rng.integers(0, 2, (200, size)).astype(np.uint64)
    window = rng.integers(0, 2, (200, 2 * size)).astype(np.uint64)
    for row in range(0, 200, 2):
        at = rng.integers(0, shifts)
        window[row, at:at + size] = here[row]
    plain = [[(window[i, k:k + size] != here[i]).any() for k in range(shifts)]
             for i in range(200)]
    for bound in (1, 2 ** 40, 2 ** 70):  # one, two and three primes
        found = periodic_runs.Correlator().mismatches(here, window, shifts, bound)
        assert found.tolist() == plain


def test_runs_equal_brute_force():
    rng, finder = random.Random(2), periodic_runs.RunFinder()
    for _ in range(150):
        docs = [periodic_words(rng) for _ in range(rng.randrange(1, 6))]
        numbers = [periodic_runs.numbered([w.encode() for w in d]) for d in docs]
        for words, found in zip(docs, finder.find(numbers)):
            assert list(map(tuple, found.tolist())) == brute_runs(words)


def test_blocks_of_words_that_do_not_come_again_are_not_convolved(monkeypatch):
    rows, compare = [], periodic_runs.Correlator.mismatches
    monkeypatch.setattr(periodic_runs.Correlator, "mismatches",
                        lambda self, here, *rest: rows.append(here.size) or compare(self, here, *rest))
    finder = periodic_runs.RunFinder()
    words = np.arange(3000)
    assert len(finder.find([words])[0]) == 0 and not rows
    words[1000:1500] = 1000 + np.arange(500) % 50
    found = finder.find([words, words[::-1].copy()])
    assert [f.tolist() for f in found] == [[[1000, 500, 50]], [[1500, 500, 50]]]
    assert 0 < sum(rows) < 2000


def test_nearest_and_farthest_recurrences():
    x, end_of = np.array([5, 6, 5, 5, 6, 5, 7]), np.repeat([4, 7], [4, 3])
    nearest, farthest = periodic_runs.recurrences(x, end_of)
    assert nearest.tolist() == [2, 8, 1, 8, 8, 8, 8]
    assert farthest.tolist() == [3, 0, 1, 0, 0, 0, 0]


def test_one_word_very_often_and_no_repetition():
    finder = periodic_runs.RunFinder()
    assert finder.find([np.zeros(100_000, np.int64)])[0].tolist() == [[0, 100_000, 1]]
    assert len(finder.find([np.arange(50_000)])[0]) == 0


def test_rows(docs):
    rng = random.Random(6)
    rows = [(i, "\t ".join(periodic_words(rng))) for i in range(60)] + [r[:2] for r in EDGES]
    rows.append((1000, " ".join(["x"] * 300_000)))
    found = periodic_runs.periodic_runs(docs(*rows)).collect()
    plain = []
    for key, text in rows[:-1]:
        words = WORD.findall(text or "")
        runs = brute_runs(words)
        plain.append((key, len(words), runs, brute_collapsed(words, runs)))
    plain.append((1000, 300_000, [(0, 300_000, 1)], "x"))
    assert sorted(((r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in found), key=str) \
        == sorted(plain, key=str)


def test_empty_table(docs):
    assert periodic_runs.periodic_runs(docs(*EDGES).where("doc_id = 12345")).count() == 0


def test_query(spark, docs, tmp_path):
    rng = random.Random(9)
    rows = [(i, " ".join(periodic_words(rng) + [prose(i, rng.randrange(30))])) for i in range(150)]
    rows += [r[:2] for r in EDGES if r[0] != 5]
    docs(*rows).write.parquet(f"{tmp_path}/documents.parquet")
    plain = []
    for key, text in rows:
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(key).encode()) if key is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        plain.append((key, len(runs), *(best or (None,) * 3),
                      best and 1000 * best[1] // best[2],
                      *(hashlib.sha256(x.encode()).hexdigest()
                        for x in (lines, brute_collapsed(words, runs)))))
    found = op13_periodic_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                             "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(plain, key=str)
