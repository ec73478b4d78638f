"""Language identification and line quality."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairstream.llm import language_id, line_quality
from fairstream.llm.common import held_out
from tests.llm.conftest import EDGES

SOUNDS = {"en": ["the", "and", "of", "with", "ing", "er", "th"],
          "de": ["der", "und", "sch", "ung", "ü", "ein", "keit"],
          "fr": ["le", "que", "eau", "ç", "est", "ment", "é"]}


def spoken(lang: str, seed: int, n: int = 40) -> str:
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choices(SOUNDS[lang], k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def network():
    x, y, classes = [], [], sorted(SOUNDS)
    for lang in classes:
        for i in range(60):
            some = language_id.windows(spoken(lang, i).encode())
            x.append(some)
            y += [classes.index(lang)] * len(some)
    return language_id.ByteNetwork(classes).fit(np.concatenate(x), np.array(y))


def test_compiled_network_equals_the_plain_one(network):
    x = language_id.windows(spoken("fr", 900, 300).encode())
    values, _ = network._pooled(x)
    z = np.maximum(values, 0) @ network.out + network.out_bias
    p = np.exp(z - z.max(axis=1, keepdims=True))
    assert np.allclose(network.compiled()(x), p / p.sum(axis=1, keepdims=True), atol=1e-5)


def test_windows_cover_the_text():
    for n in (0, 1, 127, 128, 129, 1000):
        x = language_id.windows(b"a" * n)
        assert x.shape == (max(1, -(-n // 128)), 128) and (x == 97).sum() == n


def test_languages_of_unseen_texts(docs, network):
    rows = [(i, spoken(lang, 1000 + i)) for i, lang in enumerate(sorted(SOUNDS) * 20)]
    found = language_id.identify(docs(*rows), network, ["doc_id"]).collect()
    right = sum(r.lang_pred == (sorted(SOUNDS) * 20)[r.doc_id] for r in found)
    assert right >= 57 and all(0 <= r.score <= 1 for r in found)


def test_texts_without_letters(edge_docs, network):
    found = language_id.identify(edge_docs, network, ["doc_id", "lang"]).collect()
    assert len(found) == len(EDGES)
    assert {r.doc_id for r in found if r.lang_pred == "und"} == {1, 2, 3, 8}
    assert all(r.score == 0 for r in found if r.lang_pred == "und")


def test_training_takes_no_held_out_rows(docs):
    # every held-out row carries a wrong label
    rows = []
    for i in range(300):
        lang = sorted(SOUNDS)[i % 3]
        rows.append((i, spoken(lang, i), lang))
    marked = docs(*rows).withColumn("out", held_out(F.col("doc_id"))) \
        .withColumn("lang", F.when(F.col("out"), "wrong").otherwise(F.col("lang")))
    network = language_id.train(marked, ~held_out(F.col("doc_id")))
    assert network.classes == sorted(SOUNDS)
    found = language_id.identify(marked.where("out"), network, ["doc_id"]).collect()
    assert len(found) > 40
    assert np.mean([r.lang_pred == sorted(SOUNDS)[r.doc_id % 3] for r in found]) > 0.95


def test_training_learns_from_copied_texts_once(docs, monkeypatch):
    # the copies of any one text alone would fill the sample, or all be left out by the first cut
    monkeypatch.setattr(language_id, "SAMPLE_TEXTS", 20)
    learned = []
    monkeypatch.setattr(language_id.ByteNetwork, "fit",
                        lambda self, x, y: learned.append((self.classes, x, y)) or self)
    rows = [(i, spoken(lang, i % n), lang) for lang, n in (("de", 10), ("en", 1), ("fr", 90))
            for i in range(1500)]
    language_id.train(docs(*rows), F.lit(True))
    (classes, x, y), = learned
    assert classes == ["de", "en", "fr"]
    for at, (lang, n) in enumerate((("de", 10), ("en", 1), ("fr", 90))):
        starts = {language_id.windows(spoken(lang, i).encode())[0].tobytes() for i in range(n)}
        found = [w.tobytes() for w in x[y == at] if w.tobytes() in starts]
        assert len(found) == len(set(found)) == min(n, 20)


def test_nothing_to_learn_from(docs, edge_docs):
    assert language_id.train(docs(), F.lit(True)) is None
    assert language_id.train(docs((1, "text")), F.lit(True)) is None
    found = language_id.identify(edge_docs, None, ["doc_id"]).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}
    assert language_id.identify(docs(), None, ["doc_id"]).collect() == []


# line quality

def written(good: bool, seed: int) -> str:
    rng = random.Random(seed)
    lines = []
    for _ in range(rng.randint(1, 12)):
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8)))
                 for _ in range(rng.randint(4, 20))]
        lines.append(" ".join(words) + "." if good or rng.random() < 0.2
                     else " ".join(w.upper() + "!!" for w in words))
    return "\n".join(lines)


@pytest.fixture(scope="module")
def field():
    labels = np.array([i % 3 != 0 for i in range(240)], dtype=int)
    return line_quality.fit([written(bool(g), i).encode() for i, g in enumerate(labels)], labels)


def test_forward_backward_equals_enumeration():
    import itertools

    rng = np.random.default_rng(3)
    counts = np.array([1, 4, 3])
    scores, moves = rng.normal(size=(8, 2)), rng.normal(size=(2, 2))
    good, expected = line_quality._forward_backward(scores, moves, counts)
    at, pairs = 0, np.zeros((2, 2))
    for n in counts:
        total, ones = 0.0, np.zeros(n)
        moved = np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(scores[at + i, s] for i, s in enumerate(path))
                       + sum(moves[a, b] for a, b in zip(path, path[1:])))
            total += w
            ones += w * np.array(path)
            for a, b in zip(path, path[1:]):
                moved[a, b] += w
        assert np.allclose(good[at:at + n], ones / total)
        pairs += moved / total
        at += n
    assert np.allclose(expected, pairs)


def test_line_features_of_each_line():
    data = ["Ab c.\n\nX1 x1!\nAb c.".encode(), b"", "é é\r".encode()]
    f, counts = line_quality.line_features(data)
    assert counts.tolist() == [4, 1, 1]
    assert np.allclose(np.expm1(f[:, 0]), [5, 0, 6, 5, 0, 6])
    assert np.allclose(f[0, 1:6], [1 / 5, 0, 1 / 5, 1 / 5, 4 / 2])
    assert f[3, 8] == 1 and f[0, 8] == 0 and f[0, 9] == 1 and f[1, 9] == 0
    assert np.allclose(f[:, 6], [1, 1, 1, 1, 1, 0.5])


def test_quality_of_unseen_texts(docs, field):
    rows = [(i, written(i % 2 == 1, 5000 + i)) for i in range(100)]
    found = line_quality.score(docs(*rows), field, ["doc_id"]).collect()
    assert np.mean([r.predicted == r.doc_id % 2 for r in found]) > 0.9
    assert all(r.predicted == (r.score >= 0.7) for r in found)


def test_scores_do_not_depend_on_the_texts_beside(field):
    data = [written(i % 2 == 0, 100 + i).encode() for i in range(30)]
    alone = np.concatenate([field.scores([d]) for d in data])
    assert np.allclose(alone, field.scores(data), atol=1e-9)


def test_quality_of_edges(docs, edge_docs, field):
    found = line_quality.score(edge_docs, field, ["doc_id"]).collect()
    assert len(found) == len(EDGES) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (1, 2)}) == 1
    assert line_quality.score(docs(), field, ["doc_id"]).collect() == []


def test_training_from_tables(spark, docs):
    rows = [(i, written(i % 3 != 0, i)) for i in range(200)]
    labels = spark.createDataFrame(
        [(i, int(i % 3 != 0), None) for i in range(200)] + [(None, 1, 0), (3, None, 0)],
        "doc_id long, quality int, toxic int")
    field = line_quality.train(docs(*rows), labels)
    got = line_quality.score(docs(*rows), field, ["doc_id"]).collect()
    assert np.mean([r.predicted == (r.doc_id % 3 != 0) for r in got]) > 0.9
    assert line_quality.train(docs(), labels) is None
    assert line_quality.train(docs(*rows), labels.where("quality = 1")) is None
    halves = line_quality.score(docs((1, "a")), None, ["doc_id"]).collect()
    assert [(r.score, r.predicted) for r in halves] == [(0.5, 0)]


def test_training_collects_a_repeated_id_once(spark, docs, monkeypatch):
    kept = []
    monkeypatch.setattr(line_quality, "fit", lambda data, labels: kept.extend(data))
    labels = spark.createDataFrame([(1, 1, None), (3, 0, None), (4, 0, None)],
                                   "doc_id long, quality int, toxic int")
    line_quality.train(docs(*[(i, f"text {i} {n}") for i in (1, 3, 4) for n in range(50)]), labels)
    assert len(kept) == len(set(kept)) and all(t.endswith(b" 0") for t in kept)
