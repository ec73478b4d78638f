"""Alignment of two tokenizers' tokens and its corpus counts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from fairstream.llm import token_alignment
from fairstream.llm.queries import op11_token_alignment
from tests.llm.conftest import EDGES, prose

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["é", "日", "\U0001f600", "a", " ", "\n", "́", "ﬁ", "①", "ß", "x", "\t", "\x00", "न",
       "<0x0A>", "<s>", "<|endoftext|>", "word", "▁"]


@pytest.fixture(scope="module")
def aligner():
    return token_alignment.Aligner(*PATHS)


def plain_tokens(aligner, text):
    """Ids and decoded bytes of both encoders, or None where they do not give the text back."""
    if not text:
        return None
    whole = (" " + text).encode()
    a = aligner.a.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.encode(text)
    shown = {**{i: chr(i) for i in [*range(33, 127), *range(161, 173), *range(174, 256)]}}
    shown |= {i: chr(256 + n) for n, i in enumerate(i for i in range(256) if i not in shown)}
    back = {c: i for i, c in shown.items()}
    bytes_a = [bytes(back[c] for c in aligner.a.id_to_token(i)) for i in a]
    bytes_b = []
    for i in b:
        piece = aligner.b.id_to_piece(i)
        byte = len(piece) == 6 and piece.startswith("<0x")
        bytes_b.append(bytes.fromhex(piece[3:5]) if byte else piece.replace("▁", " ").encode())
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return None
    return list(zip(a, bytes_a)), list(zip(b, bytes_b))


def spans(tokens):
    at = 0
    for i, data in tokens:
        yield i, at, at + len(data)
        at += len(data)


def brute(aligner, rows):
    found, holders = [], Counter()
    for key, text in rows:
        both = plain_tokens(aligner, text)
        if both is None:
            found.append((key, [], [], [], ""))
            continue
        a, b = (list(spans(t)) for t in both)
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        cuts = sorted({e for _, _, e in a} & {f for _, _, f in b})
        groups = []
        for low, high in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(i) for i, _, e in side if low < e <= high)
                                   for side in (a, b)))
        holders.update(set(links))
        found.append((key, a, b, links, ";".join(groups)))
    most = defaultdict(int)
    for (i, _), n in holders.items():
        most[i] = max(most[i], n)
    return sorted(((key, len(a), len(b), g.count(";") + 1 if g else 0, len(links), g,
                    sum(holders[x] == most[x[0]] for x in links), sum(holders[x] for x in links))
                   for key, a, b, links, g in found), key=str)


def test_tokens_are_those_of_whole_texts(aligner):
    rng = random.Random(4)
    values = ["".join(rng.choice(ODD) for _ in range(rng.randrange(30))) for _ in range(3000)]
    values += [prose(i, 40) for i in range(20)] + ["a  b\n c", " a", "a ", "  ", "a \t b", "é  é é"]
    plain = {i: p for i, p in enumerate(plain_tokens(aligner, v) for v in values) if p}
    *sides, used = aligner.encode(values)
    assert used.tolist() == list(plain)
    for side, (ids, ends, counts) in enumerate(sides):
        tokens = [t for p in plain.values() for t in p[side]]
        assert ids.tolist() == [i for i, _ in tokens]
        assert ends.tolist() == np.cumsum([len(x) for _, x in tokens]).tolist()
        assert counts.tolist() == [len(p[side]) for p in plain.values()]


def test_tokens_around_marks_are_those_of_whole_texts(aligner):
    rng = random.Random(6)
    parts = ["word", "Ab", "é", "ñö", "don't", "'s", "'", "'ll", "12", "7", ",", ".", "###", "_", "²",
             "½", "Ⅷ", "ß", "\n", "\n\n", " ", " ", " ", "  ", "\t", "\r\n", "\x1c", "\xa0", "\u2028",
             "日本", "́", "я", "α", "ǅ", "ı", "../", "<s>", "{-}", "…", "”", "x"]
    values = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(4000)]
    plain = {i: p for i, p in enumerate(plain_tokens(aligner, v) for v in values) if p}
    for at_once in (1, 50, len(values)):
        fresh, found = token_alignment.Aligner(*PATHS), {}
        for at in range(0, len(values) if at_once > 1 else 400, at_once):
            *sides, used = fresh.encode(values[at:at + at_once])
            upto = [np.cumsum(counts) for _, _, counts in sides]
            for k, i in enumerate(used.tolist()):
                found[at + i] = [ids[u[k] - c[k]:u[k]].tolist()
                                 for (ids, _, c), u in zip(sides, upto)]
        assert found == {i: [[t for t, _ in side] for side in p] for i, p in plain.items()
                         if at_once > 1 or i < 400}


def test_marks_make_no_new_units_of_words():
    words, marks = [f"W{c}ord" for c in "abcdefgh"] + ["üb", "été"], [",", ".", "###", "!!", "\n"]
    fresh = token_alignment.Aligner(*PATHS)
    fresh.align([f"{w}{m} {v}{m}{w}" for w in words for v in words for m in marks])
    assert len(fresh.numbers) == 2 * len(words) + len(marks)


def test_units_met_again_are_remembered(aligner, monkeypatch):
    monkeypatch.setattr(token_alignment, "MOST_UNITS", 60)
    fresh, added = token_alignment.Aligner(*PATHS), []
    for units in (fresh.units_a, fresh.units_b):
        monkeypatch.setattr(units, "_add", lambda numbers, new, alone=False, add=units._add:
                            (added.extend(new), add(numbers, new, alone))[1])
    values = [f"often met  again, é x{i}y{i}" for i in range(200)]
    found = [fresh.align([v]) for v in values]
    assert added.count(" often") == 2 and len(fresh.numbers) < 80
    for value, (numbers, _, _, groups) in zip(values, found):
        assert (*numbers[0].tolist(), groups[0]) == brute(aligner, [(0, value)])[0][1:6]


@pytest.mark.parametrize("links", [1, 1 << 22])
def test_equals_brute_force(docs, aligner, monkeypatch, links):
    monkeypatch.setattr(token_alignment, "CHUNK_LINKS", links)
    monkeypatch.setattr(token_alignment, "MOST_UNITS", links)
    monkeypatch.setattr(token_alignment, "AT_ONCE", min(links, 1 << 18))
    rng = random.Random(8)
    rows = [(i, prose(i % 17, rng.randrange(1, 60))) for i in range(40)]
    rows += [(100 + i, "".join(rng.choice(ODD) for _ in range(20))) for i in range(30)]
    rows += [(7, rows[7][1]), (None, "no id here"), (200, None), (201, ""), (202, "▁ and more"),
             (203, " "), (204, "\n\n")]
    found = sorted(map(tuple, token_alignment.aligned(docs(*rows), *PATHS).collect()), key=str)
    assert found == brute(aligner, rows)


def test_edge_rows(edge_docs, aligner):
    found = {r["doc_id"]: r for r in token_alignment.aligned(edge_docs, *PATHS).collect()}
    assert len(found) == len({r[0] for r in EDGES})
    assert found[1][1:] == (0, 0, 0, 0, "", 0, 0) and found[2][1:] == (0, 0, 0, 0, "", 0, 0)
    assert found[9]["n_groups"] > 0


def test_empty_table(docs):
    rows = docs(*EDGES).where("doc_id = 12345")
    assert token_alignment.aligned(rows, *PATHS).count() == 0


def test_query(spark, docs, aligner, tmp_path):
    docs((1, "one two three"), (2, "one two"), (3, "")).write.parquet(
        f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in op11_token_alignment(spark, str(tmp_path)).collect()}
    plain = brute(aligner, [(1, "one two three"), (2, "one two"), (3, "")])
    for key, n_a, n_b, n_groups, n_links, groups, n_best, count_sum in plain:
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        assert rows[key].asDict() == {
            "doc_id": key, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
            "n_best": n_best, "count_sum": count_sum, "groups_sha256": digest}
