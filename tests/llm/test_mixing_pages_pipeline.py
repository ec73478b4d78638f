"""Mixing, page templates and the pipeline."""

import collections
import re

import numpy as np
import pytest

import corpus_pipeline
from fairstream.llm import mixing, page_templates
from tests.llm.conftest import EDGES, prose
from tests.llm.test_joins import brute_components, edited

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# mixing

def brute_targets(sizes):
    """Targets by handing on the excess round by round."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, fixed, left = {}, set(), float(sum(sizes.values()))
    while True:
        open_ = [s for s in order if s not in fixed]
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_} if total else {}
        above = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not above:
            return {**target, **share}
        for s in above:
            target[s] = 3.0 * sizes[s]
            fixed.add(s)
            left -= target[s]


def check_mix(rows, df):
    sizes = collections.Counter()
    for _, text, _, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want, taken = brute_targets(dict(sizes)), collections.Counter()
    found = mixing.mix(df).select("row.doc_id", "row.source", "size", "source_size", "target",
                                  "copies", "taken").collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], abs=1e-6)
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert sorted((r.doc_id or -1, r.size) for r in found) == sorted(
        (i or -1, len(WORD.findall(t or ""))) for i, t, *_ in rows)
    return want, taken, found


def test_mix_meets_its_targets(docs):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(900):
        source = ["a", "b", "ü", "\U0001f600", None, "z"][min(5, int(rng.exponential(1.2)))]
        rows.append((i, " ".join(["w"] * int(1 + rng.pareto(1.2) * 40)), "en", source))
    rows += [(1000 + i, None, "en", "empty") for i in range(3)]
    want, taken, found = check_mix(rows, docs(*rows))
    for source, target in want.items():
        assert abs(taken[source] - target) <= 0.02 * target + 5, (source, target, taken[source])
    again = mixing.mix(docs(*reversed(rows))).select("row.doc_id", "taken").collect()
    assert {r.doc_id: r.taken for r in found} == {r.doc_id: r.taken for r in again}
    # rates are tilted by size within a source, and copies are rates rounded up or down
    near, every = 0, 0
    for source, target in want.items():
        of = [r for r in found if r.source == source and r.size]
        if not of or target >= 3 * sum(r.size for r in of) * (1 - 1e-12):
            continue
        size = np.array([r.size for r in of], float)
        low, high = -50.0, 50.0
        for _ in range(100):
            tilt = (low + high) / 2
            rate = np.minimum(3.0, np.exp(np.minimum(2.0, tilt * size / size.mean())))
            low, high = (tilt, high) if (size * rate).sum() < target else (low, tilt)
        near += (np.abs(np.array([r.copies for r in of]) - rate) < 1 + 1e-6).sum()
        every += len(of)
    assert every > 500 and near >= 0.98 * every


def test_mix_of_edges(edge_docs, docs):
    check_mix([(r + (None,) * 4)[:4] for r in EDGES], edge_docs)
    assert mixing.mix(docs()).collect() == []
    only = mixing.mix(docs((1, "a b c", "en", "x"), (2, None, "en", "x"))).collect()
    assert sorted((r.taken, r.target) for r in only) == [(0, 3.0), (3, 3.0)]


def test_mixed_rows_are_repeated_documents(docs):
    rows = [(i, prose(i, 5 + i), "en", f"s{i % 3}") for i in range(60)]
    df = docs(*rows)
    copies = {r.doc_id: r.copies for r in mixing.mix(df).select("row.doc_id", "copies").collect()}
    out = mixing.mixed_rows(df)
    assert out.columns == df.columns
    got = collections.Counter(r.doc_id for r in out.collect())
    assert got == {i: c for i, c in copies.items() if c}


# pages

PAGES = "page_id long, url string, html string, host string, key string, fixed string, text string"


def page(i, article, ad="buy now", lang="en"):
    return (f'<!DOCTYPE html><html lang="{lang}"><head><title>t{i}</title><style>p{{x}}</style>'
            f'<script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li></ul></nav>'
            f'<!-- ad {i} <p>no</p> --><div class="ad">{ad} {i}</div>{article}'
            f'<footer>&copy; host &middot; {i}</footer></body></html>')


def extracted(spark, rows):
    df = spark.createDataFrame([(*r, *"abcd") for r in rows], PAGES).repartition(2)
    return {r.page_id: (r.text, r.n_chars, r.url) for r in page_templates.extract(df).collect()}


def test_articles(spark):
    inner = ("<h1>A &amp; B</h1><p><b>First  line\n two<br><p>Second &lt;i&gt; &#233;&nbsp;x</p>"
             '<aside>side</aside><div class="comments"><p>nice!</p></div><form>send</form>'
             "<ul><li>one<li>two</ul>")
    rows = [(i, f"https://Host.example/{i}", page(i, f"<article>{inner}</article>"))
            for i in range(4)]
    got = extracted(spark, rows)
    want = "A & B\n\nFirst line two\n\nSecond <i> é x\n\none\n\ntwo"
    assert all(got[i] == (want, len(want), f"https://Host.example/{i}") for i in range(4))


def test_repeated_article_text_stays(spark):
    # a line that is on every page of the host, inside the article
    rows = [(i, "http://h.example/", page(i, f"<article><p>Licensed.</p><p>own {i}</p></article>"))
            for i in range(6)]
    got = extracted(spark, rows)
    assert got[3][0] == "Licensed.\n\nown 3"


def test_slots_of_a_template_without_articles(spark):
    def plain(i):
        return (f"<html><body><div>Site name</div><div><p>Body {i} first</p><p>and {i} more</p>"
                f"</div><div>Fixed end</div><div id='sidebar'>x{i}</div></body></html>")

    rows = [(i, f"http://h.example/{i}", plain(i)) for i in range(8)]
    rows += [(100, "http://alone.example/", plain(100))]
    got = extracted(spark, rows)
    assert got[2][0] == "Body 2 first\n\nand 2 more"
    # one page deduces no template
    assert got[100][0] == "Site name\n\nBody 100 first\n\nand 100 more\n\nFixed end"


def test_copies_of_a_page_make_no_template(spark):
    def plain(i, extra="", ad=0):
        return (f"<html><body><div>Site name</div><div><p>Body {i} first</p><p>and {i} more</p>"
                f"{extra}</div><div>Fixed end</div><div class='ad'>x{ad}</div></body></html>")

    whole = "Site name\n\nBody 1 first\n\nand 1 more\n\nFixed end"
    slots = "Body {0} first\n\nand {0} more"
    # two mirrored pages; mirrored pages with other ads around them
    rows = [(i, f"http://two.example/{i}", plain(1)) for i in range(2)]
    rows += [(10 + i, f"http://ads.example/{i}", plain(1, ad=i)) for i in range(3)]
    # every row twice
    rows += [(20 + i, f"http://rows.example/{i}", plain(i)) for i in range(5)] * 2
    # half of a host are copies of a page with an element of its own
    own = "<section><p>Own part</p></section>"
    rows += [(30 + i, f"http://half.example/{i}", plain(i)) for i in range(6)]
    rows += [(40 + i, f"http://half.example/c{i}", plain(40, own)) for i in range(6)]
    got = extracted(spark, rows)
    assert all(got[i][0] == whole for i in (0, 1, 10, 11, 12))
    assert all(got[20 + i][0] == slots.format(i) for i in range(5))
    assert all(got[30 + i][0] == slots.format(i) for i in range(6))
    assert all(got[40 + i][0] == slots.format(40) + "\n\nOwn part" for i in range(6))


def test_template_decides_in_articles(spark):
    # an unmarked notice inside the article, beside a section of the article's own
    rows = [(i, "http://h.example/", page(i, f"<article><h1>T {i}</h1><div><p>We moved.</p></div>"
                                             f"<p>own {i}</p><div><div>part {i}</div></div></article>"))
            for i in range(6)]
    # articles that have a section in common, but are too few to tell
    rows += [(10 + i, "http://few.example/", page(i, f"<article><p>own {i}</p><section><p>same</p>"
                                                     "</section></article>")) for i in range(2)]
    got = extracted(spark, rows)
    assert got[3][0] == "T 3\n\nown 3\n\npart 3"
    assert got[11][0] == "own 1\n\nsame"


def test_classes_in_no_order_or_place_are_no_template(spark):
    def plain(i, first, second, inner=""):
        return (f"<html><body><div>{first}</div><div><p>Body {i}</p>{inner}</div>"
                f"<div>{second}</div></body></html>")

    rows = [(i, "http://order.example/", plain(i, *(("One", "Two") if i % 2 else ("Two", "One"))))
            for i in range(6)]
    # on half of the pages an element and its text, now before the body and now after it
    moved = "<section><h2>Note</h2></section>"
    rows += [(10 + i, "http://place.example/",
              plain(i, "One", "Two").replace("<div>Two", (moved if i in (1, 3) else "") + "<div>Two")
              .replace("<body>", "<body>" + (moved if i == 5 else ""))) for i in range(6)]
    got = extracted(spark, rows)
    assert got[3][0] == "One\n\nBody 3\n\nTwo"
    assert got[12][0] == "Body 2" and got[13][0] == "Body 3\n\nNote"
    assert got[15][0] == "Note\n\nBody 5"


def test_broken_pages(spark):
    rows = [(1, None, None), (2, None, ""), (3, "no url", "plain <b>text</b> &am"),
            (4, "http://h/", "<article><p>cut of"), (5, "http://h/", "<article><p>cut <a href='x"),
            (6, "http://h/", "<script>never closed <p>x"), (7, "http://h/", "a<!-- open"),
            (8, "http://h/", "<p>" * 3000 + "deep" + "x" * 300_000),
            (9, "http://h/", "</p></div>end"), (9, "http://h/", "</p></div>end"),
            (10, "http://h/", "<main><p>1 < 2 &amp;&amp; 3 > 2</p>")]
    got = extracted(spark, rows)
    assert [got[i][0] for i in (1, 2, 3, 4, 5, 6, 7)] == [
        "", "", "plain text &am", "cut of", "cut", "", "a"]
    assert got[8][1] == 300_004 and got[9][0] == "end" and got[10][0] == "1 < 2 && 3 > 2"
    assert extracted(spark, []) == {}


# the pipeline

def test_stages_keep_columns_and_take_effect(spark, docs, tmp_path):
    rows = [(i, prose(i, 40 + i), "en", f"s{i % 4}") for i in range(30)]
    rows += [(100 + i, edited(rows[i][1], i, 1), "en", "s0") for i in range(10)]
    rows += [(200, "123 456 !!", "en", "s1"), (201, None, None, None), (202, "", "en", None),
             (203, prose(203, 50) + ' password="hunter2secret"', "en", "s2")]
    df = docs(*rows).select("doc_id", "text", "lang", "source", "n_chars")
    at, tables = df, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, str(tmp_path))
        assert out.columns == df.columns and out.schema.simpleString() == df.schema.simpleString()
        at = spark.createDataFrame(out.collect(), df.schema)
        tables[name] = sorted((tuple(r) for r in at.collect()), key=str)
    ids = {name: {r[0] for r in t} for name, t in tables.items()}
    assert ids["language_id"] == {r[0] for r in rows} - {200, 201, 202}
    kept = [r for r in rows if r[0] in ids["language_id"]]
    assert ids["jaccard_join"] == {c for _, _, c in brute_components(kept)}
    assert ids["secret_scans"] == ids["jaccard_join"]
    redacted = next(r for r in tables["secret_scans"] if r[0] == 203)
    assert "hunter2" not in redacted[1] and redacted[4] == len(redacted[1])
    packed = corpus_pipeline.STAGES[-1][1](spark, at, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == ids["mixing"]


def test_pipeline_of_nothing(spark, docs, tmp_path):
    docs().select("doc_id", "text", "lang", "source", "n_chars") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
