"""Main text of web pages by deducing the templates of their hosts."""

from __future__ import annotations

import hashlib
import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairstream.llm.common import stored, texts

#: A class of tokens is valid if it covers this share of a host's pages, and two pages at least.
SUPPORT, LEAST_PAGES = 0.3, 2
#: More is asked of texts in articles, as near copies of an article have most of theirs in common.
ARTICLE_SUPPORT, LEAST_ARTICLES = 0.5, 3
#: Kinds of tokens: elements, texts outside articles, and in them.
ELEMENT, AROUND_TEXT, ARTICLE_TEXT = 0, 1, 2

# Elements by their part in a page.
_RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "xmp")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small source span strike strong sub sup time tt u var wbr br input meta link "
    "col area embed param track base".split())
_VOID = frozenset("br hr img input meta link col area embed param source track wbr base".split())
_PASSING = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption pre "
                     "blockquote figure figcaption summary html body hr".split())
_AROUND = frozenset("head nav footer aside form button select option menu dialog object canvas "
                    "fieldset noscript".split())
_MAIN = frozenset(("article", "main"))
_AROUND_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banners?|sidebar\w*|side|comments?|commentlist|disqus|reply|"
    r"replies|responses?|cookies?|consent|gdpr|notices?|alerts?|newsletters?|subscri\w+|shar\w+|"
    r"social|related|recommend\w*|promo\w*|popups?|modal|overlay|breadcrumbs?|menus?|nav|navbar|"
    r"navigation|foot|footer|head|header|masthead|sponsor\w*|widgets?|pagination|pager|login|"
    r"signup|toolbar|skip|legal|copyright)(?=$|[\s_-])", re.IGNORECASE)
_COMMENT_NAMES = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|repl(?:y|ies)|responses?)"
                            r"(?=$|[\s_-])", re.IGNORECASE)
_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog form menu "
                   "menubar".split())

# attributes: names, and values behind = that are quoted or reach to the next space or >; what is
# not closed reaches to the end
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)"
    r"(?P<attrs>(?:[^\s=>]++|\s++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>]*+))*+)"
    r"(?:>|(?P<open>\Z))", re.DOTALL)
_ATTRIBUTE = re.compile(
    r"""([^\s=>/"']+)(?:\s*=\s*("[^"]*"?|'[^']*'?|[^\s>]*))?""")
_CLOSED = re.compile(r"""(?:^|[\s"'][^\s=]*)/\Z""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def _is_around(tag: str, attrs: str, in_main: bool) -> bool:
    """Whether an element is none of the main text, by its name, names given to it, or role."""
    if tag in _AROUND or tag == "header" and not in_main:
        return True
    if not attrs or tag in ("html", "body"):
        return False
    for name, value in _ATTRIBUTE.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "style" and _HIDDEN.search(value):
            return True
        if name == "role" and value.lower() in _ROLES:
            return True
        if name in ("class", "id"):
            if (_COMMENT_NAMES if tag in _MAIN else _AROUND_NAMES).search(value):
                return True
    return False


class Page:
    """Blocks of a page in order, and its tokens: elements and texts as they follow each other.

    A structural token is an element under the path of the containers around it. Blocks are
    (path, text, around, main): whether the block lies in an element that is none of the main
    text, and whether in an article. Unclosed elements end where an outer one is closed.
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[str, str, bool, bool]] = []
        self.tokens: list[tuple[str, str, int]] = []
        self._stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]
        self._text: list[str] = []
        at, end = 0, len(source)
        while at < end:
            m = _MARKUP.search(source, at)
            if m is None:
                self._text.append(source[at:])
                break
            self._text.append(source[at:m.start()])
            at = m.end()
            if m["cdata"] is not None:
                self._text.append(m["cdata"])
            if m["tag"] is None or m["open"] is not None:
                continue
            tag, attrs = m["tag"].lower(), m["attrs"]
            if tag in _RAW and not m["end"]:
                self._close_block()
                if not _CLOSED.search(attrs):
                    close = re.compile(rf"</{tag}\s*>|\Z", re.IGNORECASE).search(source, at)
                    at = close.end()
                continue
            if m["end"]:
                self._end(tag)
            else:
                self._start(tag, attrs)
        self._close_block()

    def _start(self, tag: str, attrs: str) -> None:
        if tag in _INLINE:
            if tag == "br":
                self._text.append(" ")
            return
        self._close_block()
        path, _, around, main = self._stack[-1]
        # a named paragraph or list item ends the one before it
        while self._stack[-1][1] in _PASSING and tag in _PASSING:
            self._stack.pop()
            path, _, around, main = self._stack[-1]
        inner = around or _is_around(tag, attrs, main)
        token = f"{path}/{tag}"
        self.tokens.append((token, "", ELEMENT))
        if tag in _VOID or _CLOSED.search(attrs):
            return
        if tag not in _PASSING or inner != around:
            self._stack.append((token, tag, inner, main or tag in _MAIN and not inner))

    def _end(self, tag: str) -> None:
        if tag in _INLINE:
            return
        self._close_block()
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i][1] == tag:
                del self._stack[i:]
                return
            if self._stack[i][1] not in _PASSING and tag in _PASSING:
                return

    def _close_block(self) -> None:
        if self._text:
            text = " ".join(html.unescape("".join(self._text)).split())
            self._text = []
            if text:
                path, _, around, main = self._stack[-1]
                self.blocks.append((path, text, around, main))
                self.tokens.append((path, text, ARTICLE_TEXT if main else AROUND_TEXT))


def _token(path: str, text: str = "", kind: int = ELEMENT) -> int:
    of_kind = "\0main\0" if kind == ARTICLE_TEXT else "\0"
    raw = hashlib.blake2b(f"{path}{of_kind}{text}".encode(errors="replace"), digest_size=8).digest()
    return int.from_bytes(raw, "little", signed=True)


def _tokens_of_page(page: Page) -> tuple[list[int], list[int], list[int], list[int]]:
    """Distinct tokens, their kinds and occurrences, and the places of all tokens of the page among
    them, in page order. The token 0 stands for the page and comes first."""
    place: dict[tuple[str, str, int], int] = {}
    sequence = [place.setdefault(t, len(place) + 1) for t in page.tokens]
    counts = [1] + [0] * len(place)
    for i in sequence:
        counts[i] += 1
    return ([0, *(_token(*t) for t in place)], [ELEMENT, *(kind for _, _, kind in place)], counts,
            [0, *sequence])


def _content(page: Page) -> int:
    """A hash of the texts outside menus and the like, in order: copies of a page share it."""
    return _token("content", "\0".join(t for _, t, around, _ in page.blocks if not around))


def _hosted(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(pages[url_col].cast("string"), F.lit("")),
                                    r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(pages[id_col].alias("key"), pages[url_col].alias("url"),
                        host.alias("host"), pages[html_col].cast("string").alias("html"))


def _pages_of_hosts(hosted: DataFrame) -> DataFrame:
    """``host, page, of_page``: the tokens of each page, of its copies only one.

    Pages of a host with the same texts outside menus and the like are copies.
    """

    def tokens(batches):
        for batch in batches:
            contents, sources, found = [], [], []
            for source in texts(batch, "html"):
                page = Page(source)
                contents.append(_content(page))
                sources.append(_token(source))
                found.append(_tokens_of_page(page))
            ids, kinds, counts, sequences = ([f[i] for f in found] for i in range(4))
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array(contents, pa.int64()),
                 pa.array(sources, pa.int64()), pa.array(ids, pa.list_(pa.int64())),
                 pa.array(kinds, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32())),
                 pa.array(sequences, pa.list_(pa.int32()))],
                ["host", "page", "source", "token", "kind", "n", "sequence"])

    found = hosted.select("host", "html").mapInArrow(
        tokens, "host string, page long, source long, token array<long>, kind array<int>, "
        "n array<int>, sequence array<int>")
    return found.groupBy("host", "page").agg(
        F.min_by(F.struct("token", "kind", "n", "sequence"), "source").alias("of_page"))


def _shape(found: list[tuple[int, int]], rank: int, own: int) -> tuple[int, int] | None:
    """Digests of the order of a class of ``own`` tokens on a page, and of its place in the template.

    ``found`` are the tokens of valid classes in page order, each with the rank of its class. The
    class is in order if its tokens follow each other in turn, each as often as the others. It nests
    if no token of a class of a lower rank comes between those of one turn; its place are the tokens
    that come last before its turns. None if it is not in order or does not nest.
    """
    tokens, before, last = [], [], -1
    for i, (of, token) in enumerate(found):
        if of < rank:
            last = i
        elif of == rank:
            tokens.append(token)
            before.append(last)
    turn = tokens[:own]
    if len(set(turn)) < own or tokens != turn * (len(tokens) // own):
        return None
    if any(before[i] != before[i + own - 1] for i in range(0, len(tokens), own)):
        return None
    places = sorted({found[i][1] if i >= 0 else 0 for i in before[::own]})
    return _token("order", repr(turn)), _token("place", repr(places))


def _nested(pages: DataFrame, valid: DataFrame) -> DataFrame:
    """``host, vector`` of the classes with texts that are in order on every page that has them,
    and have the same place in the template there."""
    classes = valid.groupBy("host", "vector").agg(
        F.first("pages").alias("pages"), F.first("total").alias("total"),
        F.max(F.col("kind") == ELEMENT).alias("holds"),
        F.max(F.col("kind") != ELEMENT).alias("asked"), F.collect_list("token").alias("tokens"))
    # classes of more pages lie around those of fewer
    ranked = stored(classes.groupBy("host").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("pages")).alias("order"), "total", "vector",
        (F.col("holds") & F.col("asked")).alias("asked"), "tokens"))).alias("classes")), "classes")

    def shapes(batches):
        for batch in batches:
            hosts, vectors, orders, places = [], [], [], []
            known: dict[str, tuple] = {}
            for row, host in enumerate(batch.column("host").to_pylist()):
                if host not in known:
                    ranks = batch.column("classes")[row].as_py()
                    known = {host: (ranks, {t: r for r, c in enumerate(ranks)
                                            for t in c["tokens"]})}
                ranks, rank_of = known[host]
                tokens = batch.column("token")[row].as_py()
                ranked = [rank_of.get(t) for t in tokens]
                found = [(ranked[i], tokens[i]) for i in batch.column("sequence")[row].as_py()
                         if ranked[i] is not None]
                for rank in sorted({r for r, _ in found if ranks[r]["asked"]}):
                    shape = _shape(found, rank, len(ranks[rank]["tokens"]))
                    hosts.append(host)
                    vectors.append(ranks[rank]["vector"])
                    orders.append(shape and shape[0])
                    places.append(shape and shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), *(pa.array(x, pa.int64())
                                                 for x in (vectors, orders, places))],
                ["host", "vector", "order", "place"])

    found = pages.select("host", "of_page.token", "of_page.sequence").join(ranked, "host") \
        .select("host", "token", "sequence", "classes") \
        .mapInArrow(shapes, "host string, vector long, order long, place long")
    same = [F.min(c) == F.max(c) for c in ("order", "place")]
    return found.groupBy("host", "vector").agg(
        (same[0] & same[1] & (F.count("order") == F.count(F.lit(1)))).alias("nests")) \
        .where("nests").select("host", "vector")


def templates(hosted: DataFrame) -> DataFrame:
    """``host, fixed array<long>``: texts that belong to the host's template.

    Tokens with the same occurrence vector over the host's pages form an equivalence class. Vectors
    are compared by a digest that tasks can add up in any order, so that no task holds a host. A
    class is valid if it covers enough pages; it is part of the template if it holds an element, its
    tokens come in the same order on every page, and it nests among the classes of more pages, at
    the same place on every page. The texts of such classes are fixed, all others are slots. A
    host has at most as many fixed texts as 1 / SUPPORT of its pages hold. Copies count as one
    page: no text is fixed for being on copies of one page only.
    """
    pages = stored(_pages_of_hosts(hosted), "pages")
    found = pages.select("host", "page", F.inline(F.arrays_zip("of_page.token", "of_page.kind",
                                                               "of_page.n")))
    vectors = found.groupBy("host", "token", "kind").agg(
        F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count(F.lit(1)).alias("pages"),
        F.sum("n").alias("total"))
    # the token 0 is on every page
    totals = stored(vectors.where((F.col("pages") >= LEAST_PAGES) | (F.col("token") == 0)), "tokens")
    of_host = totals.where(f"token = 0 and kind = {ELEMENT}").select(
        "host", F.col("pages").alias("of_host"))
    valid = totals.join(of_host, "host").where(
        (F.col("pages") >= LEAST_PAGES) & (F.col("pages") >= SUPPORT * F.col("of_host")))
    enough = (F.col("kind") != ARTICLE_TEXT) | (
        (F.col("pages") >= LEAST_ARTICLES) & (F.col("pages") >= ARTICLE_SUPPORT * F.col("of_host")))
    return valid.join(_nested(pages, valid), ["host", "vector"], "left_semi") \
        .where((F.col("kind") != ELEMENT) & enough) \
        .groupBy("host").agg(F.collect_set("token").alias("fixed"))


def main_text(source: str, fixed: frozenset[int]) -> str:
    """The slots of a page's template, after a check by tags.

    Slots in menus and the like are left out, and on a page with article or main text those outside
    it. A text of the template in an article is given back where its container holds slots too, as
    a line that many articles share; and so is an article without any slot.
    """
    page = Page(source)
    blocks = [(path, t, main, _token(path, t, ARTICLE_TEXT if main else AROUND_TEXT) not in fixed)
              for path, t, around, main in page.blocks if not around]
    articles = [b for b in blocks if b[2]]
    if not articles:
        return "\n\n".join(t for _, t, _, slot in blocks if slot)
    holding = {path for path, _, _, slot in articles if slot}
    return "\n\n".join(t for path, t, _, _ in articles if path in holding or not holding)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """Per page: the id, the url, ``text`` and ``n_chars``.

    Templates of hosts are deduced first (see ``templates``); then the fixed texts of its host are
    taken from every page. Pages join the templates by host, one row each, so a host with most of
    the pages is a skewed key of one side only, which Spark splits. Null html gives the empty text;
    a null url, or one without a host, makes the host ''; repeated rows are kept. Broken markup is
    read as far as it goes.
    """
    hosted = _hosted(pages, id_col, url_col, html_col)
    known = stored(templates(hosted), "templates")

    def run(batches):
        for batch in batches:
            found = []
            for source, fixed in zip(texts(batch, "html"), batch.column("fixed").to_pylist()):
                found.append(main_text(source, frozenset(fixed or ())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("url"), pa.array(found, pa.string()),
                 pa.array([len(t) for t in found], pa.int64())],
                ["key", "url", "text", "n_chars"])

    joined = hosted.join(known, "host", "left").select("key", "url", "html", "fixed")
    kind, url = (joined.schema[c].dataType.simpleString() for c in ("key", "url"))
    return joined.mapInArrow(run, f"key {kind}, url {url}, text string, n_chars long") \
        .withColumnsRenamed({"key": id_col, "url": url_col})
