"""Main text of web pages by consensus host paths.

Each page is parsed into elements with a tolerant reader. Elements whose tag, role, class or id marks menus, headers, footers,
sidebars, notices, adverts, forms, comments and the like hold no content. A container's content is the length of its text outside
such elements and outside links. From the body down, the page moves to a child container as long as that one holds all of the
content and nothing but containers holds any, so no heading or section beside it is left out. It never moves on from an article
or main. Where it stops is the page's own container. Its path of tags and classes, digits and all that varies left out, gets the
page's vote for its host, which weighs by the logarithm of the content. In Spark the votes are summed by host, and the best path
of each host wins (of equals the greatest). Every page is then extracted again, from the elements on its host's winning path, or
from its own container if it has none.

Blocks are what block-level elements hold; a line break is white space. Character references are decoded once; white space in a
block becomes one space; blocks are joined by two line ends.

Nulls: null html counts as empty and gives an empty text. A null or odd url has the host ''. Repeated rows each keep a row.
Pages without content give an empty text. Pages of any depth and length are read in time and memory in proportion. Further
columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialise

#: Elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title xmp iframe noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
BARE = frozenset("nav footer aside form button select option input dialog menu head object svg canvas audio video map".split())
WHOLE = frozenset("article main".split())  # never left for a part of them
CONTAINERS = frozenset("article body center div main section table tbody td tr".split())
P_ENDS = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form".split())
MARKED = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|breadcrumbs?|sidebar|side-bar|footer|masthead|site-header|page-header|top-?bar|ads?|advert\w*|sponsor\w*|promo\w*|banner"
    r"|cookies?|consent|gdpr|notices?|notification|alert|popup|modal|overlay|newsletter|subscri\w+|signup|login|share|sharing|social|related|recommend\w*|comments?|commentlist|discussion|disqus|replies"
    r"|respond|search|widget|pagination|pager|toolbar|skip-?link|copyright|legal)(?:$|[\s_-])",
    re.IGNORECASE,
)
OPENS = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|(!--)|[!?])")
QUOTED = re.compile(r"[>\"']")
ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
SPACE = re.compile(r"\s+")
HOST = r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"


class Element:
    """name: tag and classes; bare: of no content; link, whole: in a link, in an article or main; p: the open paragraph it is in."""

    __slots__ = ("bare", "content", "kids", "link", "name", "p", "tag", "up", "whole")

    def __init__(self, tag: str, name: str, up: Element | None, bare: bool):
        self.tag, self.name, self.up, self.bare = tag, name, up, bare
        self.kids: list = []
        self.link = tag == "a" or bool(up and up.link)
        self.whole = tag in WHOLE or bool(up and up.whole)
        self.p = self if tag == "p" else up.p if up and tag in INLINE else None
        self.content = 0

    @property
    def path(self) -> str:
        names, x = [], self
        while x:
            names.append(x.name)
            x = x.up
        return "/".join(reversed(names))


def _named(tag: str, attrs: dict) -> str:
    classes = sorted({re.sub(r"[\d/]+", "", c).strip("-_") for c in attrs.get("class", "").lower().split()} - {""})
    return ".".join([tag, *classes])


class _Tags:
    """The ends of tags: past quoted values; a quote without a partner counts as a plain character. Each search is made once."""

    def __init__(self, text: str):
        self.text = text
        self.none: dict[str, int] = {}  # from where on a character is known not to occur

    def _find(self, c: str, at: int) -> int:
        if at >= self.none.get(c, len(self.text) + 1):
            return -1
        found = self.text.find(c, at)
        if found < 0:
            self.none[c] = at
        return found

    def end(self, at: int) -> int:
        """The place of the > that ends a tag whose name ends at ``at``; -1 if there is none."""
        if self._find(">", at) < 0:
            return -1
        while m := QUOTED.search(self.text, at):
            if m[0] == ">":
                return m.start()
            close = self._find(m[0], m.end())
            at = m.end() if close < 0 else close + 1
        return self._find(">", at)


def parse(html: str | None) -> Element:
    """The tree of elements; what is never closed ends with its parent, what closes nothing is passed over."""
    root = Element("html", "html", None, False)
    node, at, text = root, 0, html or ""
    tags, open_ = _Tags(text), Counter({"html": 1})
    said = 0  # up to where the text is taken

    def leave(x: Element) -> Element:
        """Closes all up to and with x; returns what is open then."""
        y = node
        while y is not x.up:
            open_[y.tag] -= 1
            y = y.up
        return y

    while m := OPENS.search(text, at):
        if m[3]:
            end = text.find("-->", m.end())
            end = len(text) if end < 0 else end + 3
        else:
            end = tags.end(m.end()) + 1
            if not end and m[2]:
                at = m.end()
                continue  # no tag, but text
            end = end or len(text)
        if m.start() > said:
            node.kids.append(text[said : m.start()])
        rest, at, said = text[m.end() : end - 1], end, end
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if open_[tag] > 0:
                x = node
                while x.tag != tag:
                    x = x.up
                if x.up:
                    node = leave(x)
            elif tag == "p":
                node.kids.append(Element("p", "p", node, False))
            continue
        if tag == "html":
            continue
        if tag == "body" and node.tag == "head":
            node = leave(node)
        if tag in P_ENDS and node.p:
            node = leave(node.p)
        if tag in ENDS and any(open_[t] > 0 for t in ENDS[tag]):
            x = node
            while x and x.tag not in BARS.get(tag, ()):
                if x.tag in ENDS[tag]:
                    node = leave(x)
                    break
                x = x.up
        attrs = {a[0].lower(): a[1] or a[2] or a[3] for a in ATTR.findall(rest)} if rest else {}
        own = tag in BARE or tag == "header" and not node.whole
        own = own or bool(attrs) and (attrs.get("role", "").lower() in ROLES or "hidden" in attrs or tag not in ("body", "article", "main") and bool(MARKED.search(f"{attrs.get('class', '')} {attrs.get('id', '')}")))
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(text, at)
            at = said = close.end() if close else len(text)
            continue
        x = Element(tag, _named(tag, attrs), node, node.bare or own)
        node.kids.append(x)
        if tag not in VOID and not rest.endswith("/"):
            node = x
            open_[tag] += 1
    if said < len(text):
        node.kids.append(text[said:])
    return root


def _measure(root: Element) -> None:
    stack: list[tuple[Element, bool]] = [(root, False)]
    while stack:
        x, done = stack.pop()
        if not done:
            stack.append((x, True))
            stack += [(k, False) for k in x.kids if isinstance(k, Element) and not k.bare]
        else:
            own = 0 if x.link else sum(len(k.strip()) for k in x.kids if isinstance(k, str))
            x.content = own + sum(k.content for k in x.kids if isinstance(k, Element) and not k.bare)


def container(root: Element) -> Element:
    """The page's own container of its main text."""
    _measure(root)
    node = root
    while node.tag not in WHOLE:
        filled = [k for k in node.kids if isinstance(k, Element) and not k.bare and k.content]
        if any(k.tag not in CONTAINERS and k.tag != "body" for k in filled) or any(isinstance(k, str) and any(map(str.isalnum, k)) for k in node.kids):
            break
        most = max(filled, key=lambda k: k.content, default=None)
        if most is None or most.content < node.content:
            break
        node = most
    return node


def blocks(nodes: list[Element]) -> list[str]:
    """The text blocks of the elements, in page order."""
    out: list[str] = []
    run: list[str] = []

    def flush():
        if run:
            t = SPACE.sub(" ", entities.unescape("".join(run))).strip()
            if t:
                out.append(t)
            run.clear()

    stack: list = [(n, 0) for n in reversed(nodes)]
    while stack:
        x, state = stack.pop()
        if isinstance(x, str):
            run.append(x)
        elif state == 1:
            flush()
        elif x.tag == "br":
            run.append(" ")
        elif not x.bare:
            if x.tag not in INLINE:
                flush()
                stack.append((x, 1))
            stack += [(k, 0) for k in reversed(x.kids)]
    flush()
    return out


def on_path(root: Element, path: str) -> list[Element]:
    """The outermost content elements with the path, in page order."""
    names = path.split("/")
    out, stack = [], [(root, 0)] if root.name == names[0] else []
    while stack:
        x, k = stack.pop()
        if k == len(names) - 1:
            out.append(x)
        else:
            stack += [(y, k + 1) for y in reversed(x.kids) if isinstance(y, Element) and not y.bare and y.name == names[k + 1]]
    return out


def extract(html: str | None, path: str | None = None) -> str:
    root = parse(html)
    nodes = on_path(root, path) if path else []
    text = "\n\n".join(blocks(nodes)) if nodes else ""
    return text or "\n\n".join(blocks([container(root)]))


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, score) of each page's own container, for (host, html)."""

    def run(batches):
        for b in batches:
            found = []
            for h, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                best = container(parse(t.as_py()))
                if best.content:
                    found.append((h, best.path, round(1000 * math.log2(1 + best.content))))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], k) for i, k in enumerate((pa.string(), pa.string(), pa.int64()))], ["host", "path", "score"])

    return pages.mapInArrow(run, "host string, path string, score long")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", most_hosts: int = 50_000) -> DataFrame:
    """(page_id, url, text, n_chars, host_path) of every page. Up to ``most_hosts`` winning paths are broadcast, more are joined."""
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1)).alias("host"), F.col(html_col).cast("string").alias("html"))
    counted = votes(rows.select("host", "html")).groupBy("host", "path").agg(F.sum("score").alias("score"))
    winners = materialise(counted.groupBy("host").agg(F.max(F.struct("score", "path")).alias("best")).select("host", F.col("best.path").alias("path")), "host-paths")
    small = winners.count() <= most_hosts
    joined = rows.join(F.broadcast(winners) if small else winners, "host", "left").select("page_id", "url", "html", "path")

    def run(batches):
        for b in batches:
            texts = [extract(t.as_py(), p.as_py()) for t, p in zip(b.column(2), b.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), b.column(3)], ["page_id", "url", "text", "n_chars", "host_path"])

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long, host_path string")
