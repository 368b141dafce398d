"""Main text of web pages by consensus host paths.

Every page's containers are scored by the running text below them. In Spark, pages vote per host on
generalised paths (tags and classes from the root down, digits read as one), weighted by score; each page's text
is then extracted again from all containers on its host's winning path, or, where a page has none with text,
from its own best path.

Menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles are recognised by tag
or by a word of class, id or role. Character references are decoded once, white space inside a block becomes one
space, blocks are joined by a line break.

Defined cases: null or empty html, or html without text, gives an empty text; null urls share the empty host;
unclosed tags, heads and comments are read as browsers do, roughly; plain text is its own page. A page takes time in
proportion to its length, whatever it holds. Ties between paths go
to the alphabetically first. Repeated rows are extracted alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .url_filter import url_host

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>""")
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
#: Characters within which a tag's quotes are heeded; a longer tag ends at its first `>`.
TAG_CHARS = 1 << 13
ATTRIBUTE = re.compile(r"""(?<![-\w:.])([a-zA-Z_:][-\w:.]*+)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
ENDS = {"<!--": "-->", "<![CDATA[": "]]>", "<!": ">", "<?": ">"}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg object canvas head title textarea".split())
#: What may stand in a head; any other tag, and text, ends it.
IN_HEAD = frozenset("head base link meta script style title noscript template".split())
OPAQUE = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "iframe")}
OUTSIDE = frozenset("nav footer aside form button select dialog menu fieldset label".split())
#: Of these, what pages also put around all they hold.
AROUND = frozenset("form fieldset".split())
CONTAINERS = frozenset("html body div section article main td center table tbody tr".split())
BLOCKS = CONTAINERS | OUTSIDE | frozenset(
    "address blockquote dd details dl dt figcaption figure h1 h2 h3 h4 h5 h6 header hr li ol p pre summary th thead tfoot ul caption option".split()
)
#: Words of class, id or role that mark what is not the article.
MARKS = frozenset(
    """ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs footer sidebar
    aside cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup comment comments reply replies disqus respond share sharing social
    related recommended recommendations widget form login search toolbar pagination pager skip masthead contentinfo complementary""".split()
)
#: Words that leave a mark what it is: `share-buttons` marks, `share-price` does not.
PLAIN = frozenset(
    """area bar block body bottom box btn button buttons card col column container content count desktop fixed foot global group head header heading icon icons inner item items left
    link links list main message mobile module more new outer page panel popular post posts articles stories news primary right row secondary section site slot sticky tab text thread
    title top unit wrap wrapper""".split()
)
GOOD = frozenset("article articlebody content post entry story main text body".split())
PRIOR = {"article": 2.0, "main": 1.8, "body": 0.5, "html": 0.3, "": 0.3}
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_DIGITS = re.compile(r"\d+")


class Node:
    __slots__ = ("parent", "path", "prior", "depth")

    def __init__(self, parent: int, path: str, prior: float, depth: int) -> None:
        self.parent, self.path, self.prior, self.depth = parent, path, prior, depth


def _words(value: str) -> list[str]:
    return [w.lower() for w in _WORDS.findall(value)]


def mark_of(names: list[str], marks: frozenset[str] = MARKS) -> int:
    """2 if one of the names is made of marks and plain words alone, 1 if there is a mark in one of them, else 0."""
    out = 0
    for name in names:
        words = _words(name)
        if any(w in marks for w in words):
            out = max(out, 2 if all(w in marks or w in PLAIN for w in words) else 1)
    return out


class Page:
    """Containers and text blocks of one page, in page order."""

    def __init__(self, html: str) -> None:
        self.nodes = [Node(-1, "", PRIOR[""], 0)]
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters within links
        self._stack: list[tuple[str, int, bool, bool, int]] = []  # tag, container, left out, link, mark
        self._marks: list[tuple[int, int]] = [(-1, 0)]  # of marked elements: the mark around it, how surely it is one
        self._marked: list[int] = []  # the innermost mark of each block
        self._out = self._links = self._article = 0
        self._text: list[str] = []
        self._linked = 0
        self._count: Counter[str] = Counter()  # open tags
        self._read(html)
        self._leave_out()

    def _mark(self) -> int:
        return self._stack[-1][4] if self._stack else 0

    def _leave_out(self) -> None:
        """Drops blocks of marked elements: of sure marks all, of others those of links. A mark around nearly all running text is none."""
        if len(self._marks) == 1:
            return
        running, whole = [0] * len(self._marks), [0] * len(self._marks)
        for mark, (_, text, linked) in zip(self._marked, self.blocks, strict=True):
            whole[mark] += len(text)
            running[mark] += len(text) * (2 * linked <= len(text))
        own = list(running)
        for k in range(len(self._marks) - 1, 0, -1):
            running[self._marks[k][0]] += running[k]
            whole[self._marks[k][0]] += whole[k]
        gone = [sure == 2 or sure == 1 and 2 * running[k] < whole[k] for k, (_, sure) in enumerate(self._marks)]

        def left() -> tuple[int, list[bool]]:
            out = list(gone)
            for k in range(1, len(out)):
                out[k] = out[k] or out[self._marks[k][0]]
            return sum(n for n, o in zip(own, out, strict=True) if not o), out

        rest, out = left()
        for k in range(1, len(gone)):  # from the outermost in
            if rest >= 0.1 * running[0]:
                break
            if gone[k] and 2 * running[k] > running[0]:
                gone[k] = False
                rest, out = left()
        self.blocks = [b for mark, b in zip(self._marked, self.blocks, strict=True) if not out[mark]]

    def _container(self) -> int:
        return self._stack[-1][1] if self._stack else 0

    def _say(self, text: str) -> None:
        if self._count["head"] and self._stack[-1][0] == "head" and not text.isspace():
            self._close("head")
        if not self._out and text:
            self._text.append(text)
            if self._links:
                self._linked += len(text)

    def _flush(self) -> None:
        if self._text:
            text = " ".join(unescape("".join(self._text)).split())
            if text:
                self.blocks.append((self._container(), text, self._linked))
                self._marked.append(self._mark())
            self._text, self._linked = [], 0

    def _pop(self) -> None:
        tag, _, out, link, _ = self._stack.pop()
        self._count[tag] -= 1
        self._out -= out
        self._links -= link
        self._article -= tag in ("article", "main")

    def _close(self, tag: str) -> None:
        if self._count[tag]:
            while self._stack[-1][0] != tag:
                self._pop()
            self._pop()

    def _open(self, tag: str, attributes: str) -> None:
        if self._count["head"] and tag not in IN_HEAD:
            self._close("head")
        again = tag in ("li", "dt", "dd", "option", "tr", "td", "th")
        if tag in BLOCKS and (self._count["p"] or again and self._count[tag]):  # a paragraph, list item or cell ends where the next one begins
            for k in range(len(self._stack) - 1, -1, -1):
                name = self._stack[k][0]
                if name == "p" or name == tag and again:
                    while len(self._stack) > k:
                        self._pop()
                    break
                if name in CONTAINERS or name in ("ul", "ol", "dl"):
                    break
        names: list[str] = []
        classes: list[str] = []
        if "=" in attributes:
            for name, *values in ATTRIBUTE.findall(attributes):
                if name.lower() in ("class", "id", "role"):
                    value = next((v for v in values if v), "")
                    names += value.split()
                    if name.lower() == "class":
                        classes = sorted({_DIGITS.sub("0", c) for c in value.split()})
        marked = {w for name in names for w in _words(name)}
        own = tag in ("article", "main", "body", "html")
        sure = 0
        if not own:
            sure = mark_of(names, MARKS if self._article else MARKS | {"header"}) if marked else 0
            if tag in AROUND or tag == "header" and not self._article:
                sure = 2
        # what stands within a line is left out at once, if at all
        out = tag in OUTSIDE - AROUND or tag in RAW or sure == 2 and tag not in BLOCKS
        mark = self._mark()
        if sure and tag in BLOCKS and not out and not self._out:
            self._marks.append((mark, sure))
            mark = len(self._marks) - 1
        self._out += out
        self._links += tag == "a"
        self._article += tag in ("article", "main")
        container = self._container()
        if tag in CONTAINERS and not self._out:
            above = self.nodes[container]
            step = ".".join([tag, *classes])
            path = f"{above.path}>{step}"
            if above.depth >= 40:  # deep nesting is told apart by digest
                path = f"{xxhash.xxh64_hexdigest(path)}>{step}"
            prior = PRIOR.get(tag) or (1.5 if marked & GOOD else 1.0)
            self.nodes.append(Node(container, path, prior, above.depth + 1))
            container = len(self.nodes) - 1
        self._stack.append((tag, container, out, tag == "a", mark))
        self._count[tag] += 1

    def _read(self, html: str) -> None:
        at, n, last = 0, len(html), html.rfind(">")
        while at < n:
            start = html.find("<", at)
            if start < 0 or start > last and html.find("<!--", start) < 0 and html.find("<![CDATA[", start) < 0:
                self._say(html[at:])
                break
            if start > at:
                self._say(html[at:start])
            if html.startswith(("<!", "<?"), start):
                mark = next(m for m in ENDS if html.startswith(m, start))
                stop = html.find(ENDS[mark], start + len(mark))
                at = stop + len(ENDS[mark]) if stop >= 0 else n if mark in ("<!--", "<![CDATA[") else start + 1
                continue
            m = start < last and (TAG.match(html, start, min(n, start + TAG_CHARS)) or NAME.match(html, start))
            if not m:
                self._say("<")
                at = start + 1
                continue
            end, name = m[1], m[2]
            attributes, at = (m[3], m.end()) if m.re is TAG else (html[m.end() : (gt := html.find(">", m.end()))], gt + 1)
            tag = name.lower()
            if tag == "br":
                self._say(" ")
                continue
            if tag in BLOCKS:
                self._flush()
            elif tag == "img":
                self._say(" ")
            if end:
                self._close(tag)
            elif tag in OPAQUE:
                stop = OPAQUE[tag].search(html, at)
                at = stop.end() if stop else n
            elif tag not in VOID and not (attributes.endswith("/") and tag not in BLOCKS and tag != "a"):
                self._open(tag, attributes)
        self._flush()

    def scores(self) -> dict[str, float]:
        """Of every container path: running text below it, less the farther up it is."""
        below = [0.0] * len(self.nodes)
        for node, text, linked in self.blocks:
            if 2 * linked <= len(text):
                below[node] += len(text)
        out: dict[str, float] = defaultdict(float)
        for k in range(len(self.nodes) - 1, -1, -1):  # a container comes before what it holds
            node = self.nodes[k]
            if below[k]:
                out[node.path] += below[k] * node.prior
                if node.parent >= 0:
                    below[node.parent] += 0.9 * below[k]
        return out

    def text(self, path: str | None) -> str:
        """The blocks below all containers on the path."""
        inside = [False] * len(self.nodes)
        for k, node in enumerate(self.nodes):
            inside[k] = node.path == path or node.parent >= 0 and inside[node.parent]
        return "\n".join(text for node, text, _ in self.blocks if inside[node])


def best(scores: dict[str, float]) -> str | None:
    return min(scores, key=lambda p: (-scores[p], p)) if scores else None


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path that the pages of each host vote for. `pages`: host, html."""

    def votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            total: dict[tuple[str, str], float] = defaultdict(float)
            for host, html in zip(pdf["host"], pdf["html"], strict=True):
                scores = Page(html).scores()
                top = max(scores.values(), default=0.0)
                for path, score in scores.items():
                    total[host, path] += score / top
            yield pd.DataFrame([(h, p, round(v * 1e6)) for (h, p), v in total.items()], columns=["host", "path", "votes"])

    counted = pages.mapInPandas(votes, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    return counted.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("v"), "path"))["path"].alias("path"))


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, path) of every row; `path` is the one the text was taken from."""
    rows = df.select(F.col(id_col), F.col(url_col), url_host(F.col(url_col)).alias("host"), F.coalesce(html_col, F.lit("")).alias("html"))
    winners = written(host_paths(rows.select("host", "html")), "host-paths")
    voted = rows.join(winners, "host", "left").select(id_col, url_col, "html", "path")
    schema = f"`{id_col}` {voted.schema[id_col].dataType.simpleString()}, `{url_col}` string, text string, path string"

    def extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, paths = [], []
            for html, path in zip(pdf["html"], pdf["path"], strict=True):
                page = Page(html)
                text = page.text(path)
                if not text:
                    path = best(page.scores())
                    text = page.text(path)
                texts.append(text)
                paths.append(path)
            out = pdf[[id_col, url_col]].copy()
            out["text"], out["path"] = texts, pd.Series(paths, index=pdf.index, dtype=object)
            yield out

    return voted.mapInPandas(extracted, schema)
