"""Main text of web pages by scoring the tree of elements.

Paragraphs give points for their length and commas to their ancestors; points are
discounted by the share of text inside links. The best container and those of its
siblings that read like text are kept, without what is marked as page furniture. A word of
a class or identifier is a hint only: it never drops article or main, nor an element with
more than half of the page's unlinked paragraph text, unless an article beside it has a
quarter.

Rules for odd input: NULL is an empty page; a page without any text gives the empty
text; unclosed and unopened tags are mended as browsers do; a page whose paragraphs
give no points keeps its article element, else all text outside furniture.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Kinds of elements.
RAW = frozenset("script style noscript template iframe object svg math canvas audio video".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
FURNITURE_TAGS = frozenset(
    "nav header footer aside form button select textarea fieldset menu dialog head title "
    "datalist input".split()
)
ARTICLE_TAGS = frozenset("article main".split())
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar "
    "toolbar form".split()
)
#: Words of a class or identifier that mark furniture.
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner promo promotion "
    "promoted sponsor sponsored sidebar sidebars widget widgets comment comments commentlist "
    "disqus replies respond reply cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations breadcrumb breadcrumbs menu menus nav navbar navigation topnav "
    "footer foot header masthead topbar toolbar pagination pager skip hidden tags tagcloud "
    "paywall outbrain taboola".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(sorted(RAW)) + r")\b(?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+>"
    r".*?(?:</(?P=raw)\s*+[^>]*+>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?P<rest>(?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)>"
    r"|<[!?/][^>]*+>|</?[a-zA-Z][^>]*+\Z",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s\"'=<>/]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"']++)))?")
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: What follows one of these in a class says what an element has or lacks, not what it is.
DENIALS = frozenset("has have with without no not".split())
#: Last words of classes that tell a state.
STATES = frozenset("open opened closed enabled disabled".split())

LEAST_CHARS = 25
#: Ancestors that share a paragraph's points, nearest first.
SHARES = (1.0, 0.5, 1 / 3, 0.25, 0.2)
TAG_POINTS = {"article": 25.0, "main": 25.0, "div": 5.0, "section": 5.0, "blockquote": 3.0} | {
    "pre": 3.0, "td": 3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "table": -3.0
}


class Page:
    """Elements in page order as columns, and the pieces of text under them."""

    def __init__(self, source: str):
        self.parent = [-1]
        self.tags = ["html"]
        self.furniture = [False]
        #: Elements that only a word of a class or identifier marks.
        self._hinted: list[int] = []
        #: (element, text); None stands for the border of a block.
        self.pieces: list[tuple[int, str | None]] = []
        self._stack = [0]
        self._paragraphs: list[int] = []
        self._blocks = [0]
        self._open: dict[str, int] = {"html": 1}
        self._parse(source)
        if self._hinted:
            self._judge_hints()

    def _parse(self, source: str) -> None:
        at = 0
        for token in TOKEN.finditer(source):
            if token.start() > at:
                self._text(source[at : token.start()])
            at = token.end()
            name = token["name"]
            if name is None:
                continue
            name = name.lower()
            if name == "br":
                self.pieces.append((self._stack[-1], "\n"))
            elif token["end"]:
                self._close(name)
            else:
                self._start(name, token["rest"])
        if at < len(source):
            self._text(source[at:])

    def _text(self, text: str) -> None:
        self.pieces.append((self._stack[-1], html.unescape(text) if "&" in text else text))

    def _border(self) -> None:
        self.pieces.append((self._stack[-1], None))

    def _start(self, name: str, rest: str) -> None:
        block = name not in INLINE
        if block:
            if self._paragraphs and self._paragraphs[-1] > self._blocks[-1]:
                self._pop_to(self._paragraphs[-1])
            if name in ("li", "td", "th", "tr", "dd", "dt", "option") and self._open.get(name):
                top = self._stack[self._blocks[-1]]
                if self.tags[top] == name:
                    self._pop_to(self._blocks[-1])
            self._border()
        if name in VOID:
            return
        parent = self._stack[-1]
        inside = self.furniture[parent]
        self.parent.append(parent)
        self.tags.append(name)
        self.furniture.append(inside or self._is_furniture(name, rest, parent))
        if not self.furniture[-1] and rest and self._is_hinted(name, rest):
            self._hinted.append(len(self.tags) - 1)
        if name == "p":
            self._paragraphs.append(len(self._stack))
        elif block:
            self._blocks.append(len(self._stack))
        self._stack.append(len(self.tags) - 1)
        self._open[name] = self._open.get(name, 0) + 1

    def _close(self, name: str) -> None:
        if not self._open.get(name) or name == "html":
            return
        if name not in INLINE:
            self._border()
        depth = len(self._stack) - 1
        while self.tags[self._stack[depth]] != name:
            depth -= 1
        self._pop_to(depth)
        if name not in INLINE:
            self._border()

    def _pop_to(self, depth: int) -> None:
        """Close the element at ``depth`` of the stack and all inside it."""
        while len(self._stack) > depth:
            self._open[self.tags[self._stack.pop()]] -= 1
        while self._paragraphs and self._paragraphs[-1] >= depth:
            self._paragraphs.pop()
        while self._blocks[-1] >= depth and len(self._blocks) > 1:
            self._blocks.pop()

    def _in_article(self, element: int) -> bool:
        return self._open.get("article", 0) + self._open.get("main", 0) > 0 and element > 0

    def _is_furniture(self, name: str, rest: str, parent: int) -> bool:
        if name in FURNITURE_TAGS:
            # an article's own head carries its title
            return not (name == "header" and self._in_article(parent))
        if not rest or name in ("html", "body") or name in ARTICLE_TAGS and "=" not in rest:
            return False
        for key, *values in ATTRIBUTE.findall(rest):
            key, value = key.lower(), next(filter(None, values), "")
            if key == "hidden":
                return True
            if key == "style":
                if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    return True
            elif key == "aria-hidden":
                if value.lower() == "true":
                    return True
            elif key == "role" and value.strip().lower() in FURNITURE_ROLES:
                return True
        return False

    def _is_hinted(self, name: str, rest: str) -> bool:
        if name in ("html", "body") or name in ARTICLE_TAGS:
            return False
        for key, *values in ATTRIBUTE.findall(rest):
            if key.lower() not in ("class", "id"):
                continue
            for token in next(filter(None, values), "").split():
                words = WORD.findall(CAMEL.sub(" ", token).lower())
                if words[:1] == ["overflow"] or len(words) > 1 and words[-1] in STATES:
                    continue
                for word in words:
                    if word in DENIALS:
                        break
                    if word in FURNITURE_WORDS:
                        return True
        return False

    def _judge_hints(self) -> None:
        """Make furniture of the hinted elements, except those that hold the page's text."""
        size = len(self.tags)
        held, short = [0] * size, [0] * size
        known: dict[int, bool] = {}
        block, length = 0, 0
        for element, text in [*self.pieces, (0, None)]:
            if self.furniture[element]:
                continue
            owner = self._block_of(element)
            if text is None or owner != block:
                short[block] += length
                held[block] += length if length >= LEAST_CHARS else 0
                block, length = owner, 0
            if text is not None and not self._in_link(element, known):
                length += len(text.strip())
        if not any(held):
            held = short
        end = list(range(size))  # last element inside
        for element in range(size - 1, 0, -1):
            up = self.parent[element]
            held[up] += held[element]
            end[up] = max(end[up], end[element])
        articles = [
            i for i in range(size)
            if self.tags[i] in ARTICLE_TAGS and not self.furniture[i] and 4 * held[i] >= held[0] > 0
        ]
        first_end = min((end[i] for i in articles), default=size)
        last_start = max(articles, default=-1)
        for element in self._hinted:
            beside = first_end < element or last_start > end[element]
            self.furniture[element] = beside or 2 * held[element] <= held[0]
        for element in range(1, size):
            self.furniture[element] |= self.furniture[self.parent[element]]

    def _in_link(self, element: int, known: dict[int, bool]) -> bool:
        path = []
        while element >= 0 and element not in known:
            path.append(element)
            if self.tags[element] == "a":
                known[element] = True
                break
            element = self.parent[element]
        found = known.get(element, False)
        for x in path:
            known[x] = found
        return found

    def _block_of(self, element: int) -> int:
        while self.tags[element] in INLINE:
            element = self.parent[element]
        return element

    def text(self) -> str:
        """The main text, blocks joined by one space."""
        visible = [(e, t) for e, t in self.pieces if not self.furniture[e]]
        keep = self._kept(visible)
        if keep is None:
            chosen = visible
        else:
            inside = [False] * len(self.tags)
            for element in range(len(self.tags)):  # parents come before their children
                up = self.parent[element]
                inside[element] = element in keep or (up >= 0 and inside[up])
            chosen = [(e, t) for e, t in visible if inside[e]]
        return " ".join("".join(" " if t is None else t for _, t in chosen).split())

    def _kept(self, visible: list[tuple[int, str | None]]) -> set[int] | None:
        """Roots of what is kept; None for everything."""
        size = len(self.tags)
        chars, linked = [0] * size, [0] * size
        known: dict[int, bool] = {}
        paragraphs: list[tuple[int, str]] = []
        block, parts = -1, []
        for element, text in [*visible, (0, None)]:
            owner = self._block_of(element)
            if text is None or owner != block:
                if parts:
                    paragraphs.append((block, " ".join("".join(parts).split())))
                block, parts = owner, []
            if text is not None:
                parts.append(text)
                length = len(text.strip())
                chars[element] += length
                if self._in_link(element, known):
                    linked[element] += length
        own_chars = list(chars)
        for element in range(size - 1, 0, -1):
            chars[self.parent[element]] += chars[element]
            linked[self.parent[element]] += linked[element]
        density = [linked[i] / chars[i] if chars[i] else 0.0 for i in range(size)]

        points: dict[int, float] = {}
        for element, text in paragraphs:
            if len(text) < LEAST_CHARS:
                continue
            given = 1 + text.count(",") + min(len(text) // 100, 3)
            # text right inside a container counts for the container itself
            at = self.parent[element] if self.tags[element] in ("p", "pre", "li", "td") else element
            for share in SHARES:
                if at < 0:
                    break
                start = points.get(at)
                base = TAG_POINTS.get(self.tags[at], 0.0) if start is None else start
                points[at] = base + given * share * (1 - density[element])
                at = self.parent[at]
        if not points:
            articles = [i for i in range(size) if self.tags[i] in ARTICLE_TAGS and chars[i]]
            articles = [i for i in articles if not self.furniture[i]]
            return {max(articles, key=lambda i: (chars[i], -i))} if articles else None
        score = {i: p * (1 - density[i]) for i, p in points.items()}
        best = max(score, key=lambda i: (score[i], -i))
        # an article element around the best container is the whole article
        at = best
        while at >= 0:
            if self.tags[at] in ARTICLE_TAGS:
                best = at
                if self.tags[at] == "article":
                    break
            at = self.parent[at]
        if self.tags[best] in ARTICLE_TAGS or self.parent[best] < 0:
            return {best}
        keep = {best}
        least = max(10.0, 0.2 * score.get(best, 0.0))
        for element in range(1, size):
            if self.parent[element] != self.parent[best] or self.furniture[element]:
                continue
            is_text = self.tags[element] in ("p", "h1", "h2", "h3", "blockquote", "pre")
            reads_well = is_text and own_chars[element] > 0 and density[element] < 0.25
            if score.get(element, 0.0) >= least or reads_well:
                keep.add(element)
        return keep


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def extract_text(df: DataFrame, html_column: str, carried: list[str]) -> DataFrame:
    """The columns ``carried`` and the main text of every page as ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [*batch.columns[:-1], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "text"])

    chosen = df.select(*carried, df[html_column].alias("_html"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]]
    return chosen.mapInArrow(run, ", ".join([*kinds, "text string"]))
