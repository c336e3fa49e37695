"""A small, tolerant DOM: block elements, their text and what surrounds them.

Only what extraction needs: elements that start a block become nodes; inline
elements and formulas are transparent (links are counted); scripts, styles,
media and form controls are skipped with all they hold.  Only raw text
(RAW) without an end tag runs to the end of the page, as HTML says; another
skipped element without an end tag of its own in its enclosing block ends at
the next block.  Text directly in the page, html or body is no node's own text:
each run of it up to the next block becomes a node (RUN) with the names of
its inline elements.  End tags that HTML lets authors omit are implied.  Every
step is a loop over tags, so depth is no limit.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass, field
from html import unescape

_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_ATTRIBUTES = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
_SKIPPED_TAG = re.compile(r"<(?:template|noscript|svg|canvas|object|select|button|option|video|audio|datalist)(?=[\s/>])", re.I)
_ATTRIBUTE = re.compile(r"(?<![\w-])([a-zA-Z][\w-]*+)\s*+=\s*+(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_TOKEN = re.compile(r"[a-z]+|[0-9]+")

BLOCKS = frozenset(
    "html body article main section nav header footer aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot "
    "tr td th caption blockquote pre figure figcaption address form fieldset legend label details summary hr center dialog menu "
    "hgroup search".split())
RAW = frozenset("script style title iframe textarea".split())  # hold text only, up to their end tag
SKIPPED = frozenset("template noscript svg canvas object select button option video audio datalist".split())
_NESTING = frozenset({"template", "svg", "object"})  # any other skipped element ends an open one of its kind
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES_P = BLOCKS - {"html", "body"}
#: an opening tag ends these open elements, up to the given limits
_IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"})}


RUN = "#run"
_TOP = frozenset({"page", "html", "body"})


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: set[str] | frozenset[str]
    segments: list[tuple[int, str]] = field(default_factory=list)  # (order in page, text)
    linked: int = 0      # characters of own text inside links
    links: int = 0
    inline: int = 0      # inline elements among own text
    keep: str | None = None  # data-keep of a training page


def tokens_of(attributes: str) -> tuple[frozenset[str], str | None]:
    """Lower-case word tokens of class, id and role; the training mark."""
    out, keep = [], None
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role"):
            value = re.sub(r"([a-z])([A-Z])", r"\1 \2", value)
            out += _TOKEN.findall(value.lower())
        elif name == "data-keep":
            keep = value.strip("\"'")
    return frozenset(out), keep


class Tags:
    """The tags of a page, each found in a time that all of the page's tags
    share: what was looked for in vain is not looked for again."""

    def __init__(self, html: str):
        self.html, self.last = html, html.rfind(">")
        self.places: list[int] | None = None   # quotes and ``>``, once a tag's quotes have not closed
        self.found: dict[str, re.Match | None] = {}

    def next(self, at: int) -> tuple[int, int, str, str | None, str] | None:
        """(start, end, slash, tag, attributes) of the first tag from ``at``;
        a comment or declaration has no tag."""
        html = self.html
        while (start := html.find("<", at)) >= 0:
            if start > self.last:  # only a comment can come
                rest = [i for i in (html.find("<!", start), html.find("<?", start)) if i >= 0]
                if not rest:
                    return None
                start = min(rest)
            m = _MARK.match(html, start)
            if m and m[2] is None:
                return start, m.end(), "", None, ""
            if m and (end := self._end(m.end())) >= 0:
                return start, end + 1, m[1], m[2].lower(), html[m.end():end]
            at = start + 1
        return None

    def _end(self, at: int) -> int:
        """Where the tag whose attributes begin at ``at`` has its ``>``: outside
        of quotes, or the first one if the quotes do not close; -1: nowhere."""
        if self.places is None:
            end = _ATTRIBUTES.match(self.html, at).end()
            if end < len(self.html) and self.html[end] == ">":
                return end
            self._prepare()
        k = bisect_left(self.places, at)
        return self.ends[k] if self.ends[k] >= 0 else self.html.find(">", at) if at <= self.last else -1

    def _prepare(self) -> None:
        """For each quote or ``>``, read outside of quotes: where the tag ends."""
        html = self.html
        self.places = [m.start() for m in re.finditer("[>\"']", html)]
        self.ends = [-1] * (len(self.places) + 2)
        later = {'"': len(self.places), "'": len(self.places)}   # the next quote of a kind
        for k in range(len(self.places) - 1, -1, -1):
            c = html[self.places[k]]
            self.ends[k] = self.places[k] if c == ">" else self.ends[later[c] + 1]
            if c != ">":
                later[c] = k

    def search(self, pattern: str, at: int) -> re.Match | None:
        """First match from ``at`` on; asked for ever later places."""
        if pattern not in self.found or self.found[pattern] and self.found[pattern].start() < at:
            self.found[pattern] = re.compile(pattern, re.I).search(self.html, at)
        return self.found[pattern]

    def end_of(self, tag: str, at: int) -> int | None:
        """The end of the next end tag of ``tag``."""
        done = self.search(rf"</{tag}(?=[\s/>])", at) if at <= self.last else None
        end = self.html.find(">", done.end()) if done else -1
        return end + 1 if end >= 0 else None


class OpenBlocks(list):
    """Open elements (tag, ...), innermost last, with the places of each tag."""

    def __init__(self, *first: tuple):
        super().__init__(first)
        self.of: dict[str, list[int]] = {}

    def push(self, tag: str, what: int) -> None:
        self.of.setdefault(tag, []).append(len(self))
        self.append((tag, what))

    def cut(self, upto: int) -> None:
        """End all from place ``upto`` on."""
        for tag, _ in self[upto:]:
            if tag:
                self.of[tag].pop()
        del self[upto:]

    def end_one(self, at: int) -> None:
        """End the innermost of its tag alone; what it holds stays open."""
        self.of[self[at][0]].pop()
        self[at] = ("", -1)

    def last(self, tags, limits=()) -> int | None:
        """Place of the innermost of ``tags`` that is inside of all ``limits``."""
        at = max((self.of[t][-1] for t in tags if self.of.get(t)), default=-1)
        return at if at > max((self.of[t][-1] for t in limits if self.of.get(t)), default=-1) else None


def skipped_spans(html: str) -> dict[int, int]:
    """Start and end of the skipped elements that are closed by an end tag of
    their own before their enclosing block ends."""
    out: dict[int, int] = {}
    if not _SKIPPED_TAG.search(html):
        return out
    open_, tags = OpenBlocks(), Tags(html)  # open blocks and skipped elements: tag, start
    at = 0
    while m := tags.next(at):
        start, at, slash, tag, attributes = m
        if tag is None:
            continue
        known = tag in BLOCKS or tag in SKIPPED or tag == "head"
        if slash:
            if known and (i := open_.last((tag,))) is not None:
                if tag in SKIPPED:
                    out[open_[i][1]] = at
                open_.cut(i)
        elif tag in RAW:
            if not attributes.endswith("/") or tag in ("script", "style") and not open_.of.get("svg"):
                at = tags.end_of(tag, at) or len(html)
        elif known and tag != "hr" and not (tag in SKIPPED and attributes.endswith("/")):
            if tag in SKIPPED - _NESTING and (i := open_.last((tag,))) is not None:
                open_.end_one(i)
            elif tag == "body" and (i := open_.last(("head",))) is not None:
                open_.cut(i)
            elif tag in _CLOSES_P and open_ and open_[-1][0] == "p":
                open_.cut(len(open_) - 1)
            if tag in _IMPLIED:
                ends, limits = _IMPLIED[tag]
                while (i := open_.last(ends, limits)) is not None:
                    open_.cut(i)
            open_.push(tag, start)
    return out


def parse(html: str | None) -> list[Node]:
    """Nodes in page order; node 0 is the page."""
    html = html or ""
    nodes = [Node("page", -1, 0, frozenset())]
    open_, tags = OpenBlocks(("page", 0)), Tags(html)  # open blocks: tag, node
    buffer: list[str] = []
    linked = in_link = order = at = 0
    spans = skipped_spans(html)
    muted = ""       # the skipped element without an end tag that text is in
    formula = False  # inside <math>, whose elements are no sign of boilerplate
    run = Node(RUN, 0, 0, set())  # what stands directly in the page since the last block

    def flush() -> None:
        nonlocal linked, order, muted, formula, run
        muted, formula = "", False
        if buffer:
            text = " ".join(unescape("".join(buffer)).split())
            if text:
                node = nodes[open_[-1][1]]
                if node.tag in _TOP:
                    run.parent, run.depth = open_[-1][1], node.depth + 1
                    nodes.append(run)
                    node, run = run, Node(RUN, 0, 0, set())
                node.segments.append((order, text))
                node.linked += min(linked, len(text))
                order += 1
            buffer.clear()
        if run.inline:  # inline elements without text
            nodes[open_[-1][1]].inline += run.inline
            nodes[open_[-1][1]].links += run.links
            run = Node(RUN, 0, 0, set())
        linked = 0

    def close(upto: int) -> None:
        flush()
        open_.cut(upto)

    while at < len(html):
        m = tags.next(at)
        end = m[0] if m else len(html)
        if end > at and not muted:
            buffer.append(html[at:end])
            if in_link:
                linked += end - at
        if not m:
            break
        start, at, slash, tag, attributes = m
        if tag is None:
            continue
        if slash:
            if tag == "a":
                in_link = 0
            elif tag == "math":
                formula = False
            elif tag == muted:
                muted = ""
            elif tag == "p" and open_.last(("p",)) is None:
                flush()
            elif tag in BLOCKS and (i := open_.last((tag,))) is not None:
                close(i)
            continue
        if tag in RAW:
            if not attributes.endswith("/") or tag in ("script", "style") and muted != "svg":
                at = tags.end_of(tag, at) or len(html)
            continue
        if tag == "head":
            if not attributes.endswith("/"):  # an open head ends with the body
                body = tags.search(r"(?=<body\b)", at)
                at = tags.end_of("head", at) or (body.end() if body else at)
            continue
        if tag in SKIPPED:
            if start in spans:
                at = spans[start]
            elif not attributes.endswith("/"):
                muted = tag
            continue
        if tag in VOID and tag != "hr":
            if tag == "br" and not muted:
                buffer.append(" ")
            continue
        if tag not in BLOCKS:
            if muted or formula:
                continue
            formula = tag == "math" and not attributes.endswith("/")
            node = nodes[open_[-1][1]]
            if node.tag in _TOP:
                node = run
                tokens, keep = tokens_of(attributes) if attributes else (frozenset(), None)
                node.tokens.update(tokens)
                node.keep = node.keep or keep
                if keep and not tokens:  # a training mark is no element of the page
                    continue
            node.inline += 1
            if tag == "a":
                node.links += 1
                in_link = 1
            continue
        flush()
        if tag in _CLOSES_P and open_[-1][0] == "p":
            close(len(open_) - 1)
        if tag[0] == "h" and tag[1:].isdigit() and open_[-1][0][0] == "h" and open_[-1][0][1:].isdigit():
            close(len(open_) - 1)
        if tag in _IMPLIED:
            ends, limits = _IMPLIED[tag]
            while (i := open_.last(ends, limits)) is not None:
                close(i)
        if tag == "hr":
            continue
        tokens, keep = tokens_of(attributes) if attributes else (frozenset(), None)
        nodes.append(Node(tag, open_[-1][1], nodes[open_[-1][1]].depth + 1, tokens, keep=keep))
        open_.push(tag, len(nodes) - 1)
    flush()
    return nodes
