"""Main-text extraction: boosted trees over DOM nodes, hierarchical decoding.

Every block element of a page is a node with features: its tag and its
class/id/role tokens by group, the same of its ancestors, subtree statistics
(text, words, punctuation, links, elements per character), depth, place in
the page and statistics of its siblings.  Gradient-boosted trees give its
log-odds of belonging to the article.

Decoding picks the best consistent set of nodes: a node that is dropped
drops all that is below it, so a kept paragraph never sits in a dropped
sidebar.  Bottom-up, ``best(v) = max(0, odds(v) + sum of best(children))``;
top-down, a node stays if its parent stays and its best is positive.  Kept
nodes give their own text; blocks come in page order.  Runs of text directly
in the body are nodes as well; trees of their own judge them.

Training: at most SAMPLE_PAGES pages of the table (one per hash bin), whose
semantic elements and names label their nodes, and LAYOUT_PAGES made pages
that show boilerplate the table may lack; for runs, as many bare ones.  Each other training page is used twice,
once with its semantic tags and names masked, so that density, depth and
sibling statistics are learned as well as names.  Node rows reach the driver
as at most MAX_ROWS feature vectors.

Text rules: character references are decoded, white space inside a block
becomes one space, blocks are trimmed, empty ones left out, and the rest
joined by two line feeds.  Defined results: null, empty or text-free html
gives an empty text; repeated rows and a null page_id are extracted each;
if no page can be learned from, the made pages alone train the model.
Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import gbt
from pitchlake.llm.common import in_slices, table
from pitchlake.llm.dom import RUN, Node, parse
from pitchlake.llm.layouts import bare_page, training_page
from pitchlake.llm.sampling import one_per_bin

SAMPLE_PAGES, LAYOUT_PAGES, MAX_ROWS = 256, 800, 40_000
PAGES_AT_ONCE = 256

# Groups of tags, and of name tokens that authors use.
TAG_GROUPS = (
    ("article", "main"), ("section",), ("nav", "menu"), ("header", "hgroup"), ("footer",), ("aside",),
    ("form", "fieldset", "label", "legend", "search", "dialog"), ("ul", "ol", "dl"), ("li", "dt", "dd"),
    ("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"), ("p",), ("h1", "h2", "h3", "h4", "h5", "h6"),
    ("blockquote", "pre", "figure", "figcaption"), ("html", "body", "page"),
)
NAME_GROUPS = (
    ("article", "content", "post", "entry", "main", "story", "text", "body"),
    ("nav", "navbar", "navigation", "menu", "topmenu", "breadcrumb", "breadcrumbs", "pagination", "toc"),
    ("header", "masthead", "top", "branding", "logo", "toolbar"),
    ("footer", "bottom", "copyright", "legal", "credits"),
    ("sidebar", "side", "aside", "widget", "related", "recommended", "trending", "more", "popular", "complementary"),
    ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner"),
    ("cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "newsletter", "subscribe", "overlay", "disclaimer"),
    ("comment", "comments", "disqus", "reply", "replies", "responses", "discussion", "reader"),
    ("share", "sharing", "social", "follow", "tweet"),
    ("form", "search", "login", "signin", "signup", "register", "contact"),
)
_TAG_GROUP = {t: i for i, g in enumerate(TAG_GROUPS) for t in g}
_NAME_GROUP = {t: i for i, g in enumerate(NAME_GROUPS) for t in g}
_T, _N = len(TAG_GROUPS), len(NAME_GROUPS)
_SEMANTIC = frozenset(range(0, 7))  # tag groups that masking turns into plain divisions
ARTICLE, GOOD_NAME, SECTION, HEADER = 0, 0, 1, 3
WIDTH = 2 * (_T + _N) + 21


@dataclass
class Model:
    blocks: gbt.Boosted
    runs: gbt.Boosted

    def decide(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of nodes; the last feature tells runs from blocks."""
        out, run = self.blocks.decide(x[:, :-1]), x[:, -1] > 0
        if run.any():
            out[run] = self.runs.decide(x[run, :-1])
        return out


def features(nodes: list[Node], masked: bool = False) -> np.ndarray:
    """One row per node; ``masked`` hides semantic tags and all names."""
    n = len(nodes)
    x = np.zeros((n, WIDTH), dtype=np.float32)
    parent = np.array([v.parent for v in nodes])
    own = np.zeros((n, 6))  # characters, words, punctuation, linked characters, links, elements
    for i, v in enumerate(nodes):
        if (g := _TAG_GROUP.get(v.tag)) is not None and not (masked and g in _SEMANTIC):
            x[i, g] = 1
        if not masked and v.tokens:
            for t in v.tokens:
                if (g := _NAME_GROUP.get(t)) is not None:
                    x[i, _T + g] = 1
        for _, text in v.segments:
            own[i, 0] += len(text)
            own[i, 1] += text.count(" ") + 1
            own[i, 2] += text.count(".") + text.count(",") + text.count("?") + text.count("!") + text.count(";")
        own[i, 3], own[i, 4], own[i, 5] = v.linked, v.links, v.inline + 1
    flags = _T + _N
    below = own.copy()
    children = np.zeros(n)
    for i in range(n - 1, 0, -1):  # children come after their parents
        below[parent[i]] += below[i]
        children[parent[i]] += 1
    for i in range(1, n):  # what an ancestor is, its descendants are in
        p = parent[i]
        np.maximum(x[p, :flags], x[p, flags:2 * flags], out=x[i, flags:2 * flags])
    chars = np.maximum(below[:, 0], 1)
    before = np.concatenate([[0], np.cumsum(own[:-1, 0])])
    safe = np.maximum(parent, 0)
    rank = np.zeros(n)
    seen: dict[int, int] = {}
    for i in range(1, n):
        rank[i] = seen.get(parent[i], 0)
        seen[parent[i]] = int(rank[i]) + 1
    group_chars = np.bincount(safe[1:], below[1:, 0], n)
    group_links = np.bincount(safe[1:], below[1:, 3], n)
    siblings = np.maximum(children[safe], 1)
    is_p = np.array([v.tag == "p" for v in nodes], dtype=float)
    paragraphs = np.bincount(safe[1:], is_p[1:], n)
    x[:, 2 * flags:] = np.column_stack([
        np.log1p(own[:, 0]), np.log1p(below[:, 0]), np.log1p(below[:, 1]), below[:, 1] / np.maximum(1, below[:, 5]),
        below[:, 2] / np.maximum(1, below[:, 1]), below[:, 3] / chars, np.log1p(below[:, 4]), below[:, 5] / chars * 100,
        below[:, 0] / max(1, below[0, 0]), before / max(1, below[0, 0]), [v.depth for v in nodes], children,
        rank / siblings, siblings, group_chars[safe] / siblings / 100, below[:, 0] / np.maximum(1, group_chars[safe]),
        group_links[safe] / np.maximum(1, group_chars[safe]), paragraphs[safe], paragraphs, own[:, 3] / np.maximum(1, own[:, 0]),
        [v.tag == RUN for v in nodes]])
    return x


def weak_labels(nodes: list[Node]) -> np.ndarray:
    """1 article, 0 boilerplate, -1 unknown, from marks, tags and names."""
    out = np.full(len(nodes), -1)
    for i, v in enumerate(nodes):
        if i == 0 or v.tag in ("html", "body"):
            continue
        above = out[v.parent]
        tag, names = _TAG_GROUP.get(v.tag), {_NAME_GROUP[t] for t in v.tokens if t in _NAME_GROUP}
        if v.keep is not None:
            out[i] = int(v.keep)
        elif above == 0:
            out[i] = 0
        elif tag in _SEMANTIC and tag not in (ARTICLE, SECTION) and not (tag == HEADER and above == 1):
            out[i] = 0
        elif names and GOOD_NAME not in names:
            out[i] = 0
        elif tag == ARTICLE or GOOD_NAME in names:
            out[i] = 1
        else:
            out[i] = above
    return out


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """The consistent choice of nodes with the largest sum of log-odds."""
    best = odds.astype(float).copy()
    for i, v in enumerate(nodes):
        if i == 0 or v.tag in ("html", "body"):
            best[i] = 0.0  # the page itself is always open
    for i in range(len(nodes) - 1, 0, -1):
        if best[i] > 0:
            best[nodes[i].parent] += best[i]
    kept = [True] * len(nodes)
    for i, v in enumerate(nodes):
        if i and v.tag not in ("html", "body"):
            kept[i] = kept[v.parent] and bool(best[i] > 0)
    return kept


def text_of(nodes: list[Node], kept: list[bool]) -> str:
    parts = [s for v, k in zip(nodes, kept) if k for s in v.segments]
    return "\n\n".join(t for _, t in sorted(parts))


def extract(pages: list[str | None], model: Model) -> list[str]:
    """The main text of each page; nodes of all pages are scored together."""
    parsed = [parse(h) for h in pages]
    odds = model.decide(np.vstack([features(p) for p in parsed])) if parsed else np.zeros(0)
    out, at = [], 0
    for p in parsed:
        out.append(text_of(p, decode(p, odds[at:at + len(p)])))
        at += len(p)
    return out


def training_rows(html: str | None, masked: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Labelled nodes of a page, seen and, if asked for, masked."""
    nodes = parse(html)
    y = weak_labels(nodes)
    use = y >= 0
    if not masked:
        return features(nodes)[use], y[use]
    return np.vstack([features(nodes)[use], features(nodes, masked=True)[use]]), np.concatenate([y[use], y[use]])


def train(pages: DataFrame) -> Model:
    """Fit on a bounded sample of the table's pages and on made pages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, "html"):
            for page, html in zip(b.column("doc_id").to_pylist(), b.column("html").to_pylist()):
                x, y = training_rows(html)
                most = MAX_ROWS // (2 * SAMPLE_PAGES)  # a long page gives evenly spread nodes
                step = max(1, -(-len(y) // most))
                yield pa.RecordBatch.from_arrays([pa.array([page]), pa.array([x[::step].tobytes()]), pa.array([y[::step].astype(np.int8).tobytes()])],
                                                 ["page_id", "x", "y"])
    sample = one_per_bin(pages.select(F.col("page_id").cast("bigint").alias("doc_id"), "html").where("html is not null"), SAMPLE_PAGES)
    rows = sorted(sample.select("doc_id", "html").mapInArrow(run, "page_id bigint, x binary, y binary")
                  .limit(SAMPLE_PAGES).collect(), key=lambda r: r.page_id)
    xs = [np.frombuffer(bytes(r.x), dtype=np.float32).reshape(-1, WIDTH) for r in rows]
    ys = [np.frombuffer(bytes(r.y), dtype=np.int8) for r in rows]
    made = [training_rows(training_page(seed)) for seed in range(LAYOUT_PAGES)]
    # an advert directly in the body is told from a short article by its name alone
    bare = [training_rows(bare_page(seed), masked=False) for seed in range(LAYOUT_PAGES)]
    is_run = [x[:, -1] > 0 for x in xs]
    runs = _fit([x[k] for x, k in zip(xs, is_run)] + [x[x[:, -1] > 0] for x, _ in bare],
                [y[k] for y, k in zip(ys, is_run)] + [y[x[:, -1] > 0] for x, y in bare])
    most = MAX_ROWS - sum(map(len, ys))
    mx, my = np.vstack([x for x, _ in made]), np.concatenate([y for _, y in made])
    step = max(1, -(-len(my) // most))
    return Model(_fit([*[x[~k] for x, k in zip(xs, is_run)], mx[::step]], [*[y[~k] for y, k in zip(ys, is_run)], my[::step]]), runs)


def _fit(xs: list[np.ndarray], ys: list[np.ndarray]) -> gbt.Boosted:
    x, y = np.vstack(xs)[:, :-1], np.concatenate(ys).astype(float)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())) * len(y)
    return gbt.fit(x, y, weight)


def extract_main_text(pages: DataFrame, model: Model) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``."""
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, "html", max_rows=PAGES_AT_ONCE):
            texts = extract(b.column("html").to_pylist(), sent.value)
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page of ``pages``."""
    pages = table(spark, sf_dir, "pages")
    return extract_main_text(pages, train(pages))
