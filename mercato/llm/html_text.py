"""Main text of web pages by boosted trees over DOM nodes (operator 9).

A page's block elements and text runs are nodes; each has features of its
tag and ancestors, attribute tokens, depth, subtree density, links and
siblings.  Gradient-boosted trees (Spark ML) give the odds that a node is, or
holds, main text.  Decoding keeps the set of nodes with the greatest total
log-odds among those that contain every kept node's ancestors, so that no
node is kept inside a dropped one, nor a container without content.

The classifier is fitted on at most ``SAMPLE_PAGES`` pages of the table, those
with the lowest hash of their url and markup: once as they are where they mark their
article, and once as new layouts in which the same text fills articles,
menus, side bars, notices, adverts, forms and comments with common names.
Every page of the table is extracted.

Defined cases: null html is empty and has no text; markup that is cut off or
never closed is read as far as it goes; a quote that opens an attribute value
and is never closed takes the rest of the page into its tag, as in HTML; a page without main text gives the
empty string; null page ids and urls and repeated rows are kept; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import chunks, read_table

SAMPLE_PAGES, N_LAYOUTS = 300, 400
TREES, TREE_DEPTH, SEED = 20, 4, 11
BATCH_BYTES = 4 << 20

# Elements whose content is no text of the page, whole; a self-closed svg has none.
DROPPED = "script|style|noscript|template|svg|iframe|select|textarea|button|object|canvas|title"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{DROPPED})(?=[\s/>])(?!(?<=svg)[^>]*/>)[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote counts after "=" only; a value that is not closed goes on to the next quote or the end of the page.
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"?+|'[^']*+'?+)?+)*+)(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"?+|'([^']*+)'?+|([^\s>]++)))?+", re.S)
NAMES = frozenset(("class", "id", "role"))
LABEL = "data-y"  # in the layouts made here only; an attribute of that name in a page has no meaning
NAME = re.compile("[a-z]+")

TAGS = ("html", "body", "main", "article", "section", "div", "p", "h", "ul", "ol", "li", "dl", "dt", "dd", "table",
        "thead", "tbody", "tr", "td", "th", "form", "fieldset", "nav", "header", "footer", "aside", "blockquote", "pre",
        "figure", "figcaption", "address", "head", "details", "other")
BLOCKS = {**{t: i for i, t in enumerate(TAGS)}, **{f"h{k}": TAGS.index("h") for k in range(1, 7)},
          **dict.fromkeys(("hr", "dialog", "summary", "caption", "center", "hgroup", "menu", "search"), len(TAGS) - 1)}
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
# An open element that the start of another one closes.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "tbody": ("thead", "tbody"), "body": ("head",)}
WORDS = ("ad", "ads", "advert", "advertisement", "article", "banner", "body", "breadcrumb", "comment", "comments",
         "content", "cookie", "copyright", "entry", "footer", "form", "header", "links", "login", "main", "menu", "meta",
         "nav", "navigation", "newsletter", "notice", "page", "popup", "post", "promo", "related", "search", "share",
         "sidebar", "signup", "social", "sponsored", "story", "subscribe", "tags", "text", "toolbar", "widget")
WORD_AT = {w: i for i, w in enumerate(WORDS)}
UNDER = ("article", "main", "nav", "header", "footer", "aside", "form", "li", "table")
N_SHAPE = 13


class Page:
    """Block elements (0 is the root) and text runs of one page, in order;
    ``labelled``: with the labels of a layout."""

    def __init__(self, source: str, labelled: bool = False):
        self.parent, self.tag, self.words, self.label, self.run = [-1], [0], [()], [None], [None]
        open_at, open_names, text, links, link = [0], ["html"], [], 0, 0

        def close_run() -> None:
            nonlocal links
            if text:
                joined = " ".join(html.unescape("".join(text)).split())
                text.clear()
                if joined:
                    self.add(open_at[-1], -1, (), None, (joined, min(links, len(joined))))
                links = 0

        def leave(k: int) -> None:
            del open_at[k:], open_names[k:]

        for m in TOKEN.finditer(source):
            piece = m["text"]
            if piece is not None:
                text.append(piece)
                if link:
                    links += len(piece)
                continue
            name = m["tag"]
            if name is None:
                continue
            name = name.lower()
            if name not in BLOCKS:
                if name == "a":
                    link = not m["end"]
                elif name in VOID:
                    text.append(" ")
                continue
            close_run()
            link = 0
            if m["end"]:
                if name in open_names[1:]:
                    leave(len(open_names) - 1 - open_names[::-1].index(name))
                continue
            if name in ("html", "body") and name in open_names:
                continue
            if open_names[-1] == "p" or open_names[-1] in CLOSES.get(name, ()):
                leave(-1)
                if open_names[-1] in CLOSES.get(name, ()) and len(open_names) > 1:
                    leave(-1)
            if name in VOID:
                continue
            rest, words, label = m["rest"], (), None
            if "=" in rest:
                for a in ATTRIBUTE.finditer(rest):
                    name_of, value = a[1].lower(), a[2] or a[3] or a[4] or ""
                    if name_of in NAMES:
                        words += tuple(WORD_AT[w] for w in NAME.findall(value.lower()) if w in WORD_AT)
                    elif labelled and name_of == LABEL:
                        label = int(value)
            open_at.append(self.add(open_at[-1], BLOCKS[name], words, label, None))
            open_names.append(name)
        close_run()

    def add(self, parent: int, tag: int, words: tuple, label: int | None, run) -> int:
        for column, value in ((self.parent, parent), (self.tag, tag), (self.words, words), (self.label, label),
                              (self.run, run)):
            column.append(value)
        return len(self.parent) - 1


def features(pages: list[Page]) -> np.ndarray:
    """One row per node: shape, own tag, tags above, own and inherited words."""
    n = sum(len(p.parent) for p in pages)
    out = np.zeros((n, N_SHAPE + len(TAGS) + len(UNDER) + 2 * len(WORDS)), np.float32)
    own, under, words, above = (N_SHAPE + k for k in np.cumsum([0, len(TAGS), len(UNDER), len(WORDS)]))
    under_at = {TAGS.index(t): under + i for i, t in enumerate(UNDER)}
    base = 0
    for page in pages:
        size = len(page.parent)
        depth, place, runs, below = [0] * size, [0] * size, [0] * size, [0] * size
        chars, links, stops, kids, before = [0] * size, [0] * size, [0] * size, [0] * size, [0] * size
        read = 0
        for i in range(size):
            p = page.parent[i]
            before[i] = read
            if i:
                depth[i], place[i] = depth[p] + 1, kids[p]
                kids[p] += 1
            row = out[base + i]
            if p >= 0:
                row[under:words] = out[base + p, under:words]
                row[above:] = out[base + p, above:]
                at = under_at.get(page.tag[p])
                if at is not None:
                    row[at] = 1
                for w in page.words[p]:
                    row[above + w] = 1
            if page.run[i]:
                text, linked = page.run[i]
                chars[i], links[i], runs[i] = len(text), linked, 1
                stops[i] = text.count(".") + text.count(",")
                read += len(text)
                row[own + page.tag[p]] = 1
            else:
                row[own + page.tag[i]] = 1
            for w in page.words[i]:
                row[words + w] = 1
        for i in range(size - 1, 0, -1):
            p = page.parent[i]
            chars[p] += chars[i]
            links[p] += links[i]
            stops[p] += stops[i]
            runs[p] += runs[i]
            below[p] += below[i] + 1
        total, block = max(1, read), out[base:base + size]
        c, parents = np.array(chars, np.float32), np.maximum(0, page.parent)
        block[:, 0] = depth
        block[:, 1] = np.log1p(c)
        block[:, 2] = c / total
        block[:, 3] = np.array(links) / np.maximum(1, c)
        block[:, 4] = np.log1p(below)
        block[:, 5] = np.log1p(c / np.maximum(1, runs))
        block[:, 6] = np.array(stops) / np.maximum(1, c)
        block[:, 7] = np.array(place)
        block[:, 8] = np.log1p(np.array(kids)[parents])
        block[:, 9] = np.array(before) / total
        block[:, 10] = [r is not None for r in page.run]
        block[:, 11] = np.log1p(c[parents])
        block[:, 12] = np.log1p(runs)
        base += size
    return out


class Trees:
    """Exported regression trees, scored on all rows at once."""

    SPLIT = re.compile(r"(If|Else) \(feature (\d+) (?:<=|>) (\S+)\)")

    def __init__(self, debug_strings: list[str], weights: list[float]):
        self.trees = []
        for text, weight in zip(debug_strings, weights):
            lines = [line.strip() for line in text.splitlines()[1:] if line.strip()]
            nodes: list[list] = []

            def read(at: int) -> int:
                node: list = [0, 0.0, 0, 0, 0.0]  # feature, threshold, left, right, value
                nodes.append(node)
                m = self.SPLIT.match(lines[at])
                if not m:
                    node[2] = node[3] = len(nodes) - 1
                    node[1], node[4] = math.inf, weight * float(lines[at].removeprefix("Predict: "))
                    return at + 1
                node[0], node[1], node[2] = int(m[2]), float(m[3]), len(nodes)
                at = read(at + 1)
                node[3] = len(nodes)
                return read(at + 1)  # after the Else line

            read(0)
            self.trees.append(tuple(np.array(c) for c in zip(*nodes)))

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of main text."""
        every, out = np.arange(len(rows)), np.zeros(len(rows))
        for feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(rows), np.int64)
            for _ in range(TREE_DEPTH):
                at = np.where(rows[every, feature[at]] <= threshold[at], left[at], right[at])
            out += value[at]
        return 2 * out


def decoded(page: Page, odds: np.ndarray) -> str:
    """Text of the best consistent choice of nodes."""
    n = len(page.parent)
    best = [float(x) for x in odds]
    best[0] = 0.0
    for i in range(n - 1, 0, -1):
        if page.run[i] is None and best[i] - odds[i] <= 0:
            best[i] = 0.0  # nothing kept inside
        if best[i] > 0:
            best[page.parent[i]] += best[i]
    kept, out = [True] + [False] * (n - 1), []
    for i in range(1, n):
        kept[i] = kept[page.parent[i]] and best[i] > 0
        if kept[i] and page.run[i]:
            out.append(page.run[i][0])
    return "\n".join(out)


WRAPPERS = ("article", "main", 'div class="content"', 'div id="main-content"', 'div class="post"',
            'section class="entry"', 'article class="story"', 'div class="article-text"', 'div class="post-body"',
            'div class="entry-content"', 'main id="main"', 'div class="page-content"', 'div id="story"')
BOILERPLATE = {
    "links": ("nav", 'div class="menu"', 'ul class="nav"', 'div id="navigation"', 'div class="breadcrumb"',
              'div class="related"', 'div class="tags"', 'div class="share social"', 'div class="links"', "header", "footer"),
    "words": ("header", 'div id="header"', "footer", 'div class="footer"', "aside", 'div class="sidebar"',
              'div class="widget"', 'div class="cookie-notice"', 'div class="notice"', 'div class="banner"', 'div class="ad"',
              'div class="advert"', 'div class="ads"', 'div class="sponsored promo"', 'div class="newsletter signup"', "form",
              'form class="search"', 'div class="popup"', 'div class="copyright"', 'div class="meta"'),
    "talk": ('section class="comments"', 'div id="comments"', 'div class="comment"', 'ol class="comments"'),
}


def layout(rng: random.Random, texts: list[str]) -> str:
    """A labelled page: common wrappers filled with the given text."""
    def some(a: int, b: int) -> str:
        words = rng.choice(texts).split()
        n, at = rng.randint(a, b), rng.randrange(max(1, len(words)))
        return html.escape(" ".join(words[at:at + n] or words[:n]))

    def element(opening: str, y: int, inner: str) -> str:
        return f'<{opening} {LABEL}="{y}">{inner}</{opening.split()[0]}>'

    def boilerplate() -> str:
        kind = rng.choice(("links", "words", "words", "talk"))
        if kind == "links":
            item = [f'<a href="/x">{some(1, 3)}</a>' for _ in range(rng.randint(3, 9))]
            inner = "".join(element("li", 0, x) for x in item) if rng.random() < 0.7 else " ".join(item)
            inner = element("ul", 0, inner) if rng.random() < 0.5 else inner
        elif kind == "words":
            inner = some(3, 25) if rng.random() < 0.6 else "".join(
                element("p", 0, some(3, 20)) for _ in range(rng.randint(1, 3)))
        else:
            inner = "".join(element(rng.choice(("p", "div", "li")), 0, some(5, 60)) for _ in range(rng.randint(1, 6)))
        return element(rng.choice(BOILERPLATE[kind]), 0, inner)

    parts = [element(rng.choice(("h1", "h2")), 1, some(2, 12))]
    for _ in range(rng.choice((1, 1, 2, 3, 5, 8, 13))):
        kind = rng.random()
        if kind < 0.78:
            parts.append(element("p", 1, some(1, 120)))
        elif kind < 0.84:
            parts.append(element(rng.choice(("h2", "h3")), 1, some(1, 6)))
        elif kind < 0.9:
            parts.append(element(rng.choice(("ul", "ol")), 1, "".join(
                element("li", 1, some(2, 15)) for _ in range(rng.randint(2, 5)))))
        elif kind < 0.95:
            parts.append(element("blockquote", 1, element("p", 1, some(5, 40))))
        else:
            parts.append(element("table", 1, "".join(element("tr", 1, element("td", 1, some(1, 4)) + element(
                "td", 1, some(1, 4))) for _ in range(rng.randint(2, 5)))))
    for _ in range(rng.choice((0, 0, 0, 1, 2))):
        parts.insert(rng.randrange(1, len(parts) + 1), boilerplate())
    body = element(rng.choice(WRAPPERS), 1, "".join(parts))
    if rng.random() < 0.3:
        body = element("div", 1, body + (boilerplate() if rng.random() < 0.5 else ""))
    around = [boilerplate() for _ in range(rng.randint(1, 6))]
    at = rng.randint(0, len(around))
    return element("body", 1, "".join([*around[:at], body, *around[at:]]))


def marked(page: Page) -> bool:
    """Labels a page by its own one article element, where it has one."""
    articles = [i for i, t in enumerate(page.tag) if t == TAGS.index("article")]
    if len(articles) != 1:
        return False
    never = {TAGS.index(t) for t in ("nav", "header", "footer", "aside", "form")}
    page.label, up = [0] * len(page.tag), articles[0]
    while up >= 0:
        page.label[up], up = 1, page.parent[up]
    for i in range(articles[0] + 1, len(page.tag)):
        p = page.parent[i]
        inside = page.label[p] and p >= articles[0]
        page.label[i] = int(inside and page.tag[i] not in never)
    return True


def training_rows(sources: list[str], seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the sampled pages and of layouts of their text."""
    rng, pages = random.Random(seed), [Page(s) for s in sources]
    texts = [r[0] for p in pages for r in p.run if r and len(r[0]) > 20] or ["some text, as pages have it. " * 5]
    layouts = [Page(layout(rng, texts), labelled=True) for _ in range(N_LAYOUTS)]
    for page in layouts:
        page.label[0] = 1
        for i, run in enumerate(page.run):
            if run:  # a run is what its element is; loose text beside others is not
                page.label[i] = page.label[page.parent[i]]
    labelled = [p for p in pages if marked(p)] + layouts
    return features(labelled), np.array([y for p in labelled for y in p.label])


def fit(pages: DataFrame) -> Trees:
    """Boosted trees on a bounded sample of the table's pages."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.linalg import Vectors

    hashed = pages.select(F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
                          F.xxhash64("url", "html").alias("h"))
    # The hashes alone tell which pages; of equal pages one is sent.
    lowest = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(SAMPLE_PAGES).collect()]
    sample = hashed.where(F.col("h") <= max(lowest, default=0)).groupBy("h").agg(F.min("html").alias("html"))
    rows, labels = training_rows([r["html"] for r in sample.orderBy("h").collect()])
    spark = pages.sparkSession
    held = ((Vectors.sparse(len(x), np.flatnonzero(x), x[x != 0].astype(float)), float(y)) for x, y in zip(rows, labels))
    data = spark.createDataFrame(list(held), ["features", "label"]).coalesce(4)
    model = GBTClassifier(maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=0.3, seed=SEED).fit(data)
    return Trees([t.toDebugString for t in model.trees], model.treeWeights)


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    trees = fit(pages)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html", BATCH_BYTES):
            parsed = [Page(s) for s in batch["html"].to_pylist()]
            odds = trees(features(parsed))
            ends = np.cumsum([len(p.parent) for p in parsed])
            texts = [decoded(p, odds[e - len(p.parent):e]) for p, e in zip(parsed, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"
    return rows.mapInArrow(extract, schema)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(read_table(spark, sf_dir, "pages"))
