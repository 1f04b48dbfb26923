"""Main text of web pages by a tree-structured graphical model.

The block elements of a page form a tree.  Every node is content or not; a
node's own evidence (its tag, the words of its class, id and role, text and
link density) gives a log-odds, and parent and child are tied by potentials
that differ for containers and for text blocks.  Sum-product messages go
upward from the leaves and back down from the root and give each node's exact
marginal; a block of text is kept when its node's marginal is at least 1/2.

Weights and potentials are trained from labelled pages: the hand-labelled
layouts below (``data-y`` is the label of an element and all below it) and, if
pages are given to ``train``, a bounded sample of them labelled by their own
semantic elements, seen both as they are and with those elements renamed to
``div``, so that other evidence is learned too.

Text: character references decoded, white space inside a block one space,
trimmed; blocks in page order joined by one newline.  ``br`` ends a block.
Null or empty html gives an empty text; broken markup is read leniently;
repeated rows give the same result each; an empty table an empty one; columns
besides id, url and html are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, prepare

SAMPLE = 400  # pages of the table that training may look at
# --- fixed values: kinds of HTML elements, cue words ----------------------
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"script", "style", "noscript", "template", "head", "title", "iframe", "svg", "object", "canvas", "select",
          "button", "textarea", "datalist", "audio", "video", "map"}
CONTAINERS = {"html", "body", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "ul", "ol", "dl",
              "table", "thead", "tbody", "tfoot", "tr", "fieldset", "details", "dialog", "menu", "figure", "center", "hgroup", "search"}
LEAVES = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "caption", "blockquote", "pre", "figcaption",
          "address", "summary", "legend", "option"}
CLOSES_P = CONTAINERS | LEAVES | {"hr"}
HEAD = {"base", "link", "meta", "noscript", "script", "style", "template", "title"}  # what may stand in a head
ENDS_LOST = (CONTAINERS | LEAVES) - {"option"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BAD_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset", "search"}
GOOD_TAGS = {"article", "main"}
BAD_WORDS = set("""nav navbar navigation menu header footer masthead sidebar side aside notice notices cookie cookies consent gdpr banner
ad ads adv advert adverts advertisement advertising promo promotion sponsor sponsored comment comments reply replies respond disqus
discussion form login signup subscribe subscription newsletter share sharing social related recommended recommendations more popular trending
breadcrumb breadcrumbs pagination pager toolbar widget popup modal overlay alert copyright legal disclaimer search tags toc""".split())
GOOD_WORDS = set("article content entry post story body main text maincontent articlebody page prose".split())
# --- end fixed values -----------------------------------------------------

# --- fixed values: labelled layouts ----------------------------------------
LONG = "Some sentences of running text stand here, with commas and full stops, as in a report. They go on for a while."
LAYOUTS = [
    f"<body><header data-y=0><h1>Site</h1><nav><ul><li><a>Home</a><li><a>News</a></ul></nav></header><main data-y=1><h1>Title</h1><p>{LONG}<p>{LONG}</main><aside data-y=0><h3>Related</h3><ul><li><a>One</a></ul><p>{LONG}</aside><footer data-y=0><p>Copyright words</footer></body>",
    f"<body><div class=cookie-notice data-y=0><p>{LONG}</p></div><div id=content data-y=1><h2>Title</h2><p>{LONG}</p><ul><li>{LONG}<li>{LONG}</ul></div><div class=sidebar data-y=0><p>{LONG}</p></div><div class=footer data-y=0>Terms</div></body>",
    f"<body><article data-y=1><h1>Title</h1><div class=ad data-y=0>{LONG}</div><p>{LONG}</p><blockquote><p>{LONG}</p></blockquote><section><h2>Part</h2><p>{LONG}</p><p>Short.</p></section></article><section class=comments data-y=0><h3>Comments</h3><div class=comment><p>{LONG}</p></div><div class=comment><p>{LONG}</p></div><form><label>Name</label><p>Send us a line</p></form></section></body>",
    f"<body><div class=wrap><div class=top-menu data-y=0><a>Home</a> <a>About</a></div><div class=post data-y=1><p>{LONG}</p><p>{LONG}</p><p>A short one</p></div><div id=comments data-y=0><p>{LONG}</p><p>{LONG}</p></div></div></body>",
    f"<body><div data-y=0><a>Home</a> | <a>Shop</a> | <a>Help</a></div><div data-y=1><h1>Title</h1><p>{LONG}</p><p>{LONG}</p><table><tr><td>12</td><td>{LONG}</td></tr></table></div><div data-y=0><a>Terms</a> <a>Privacy</a></div></body>",
    f"<body><article data-y=1><header><h1>Title</h1></header><p>{LONG}</p><p>Yes.</p><ol><li>One point</li><li>{LONG}</li></ol><div class=share data-y=0><a>Post this</a></div><aside data-y=0><p>{LONG}</p></aside></article><form data-y=0><p>Subscribe to our letter</p><input></form><div class=advert data-y=0>Buy things now</div></body>",
    f"<body><div role=banner data-y=0><p>The daily site</p></div><div role=main data-y=1><p>{LONG}</p><div><p>{LONG}</p><pre>code text</pre></div></div><div class='widget newsletter' data-y=0><p>{LONG}</p></div><div role=contentinfo data-y=0><p>Imprint</p></div></body>",
    f"<body><article data-y=1><p>{LONG}</p><aside data-y=0><h4>See also</h4><p>{LONG}</p></aside><p>{LONG}</p><nav data-y=0><p>{LONG}</p></nav><p>{LONG}</p><form data-y=0><p>{LONG}</p></form></article><aside data-y=0><p>{LONG}</p></aside><footer data-y=0><p>{LONG}</p></footer></body>",
    f"<body><p data-y=1>{LONG}</p><p data-y=1>{LONG}</p><h2 data-y=1>Part</h2><p data-y=1>Short text.</p><div class=alert data-y=0>{LONG}</div><ul class=menu data-y=0><li><a>One</a><li><a>Two</a></ul></body>",
]
# --- end fixed values -----------------------------------------------------
SPACE = re.compile(r"\s+")
CUE = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Node:
    __slots__ = ("tag", "parent", "cues", "label", "chars", "link_chars", "commas")

    def __init__(self, tag, parent, cues, label):
        self.tag, self.parent, self.cues, self.label = tag, parent, cues, label
        self.chars = self.link_chars = self.commas = 0


class Page(HTMLParser):
    """Block elements (``nodes``, parents first) and text blocks
    ``(node, text)`` in page order.

    A hidden element without an end tag of its own (a head may leave it out)
    hides what follows only up to the next block element.  That there is none
    is known at the end, so such a page is read a second time."""

    def __init__(self, html: str):
        self.read(html, set())
        if self.lost:
            self.read(html, set(self.lost))

    def read(self, html: str, known: set[int]):
        super().__init__(convert_charrefs=True)
        self.known, self.lost = known, set()  # hidden elements without an end tag, by number
        self.n_hidden = 0
        self.nodes = [Node("#page", -1, set(), None)]
        self.blocks: list[tuple[int, str]] = []
        self.stack: list[tuple[str, int, int]] = []  # open elements; node of block elements, number of hidden ones, else -1
        # of the open elements: how many of each tag, the block ones' nodes, the known lost ones
        self.open: Counter[str] = Counter()
        self.within = [0]
        self.open_known = 0
        self.hidden = self.links = 0
        self.text: list[str] = []
        self.feed(html)
        self.close()
        self.flush()
        self.lost |= {k for _, _, k in self.stack if k >= 0}

    def block(self) -> int:
        return self.within[-1]

    def flush(self):
        if self.text:
            text = SPACE.sub(" ", "".join(self.text)).strip()
            self.text = []
            if text:
                at = self.block()
                self.nodes[at].chars += len(text)
                self.nodes[at].commas += sum(map(text.count, ",.;:!?"))
                self.blocks.append((at, text))

    def pop(self, ended=False):
        tag, node, number = self.stack[-1]
        if number >= 0 and not ended:
            self.lost.add(number)
        if node >= 0:
            self.flush()
            self.within.pop()
        self.stack.pop()
        self.open[tag] -= 1
        self.open_known -= number in self.known
        self.hidden -= tag in HIDDEN
        self.links -= tag == "a"

    def close_lost(self, tag):
        """Close what ``tag`` ends of the hidden elements without an end tag."""
        if not self.known:
            return
        if self.stack and self.stack[-1][0] == "head" and self.stack[-1][2] in self.known and tag not in HEAD:
            self.pop()
        if tag in ENDS_LOST and self.open_known:
            at = next((k for k, x in enumerate(self.stack) if x[2] in self.known), len(self.stack))
            while len(self.stack) > at:
                self.pop()

    def close_open(self, tags, stop, ended=False):
        """Close the innermost open element of ``tags``, unless ``stop`` comes first."""
        if not any(self.open[t] for t in tags):
            return
        for k in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[k][0]
            if tag in tags:
                while len(self.stack) > k:
                    self.pop(ended and len(self.stack) == k + 1)
                return
            if tag in stop:
                return

    def handle_starttag(self, tag, attrs):
        self.close_lost(tag)
        if tag == "br":
            self.flush()
        if tag in CLOSES_P:
            self.close_open({"p"}, CONTAINERS | (LEAVES - {"p"}))
        if tag in SAME:
            self.close_open(SAME[tag], {"ul", "ol", "dl", "table", "menu", "select"})
        if tag in ("hr",):
            self.flush()
        if tag in VOID:
            return
        node = -1
        if tag in CONTAINERS or tag in LEAVES:
            self.flush()
            told = dict(attrs)
            cues = {w.lower() for a in ("class", "id", "role") for w in CUE.findall(told.get(a) or "")}
            label = told.get("data-y")
            parent = self.block()
            self.nodes.append(Node(tag, parent, cues, int(label) if label in ("0", "1") else self.nodes[parent].label))
            node = len(self.nodes) - 1
            self.within.append(node)
        number = self.n_hidden if tag in HIDDEN else -1
        self.stack.append((tag, node, number))
        self.open[tag] += 1
        self.open_known += number in self.known
        self.n_hidden += tag in HIDDEN
        self.hidden += tag in HIDDEN
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in CONTAINERS and tag not in LEAVES:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.open[tag]:
            self.close_open({tag}, set(), ended=True)

    def handle_data(self, data):
        if data.strip():
            self.close_lost("")
        if not self.hidden:
            self.text.append(data)
            if self.links:
                self.nodes[self.block()].link_chars += len(data.strip())


def gathered(page: Page) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """chars, link chars and commas of each node with all below it."""
    sums = np.array([(n.chars, n.link_chars, n.commas) for n in page.nodes], dtype=float)
    for k in range(len(page.nodes) - 1, 0, -1):
        sums[page.nodes[k].parent] += sums[k]
    return sums[:, 0], sums[:, 1], sums[:, 2]


N_FEATURES = 13
RIDGE = 5e-4


def evidence(page: Page, plain: bool = False) -> np.ndarray:
    """A row of features per node; ``plain``: as if semantic tags were div."""
    chars, links, commas = gathered(page)
    out = np.zeros((len(page.nodes), N_FEATURES))
    for k, n in enumerate(page.nodes):
        leaf, tag = n.tag in LEAVES, "div" if plain else n.tag
        density = min(1.0, links[k] / chars[k]) if chars[k] else 0.0
        out[k] = (1, tag in BAD_TAGS and tag != "header", tag == "header", tag in GOOD_TAGS, bool(n.cues & BAD_WORDS), bool(n.cues & GOOD_WORDS) and not n.cues & BAD_WORDS,
                  leaf, n.tag == "p", n.tag.startswith("h") and n.tag[1:].isdigit(), density, leaf and math.log1p(chars[k]) / 5,
                  leaf and commas[k] >= 2, chars[k] == 0)
    return out


def own_labels(page: Page) -> list[int] | None:
    """Labels by the page's semantic elements; None if it has none."""
    if not any(n.tag in GOOD_TAGS for n in page.nodes):
        return None
    out = []
    for n in page.nodes:
        above = out[n.parent] if n.parent >= 0 else 0
        cut = n.tag in BAD_TAGS or bool(n.cues & BAD_WORDS)
        out.append(0 if cut else 1 if n.tag in GOOD_TAGS else above)
    return out


class Model:
    """Log-odds weights, and ties[kind][parent][child] = log P(child | parent)."""

    def __init__(self, w: np.ndarray, ties: np.ndarray):
        self.w, self.ties = w, ties

    def marginals(self, page: Page) -> np.ndarray:
        """Content marginal of every node by two passes of messages."""
        nodes, n = page.nodes, len(page.nodes)
        odds = evidence(page) @ self.w
        own = np.stack([np.zeros(n), odds], axis=1).tolist()  # log potentials
        up = [[0.0, 0.0] for _ in range(n)]  # message of each node to its parent
        below = [list(x) for x in own]  # own potential and all messages from below
        kinds = [int(x.tag in LEAVES) for x in nodes]
        ties = self.ties.tolist()
        for k in range(n - 1, 0, -1):
            t, b = ties[kinds[k]], below[k]
            up[k] = [_add(t[z][0] + b[0], t[z][1] + b[1]) for z in (0, 1)]
            parent = below[nodes[k].parent]
            parent[0] += up[k][0]
            parent[1] += up[k][1]
        full = [list(x) for x in below]  # with the message from above
        for k in range(1, n):
            t, f = ties[kinds[k]], full[nodes[k].parent]
            rest = (f[0] - up[k][0], f[1] - up[k][1])
            for y in (0, 1):
                full[k][y] = below[k][y] + _add(rest[0] + t[0][y], rest[1] + t[1][y])
            top = max(full[k])
            full[k] = [full[k][0] - top, full[k][1] - top]
        return np.array([1 / (1 + math.exp(min(700.0, f[0] - f[1]))) for f in full])

    def text(self, html: str | None) -> str:
        if not html:
            return ""
        page = Page(html)
        p = self.marginals(page)
        return "\n".join(t for k, t in page.blocks if p[k] >= 0.5)


def _add(a: float, b: float) -> float:
    top = max(a, b)
    return top + math.log(math.exp(a - top) + math.exp(b - top))


def train(pages: list[str] = ()) -> Model:
    """Logistic weights for the nodes' own evidence, counted ties, from the
    labelled layouts and from pages that label themselves."""
    rows, ys, ties = [], [], np.ones((2, 2, 2))
    told = [(p, [n.label for n in p.nodes], 40.0) for p in map(Page, LAYOUTS)]
    told += [(p, y, 1.0) for p in map(Page, pages) if (y := own_labels(p))]
    weights = []
    for page, y, weight in told:
        y = [0 if v is None else v for v in y]
        for plain in (False, True):
            rows.append(evidence(page, plain))
            ys.append(y)
            weights += [weight / len(y)] * len(y)
        for k, n in enumerate(page.nodes[1:], 1):
            ties[int(n.tag in LEAVES), y[n.parent], y[k]] += weight / len(y)
    x, y, c = np.concatenate(rows), np.concatenate(ys).astype(float), np.array(weights)
    c /= c.sum()
    w = np.zeros(N_FEATURES)
    for _ in range(60):  # Newton steps with a ridge
        p = 1 / (1 + np.exp(-x @ w))
        grad = x.T @ (c * (p - y)) + RIDGE * w
        hess = (x * (c * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(N_FEATURES)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Model(w, np.log(ties / ties.sum(axis=2, keepdims=True)))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text."""
    spark = prepare(pages.sparkSession)
    rows = pages.select(column(id_col).cast("long").alias("page_id"), column(url_col).cast("string").alias("url"),
                        column(html_col).cast("string").alias("html"))
    # keys first: whole pages would be sent to the driver from every task
    keyed = rows.filter("html is not null and length(html) < 200000").select(F.xxhash64("page_id", "url").alias("h"), "html")
    chosen = keyed.select("h").distinct().orderBy("h").limit(SAMPLE)
    sample = keyed.join(F.broadcast(chosen), "h").groupBy("h").agg(F.max("html").alias("html")).toPandas().sort_values("h").html.tolist()
    shared = spark.sparkContext.broadcast(train(sample))

    def run(batches):
        for b in batches:
            texts = [shared.value.text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return rows.mapInArrow(run, "page_id long, url string, text string")


def digest(found: DataFrame) -> DataFrame:
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
