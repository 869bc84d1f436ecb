"""HTML extraction: the main text of web pages, by a tree-structured graphical model over their elements and blocks.

A page becomes a forest: block elements, and under them the blocks, runs of text that no block element interrupts. Each of them
is content or not. Unary potentials rate an element's tag, names and share of text and links, and a block's length, links
and marks; a potential of each kind of child ties it to its parent. Sum-product messages go up the tree and down again, by levels
of depth for many pages at once, and give exact marginals; blocks that are likelier content than not make up the text. The weights
maximise the likelihood of labelled pages, whose gradient takes marginals of nodes and of edges from the same messages.

Pages are independent, so extraction is one pass without a shuffle; a task works on some MB of pages at a time. The labelled pages of the
fit are bounded (TRAINING); pages of one's own can be given, their content marked by data-content="1" and "0".

Defined results: null and empty pages, and pages without a likely block, give an empty text; markup that isn't closed ends with its
parent or the page; rows repeated are extracted alike; an empty table gives an empty result; columns beyond page_id, url and html aren't
read; pages of any length and depth are read whole (nothing recurses).
"""

from __future__ import annotations

import functools
import html as entities
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean
from .page_layouts import labelled_pages

TRAINING, SEED = 900, 13  # labelled pages of the fit
STEPS, RATE, PENALTY = 200, 0.2, 0.3
SLICE = 1 << 21  # characters of pages worked on at once

# Fixed values of HTML: elements without an end, with raw or no text of their own, and those that begin a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style title noscript template textarea select svg math iframe object canvas audio video button".split())
BLOCK = frozenset(
    "html body main article section nav header footer aside form div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure figcaption address fieldset legend label details summary ins center dialog menu hgroup".split()
)
# What a start tag closes, if it is open further in than the given elements.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("td", "th", "tr", "thead", "tbody"), "tfoot": ("td", "th", "tr", "thead", "tbody")}
WITHIN = frozenset("html body ul ol dl table div section article nav aside header footer form main blockquote".split())
PHRASING = frozenset("p h1 h2 h3 h4 h5 h6".split())  # elements that a block's start closes

# Elements whose size and share of the page are rated together: none for the page itself and for single blocks; parts of articles; any part; lesser ones.
_GROUPS = {**dict.fromkeys("page html body text p h1 h2 h3 h4 h5 h6 li dt dd tr tbody thead caption figcaption blockquote pre".split(), 0), "article": 1, "main": 1, "div": 2, "section": 2, "td": 2}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_MARK = re.compile(r"""data-content\s*=\s*["']?([01])""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_END = {tag: re.compile(rf"</{tag}\b[^>]*>?", re.I) for tag in SILENT}


@dataclass
class Tree:
    """Nodes of pages in order of their starts; a block is a node with a text. Roots have themselves as parent."""

    page: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    name: list[tuple[str, ...]] = field(default_factory=list)  # ("tag", words of its names)
    mark: list[int] = field(default_factory=list)  # the label, of labelled pages
    text: list[str | None] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)  # characters inside links

    def add(self, page, parent, name, mark, text=None, linked=0) -> int:
        at = len(self.page)
        self.page.append(page)
        self.parent.append(at if parent is None else parent)
        self.depth.append(0 if parent is None else self.depth[parent] + 1)
        self.name.append(name)
        self.mark.append(mark)
        self.text.append(text)
        self.linked.append(linked)
        return at


@functools.lru_cache(1 << 16)
def _named(tag: str, attributes: str) -> tuple[tuple[str, ...], int | None]:
    words = {w.lower() for m in _NAMES.finditer(attributes) for w in _PART.findall(m[1] or m[2] or m[3] or "")}
    mark = _MARK.search(attributes)
    return (tag, *sorted(words)), int(mark[1]) if mark else None


def grow(tree: Tree, page: int, source: str) -> None:
    """Adds one page's nodes."""
    root = tree.add(page, None, ("page",), 0)
    stack, open_ = [(root, "page")], {}
    buffer, linked, link = [], 0, False

    def flush():
        nonlocal linked
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                tree.add(page, stack[-1][0], ("text",), tree.mark[stack[-1][0]], text, min(linked, len(text)))
            linked = 0

    def pop_to(size):
        while len(stack) > size:
            open_[stack.pop()[1]] -= 1

    at, token = 0, _TOKEN.search
    while True:
        m = token(source, at)
        raw = source[at : m.start() if m else len(source)]
        if raw:
            if "&" in raw:
                raw = entities.unescape(raw)
            buffer.append(raw)
            if link:
                linked += len(raw)
        if not m:
            break
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, closing = tag.lower(), m[1] or m[4]
        if tag in BLOCK:
            if not closing:
                flush()
                if stack[-1][1] in PHRASING and tag not in ("ins", "label"):
                    pop_to(len(stack) - 1)
                ends = CLOSES.get(tag)
                if ends and any(open_.get(e) for e in ends):
                    size = len(stack)
                    while size > 1 and (stack[size - 1][1] in ends or stack[size - 1][1] not in WITHIN):
                        size -= 1
                    inner = [i for i in range(size, len(stack)) if stack[i][1] in ends]
                    if inner:
                        pop_to(inner[0])
                name, mark = _named(tag, m[3] or m[6] or "")
                above = stack[-1][0]
                stack.append((tree.add(page, above, name, tree.mark[above] if mark is None else mark), tag))
                open_[tag] = open_.get(tag, 0) + 1
            elif open_.get(tag) or tag in PHRASING:
                flush()
                if tag[0] == "h" and tag in PHRASING and stack[-1][1] in PHRASING:
                    pop_to(len(stack) - 1)  # any heading's end closes the open one
                elif open_.get(tag):
                    size = len(stack) - 1
                    while stack[size][1] != tag:
                        size -= 1
                    pop_to(size)
        elif tag in SILENT:
            if not closing:
                end = _END[tag].search(source, at)
                at = end.end() if end else len(source)
                if tag in ("select", "button", "textarea"):
                    buffer.append(" ")
        elif tag == "br":
            buffer.append(" ")
        elif tag == "hr":
            flush()
        elif tag == "a":
            link = not closing
    flush()


@dataclass
class Forest:
    """Columns of a tree's nodes: entries (node, feature) of the unary potentials, kind of each child's edge, levels of depth."""

    tree: Tree
    node: np.ndarray
    feature: np.ndarray
    kind: np.ndarray
    parent: np.ndarray
    levels: list[np.ndarray]


def _bins(x: np.ndarray, cuts) -> np.ndarray:
    return np.searchsorted(np.asarray(cuts, float), x, "right")


def measured(tree: Tree) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(name, nodes, bin) of the features that come from texts: sizes, links, marks."""
    n = len(tree.page)
    parent, depth = np.array(tree.parent), np.array(tree.depth)
    leaf = np.array([t is not None for t in tree.text])
    size = np.array([len(t) if t else 0 for t in tree.text], float)
    linked = np.array(tree.linked, float)
    stops = np.array([sum(map(t.count, ".,;:!?")) if t else 0 for t in tree.text], float)
    for level in reversed(_levels(depth)):
        np.add.at(size, parent[level], size[level])
        np.add.at(linked, parent[level], linked[level])
        np.add.at(stops, parent[level], stops[level])
    first = np.flatnonzero(depth == 0)
    total = size[first][np.searchsorted(first, np.arange(n), "right") - 1]
    some = np.maximum(size, 1)
    group = np.array([_GROUPS.get(name[0], 3) for name in tree.name])
    nodes = np.flatnonzero(group > 0)
    # blocks of one part are alike, and would outvote it; so only those that stand in the page itself are rated by their own text
    alone = np.array([name[0] in ("page", "html", "body") for name in tree.name])
    leaves = np.flatnonzero(leaf & (alone[parent] | (alone[parent[parent]] & (group[parent] == 0))))
    out = []
    for name, who in (("el", nodes), ("bl", leaves)):
        if name == "bl":
            out.append(("bl size", who, _bins(size[who], (1, 15, 40, 80, 160, 400, 1500, 5000))))
        out.append((f"{name} links", who, _bins(linked[who] / some[who], (0.01, 0.1, 0.3, 0.6, 0.95))))
        out.append((f"{name} stops", who, _bins(stops[who] / some[who], (1e-9, 0.008, 0.02, 0.05))))
    for g in (1, 2, 3):
        who = np.flatnonzero(group == g)
        out.append((f"el share {g}", who, _bins(size[who] / np.maximum(total[who], 1), (0.02, 0.1, 0.3, 0.6, 0.9))))
        out.append((f"el size {g}", who, _bins(size[who], (1, 15, 40, 80, 160, 400, 1500, 5000))))
    copy = np.array([bool(t) and ("©" in t or "copyright" in t[:60].lower()) for t in tree.text])
    out.append(("bl copyright", np.flatnonzero(copy), np.zeros(copy.sum(), int)))
    return out


def _levels(depth: np.ndarray) -> list[np.ndarray]:
    """Nodes by depth, from 1 on."""
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(1, depth.max(initial=0) + 2))
    return [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def forest(tree: Tree, words: dict[str, int], grows: bool = False) -> Forest:
    """The tree with features as numbers; unknown ones are left out, or numbered if the vocabulary grows."""
    number = (lambda w: words.setdefault(w, len(words))) if grows else words.get
    cache: dict[tuple[str, ...], list[int]] = {}
    node, feature, kind = [], [], np.zeros(len(tree.page), np.int64)
    for i, name in enumerate(tree.name):
        known = cache.get(name)
        if known is None:
            found = [f"tag {name[0]}", *(f"name {w}" for w in name[1:])]
            known = cache[name] = [k for k in map(number, found) if k is not None]
        node.extend([i] * len(known))
        feature.extend(known)
    parent = np.array(tree.parent, np.int64)
    edges: dict[tuple[str, str], int] = {}
    for i, name in enumerate(tree.name):
        # an edge goes by the child, and by whether it stands in the page itself, in a part with a name, or elsewhere; a block's goes by its element
        above = tree.name[parent[i]]
        key = (name[0], above[0] if name[0] == "text" else "page" if above[0] in ("page", "html", "body") else "named" if len(above) > 1 else "")
        k = edges.get(key)
        if k is None:
            k = number(f"edge {key}")
            k = edges[key] = 0 if k is None else k
        kind[i] = k
    for name, who, bins in measured(tree):
        top = int(bins.max(initial=-1))
        table = np.array([-1 if (k := number(f"{name} {b}")) is None else k for b in range(top + 1)], np.int64)
        f = table[bins] if len(bins) else np.zeros(0, np.int64)
        node.extend(who[f >= 0].tolist())
        feature.extend(f[f >= 0].tolist())
    return Forest(tree, np.array(node, np.int64), np.array(feature, np.int64), kind, parent, _levels(np.array(tree.depth)))


def messages(f: Forest, unary: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Log marginals of nodes (n, 2) and of edges to the parents (n, parent, child), and the log of the partition sum.

    unary: log potential of content; edge: (n, 2, 2) log potentials by the states of parent and child.
    """
    n = len(unary)
    up = np.stack([np.zeros(n), unary], axis=1)  # what a node's subtree says of its state
    to_parent = np.zeros((n, 2))
    for level in reversed(f.levels):
        to_parent[level] = np.logaddexp(edge[level, :, 0] + up[level, None, 0], edge[level, :, 1] + up[level, None, 1])
        np.add.at(up, f.parent[level], to_parent[level])
    belief = up.copy()
    both = np.zeros((n, 2, 2))
    for level in f.levels:
        rest = belief[f.parent[level]] - to_parent[level]  # the parent without this child
        joint = rest[:, :, None] + edge[level] + up[level][:, None, :]
        both[level] = joint
        belief[level] = np.logaddexp(joint[:, 0], joint[:, 1])
    z = np.logaddexp(belief[:, 0], belief[:, 1])
    roots = f.parent == np.arange(n)
    return belief - z[:, None], both - z[:, None, None], float(z[roots].sum())


def _potentials(f: Forest, unary_w: np.ndarray, edge_w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unary = np.bincount(f.node, weights=unary_w[f.feature], minlength=len(f.parent))
    return unary, edge_w[f.kind]


@dataclass
class Model:
    words: dict[str, int]
    unary: np.ndarray
    edge: np.ndarray


def fit(pages: list[str], steps: int = STEPS) -> Model:
    """Weights of the greatest penalised likelihood of the marked pages, by Adam on all of them."""
    tree = Tree()
    for i, page in enumerate(pages):
        grow(tree, i, page)
    words: dict[str, int] = {}
    number = words.setdefault
    number("edge", 0)  # of children of unknown kinds: no tie
    f = forest(tree, words, grows=True)
    y = np.array(tree.mark)
    child = np.flatnonzero(f.parent != np.arange(len(y)))
    size = len(words)
    seen_u = np.bincount(f.feature, weights=y[f.node], minlength=size)
    cell = f.kind[child] * 4 + y[f.parent[child]] * 2 + y[child]
    seen_e = np.bincount(cell, minlength=size * 4).reshape(size, 2, 2)
    w = np.zeros(size * 5)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        unary_w, edge_w = w[:size], w[size:].reshape(size, 2, 2)
        node, both, _ = messages(f, *_potentials(f, unary_w, edge_w))
        got_u = np.bincount(f.feature, weights=np.exp(node[f.node, 1]), minlength=size)
        p = np.exp(both[child]).reshape(-1, 4)
        got_e = np.stack([np.bincount(f.kind[child], weights=p[:, k], minlength=size) for k in range(4)], axis=1)
        slope = np.concatenate([seen_u - got_u, (seen_e.reshape(size, 4) - got_e).ravel()]) / len(pages) - PENALTY * w / len(pages)
        m, v = 0.9 * m + 0.1 * slope, 0.995 * v + 0.005 * slope**2
        w += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.995**step)) + 1e-6)
    return Model(words, w[:size].copy(), w[size:].reshape(size, 2, 2).copy())


def content(tree: Tree, model: Model) -> np.ndarray:
    """The probability of being content of each node."""
    if not tree.page:
        return np.zeros(0)
    f = forest(tree, model.words)
    return np.exp(messages(f, *_potentials(f, model.unary, model.edge))[0][:, 1])


def texts(pages: list[str | None], model: Model) -> list[str]:
    """The main text of each page."""
    out = [""] * len(pages)
    begin = 0
    while begin < len(pages):
        end, size = begin, 0
        while end < len(pages) and (end == begin or size + len(pages[end] or "") <= SLICE):
            size += len(pages[end] or "")
            end += 1
        tree = Tree()
        for i in range(begin, end):
            if pages[i]:
                grow(tree, i, pages[i])
        likely = content(tree, model) > 0.5
        blocks: dict[int, list[str]] = {}
        for i in np.flatnonzero(likely):
            if tree.text[i] is not None:
                blocks.setdefault(tree.page[i], []).append(tree.text[i])
        for page, kept in blocks.items():
            out[page] = "\n\n".join(kept)
        begin = end
    return out


def trained(many: int = TRAINING, seed: int = SEED) -> Model:
    return fit(labelled_pages(many, seed))


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """(page_id, url, text) of every page."""

    @lean
    def run(batches):
        for batch in batches:
            found = texts(batch.column("html").to_pylist(), model)
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string())], names=["page_id", "url", "text"])

    kinds = dict(pages.dtypes)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


def op13_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), trained())
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
