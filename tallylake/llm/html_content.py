"""Main text of HTML pages by a tree-structured graphical model.

Every element and text of the page's tree is a node with a hidden label, content or not.  A node
potential is linear in features of the node; a parent-child potential depends on both labels and
on the sort of the child.  Sum-product messages go from the leaves up and from the root down and
give every node's exact marginal.  The same passes give the gradient of the likelihood, by which
the potentials are trained from labelled pages.

All trees of a batch form one forest whose levels are handled together.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.llm.common import text_slices

#: Pages the model is trained on, steps of training, and the marginal from which text is kept.
TRAINING_PAGES = 400
STEPS = 150
THRESHOLD = 0.5
SLICE_BYTES = 2 << 20

# Names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
HIDDEN = frozenset("script style noscript iframe template head svg math object canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table "
    "ul".split()
)
#: A start tag that ends open elements, and where the search for them stops.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}
BOUNDS = frozenset(
    "article aside body div footer form header html main nav section table td th".split()
)

#: Elements nested deeper than this are put where the limit is, as browsers do.
MAX_DEPTH = 512

#: What begins markup: a comment, a declaration, or a tag with its name.
_MARKUP = re.compile(r"<(?:(!--)|([!?])|(/?)([A-Za-z][^\s/>]*+))")
#: The rest of a tag.  Only a value, after its equals sign, is quoted; a quote that is never closed
#: is a character like others.
_REST = re.compile(r"((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
# References to characters with more digits than any has, and zeros before the others.
_ZEROS = re.compile(r"&#([xX]?)0++(?=[0-9A-Fa-f])")
_NO_CHARACTER = re.compile(r"&#(?:[xX][0-9A-Fa-f]{7,}+|[0-9]{8,}+);?")
#: One whole attribute: its name and its value, quoted or not.
_ATTRIBUTE = re.compile(
    r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?"
)
_READ = frozenset("class id role hidden style aria-hidden".split())
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}
_NAME_PART = re.compile(r"[A-Za-z]+")

TEXT = "#text"
_P = frozenset(["p"])
_NO_HINTS: frozenset[str] = frozenset()
NAMED = (
    "html body div section article main p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th "
    "blockquote pre nav header footer aside form button a b span br figure figcaption"
).split() + [TEXT]
# Parts of class and id names, by what they tell.
HINTS = {
    "ad": "ad ads advert adverts advertisement banner sponsor sponsored promo promoted".split(),
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs".split(),
    "frame": "header masthead footer foot topbar bottom copyright legal".split(),
    "side": "sidebar side aside widget widgets related recommended recommendations more".split(),
    "notice": "cookie cookies consent notice popup modal overlay alert gdpr privacy".split(),
    "form": "form newsletter subscribe signup login search share social sharing".split(),
    "comment": "comment comments reply replies respond discussion disqus reactions".split(),
    "content": "content article post story entry main body text prose".split(),
}
_HINT = {word: hint for hint, words in HINTS.items() for word in words}
_NAMED = {name: i for i, name in enumerate(NAMED)}
_HINTED = {name: i for i, name in enumerate(HINTS)}
#: The bias, the node's name, its own hints, its ancestors' names and hints, then shapes.
N_FEATURES = 1 + 2 * (len(NAMED) + 1 + len(HINTS)) + 8
N_SORTS = len(NAMED) + 1


@dataclass(slots=True)
class Node:
    name: str
    parent: int
    hints: frozenset[str]
    text: str = ""
    hidden: bool = False


def unescaped(raw: str) -> str:
    """``raw`` with its character references decoded."""
    if "&#" in raw:
        raw = _NO_CHARACTER.sub("\ufffd", _ZEROS.sub(r"&#\1", raw))
    return html.unescape(raw) if "&" in raw else raw


class _Open:
    """The open elements, outermost first, and where each name stands among them."""

    def __init__(self, nodes: list[Node]):
        self.nodes = nodes
        self.stack = [0]
        self.at: dict[str, list[int]] = {}

    def parent(self) -> int:
        return self.stack[min(len(self.stack), MAX_DEPTH) - 1]

    def push(self, node: int) -> None:
        self.at.setdefault(self.nodes[node].name, []).append(len(self.stack))
        self.stack.append(node)

    def _last(self, names: frozenset[str]) -> int:
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=0)

    def close(self, names: frozenset[str], bounds: frozenset[str]) -> None:
        """End the innermost element of ``names``, unless one of ``bounds`` lies inside it."""
        depth = self._last(names)
        if depth and (not bounds or depth >= self._last(bounds)):
            for node in self.stack[depth:]:
                self.at[self.nodes[node].name].pop()
            del self.stack[depth:]


def parse(page: str) -> list[Node]:
    """The page's tree, parents before children; broken markup is closed as browsers do.

    Markup without an end goes to the end of the page.  Every character is looked at a fixed
    number of times, whatever is left open.
    """
    nodes = [Node("#root", -1, frozenset())]
    opened = _Open(nodes)
    at, size, quoted = 0, len(page), True

    def text(raw: str) -> None:
        nodes.append(Node(TEXT, opened.parent(), _NO_HINTS, unescaped(raw)))

    while at < size:
        token = _MARKUP.search(page, at)
        if token is None:
            text(page[at:])
            break
        if token.start() > at:
            text(page[at : token.start()])
        at, name, rest = token.end(), token[4], ""
        if token[1]:
            end = page.find("-->", at)
            at = end + 3 if end >= 0 else size
            continue
        whole = _REST.match(page, at) if name and quoted else None
        if whole is None:
            # With no bracket outside quotes from here on, quotes are not looked at any more.
            quoted = quoted and not name
            end = page.find(">", at)
            if end < 0:
                break
            rest, at = page[at:end], end + 1
        else:
            rest, at = whole[1], whole.end()
        if not name:
            continue
        name = name.lower()
        if token[3]:
            opened.close(frozenset([name]), BOUNDS if name in INLINE else _NO_HINTS)
            continue
        if name in CLOSES_P:
            opened.close(_P, BOUNDS)
        if name in ENDS:
            opened.close(*ENDS[name])
        hints, hidden = _read_attributes(rest) if rest else (_NO_HINTS, False)
        node = Node(name, opened.parent(), hints, hidden=hidden or name in HIDDEN)
        nodes.append(node)
        if name in VOID or rest.endswith("/") and name not in _NAMED:
            continue
        if name in RAW:
            ended = _RAW_END[name].search(page, at)
            at = ended.end() if ended else size
            continue
        opened.push(len(nodes) - 1)
    return nodes


def _read_attributes(raw: str) -> tuple[frozenset[str], bool]:
    hints, hidden = set(), False
    seen = set()
    for m in _ATTRIBUTE.finditer(raw):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        # Of attributes of one name the first holds.
        if key not in _READ or key in seen:
            continue
        seen.add(key)
        if key in ("class", "id", "role"):
            for part in _NAME_PART.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value)):
                hint = _HINT.get(part.lower())
                if hint:
                    hints.add(hint)
        elif key == "hidden" or key == "aria-hidden" and value == "true":
            hidden = True
        elif key == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
    return frozenset(hints), hidden


class Forest:
    """Trees of many pages as arrays, with features and the levels of the message passes."""

    def __init__(self, pages: list[list[Node]]):
        counts = [len(nodes) for nodes in pages]
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        nodes = [n for page in pages for n in page]
        n = len(nodes)
        shift = np.repeat(self.first[:-1], counts)
        own = np.fromiter((x.parent for x in nodes), np.int64, n)
        self.parent = np.where(own < 0, -1, own + shift)
        self.sort = np.fromiter((_NAMED.get(x.name, len(NAMED)) for x in nodes), np.int64, n)
        self.hidden = np.fromiter((x.hidden for x in nodes), bool, n)
        self.texts = nodes
        level = np.zeros(n, dtype=np.int64)
        parent = self.parent.tolist()
        for i, p in enumerate(parent):
            if p >= 0:
                level[i] = level[p] + 1
        order = np.argsort(level, kind="stable")
        cuts = np.flatnonzero(np.diff(level[order])) + 1
        self.levels = np.split(order, cuts) if n else []
        for at in self.levels[1:]:
            self.hidden[at] |= self.hidden[self.parent[at]]
        self._features(nodes)

    def _features(self, nodes: list[Node]) -> None:
        n, width = len(nodes), len(NAMED) + 1 + len(HINTS)
        x = np.zeros((n, N_FEATURES), dtype=np.float32)
        x[:, 0] = 1
        own = np.zeros((n, width), dtype=np.float32)
        own[np.arange(n), self.sort] = 1
        for i, node in enumerate(nodes):
            for hint in node.hints:
                own[i, len(NAMED) + 1 + _HINTED[hint]] = 1
        above = np.zeros_like(own)
        for at in self.levels[1:]:
            above[at] = np.maximum(above[self.parent[at]], own[self.parent[at]])
        x[:, 1 : 1 + width] = own
        x[:, 1 + width : 1 + 2 * width] = above
        # Text below each node, the share of it in links, and its words and sentences.
        size = np.zeros((n, 3))
        for i in np.flatnonzero((self.sort == _NAMED[TEXT]) & ~self.hidden).tolist():
            body = nodes[i].text
            size[i] = len(body), body.count(" "), body.count(".") + body.count(",")
        linked = np.where(above[:, _NAMED["a"]] > 0, size[:, 0], 0)
        for at in reversed(self.levels[1:]):
            np.add.at(size, self.parent[at], size[at])
            np.add.at(linked, self.parent[at], linked[at])
        page_total = np.repeat(size[self.first[:-1], 0], np.diff(self.first))
        x[:, -8] = np.log1p(size[:, 0]) / 8
        x[:, -7] = np.log1p(size[:, 1]) / 6
        x[:, -6] = size[:, 2] / np.maximum(size[:, 0], 1)
        x[:, -5] = linked / np.maximum(size[:, 0], 1)
        x[:, -4] = size[:, 0] / np.maximum(page_total, 1)
        x[:, -3] = size[:, 0] == 0
        x[:, -2] = size[:, 0] > 80
        x[:, -1] = self.hidden
        self.x = x


@dataclass
class Model:
    """Weights of the node potential, and log potentials [sort of child, parent, child]."""

    node: np.ndarray
    edge: np.ndarray


def marginals(model: Model, forest: Forest) -> tuple[np.ndarray, np.ndarray, float]:
    """P(content) of every node, P(parent, child) of every edge, and the log partition sum."""
    n = len(forest.parent)
    score = np.zeros((n, 2))
    score[:, 1] = forest.x @ model.node
    up = score.copy()
    message = np.zeros((n, 2))
    # Upward: a child's messages are summed into its parent.
    for at in reversed(forest.levels[1:]):
        potential = model.edge[forest.sort[at]]
        message[at] = np.logaddexp.reduce(potential + up[at][:, None, :], axis=2)
        np.add.at(up, forest.parent[at], message[at])
    roots = forest.levels[0] if forest.levels else np.zeros(0, np.int64)
    total = np.logaddexp.reduce(up[roots], axis=1)
    # Downward: what the parent believes without this child.
    belief = up.copy()
    belief[roots] -= total[:, None]
    joint = np.zeros((n, 2, 2))
    for at in forest.levels[1:]:
        parent = belief[forest.parent[at]] - message[at]
        pair = parent[:, :, None] + model.edge[forest.sort[at]] + up[at][:, None, :]
        pair -= np.logaddexp.reduce(pair.reshape(len(at), 4), axis=1)[:, None, None]
        joint[at] = np.exp(pair)
        belief[at] = np.logaddexp.reduce(pair, axis=1)
    return np.exp(belief[:, 1]), joint, float(total.sum())


def train(forest: Forest, labels: np.ndarray, steps: int = STEPS) -> Model:
    """Maximum likelihood by gradient steps (Adam), with a small weight penalty."""
    model = Model(np.zeros(N_FEATURES), np.zeros((N_SORTS, 2, 2)))
    child = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros_like(model.edge)
    np.add.at(
        seen, (forest.sort[child], labels[forest.parent[child]], labels[child]), 1
    )
    flat = np.concatenate([model.node, model.edge.ravel()])
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    pages = max(1, len(forest.first) - 1)
    for step in range(1, steps + 1):
        p, joint, _ = marginals(model, forest)
        expected = np.zeros_like(model.edge)
        np.add.at(expected, forest.sort[child], joint[child])
        gradient = np.concatenate([forest.x.T @ (labels - p), (seen - expected).ravel()])
        gradient = gradient / pages - 0.002 * flat
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        flat = flat + 0.1 * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.99**step)) + 1e-8
        )
        model = Model(flat[:N_FEATURES], flat[N_FEATURES:].reshape(model.edge.shape))
    return model


def main_text(nodes: list[Node], p: np.ndarray, hidden: np.ndarray, threshold: float) -> str:
    """Text of content nodes; white space inside a block is one space, blocks are lines."""
    blocks: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        block = " ".join("".join(parts).split())
        if block:
            blocks.append(block)
        parts.clear()

    # The block each node lies in; a change of block ends a line.
    block_of = [0] * len(nodes)
    last = 0
    for i, node in enumerate(nodes):
        if i:
            inline = node.name == TEXT or node.name in INLINE
            block_of[i] = block_of[node.parent] if inline else i
        if block_of[i] != last:
            flush()
            last = block_of[i]
        if node.name == TEXT and not hidden[i] and p[i] >= threshold:
            parts.append(node.text)
    flush()
    return "\n".join(blocks)


# --- labelled pages -------------------------------------------------------------------

_SYLLABLES = "an be con der el fra gen han in jo ka lo men nor ou per qui ren ste tion ur ver".split()


def labelled_page(rng: random.Random) -> list[tuple[str, bool]]:
    """A page as (markup or text, whether it is main text), drawn from usual layouts."""

    def word() -> str:
        return "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4)))

    def phrase(low: int, high: int) -> str:
        return " ".join(word() for _ in range(rng.randint(low, high)))

    def sentences(low: int, high: int) -> str:
        return " ".join(
            phrase(3, 14).capitalize() + rng.choice(["." , ".", ".", "!", "?"])
            for _ in range(rng.randint(low, high))
        )

    page: list[tuple[str, bool]] = []

    def tag(markup: str) -> None:
        page.append((markup, False))

    def content(text: str) -> None:
        page.append((text, True))

    def links(count: int, item: str = "li") -> None:
        for _ in range(count):
            tag(f"<{item}><a href='/x'>{phrase(1, 3)}</a></{item}>")

    def junk(kind: str) -> None:
        name = rng.choice(HINTS[kind])
        holder = rng.choice(["div", "div", "section", "aside", "p"])
        attribute = rng.choice(["class", "class", "id"])
        tag(f"<{holder} {attribute}='{name}'>")
        if kind in ("menu", "side", "form") and rng.random() < 0.6:
            tag("<ul>")
            links(rng.randint(2, 7))
            tag("</ul>")
        elif kind == "comment":
            for _ in range(rng.randint(1, 4)):
                tag(f"<div><b>{phrase(1, 2)}</b>" if rng.random() < 0.5 else "<div>")
                tag(f"<p>{sentences(1, 4)}</p></div>")
        else:
            body = sentences(1, 3)
            tag(f"<p>{body}</p>" if holder != "p" and rng.random() < 0.4 else body)
        tag(f"</{holder}>")

    def menu() -> None:
        tag(rng.choice(["<nav>", "<nav class='menu'>", "<nav id='top'>"]))
        tag("<ul>")
        links(rng.randint(2, 9))
        tag("</ul></nav>")

    def body_of_article() -> None:
        if rng.random() < 0.8:
            # A headline may stand in a header of the article's own.
            headed = rng.random() < 0.25
            tag("<header>" if headed else "")
            tag(rng.choice(["<h1>", "<h2>"]))
            content(phrase(2, 9).capitalize())
            tag(rng.choice(["</h1>", "</h2>"]))
            tag("</header>" if headed else "")
        inner = rng.choice(["section", "div"]) if rng.random() < 0.3 else ""
        tag(f"<{inner}>" if inner else "")
        paragraphs()
        tag(f"</{inner}>" if inner else "")

    def paragraphs() -> None:
        for _ in range(rng.randint(0, 7)):
            shape = rng.random()
            if shape < 0.6:
                tag("<p>")
                content(sentences(1, 7))
                if rng.random() < 0.2:
                    tag("<a href='/y'>")
                    content(" " + phrase(1, 3))
                    tag("</a>")
                    content(" " + phrase(1, 5) + ".")
                tag("</p>" if rng.random() < 0.9 else "")
            elif shape < 0.7:
                tag("<p><b>")
                content(phrase(2, 12).capitalize() + ".")
                tag(rng.choice(["<br>", "</b></p>", "</b><br>"]))
            elif shape < 0.78:
                tag(rng.choice(["<h2>", "<h3>"]))
                content(phrase(1, 5).capitalize())
                tag("</h3>" if rng.random() < 0.5 else "</h2>")
            elif shape < 0.86:
                tag("<ul>")
                for _ in range(rng.randint(1, 5)):
                    tag("<li>")
                    content(phrase(1, 14))
                    tag("</li>")
                tag("</ul>")
            elif shape < 0.9:
                tag("<blockquote>")
                content(sentences(1, 3))
                tag("</blockquote>")
            elif shape < 0.94:
                tag("<table><tr><td>")
                content(phrase(1, 4))
                tag("</td><td>")
                content(phrase(1, 4))
                tag("</td></tr></table>")
            else:
                junk(rng.choice(["ad", "side", "form", "notice"]))

    if rng.random() < 0.05:
        # No element at all, or hardly any.
        for _ in range(rng.randint(1, 4)):
            content(sentences(1, 4))
            tag(rng.choice(["<br>", "<p>"]))
        return page if rng.random() < 0.5 else page[:1]

    tag("<html><body>")
    for _ in range(rng.randint(0, 2)):
        rng.choice([menu, lambda: junk("ad"), lambda: junk("notice"), lambda: junk("frame")])()
    if rng.random() < 0.5:
        tag("<header>")
        tag(f"<{rng.choice(['h1', 'p', 'div'])}>{phrase(1, 5)}")
        if rng.random() < 0.5:
            menu()
        tag("</header>")
    wrap = rng.choice(
        ["article", "article", "article", "main", "main><article", "div class='content'",
         "div id='main'", "div class='post-body'", "section class='article'"]
    )
    tag(f"<{wrap}>")
    body_of_article()
    if rng.random() < 0.2:
        junk("comment")
    tag("".join(f"</{part.split()[0]}>" for part in reversed(wrap.split("><"))))
    for _ in range(rng.randint(0, 2)):
        kind = rng.choice(["ad", "side", "comment", "form", "notice"])
        junk(kind)
    if rng.random() < 0.3:
        tag("<aside>")
        tag(f"<p>{sentences(1, 3)}</p>" if rng.random() < 0.5 else sentences(1, 2))
        tag("</aside>")
    if rng.random() < 0.2:
        tag(f"<form><label>{phrase(1, 4)}</label><input name='q'><button>{word()}</button></form>")
    if rng.random() < 0.8:
        tag(f"<footer>&copy; {phrase(1, 3)} &middot; {sentences(1, 3)}</footer>")
    tag("</body></html>")
    return page


def labelled_forest(pages: list[list[tuple[str, bool]]]) -> tuple[Forest, np.ndarray]:
    """Trees and labels; an element is content if all text below it is, and there is some."""
    trees, labels = [], []
    for page in pages:
        # Text of both sorts never touches, so a text node has one label.
        mark = "\x00"
        nodes = parse("".join(mark + part if good else part for part, good in page))
        good = np.zeros(len(nodes))
        size = np.zeros(len(nodes))
        for i, node in enumerate(nodes):
            if node.name == TEXT and not node.text.isspace():
                size[i] = 1
                if mark in node.text:
                    good[i] = 1
                    node.text = node.text.replace(mark, "")
        for i in range(len(nodes) - 1, 0, -1):
            good[nodes[i].parent] += good[i]
            size[nodes[i].parent] += size[i]
        label = ((good > 0) & (good == size)).astype(np.int64)
        for i, node in enumerate(nodes):
            if node.name == TEXT and node.text.isspace():
                label[i] = label[node.parent]
            elif not size[i]:
                label[i] = label[node.parent] if i else 0
        trees.append(nodes)
        labels.append(label)
    return Forest(trees), np.concatenate(labels)


@functools.lru_cache(maxsize=2)
def trained_model(pages: int = TRAINING_PAGES, steps: int = STEPS, seed: int = 5) -> Model:
    """The model of ``pages`` labelled pages; the number is the bound of what is fitted."""
    rng = random.Random(seed)
    return train(*labelled_forest([labelled_page(rng) for _ in range(pages)]), steps)


def extract(pages: list[str | None], model: Model, threshold: float = THRESHOLD) -> list[str]:
    trees = [parse(page or "") for page in pages]
    forest = Forest(trees)
    p, _, _ = marginals(model, forest)
    cuts = forest.first.tolist()
    return [
        main_text(nodes, p[a:b], forest.hidden[a:b], threshold)
        for nodes, a, b in zip(trees, cuts, cuts[1:])
    ]


def extract_pages(
    pages: DataFrame,
    html_col: str = "html",
    keep: list[str] | None = None,
    model: Model | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Every row of ``pages`` with its main ``text``.

    ``keep`` names the columns that are passed on, all by default; one named ``text`` is
    replaced.  A null or empty page, and one without main text, gives an empty text.  Markup
    that is not closed is closed as browsers do; repeated rows are rows of their own; an empty
    table gives no rows.  A very long page takes time in proportion to its length.
    """
    kept = [c for c in (pages.columns if keep is None else keep) if c != "text"]
    shared = pages.sparkSession.sparkContext.broadcast(model or trained_model())
    rows = pages.select(*[pages[c] for c in kept], F.col(html_col).cast("string").alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "__html", SLICE_BYTES):
            texts = extract(batch.column("__html").to_pylist(), shared.value, threshold)
            arrays = [batch.column(c) for c in kept] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "text"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__html"]
    return rows.mapInArrow(run, ", ".join([*fields, "text string"]))
