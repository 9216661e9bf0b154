"""Main text of HTML pages by a tree-structured graphical model over their DOM."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm import seed_pages
from stockflow.llm.store import annotate

#: Pages of the table whose own markup labels them for training, at most.
SAMPLE = 500
#: Weight of one seed page beside one page of the table.
SEED_WEIGHT = 4.0
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset("script style template noscript head svg math iframe object canvas audio video select textarea".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
#: Characters beyond which a paragraph, or an element's own text, counts as running text.
SENTENCE = 60
_FRAMES = frozenset(["#root", "html", "body", "div"])
#: Elements that an opening tag of the key ends when they are open.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "body": {"head"},
}
_SCOPE = frozenset("html body article main section div table td th ul ol dl li blockquote aside nav footer form".split())
_TOKEN = re.compile(r"[a-z]+")
_WHITE = re.compile(r"[ \t\n\r\x0b\x0c\x85\xa0  -     　]+")


@dataclass
class Node:
    tag: str
    names: tuple[str, ...] = ()
    parent: Node | None = None
    children: list = field(default_factory=list)  # nodes and strings, in page order


class _Builder(HTMLParser):
    """A forgiving tree: unknown ends are ignored, open elements end with their parent.

    The open elements are counted by tag, and those since the last element of ``_SCOPE`` apart, so
    a tag that ends nothing costs the same however deep it stands.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root")
        self.open: Counter = Counter()
        self.scopes: list[tuple[Node, Counter]] = [(self.root, Counter())]

    def _push(self, node: Node) -> None:
        self.open[node.tag] += 1
        if node.tag in _SCOPE:
            self.scopes.append((node, Counter()))
        else:
            self.scopes[-1][1][node.tag] += 1
        self.at = node

    def _pop(self) -> None:
        self.open[self.at.tag] -= 1
        if self.at.tag in _SCOPE:
            self.scopes.pop()
        else:
            self.scopes[-1][1][self.at.tag] -= 1
        self.at = self.at.parent

    def handle_starttag(self, tag, attrs):
        ends = _CLOSES.get(tag)
        if ends or tag not in _INLINE:
            self._end_open(ends or frozenset())
        node = Node(tag, _names(attrs), self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self._push(node)

    def _end_open(self, ends) -> None:
        """A block ends the paragraph it would stand in, and the open elements of ``ends``."""
        while True:
            head, inside = self.scopes[-1]
            if inside["p"] or any(inside[t] for t in ends):
                while self.at.tag != "p" and self.at.tag not in ends:
                    self._pop()
            elif head.tag in ends:
                while self.at is not head:
                    self._pop()
            else:
                return
            self._pop()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.open[tag]:
            while self.at.tag != tag:
                self._pop()
            self._pop()

    def handle_data(self, data):
        if data:
            self.at.children.append(data)


def _names(attrs) -> tuple[str, ...]:
    """Words of the attributes that say what an element is for."""
    found = []
    for key, value in attrs:
        if key in ("class", "id", "role", "aria-label", "itemprop") and value:
            found += _TOKEN.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
        elif key in ("hidden", "data-label"):
            found.append(f"{key}={value}")
    return tuple(found)


def _named(node: Node) -> bool:
    """Whether an element has names, but for the labels of seed pages."""
    return any(not n.startswith("data-label") for n in node.names)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed((html or "").replace("\x00", ""))
    builder.close()
    return builder.root


def in_order(root: Node) -> list[Node]:
    """Elements, parents before children, without those that never hold text."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [c for c in reversed(node.children) if isinstance(c, Node) and c.tag not in _SILENT]
    return out


def _measure(nodes: list[Node]) -> dict[int, tuple[int, int, int, int, int]]:
    """Characters, characters in links, paragraph-like children below each node; of its own, the
    characters and the paragraphs that no name tells apart."""
    found: dict[int, tuple[int, int, int, int, int]] = {}
    for node in reversed(nodes):
        chars = links = blocks = own = plain = 0
        for c in node.children:
            if isinstance(c, str):
                chars += (n := len(c.strip()))
                own += n
            elif id(c) in found:
                chars, links = chars + found[id(c)][0], links + found[id(c)][1]
                blocks += c.tag == "p"
                plain += c.tag == "p" and not _named(c) and found[id(c)][0] > SENTENCE
        found[id(node)] = (chars, chars if node.tag == "a" else links, blocks, own, plain)
    return found


def features(node: Node, measure: tuple[int, int, int, int, int]) -> list[str]:
    """Discrete statements about one element."""
    chars, links, blocks, own, plain = measure
    share = links / chars if chars else 0.0
    # What an element without a name holds itself is all that tells a main part from a frame.
    bare = [f"holds {node.tag} {min(plain, 2)} {own > SENTENCE}"] if node.tag in _FRAMES and not _named(node) else []
    return [
        *([] if node.parent is None else [f"tag {node.tag}"]),
        *bare,
        *sorted({f"name {n}" for n in node.names}),
        f"size {min(5, len(str(chars))) if chars else 0}",
        f"links {0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.7 else 3}",
        f"paragraphs {min(blocks, 3)}",
    ]


@dataclass
class Model:
    """Log-potentials: of a node's statements, and of a child's state given its parent's."""

    unary: dict[str, float]
    edge: dict[str, np.ndarray]
    root: float


def _labels(nodes: list[Node], main, bare: bool) -> dict[int, bool]:
    """Content or not by a page's own labels; a label holds for what is below it, ``bare`` for the root."""
    out: dict[int, bool] = {}
    for node in nodes:
        said = main(node)
        out[id(node)] = said if said is not None else out.get(id(node.parent), bare)
    return out


def seed_label(node: Node) -> bool | None:
    """What the seed pages say: data-label is ``main`` or ``rest``."""
    for n in node.names:
        if n.startswith("data-label="):
            return n.endswith("main")
    return None


#: Elements that the HTML standard defines as the main part, or as not of it.
_MAIN = frozenset(["article", "main"])
_REST = frozenset(["nav", "aside", "footer", "header", "form", "dialog", "menu", "button"])


def markup_label(node: Node) -> bool | None:
    if node.tag in _MAIN:
        return True
    return False if node.tag in _REST else None


def _tally(pages: list[tuple[str, float, object, bool]]) -> tuple[dict, dict, np.ndarray, np.ndarray]:
    """Counts of statements by state, of parents' and children's states, of states, and of roots' states."""
    unary: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(2))
    edge: dict[str, np.ndarray] = defaultdict(lambda: np.zeros((2, 2)))
    total, roots = np.zeros(2), np.zeros(2)
    for html, weight, main, bare in pages:
        nodes = in_order(parse(html))
        labels, measure = _labels(nodes, main, bare), _measure(nodes)
        roots[int(bare)] += weight
        for node in nodes:
            state = int(labels[id(node)])
            total[state] += weight
            for name in features(node, measure[id(node)]):
                if not name.startswith("name data-label"):
                    unary[name][state] += weight
            if node.parent is not None:
                edge[_edge_kind(node)][int(labels[id(node.parent)]), state] += weight
    return unary, edge, total, roots


def _edge_kind(node: Node) -> str:
    """Edges share potentials by the child's element where that tells sections apart."""
    if node.tag in _MAIN or node.tag in _REST:
        return node.tag
    return "named" if _named(node) else "inline" if node.tag in _INLINE else "plain"


def train(pages: list[str]) -> Model:
    """Potentials by counting over labelled pages, with add-one smoothing.

    The seed pages carry labels of every kind of section; the given pages are labelled by their
    own sectioning elements, where they have a main one.
    """
    marked = [(h, 1.0, markup_label, False) for h in pages if h and ("<article" in h or "<main" in h)]
    seeds = [(h, SEED_WEIGHT, seed_label, False) for h in seed_pages.PAGES]
    bare = [(h, SEED_WEIGHT, seed_label, True) for h in seed_pages.FRAGMENTS]
    unary, edge, total, roots = _tally(marked + seeds + bare)
    share = (total + 1) / (total.sum() + 2)
    logs = {}
    for name, n in unary.items():
        chance = (n + share) / (total + 1)
        ratio = float(np.log(chance[1]) - np.log(chance[0]))
        # Sizes and link shares repeat what the tree says already: they count for less.
        logs[name] = ratio if name.startswith(("tag", "name", "holds")) else ratio / 4
    edges = {}
    for kind, n in edge.items():
        smooth = n + 0.05
        edges[kind] = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    return Model(logs, edges, float(np.log(roots[1] + 1) - np.log(roots[0] + 1)))


def marginals(nodes: list[Node], model: Model) -> np.ndarray:
    """Probability that each element belongs to the main text, by sum-product on the tree.

    Messages go up from the leaves and down from the root once each, in logarithms; both passes
    are loops over the page order, so deep trees need no recursion.
    """
    index = {id(n): i for i, n in enumerate(nodes)}
    measure = _measure(nodes)
    default = np.log(np.array([[0.95, 0.05], [0.05, 0.95]]))
    own = np.zeros((len(nodes), 2))
    for i, node in enumerate(nodes):
        own[i, 1] = sum(model.unary.get(f, 0.0) for f in features(node, measure[id(node)]))
    own[0, 1] += model.root
    edge = [model.edge.get(_edge_kind(n), default) for n in nodes]
    parent = [index[id(n.parent)] if n.parent is not None else -1 for n in nodes]
    gathered = own.copy()
    up = np.zeros((len(nodes), 2))
    for i in range(len(nodes) - 1, 0, -1):
        up[i] = np.logaddexp(edge[i][:, 0] + gathered[i, 0], edge[i][:, 1] + gathered[i, 1])
        gathered[parent[i]] += up[i]
    down = np.zeros((len(nodes), 2))
    for i in range(1, len(nodes)):
        p = parent[i]
        outside = gathered[p] - up[i] + down[p]
        down[i] = np.logaddexp(edge[i][0] + outside[0], edge[i][1] + outside[1])
    belief = gathered + down
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -50, 50)))


def main_text(html: str | None, model: Model) -> str:
    """The blocks of the elements whose marginal is at least one half, joined by newlines.

    White space in a block becomes one space; empty blocks go. Text belongs to its element; an
    inline element inside a block continues it.
    """
    nodes = in_order(parse(html))
    chance = {id(n): p for n, p in zip(nodes, marginals(nodes, model))}
    blocks: list[list[str]] = [[]]
    todo: list = [(nodes[0], False)]
    while todo:
        item, ends = todo.pop()
        if isinstance(item, str):
            blocks[-1].append(item)
        elif ends:
            blocks.append([])
        elif item.tag == "br":
            blocks[-1].append(" ")
        elif id(item) in chance:
            block = item.tag not in _INLINE
            if block:
                blocks.append([])
                todo.append((item, True))
            inside = chance[id(item)] >= 0.5
            todo += [(c, False) for c in reversed(item.children) if inside or isinstance(c, Node)]
    lines = (_WHITE.sub(" ", "".join(b)).strip(" ") for b in blocks)
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    The model is trained on the seed pages and on at most ``sample`` pages of the table, those of
    the least hash. A null or empty page has an empty text; a page without a body is read as one;
    null ids, null URLs and repeated rows are rows like others; an empty table gives no rows; other
    columns are ignored.
    """
    mark = F.xxhash64("html")
    least = pages.select(mark.alias("mark")).distinct().orderBy("mark").limit(sample).agg(F.max("mark")).first()[0]
    # Only hashes are sorted; of the pages themselves each distinct one is sent once.
    taken = pages.filter(mark <= F.lit(least).cast("long")).select("html", mark.alias("mark"))
    taken = taken.dropDuplicates(["mark"]).collect()
    shared = pages.sparkSession.sparkContext.broadcast(train([r["html"] for r in sorted(taken, key=lambda r: r["mark"])]))

    def compute(texts: pa.Array) -> dict[str, object]:
        found = [main_text(h, shared.value) for h in texts.to_pylist()]
        return {"text": found, "n_chars": [len(t) for t in found]}

    html = pages.select("page_id", "url", F.col("html").alias("text"))
    return annotate(html, ["page_id", "url"], "text string, n_chars long", compute).select(
        "row.page_id", "row.url", "text", "n_chars"
    )
