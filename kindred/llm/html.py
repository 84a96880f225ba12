"""Main-text extraction by a tree-structured graphical model over the DOM.

Each element and each block of text is a node with two states, content or not. A node's own potential is
logistic in features of its tag, its class and id words, its text and its links; an edge's potential
couples parent and child. Messages upward and downward give every node's exact marginal. Potentials are
trained on labelled pages by the likelihood's gradient, observed states minus marginals."""

from __future__ import annotations

import html as entities
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from math import exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# Fixed values of HTML: elements without content, with raw text, that begin a block, that close an open p,
# and never shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td
    tfoot th thead tr ul""".split()
)
CLOSES_P = BLOCK - frozenset("body caption dd dt html legend li optgroup option summary tbody td tfoot th thead tr".split())
HIDDEN = frozenset("script style noscript template head title svg math textarea select option button iframe object embed noembed noframes audio video canvas xmp".split())
#: An opening tag on the left ends an open element on the right, up to the nearest of the last set.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+")

# Words of class, id and role by what they tell; names in pages, stated plainly.
WORDS = {
    "is_ad": "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion affiliate outbrain taboola".split(),
    "is_nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs pager pagination pagenav tabs toolbar toc skip sitemap".split(),
    "is_side": "sidebar side aside widget widgets rail related recommended recommendations popular trending archive archives tags tagcloud categories more latest teaser teasers".split(),
    "is_foot": "foot footer colophon copyright legal imprint credits bottom".split(),
    "is_head": "header masthead topbar top logo branding brand siteheader site".split(),
    "is_note": "cookie cookies consent gdpr notice notices notification alert warning disclaimer popup modal overlay newsletter subscribe subscription signup login paywall".split(),
    "is_talk": "comment comments commentlist disqus reply replies respond discussion reviews review feedback reader responses".split(),
    "is_share": "share sharing social follow tools meta byline author tweet facebook rating buttons print".split(),
    "is_text": "article post entry content story body text main prose blog news page chapter".split(),
}
_WORD_KIND = {w: k for k, ws in WORDS.items() for w in ws}
TAG_KINDS = ("html body div span section article main p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th blockquote pre figure figcaption address nav header footer aside form fieldset menu dialog details summary search label a #text").split()


@dataclass
class Node:
    tag: str
    parent: int
    kinds: tuple[str, ...] = ()
    text: str = ""  #: of a block of text: white space collapsed and trimmed
    linked: int = 0  #: characters inside links
    n: int = 0  #: characters below
    links: int = 0
    inside: frozenset = field(default_factory=frozenset)  #: tags around it
    under: frozenset = field(default_factory=frozenset)  #: kinds of the elements around it


def parse(page: str) -> list[Node]:
    """Nodes in page order, parents first: visible elements that begin a block, and the blocks of text in
    them. Inline elements add to the text of the block around them; a br is white space."""
    nodes = [Node("#root", -1)]
    # all elements, with the node they belong to; one that ended inside an open one stays as a gap ("", -1)
    stack: list[tuple[str, int]] = [("#root", 0)]
    places: defaultdict[str, list[int]] = defaultdict(list)  # where the open elements of each tag are
    blocks = [0]  # and those that begin a block: no end tag searches the stack
    hidden, links = 0, 0
    parts: list[str] = []
    linked = n_links = 0

    def flush() -> None:
        nonlocal linked, n_links
        text = _SPACE.sub(" ", "".join(parts)).strip()
        if text:
            nodes.append(Node("#text", stack[-1][1], text=text, linked=min(linked, len(text)), n=len(text), links=n_links))
        parts.clear()
        linked = n_links = 0

    def add(text: str) -> None:
        nonlocal linked
        if hidden or not text:
            return
        got = entities.unescape(text)
        parts.append(got)
        if links:
            linked += len(got.strip())

    def last(tag: str) -> int:
        found = places.get(tag)
        return found[-1] if found else 0

    def close(k: int) -> None:
        """Close open elements from place k on."""
        nonlocal hidden, links
        if blocks[-1] >= k:
            flush()
        while len(stack) > k or not stack[-1][0]:
            t, _ = stack.pop()
            if t:
                places[t].pop()
                hidden -= t in HIDDEN
                links -= t == "a"
        while blocks[-1] >= k:
            blocks.pop()

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, attrs = name.lower(), m[3] or m[6] or ""
        if m[1] or m[4]:
            k = last(tag)
            if k and (tag in BLOCK or blocks[-1] <= k):
                close(k)
            elif k:  # an inline end tag across blocks ends the inline element alone
                hidden -= tag in HIDDEN
                links -= tag == "a"
                places[tag].pop()
                stack[k] = ("", -1)
            elif tag == "p" or tag == "br":
                parts.append(" ")
            continue
        if tag == "br":
            parts.append("\n")
            continue
        if tag in CLOSES_P or tag in ENDS:
            names, until = ENDS.get(tag, ({"p"}, {"button", "table", "td", "th", "caption", "object"}))
            ended = names | {"p"}
            while (k := max(map(last, ended))) and k > max(map(last, until)):
                close(k)
                if stack[-1][0] not in names:
                    break
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        own = stack[-1][1]
        if tag in BLOCK and not hidden and tag not in HIDDEN:
            flush()
            kinds = []
            for a in _ATTR.finditer(attrs):
                key, value = a[1].lower(), a[2] or a[3] or a[4] or ""
                if key in ("class", "id", "role", "itemprop", "aria-label"):
                    kinds += [_WORD_KIND[w] for w in _NAME.findall(value.lower()) if w in _WORD_KIND]
                elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                    kinds.append("is_hidden")
            if re.search(r"(?:^|\s)hidden(?:\s|=|$|/)", attrs):
                kinds.append("is_hidden")
            own = len(nodes)
            nodes.append(Node(tag, stack[-1][1], tuple(sorted(set(kinds)))))
        if attrs.rstrip().endswith("/") and tag not in BLOCK and tag not in HIDDEN:
            continue
        if tag in HIDDEN and not hidden and tag in ("textarea", "select", "option", "button"):
            parts.append(" ")
        places[tag].append(len(stack))
        if tag in BLOCK:
            blocks.append(len(stack))
        stack.append((tag, own))
        hidden += tag in HIDDEN
        if tag == "a":
            links += 1
            n_links += not hidden
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else size
    flush()
    for k in range(len(nodes) - 1, 0, -1):
        up = nodes[nodes[k].parent]
        up.n, up.linked, up.links = up.n + nodes[k].n, up.linked + nodes[k].linked, up.links + nodes[k].links
    for k in nodes[1:]:
        up = nodes[k.parent]
        k.under = up.under.union(up.kinds) if up.kinds else up.under
        k.inside = nodes[k.parent].inside | {nodes[k.parent].tag} if nodes[k.parent].tag in ("article", "main", "nav", "aside", "footer", "header", "form", "li", "table") else nodes[k.parent].inside
    return nodes


#: Share of the labelled pages with made-up names: so much does a block's place and form count beside names.
STRANGE = 0.3
FEATURES = ["bias", *(f"tag {t}" for t in TAG_KINDS), "tag other", *WORDS, "is_hidden", *(f"in {t}" for t in ("article", "main", "nav", "aside", "footer", "header", "form", "li", "table")), *(f"under {k}" for k in WORDS), "before h1", "after h1", "text", "short text", "long text", "link share", "mostly links", "many links", "ends sentence", "has words"]
_PLACE = {f: k for k, f in enumerate(FEATURES)}
EDGES = ("edge", "edge to text")


def describe(nodes: list[Node]) -> list[list[tuple[int, float]]]:
    """The features of each node that are not zero, with their values."""
    out = []
    title = max((k for k, v in enumerate(nodes) if v.tag == "h1"), default=None)  # the site's name may be an h1 before it
    for k, v in enumerate(nodes):
        row = [(0, 1.0), (_PLACE.get(f"tag {v.tag}", _PLACE["tag other"]), 1.0)]
        row += [(_PLACE[f], 1.0) for f in v.kinds]
        row += [(_PLACE[f"in {t}"], 1.0) for t in v.inside]
        row += [(_PLACE[f"under {t}"], 1.0) for t in v.under if t in WORDS]
        if title is not None and k != title:
            row.append((_PLACE["before h1" if k < title else "after h1"], 1.0))
        if v.n:
            share = v.linked / v.n
            if share:
                row.append((_PLACE["link share"], share))
            if share > 0.5:
                row.append((_PLACE["mostly links"], 1.0))
            if v.links > 3 and share > 0.3:
                row.append((_PLACE["many links"], 1.0))
        if v.tag == "#text":
            row.append((_PLACE["text"], min(v.n, 400) / 400))
            if v.n < 25:
                row.append((_PLACE["short text"], 1.0))
            if v.n > 120:
                row.append((_PLACE["long text"], 1.0))
            if v.text[-1] in ".!?…\"'”":
                row.append((_PLACE["ends sentence"], 1.0))
            if v.text.count(" ") > 5:
                row.append((_PLACE["has words"], 1.0))
        out.append(row)
    return out


def _log_add(a: float, b: float) -> float:
    return a + log1p(exp(b - a)) if a > b else b + log1p(exp(a - b))


@dataclass
class Model:
    own: list[float]  #: weight of each feature for content
    edge: list[list[list[float]]]  #: two kinds of edge, by parent's and child's state

    def marginals(self, nodes: list[Node], x: list[list[tuple[int, float]]]) -> list[float]:
        """P(content) of each node, by sum-product."""
        return self.passed(nodes, [sum(self.own[k] * v for k, v in row) for row in x])

    def passed(self, nodes: list[Node], up1: list[float], pairs: bool = False):
        """The marginals by the nodes' own potentials, which the messages are added to; with pairs, also
        P(parent's state, child's state) of each node's edge to its parent."""
        n = len(nodes)
        up0 = [0.0] * n
        msg0, msg1, down0, down1 = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
        for k in range(n - 1, 0, -1):  # children come after parents
            v = nodes[k]
            (e00, e01), (e10, e11) = self.edge[v.tag == "#text"]
            msg0[k], msg1[k] = _log_add(e00 + up0[k], e01 + up1[k]), _log_add(e10 + up0[k], e11 + up1[k])
            up0[v.parent] += msg0[k]
            up1[v.parent] += msg1[k]
        both: list[tuple[float, float, float, float]] = [(0.0,) * 4] * n
        for k in range(1, n):
            v = nodes[k]
            (e00, e01), (e10, e11) = self.edge[v.tag == "#text"]
            r0, r1 = up0[v.parent] + down0[v.parent] - msg0[k], up1[v.parent] + down1[v.parent] - msg1[k]
            down0[k], down1[k] = _log_add(e00 + r0, e10 + r1), _log_add(e01 + r0, e11 + r1)
            if pairs:
                cell = (e00 + r0 + up0[k], e01 + r0 + up1[k], e10 + r1 + up0[k], e11 + r1 + up1[k])
                top = max(cell)
                cell = tuple(exp(c - top) for c in cell)
                both[k] = tuple(c / sum(cell) for c in cell)
        gap = [max(-700.0, min(700.0, up0[k] + down0[k] - up1[k] - down1[k])) for k in range(n)]
        p = [1 / (1 + exp(g)) for g in gap]
        return (p, both) if pairs else p


def _words(rng: random.Random, n: int) -> str:
    sound = "ba ke li mo nu ra se ti vo za der ung que les ion ard ent ish os ar".split()
    return " ".join("".join(rng.choice(sound) for _ in range(rng.randint(1, 4))) for _ in range(n))


def _sentence(rng: random.Random, low: int = 6, high: int = 30) -> str:
    return _words(rng, rng.randint(low, high)).capitalize() + rng.choice(".....!?")


def labelled_page(seed: int, strange: float = STRANGE) -> tuple[str, set[str]]:
    """A page and its blocks of main text, written from one of many layouts. No word of it is a feature. On a
    share of the pages, `strange`, half of the class names and ids are made up too and tell nothing."""
    rng = random.Random(seed)
    made_up = 0.5 * (rng.random() < strange)
    main: list[str] = []

    def text(s: str) -> str:
        main.append(s)
        return s

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{k}">{_words(rng, rng.randint(1, 3))}</a></li>' for k in range(n))

    def named(kind: str) -> str:
        name = _words(rng, 1) if rng.random() < made_up else rng.choice(WORDS[kind])
        return rng.choice(["class", "class", "id"]) + f'="{name}{rng.choice(["", "", "-box", "_1", " wide"])}"'

    def side(kind: str) -> str:
        tag = {"is_nav": ["nav", "div", "ul"], "is_side": ["aside", "div", "section"], "is_foot": ["footer", "div"], "is_head": ["header", "div"]}.get(kind, ["div", "section", "aside", "div"])
        tag, attr = rng.choice(tag), named(kind)
        if tag in ("nav", "aside", "footer", "header") and rng.random() < 0.6:
            attr = ""
        if tag == "ul" or kind == "is_nav":
            inner = links(rng.randint(2, 9)) if tag == "ul" else f"<ul>{links(rng.randint(2, 9))}</ul>"
        elif kind == "is_talk":
            inner = "".join(f"<{t}><b>{_words(rng, 1)}</b> {' '.join(_sentence(rng) for _ in range(rng.randint(1, 4)))}</{t}>" for t in rng.choices(["p", "div", "li"], k=rng.randint(1, 5)))
            inner = f"<h3>{_words(rng, 1)}</h3>" + inner
        elif kind == "is_head":
            inner = rng.choice([f"<h1>{_words(rng, 2)}</h1>", f"<p>{_words(rng, 3)}</p>", f"<ul>{links(4)}</ul>", f'<a href="/">{_words(rng, 2)}</a>'])
        else:
            inner = rng.choice(["{}", "<p>{}</p>", "<p>{}</p><p>{}</p>", "<div><p>{}</p></div>", "<h3>{}</h3><p>{}</p>"])
            inner = re.sub(r"\{\}", lambda _: " ".join(_sentence(rng, 3, 18) for _ in range(rng.randint(1, 3))), inner)
            if rng.random() < 0.4:
                inner += f"<ul>{links(rng.randint(1, 6))}</ul>"
        return f"<{tag} {attr}>{inner}</{tag}>"

    def form() -> str:
        return f"<form><p>{_words(rng, 4)}</p><label>{_words(rng, 2)}</label><input name=q><button>{_words(rng, 1)}</button></form>"

    def block() -> str:
        r = rng.random()
        if r < 0.7:
            s = " ".join(_sentence(rng) for _ in range(rng.randint(1, 7)))
            return f"<p>{text(s)}" + rng.choice(["</p>", "</p>", "<br>", ""])
        if r < 0.78:
            return f"<{(h := rng.choice(['h2', 'h3', 'h4']))}>{text(_words(rng, rng.randint(1, 6)))}</{h}>"
        if r < 0.86:
            return "<ul>" + "".join(f"<li>{text(_sentence(rng, 3, 12))}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        if r < 0.9:
            return f"<blockquote><p>{text(_sentence(rng))}</p></blockquote>"
        if r < 0.94:
            return f"<pre>{text(_words(rng, 5))}</pre>"
        if r < 0.97:
            return "<table>" + "".join(f"<tr><td>{text(_words(rng, 2))}</td><td>{text(_words(rng, 1))}</td></tr>" for _ in range(2)) + "</table>"
        return f"<p>{text(_words(rng, rng.randint(1, 3)) + '.')}</p>"

    body, inside = [], []
    for kind, chance in (("is_head", 0.5), ("is_nav", 0.8), ("is_note", 0.3), ("is_ad", 0.6), ("is_side", 0.3)):
        if rng.random() < chance:
            body.append(side(kind))
    if rng.random() < 0.2:
        body.append(form())
    head = f"<h1>{text(_words(rng, rng.randint(2, 9)))}</h1>"
    if rng.random() < 0.3:
        head = f"<header>{head}</header>"
    for _ in range(rng.randint(1, 12)):
        inside.append(block())
        r = rng.random()
        if r < 0.1:
            inside.append(side(rng.choice(["is_ad", "is_share", "is_note", "is_side", "is_ad"])))
        elif r < 0.12:
            inside.append(form())
    if rng.random() < 0.2:
        inside.append(side(rng.choice(["is_talk", "is_share", "is_side", "is_foot"])))
    tag = rng.choice(["article", "article", "article", "main", "div", "section"])
    attr = "" if tag in ("article", "main") and rng.random() < 0.6 else " " + named("is_text")
    core = f"<{tag}{attr}>{head}{''.join(inside)}</{tag}>"
    if rng.random() < 0.3:
        core = f"<{(w := rng.choice(['main', 'div', 'section']))}>{core}</{w}>"
    body.append(core)
    for kind, chance in (("is_talk", 0.35), ("is_side", 0.4), ("is_ad", 0.3), ("is_note", 0.2), ("is_foot", 0.8)):
        if rng.random() < chance:
            body.append(side(kind))
    page = f"<!DOCTYPE html><html><head><title>{_words(rng, 3)}</title><style>p{{}}</style></head><body>{''.join(body)}</body></html>"
    return page, set(main)


def states(nodes: list[Node], main: set[str]) -> list[int]:
    """A block of text is content if it is labelled so, an element if most of its text is."""
    good = [v.n * (v.text in main) if v.tag == "#text" else 0 for v in nodes]
    for k in range(len(nodes) - 1, 0, -1):
        good[nodes[k].parent] += good[k]
    return [int(g > 0.5 * v.n) for g, v in zip(good, nodes)]


def train(pages: list[tuple[str, set[str]]], rounds: int, l2: float = 0.0001, step: float = 1.0) -> Model:
    """Full-batch AdaGrad on the log likelihood of the labelled states."""
    data = []
    for page, main in pages:
        nodes = parse(page)
        data.append((nodes, describe(nodes), states(nodes, main)))
    own, edge = np.zeros(len(FEATURES)), np.zeros((2, 2, 2))
    # all pages' features as one sparse matrix: row, feature, value
    rows = [row for _, x, _ in data for row in x]
    at = np.repeat(np.arange(len(rows)), [len(row) for row in rows])
    feature, value = np.array([f for row in rows for f, _ in row], np.int64), np.array([v for row in rows for _, v in row])
    wanted, total = np.array([s for _, _, y in data for s in y], float), len(rows)
    seen = [np.zeros_like(own), np.zeros_like(edge)]
    for _ in range(rounds):
        model = Model(own.tolist(), edge.tolist())
        potential = np.bincount(at, own[feature] * value, total).tolist()
        got: list[float] = []
        g_edge = [[0.0] * 4, [0.0] * 4]
        for nodes, _, y in data:
            p, pair = model.passed(nodes, potential[len(got) : len(got) + len(nodes)], pairs=True)
            got += p
            for k in range(1, len(nodes)):
                g = g_edge[nodes[k].tag == "#text"]
                for c in range(4):
                    g[c] -= pair[k][c]
                g[2 * y[nodes[k].parent] + y[k]] += 1
        g_own = np.bincount(feature, ((wanted - np.array(got))[at]) * value, len(FEATURES))
        grads = (g_own / total - l2 * own, np.array(g_edge).reshape(2, 2, 2) / total - l2 * edge)
        for s, g in zip(seen, grads):
            s += g * g
        own = own + step * grads[0] / np.sqrt(seen[0] + 1e-8)
        edge = edge + step * grads[1] / np.sqrt(seen[1] + 1e-8)
    return Model(own.tolist(), edge.tolist())


@cache
def default_model(pages: int = 160, rounds: int = 60) -> Model:
    """Trained on the labelled pages of seeds 0 to pages - 1: once for each driver, and the same each time."""
    return train([labelled_page(s) for s in range(pages)], rounds)


def main_text(page: str, model: Model, threshold: float = 0.5) -> str:
    nodes = parse(page)
    if len(nodes) < 2:
        return ""
    p = model.marginals(nodes, describe(nodes))
    return "\n".join(v.text for v, q in zip(nodes, p) if v.tag == "#text" and q >= threshold)


def extract(pages: DataFrame, model: Model | None = None, threshold: float = 0.5) -> DataFrame:
    """One row per row of pages (page_id, url, html; other columns are ignored): page_id, url, text, n_chars.

    Null, empty and text-free html give an empty text. Broken markup is read as browsers do in the common
    cases: open elements end with their parents, unknown tags are inline. Repeated rows get a row each; an
    empty table gives none. A page is one row's work; its memory follows its length."""
    small_batches(pages.sparkSession)
    held = pages.sparkSession.sparkContext.broadcast(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h or "", held.value, threshold) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    p = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), pages["html"].cast("string").alias("html"))
    return p.mapInArrow(run, "page_id long, url string, text string, n_chars long")
