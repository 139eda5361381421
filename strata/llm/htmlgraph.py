"""Main-text extraction by a tree-structured graphical model.

A page is parsed to a tree of elements whose leaves are text blocks (runs of
inline text within a block element). Every node is content or not; a node's
potential is a weighted sum of its features (element, class words, text size,
link density), and an edge's potential is a table over parent and child state
for the child's kind. The tree makes sum-product exact: messages run from
the leaves upward, then downward, and give each block's content marginal.
Weights maximise the likelihood of labelled pages (observed less expected
counts, by the same messages).

The given pages carry no labels, so the model is fitted on labelled pages
drawn by a seeded generator (``labelled_pages``) that varies templates,
elements, class words and text sizes; a caller may pass other labelled pages.
"""

from __future__ import annotations

import html as htmllib
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import small_batches

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noembed noframes xmp textarea title select desc metadata "
                "annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
# Parts of formulas and drawings: their text belongs to the text around them.
DRAWN = frozenset("math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle mpadded mphantom menclose merror "
                  "mfenced mprescripts mmultiscripts msub msup msubsup munder mover munderover mtable mtr mtd svg g defs "
                  "symbol use text tspan textpath path circle ellipse line polyline polygon rect marker pattern mask "
                  "clippath lineargradient radialgradient stop filter image foreignobject switch view".split())
INLINE |= DRAWN
CLOSES_P = frozenset("address article aside blockquote center details dialog div dl fieldset figcaption figure footer "
                     "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th")}
BARRIERS = frozenset("ul ol dl table article section div body html nav aside main footer header form".split())
KINDS = ("article main", "nav menu", "header hgroup", "footer", "aside", "form button fieldset dialog", "section",
         "div center body html", "p blockquote pre", "h1", "h2 h3 h4 h5 h6", "ul ol dl", "li dt dd", "table tr td th",
         "figure figcaption", "#text")
# Class, id and role words that tell of a part's use.
WORDS = (
    "ad ads advert advertisement adsense banner sponsor sponsored promo promotion",
    "comment comments respond reply replies discussion disqus",
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar skip",
    "sidebar side rail widget related recommended popular trending more",
    "footer foot copyright legal colophon bottom",
    "header masthead topbar head branding logo",
    "cookie cookies consent notice alert popup modal overlay gdpr warning message",
    "share sharing social follow subscribe newsletter signup login search",
    "tags tag meta byline author date",
    "article content post entry story body text main page single",
)
_KIND = {t: i for i, row in enumerate(KINDS) for t in row.split()}
_WORD = {w: i for i, row in enumerate(WORDS) for w in row.split()}
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
# Elements nest to this depth, as in browsers; deeper ones add their text to the element there.
MAX_DEPTH = 512
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
N_FEATURES = len(KINDS) + len(WORDS) + 11


@dataclass
class Tree:
    """Nodes in page order: parents come before children."""
    parent: list[int]
    kind: list[int]
    words: list[frozenset]
    chars: list[int]        # of text below a node
    linked: list[int]       # of those within links
    text: list[str | None]  # of text blocks
    depth: list[int]
    mark: list[str | None]  # value of a data-label attribute, as labelled pages have it


class _Tokens:
    """Tags, comments and declarations of a page, in order. Every search of
    the page remembers what it found, so the whole is linear in its length."""

    def __init__(self, src: str):
        self.src, self.seen, self.quoted = src, {}, True

    def find(self, mark: str, at: int) -> int:
        """First ``mark`` from ``at``, or the end of the page."""
        got = self.seen.get(mark)
        if got is None or not got[0] <= at <= got[1]:
            k = self.src.find(mark, at)
            got = self.seen[mark] = (at, k if k >= 0 else len(self.src))
        return got[1]

    def next(self, at: int):
        """(start, end, closing, name, attributes) of the next token from
        ``at``, its name empty where it is no tag; None if there is none. A
        "<" that starts no token is text. A tag ends at the first ">" outside
        quotes; where a quote is never closed, quotes don't count from there on."""
        src, n = self.src, len(self.src)
        while (at := src.find("<", at)) >= 0:
            if src.startswith("<!--", at):
                end = self.find("-->", at + 4)
                return at, min(end + 3, n), "", "", ""
            if src.startswith("<![CDATA[", at) and (end := self.find("]]>", at + 9)) < n:
                return at, end + 3, "", "", ""
            if src.startswith(("<!", "<?"), at):
                if (end := self.find(">", at + 2)) < n:
                    return at, end + 1, "", "", ""
            elif m := _NAME.match(src, at + 1):
                if (end := self.close(m.end())) < n:
                    return at, end + 1, m[1], m[2].lower(), src[m.end():end]
            if self.find(">", at) == n:
                return None
            at += 1
        return None

    def close(self, at: int) -> int:
        """The ">" that ends a tag whose name ends at ``at``."""
        n, k = len(self.src), at
        while self.quoted:
            end, single, double = self.find(">", k), self.find("'", k), self.find('"', k)
            quote = min(single, double)
            if end <= quote:
                if end == n:
                    self.quoted = False
                return end if end < n else self.find(">", at)
            k = self.find(self.src[quote], quote + 1) + 1
            if k > n:
                self.quoted = False
        return self.find(">", at)


def parse(page: str | None) -> Tree:
    """Tolerant parse of a page, linear in its length; a null or empty page is
    a bare root."""
    t = Tree([-1], [_KIND["div"]], [frozenset()], [0], [0], [None], [0], [None])
    src = page or ""
    stack: list[tuple[str, int]] = [("#root", 0)]       # block elements: tag, node
    inline: Counter = Counter()
    open_tags: Counter = Counter()
    deep: Counter = Counter()           # open elements beyond MAX_DEPTH
    held: list[tuple[str, bool]] = []
    tokens, at = _Tokens(src), 0

    def node(kind, words, text, mark=None):
        up = stack[-1][1]
        for col, v in zip((t.parent, t.kind, t.words, t.chars, t.linked, t.text, t.depth, t.mark),
                          (up, kind, words, 0, 0, text, t.depth[up] + 1, mark)):
            col.append(v)
        return len(t.parent) - 1

    def block():
        """Close the run of inline text: one text block."""
        if held:
            text = " ".join(htmllib.unescape("".join(s for s, _ in held)).split())
            if text:
                i = node(_KIND["#text"], frozenset(), text)
                t.chars[i] = len(text)
                whole = sum(len(s) for s, _ in held)
                t.linked[i] = len(text) * sum(len(s) for s, link in held if link) // max(whole, 1)
            held.clear()

    def pop_to(k):
        block()
        open_tags.subtract(s for s, _ in stack[k:])
        del stack[k:]
        inline.clear()
        deep.clear()

    while at < len(src):
        token = tokens.next(at)
        stop = token[0] if token else len(src)
        if stop > at:
            held.append((src[at:stop], inline["a"] > 0))
        if not token:
            break
        _, at, closing, tag, attributes = token
        if not tag:
            continue
        if closing:
            if tag in INLINE:
                inline[tag] = max(0, inline[tag] - 1)
            elif deep[tag] > 0:
                block()
                deep[tag] -= 1
            elif open_tags[tag] > 0:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        pop_to(k)
                        break
            continue
        if tag in RAW and not attributes.endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(src, at)
            at = close.start() if close else len(src)
            gt = src.find(">", at)
            at = gt + 1 if gt >= 0 else len(src)
            continue
        if tag == "br" or tag == "wbr":
            held.append((" " if tag == "br" else "", False))
            continue
        if tag in INLINE:
            if tag not in VOID and not (tag in DRAWN and attributes.endswith("/")):
                inline[tag] += 1
            continue
        if tag in CLOSES_P and open_tags["p"] > 0:
            k = max(i for i, (s, _) in enumerate(stack) if s == "p")
            pop_to(k)
        if any(open_tags[s] > 0 for s in SIBLINGS.get(tag, ())):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in SIBLINGS[tag]:
                    pop_to(k)
                elif stack[k][0] in BARRIERS:
                    break
        block()
        if tag in VOID or tag in ("html", "body"):
            continue
        if len(stack) >= MAX_DEPTH:
            deep[tag] += 1
            continue
        words, mark = frozenset(), None
        if attributes.strip(" /"):
            names = " ".join(v.strip("\"'") for _, v in _ATTR.findall(attributes))
            words = frozenset(_WORD[w.lower()] for w in _PART.findall(names) if w.lower() in _WORD)
            label = re.search(r'data-label="(\w+)"', attributes)
            mark = label and label[1]
        i = node(_KIND.get(tag, _KIND["div"]), words, None, mark)
        stack.append((tag, i))
        open_tags[tag] += 1
    block()
    for i in range(len(t.parent) - 1, 0, -1):
        t.chars[t.parent[i]] += t.chars[i]
        t.linked[t.parent[i]] += t.linked[i]
    return t


class Forest:
    """Trees of many pages in arrays: features and levels for message passing."""

    def __init__(self, trees: list[Tree]):
        sizes = [len(t.parent) for t in trees]
        base = np.repeat(np.cumsum([0] + sizes[:-1]), sizes)
        flat = lambda name: np.array([v for t in trees for v in getattr(t, name)])
        self.parent = np.where(flat("parent") < 0, -1, flat("parent") + base)
        self.kind, depth = flat("kind"), flat("depth")
        chars, linked = flat("chars"), flat("linked")
        n = len(self.parent)
        x = np.zeros((n, N_FEATURES), np.float32)
        x[np.arange(n), self.kind] = 1
        words = [(i, w) for i, ws in enumerate(ws for t in trees for ws in t.words) for w in ws]
        if words:
            i, w = np.array(words).T
            x[i, len(KINDS) + w] = 1
        k = len(KINDS) + len(WORDS)
        density = linked / np.maximum(chars, 1)
        x[:, k] = 1
        x[:, k + 1] = density
        x[:, k + 2] = density > 0.5
        size = np.log2(chars + 1.0)
        x[:, k + 3] = size / 10
        for j, least in enumerate((1, 30, 80, 200, 600)):
            x[:, k + 4 + j] = chars >= least
        x[:, k + 9] = np.minimum(depth, 12) / 12
        x[:, k + 10] = self.kind == _KIND["#text"]
        self.x, self.depth = x, depth
        order = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[order], np.arange(1, int(depth.max(initial=0)) + 2))
        self.levels = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]     # depth 1, 2, ...


@dataclass
class Model:
    weights: np.ndarray     # feature -> log odds of content
    edges: np.ndarray       # kind of child, parent state, child state


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    """log-sum-exp over an axis of two states."""
    return np.logaddexp(a.take(0, axis), a.take(1, axis))


def propagate(model: Model, f: Forest) -> tuple[np.ndarray, np.ndarray]:
    """Sum-product on all trees at once: node marginals (n, 2) and, for each
    node but a root, the joint of parent and own state (n, 2, 2)."""
    z = f.x @ model.weights
    up = np.column_stack((np.zeros_like(z), z)).astype(np.float64)
    psi = model.edges[f.kind]
    message = np.zeros_like(up)                     # from a node to its parent
    for level in reversed(f.levels):
        message[level] = _logsum(psi[level] + up[level][:, None, :], 2)
        p, first = np.unique(f.parent[level], return_index=True)    # a level's children lie side by side
        up[p] += np.add.reduceat(message[level], first)
    down = np.zeros_like(up)                        # from the parent to a node
    joint = np.zeros((len(z), 2, 2))
    for level in f.levels:
        p = f.parent[level]
        above = up[p] + down[p] - message[level]
        both = psi[level] + above[:, :, None]
        down[level] = _logsum(both, 1)
        down[level] -= down[level].max(axis=1, keepdims=True)
        full = both + up[level][:, None, :]
        full -= full.max(axis=(1, 2), keepdims=True)
        e = np.exp(full)
        joint[level] = e / e.sum(axis=(1, 2), keepdims=True)
    b = up + down
    b = np.exp(b - b.max(axis=1, keepdims=True))
    return b / b.sum(axis=1, keepdims=True), joint


def fit(pages: list[str], rounds: int = 200, l2: float = 1e-4) -> Model:
    """Maximum-likelihood weights from labelled pages: elements carry
    ``data-label="content"`` or ``"other"``, which holds for all below them
    until a nearer label; a node above labelled parts is content if any of
    its text is."""
    trees = [parse(p) for p in pages]
    f = Forest(trees)
    y = np.concatenate([_states(t) for t in trees])
    model = Model(np.zeros(N_FEATURES), np.zeros((len(KINDS), 2, 2)))
    child = f.parent >= 0
    seen = np.zeros_like(model.edges)
    np.add.at(seen, (f.kind[child], y[f.parent[child]], y[child]), 1)
    n = len(y)
    rate = [np.zeros(N_FEATURES), np.zeros_like(model.edges)]
    for _ in range(rounds):
        marginal, joint = propagate(model, f)
        expected = np.stack([np.bincount(f.kind[child], joint[child, a, b], len(KINDS)) for a in (0, 1)
                             for b in (0, 1)], axis=1).reshape(model.edges.shape)
        grads = (f.x.T @ (y - marginal[:, 1]) / n - l2 * model.weights, (seen - expected) / n - l2 * model.edges)
        for value, g, r in zip((model.weights, model.edges), grads, rate):
            r += g * g
            value += 1.0 * g / (np.sqrt(r) + 1e-8)
    return model


def _states(t: Tree) -> np.ndarray:
    mark = list(t.mark)
    for i in range(1, len(mark)):
        mark[i] = mark[i] or mark[t.parent[i]]
    y = np.array([m == "content" for m in mark], np.int64)
    for i in range(len(y) - 1, 0, -1):
        if t.mark[t.parent[i]] is None and y[i] and mark[t.parent[i]] is None:
            y[t.parent[i]] = 1
    return y


def extract(model: Model, pages: list[str | None], separator: str = "\n") -> list[str]:
    """Content blocks of each page in order, joined by ``separator``."""
    trees = [parse(p) for p in pages]
    if not trees:
        return []
    keep = propagate(model, Forest(trees))[0][:, 1] >= 0.5
    out, at = [], 0
    for t in trees:
        out.append(separator.join(s for s, k in zip(t.text, keep[at:at + len(t.text)]) if k and s))
        at += len(t.text)
    return out


# --- labelled pages -------------------------------------------------------------------------

_OTHER = (
    ("nav", ("", "menu", "main-nav", "breadcrumb")), ("div", ("navbar", "nav menu", "breadcrumbs", "pagination")),
    ("header", ("", "site-header", "masthead")), ("div", ("header", "topbar", "logo")),
    ("footer", ("", "site-footer")), ("div", ("footer", "copyright", "legal")),
    ("aside", ("", "sidebar", "related")), ("div", ("sidebar", "widget", "related", "popular more")),
    ("div", ("ad", "ads", "advert", "sponsored", "promo banner")), ("section", ("promo", "advertisement", "related")),
    ("div", ("cookie-notice", "consent", "alert notice", "popup")), ("form", ("", "search", "newsletter", "login")),
    ("section", ("comments", "discussion", "respond")), ("div", ("comments", "comment-list", "replies", "disqus")),
    ("div", ("share", "social follow", "subscribe")), ("ol", ("comments", "comment-list")),
)
_MAIN = (("article", ("", "post", "entry", "story")), ("main", ("", "content")),
         ("div", ("content", "article-body", "post-content", "entry-content", "story text", "main", "")),
         ("section", ("article", "content", "")))


# Where a page keeps its article: in a part named for it, in elements without names, straight in the body, in a table.
FAMILIES = ("part", "nested", "nested", "flat", "table")


def labelled_pages(count: int = 600, seed: int = 7, families: tuple = FAMILIES) -> list[str]:
    """Seeded pages of varied templates whose parts carry ``data-label``."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(("ta", "re", "on", "is", "mu", "el", "da", "ko")) for _ in range(r.randint(1, 3)))
    prose = lambda lo, hi: " ".join(word() for _ in range(r.randint(lo, hi))).capitalize() + "."
    links = lambda lo, hi: "".join(f'<li><a href="/{word()}">{word()}</a></li>' for _ in range(r.randint(lo, hi)))
    cls = lambda c: f' class="{c}"' if c else ""

    def other(only=None):
        tag, names = r.choice([o for o in _OTHER if only is None or o[0] in only])
        name = r.choice(names)
        if "comment" in name or "respond" in name or "replies" in name or "discuss" in name or "disqus" in name:
            item = "li" if tag == "ol" else "div"
            body = "".join(f"<{item}{cls(r.choice(('comment', 'reply', '')))}><p>{prose(3, 60)}</p></{item}>"
                           for _ in range(r.randint(1, 6)))
            body = r.choice(("", "<h3>" + prose(1, 2) + "</h3>")) + body
        elif tag == "nav" or "nav" in name or "menu" in name or "bread" in name or "pagin" in name:
            body = f"<ul>{links(2, 9)}</ul>"
        elif tag == "form":
            body = f"<label>{prose(1, 4)}</label><input name=q><p>{prose(2, 12)}</p><button>{word()}</button>"
        else:
            body = r.choice((prose(2, 30), f"<p>{prose(2, 40)}</p>", f"<h3>{prose(1, 4)}</h3><ul>{links(2, 6)}</ul>",
                             f"<p>{prose(2, 25)}</p><a href=x>{prose(1, 4)}</a>"))
        return f'<{tag}{cls(name)} data-label="other">{body}</{tag}>'

    def content():
        parts = [f"<h1>{prose(1, 12)}</h1>"] if r.random() < 0.6 else []
        for _ in range(r.randint(1, 12) if r.random() < 0.6 else r.randint(1, 2)):
            parts.append(r.choices((
                f"<p>{r.choice((word() + chr(46), prose(1, 6)))}</p>", f"<p>{prose(10, 120)}</p>", f"<h2>{prose(1, 8)}</h2>",
                f"<p><b>{prose(1, 40)}<br><p>{prose(1, 40)}", f"<ul><li>{prose(2, 20)}</li><li>{prose(2, 20)}</li></ul>",
                f"<blockquote><p>{prose(5, 50)}</p></blockquote>", prose(5, 80),
                f"<p>{prose(5, 30)} <a href=x>{prose(1, 4)}</a> {prose(5, 30)}</p>",
                f"<table><tr><td>{prose(1, 5)}</td><td>{prose(1, 5)}</td></tr></table>",
                f"<figure><figcaption>{prose(3, 15)}</figcaption></figure>"),
                (3, 6, 1, 1, 1, 1, 1, 2, 0.5, 0.5))[0])
            if r.random() < 0.12:
                parts.append(other(("div", "aside", "section", "form")))
        family, body = r.choice(families), "".join(parts)
        if family == "part":
            tag, names = r.choice(_MAIN)
            return f'<{tag}{cls(r.choice(names))} data-label="content">{body}</{tag}>'
        if family == "nested":
            inner = r.randint(0, 3)
            name = cls(r.choice(("", "", "", "x1", "col", "css-1a2b")))
            return f'<div{name} data-label="content">{"<div>" * inner}{body}{"</div>" * inner}</div>'
        if family == "table":
            side = f"<td>{other()}</td>" * (r.random() < 0.5)
            return f'<table><tr>{side}<td data-label="content">{body}</td></tr></table>'
        # Straight in the body: every part carries its own label; text without an element would have none.
        return "".join(re.sub(r"^<(\w+)", r'<\1 data-label="content"', p) if "data-label" not in p.split(">")[0] else p
                       for p in parts if p.startswith("<"))

    out = []
    for _ in range(count):
        alone = r.random() < 0.25
        before = "" if alone else "".join(other() for _ in range(r.randint(0, 4)))
        after = "" if alone else "".join(other() for _ in range(r.randint(0, 4)))
        body = content()
        if r.random() < 0.4:
            tag, names = r.choice((("div", ("page", "wrapper", "container", "single")), ("main", ("",)),
                                   ("section", ("main", ""))))
            body = f"<{tag}{cls(r.choice(names))}>{other() * (r.random() < 0.3)}{body}{other() * (r.random() < 0.3)}</{tag}>"
        out.append(f"<!DOCTYPE html><html><head><title>{prose(1, 9)}</title></head><body>{before}{body}{after}</body></html>")
    return out


def extract_pages(spark: SparkSession, pages: DataFrame, html_col: str = "html", out: str = "text",
                  model: Model | None = None, separator: str = "\n\n") -> DataFrame:
    """``pages`` with its main text in a new column ``out``, its blocks joined
    by ``separator``; every row gets one, empty for a null, empty or contentless page. Rows are independent:
    nulls elsewhere and repeated rows are passed through; an empty table stays
    empty; an existing column ``out`` is an error."""
    if out in pages.columns:
        raise ValueError(f"column {out} exists")
    small_batches(spark)
    held = spark.sparkContext.broadcast(model or fit(labelled_pages()))
    at = pages.columns.index(html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = extract(held.value, b.column(at).to_pylist(), separator)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())], [*b.schema.names, out])

    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField(out, T.StringType())]))
