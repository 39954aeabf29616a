"""Main text of web pages: gradient-boosted trees over DOM nodes, and a decoding along the tree.

A page is cut into a tree of elements; text that stands in a block beside other blocks is an element too. Each element that can hold text on its own becomes a row of features: text, tag and link
densities of its subtree, depth, place among its siblings and shares of its parent, and hashed tokens of its tag, class, id and role and of
those of its ancestors. Boosted trees give each row the log-odds of being the article or a way to it. The decoding takes the subtree
with the highest sum in which whatever is kept has its ancestors kept, so no block survives inside a menu that was dropped.

Labels come from the given pages themselves: in a bounded sample, pages that name their article (`<article>`, `<main>`, role=main)
are labelled by it, and variants of them (other tags and class names, added menus, notices, forms, comments, lists) keep the
labels of their parts. Nothing is dropped by a list of names but what never shows as text: scripts, styles, form controls and the like.
Math, xmp and the fallback text of noscript, object, noembed and noframes are left to the trees.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES = 300
VARIANTS = 4
TREES = 30
DEPTH = 6
RATE = 0.5
BINS = 24
HASHED = 96
DOUBT = 1.0  # log-odds for keeping what only variants taught

# --- fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
HIDDEN = frozenset("script style textarea title head template svg annotation annotation-xml iframe canvas audio video map select option button datalist input".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input button select textarea option picture math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd semantics annotation annotation-xml maction".split()
)
CELLS = frozenset("td th".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
# an opening tag ends these, up to a boundary
ENDS = {
    "li": ("li", "ul ol menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table thead tbody tfoot"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "thead": ("thead tbody tfoot tr td th", "table"),
    "tbody": ("thead tbody tfoot tr td th", "table"),
    "tfoot": ("thead tbody tfoot tr td th", "table"),
    "option": ("option", "select"),
    "body": ("head", "html"),
}
ENDS = {tag: (frozenset(a.split()), frozenset(b.split())) for tag, (a, b) in ENDS.items()}
# --- end of fixed values

# the element around a run of text and line elements that stands directly in a block; training pages may write it out
RUN = "x-run"
INLINE = INLINE | {RUN}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|data-part)\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+))", re.I | re.S)
_TOKEN = re.compile(r"[a-z]+")
NOTHING = "\u0000"  # an element without text, inside a line
_SPACE = re.compile(r"\s+")


@dataclass
class Page:
    """Elements as columns, in page order, and the texts between the tags."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    tokens: list[tuple[str, ...]] = field(default_factory=list)
    part: list[str | None] = field(default_factory=list)
    events: list[tuple[int, str]] = field(default_factory=list)  # (element, text); an empty text marks the edge of a block


def parse(source: str) -> Page:
    page = Page()
    tags, parents, events = page.tag, page.parent, page.events

    def add(tag: str, parent: int, rest: str) -> int:
        tags.append(tag)
        parents.append(parent)
        tokens, part = (), None
        if "=" in rest:
            for name, a, b, c in _ATTRIBUTE.findall(rest):
                value = a or b or c
                if name.lower() == "data-part":
                    part = value
                else:
                    tokens += tuple(_TOKEN.findall(value.lower()))
        page.tokens.append(tokens)
        page.part.append(part)
        return len(tags) - 1

    stack = [add("", -1, "")]
    open_tags: dict[str, int] = {}

    def push(node: int) -> None:
        stack.append(node)
        open_tags[tags[node]] = open_tags.get(tags[node], 0) + 1

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            tag = tags[stack[-1]]
            if tag not in INLINE:
                events.append((stack[-1], ""))
            open_tags[tag] -= 1
            stack.pop()

    def say(text: str) -> None:
        """Text where the page stands now; in a block it opens a run."""
        if tags[stack[-1]] not in INLINE and tags[stack[-1]] not in HIDDEN and not text.isspace():
            push(add(RUN, stack[-1], ""))
        events.append((stack[-1], text))

    at, size = 0, len(source)
    while at < size:
        found = _MARKUP.search(source, at)
        if found is None:
            say(source[at:])
            break
        if found.start() > at:
            say(source[at : found.start()])
        at = found.end()
        if found["cdata"]:
            say(found["cdata"].replace("&", "&amp;"))
        tag = found["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if found["close"]:
            if tag == "br":
                events.append((stack[-1], " "))
            for depth in range(len(stack) - 1, 0, -1) if open_tags.get(tag) else ():
                if tags[stack[depth]] == tag:
                    pop_to(depth)
                    break
                # a stray end tag of a line element does not end blocks
                if tag in INLINE and tags[stack[depth]] not in INLINE:
                    break
            continue
        if tag not in INLINE and tag not in VOID and tags[stack[-1]] == RUN:
            pop_to(len(stack) - 1)
        if tag in ENDS_P:
            for depth in range(len(stack) - 1, 0, -1) if open_tags.get("p") else ():
                inner = tags[stack[depth]]
                if inner == "p":
                    pop_to(depth)
                    break
                if inner not in INLINE:
                    break
            if tag[0] == "h" and len(tag) == 2 and tag[1] in "123456" and tags[stack[-1]][:1] == "h" and tags[stack[-1]][1:] in ("1", "2", "3", "4", "5", "6"):
                pop_to(len(stack) - 1)
        elif tag in ENDS:
            ended, bounds = ENDS[tag]
            for depth in range(len(stack) - 1, 0, -1) if any(open_tags.get(name) for name in ended) else ():
                inner = tags[stack[depth]]
                if inner in bounds:
                    break
                if inner in ended:
                    pop_to(depth)
                    if tag not in ("tr", "thead", "tbody", "tfoot"):
                        break
        if tag == "br" or tag in VOID:
            if tag == "hr":
                if tags[stack[-1]] == RUN:
                    pop_to(len(stack) - 1)
                events.append((stack[-1], ""))
            else:
                events.append((stack[-1], " " if tag == "br" else "" if tag not in INLINE else NOTHING))
            continue
        if tag in INLINE and tag != RUN and tag not in HIDDEN and tags[stack[-1]] not in INLINE:
            push(add(RUN, stack[-1], ""))
        node = add(tag, stack[-1], found["rest"])
        if tag not in INLINE:
            events.append((node, ""))
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|$)", re.I).search(source, at)
            stop = end.start() if end else size
            events.append((node, source[at:stop].replace("&", "&amp;") if tag == "xmp" else source[at:stop]))
            at = source.find(">", stop) + 1 if end else size
            at = at or size
            continue
        if not (found["rest"] or "").endswith("/") or tag not in ("svg", "math", "path"):
            push(node)
    return page


_NUMERIC = 22
WIDTH = _NUMERIC + 2 * HASHED


def _slot(token: str) -> int:
    return zlib.crc32(token.encode()) % HASHED


def hidden(page: Page) -> list[bool]:
    out: list[bool] = []
    for tag, parent in zip(page.tag, page.parent):
        out.append(tag in HIDDEN or (parent >= 0 and out[parent]))
    return out


def features(page: Page) -> tuple[list[int], np.ndarray]:
    """The elements that are rows and their features: shown ones that are blocks, have tokens of their own, or are runs of text beside blocks."""
    size = len(page.tag)
    gone = hidden(page)
    chars, links, tags, marks, paragraphs = [0] * size, [0] * size, [1] * size, [0] * size, [0] * size
    own = [0] * size
    in_link = [False] * size
    for k in range(1, size):
        in_link[k] = in_link[page.parent[k]] or page.tag[k] == "a"
    for node, text in page.events:
        if text and not gone[node]:
            n = len(text) if text.strip() else 0
            own[node] += n
            marks[node] += text.count(".") + text.count(",")
            if in_link[node]:
                links[node] += n
    chars[:] = own
    for k in range(size - 1, 0, -1):
        if gone[k]:
            continue
        up = page.parent[k]
        chars[up] += chars[k]
        links[up] += links[k]
        tags[up] += tags[k]
        marks[up] += marks[k]
        paragraphs[k] += page.tag[k] == "p"
        paragraphs[up] += paragraphs[k]
    beside = [False] * size
    for k in range(1, size):
        if page.tag[k] not in INLINE and page.tag[k] not in HIDDEN:
            beside[page.parent[k]] = True
    rows = [k for k in range(1, size) if not gone[k] and (page.tag[k] not in INLINE or page.tokens[k] or (page.tag[k] == RUN and beside[page.parent[k]]))]
    out = np.zeros((len(rows), WIDTH), np.float32)
    row_of = {k: r for r, k in enumerate(rows)}
    up_of, depth = [0] * size, [0] * size
    children: dict[int, list[int]] = {}
    for k in rows:
        up = page.parent[k]
        while up and up not in row_of:
            up = page.parent[up]
        up_of[k] = up
        depth[k] = depth[up] + 1
        children.setdefault(up, []).append(k)
    slots: dict[int, np.ndarray] = {0: np.zeros(HASHED, np.float32)}
    total = max(chars[0], 1)
    values = []
    for up, below in children.items():
        same: dict[str, int] = {}
        for k in below:
            same[page.tag[k]] = same.get(page.tag[k], 0) + 1
        for place, k in enumerate(below):
            n, parent_chars = chars[k], max(chars[up], 1)
            values.append(
                (
                    row_of[k],
                    (n, links[k] / max(n, 1), tags[k], n / tags[k], depth[k], len(children.get(k, ())), place / len(below), len(below), same[page.tag[k]] / len(below), n / parent_chars, n / total,
                     marks[k] / max(n, 1), paragraphs[k], own[k], links[up] / parent_chars, chars[up] / tags[up], chars[below[place - 1]] if place else -1, chars[below[place + 1]] if place + 1 < len(below) else -1,
                     paragraphs[up], row_of[k] / len(rows), n / max(len(children.get(k, ())), 1), len(page.tokens[k])),
                )
            )
    for row, value in values:
        out[row, :_NUMERIC] = value
    for r, k in enumerate(rows):
        mine = np.zeros(HASHED, np.float32)
        mine[_slot("<" + page.tag[k])] = 1
        for token in page.tokens[k]:
            mine[_slot(token)] = 1
        out[r, _NUMERIC : _NUMERIC + HASHED] = mine
        above = slots[up_of[k]]
        out[r, _NUMERIC + HASHED :] = above
        slots[k] = np.maximum(above, mine) if page.tag[k] not in ("html", "body") else above
    return rows, out


@dataclass
class Forest:
    """Boosted trees of one depth as arrays; a row's value is the sum of a leaf of each, in log-odds."""

    cuts: np.ndarray  # numeric features x bins
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def binned(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty(rows.shape, np.uint8)
        for k in range(_NUMERIC):
            out[:, k] = np.searchsorted(self.cuts[k], rows[:, k], side="left")
        out[:, _NUMERIC:] = rows[:, _NUMERIC:] > 0
        return out

    def predict(self, rows: np.ndarray) -> np.ndarray:
        seen = self.binned(rows)
        total = np.full(len(rows), self.base)
        flat, start = seen.reshape(-1), np.arange(len(rows)) * WIDTH
        depth = int(np.log2(self.leaf.shape[1]))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (flat[start + feature[at]] > threshold[at])
            total += leaf[at - (len(leaf) - 1)]
        return total


def boost(rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Forest:
    """Newton boosting with histograms; the hashed tokens, being 0 or 1, are summed by a matrix product."""
    cuts = np.stack([np.resize(np.unique(np.quantile(rows[:, k], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")), BINS) if len(rows) else np.zeros(BINS) for k in range(_NUMERIC)])
    cuts.sort(axis=1)
    share = float(np.clip(labels.mean() if len(labels) else 1, 0.01, 0.99))  # without rows everything is kept
    nodes = 2**depth - 1
    out = Forest(cuts, np.zeros((trees, nodes), np.int64), np.full((trees, nodes), 255, np.uint8), np.zeros((trees, nodes + 1)), float(np.log(share / (1 - share))))
    seen = out.binned(rows)
    flags = seen[:, _NUMERIC:].astype(np.float32)
    value = np.full(len(rows), out.base)
    for tree in range(trees if len(rows) else 0):
        chance = 1 / (1 + np.exp(-value))
        pull, weight = labels - chance, np.maximum(chance * (1 - chance), 1e-6)
        at = np.zeros(len(rows), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            place = at - first
            sums = []
            for what in (pull, weight):
                number = np.stack([np.bincount(place * (BINS + 1) + seen[:, k], what, count * (BINS + 1)) for k in range(_NUMERIC)]).reshape(_NUMERIC, count, BINS + 1)
                by_node = np.zeros((len(rows), count), np.float32)
                by_node[np.arange(len(rows)), place] = what
                sums.append((np.cumsum(number, axis=2)[:, :, :-1], flags.T @ by_node, np.bincount(place, what, count)))
            (g, on_g, all_g), (h, on_h, all_h) = sums
            gain = lambda a, b: a * a / (b + 1.0)
            numeric = gain(g, h) + gain(all_g[None, :, None] - g, all_h[None, :, None] - h)
            flag = gain(on_g, on_h) + gain(all_g[None, :] - on_g, all_h[None, :] - on_h)
            for node in range(count):
                k, cut = np.unravel_index(np.argmax(numeric[:, node]), numeric[:, node].shape)
                f = int(np.argmax(flag[:, node]))
                best = max(numeric[k, node, cut], flag[f, node])
                if best <= gain(all_g[node], all_h[node]) + 1e-6:
                    continue  # all rows go left
                if flag[f, node] >= numeric[k, node, cut]:
                    out.feature[tree, first + node], out.threshold[tree, first + node] = _NUMERIC + f, 0
                else:
                    out.feature[tree, first + node], out.threshold[tree, first + node] = k, cut
            feature, threshold = out.feature[tree][at], out.threshold[tree][at]
            at = 2 * at + 1 + (seen[np.arange(len(rows)), feature] > threshold)
        place = at - nodes
        out.leaf[tree] = rate * np.bincount(place, pull, nodes + 1) / (np.bincount(place, weight, nodes + 1) + 1.0)
        value += out.leaf[tree][place]
    return out


def decode(page: Page, rows: list[int], odds: np.ndarray) -> list[bool]:
    """Which elements are kept: the set with the highest sum of log-odds in which every element has its ancestors.

    Elements without a row go with their parents.
    """
    value = [0.0] * len(page.tag)
    for k, odd in zip(rows, odds.tolist()):
        value[k] = odd
    for k in range(len(page.tag) - 1, 0, -1):
        if value[k] > 0:
            value[page.parent[k]] += value[k]
    row = [False] * len(page.tag)
    for k in rows:
        row[k] = True
    gone = hidden(page)
    kept = [True] * len(page.tag)
    for k in range(1, len(page.tag)):
        kept[k] = kept[page.parent[k]] and not gone[k] and (value[k] > 0 or not row[k])
    return kept


def text_of(page: Page, kept: list[bool]) -> str:
    """Kept texts in page order, blocks two line breaks apart; cells of a row are parts of one block."""
    blocks: list[str] = []
    held: list[str] = []
    for node, text in page.events:
        if text:
            if kept[node] and text != NOTHING:
                held.append(text)
        elif page.tag[node] in CELLS:
            held.append(" ")
        elif held:
            blocks.append("".join(held))
            held = []
    blocks.append("".join(held))
    blocks = [_SPACE.sub(" ", entities.unescape(block)).strip() for block in blocks]
    return "\n\n".join(block for block in blocks if block)


# --- labels -------------------------------------------------------------------------------------

# how pages name their parts; only variants of training pages are made of these
_CONTENT = ["<article>", "<main>", '<div class="content">', '<div id="main">', '<div class="post entry">', '<section class="article body">', '<div role="main">', "<div>", '<div class="story text">']
_MENU = ["<nav>", '<div class="menu">', '<ul id="navbar">', '<div class="breadcrumb links">', '<div role="navigation">', '<div class="tags">', '<div class="pagination">']
_BESIDE = ["<aside>", '<div class="sidebar">', '<div id="related">', '<section class="widget">', '<div class="share social">', '<div class="promo">', '<div class="recommended more">']
_NOTICE = ['<div class="cookie notice">', '<div class="banner">', '<div class="alert consent">', '<p class="disclaimer">', '<div role="dialog">', '<div class="popup modal">', '<div class="newsletter subscribe">']
_ADVERT = ['<div class="ad">', '<div class="ads advert">', '<div class="sponsored">', '<ins class="adsbygoogle">', '<div id="advertisement">']
_FOOTER = ["<footer>", '<div class="footer">', '<div id="foot copyright">', '<div role="contentinfo">', '<div class="legal">']
_HEADER = ["<header>", '<div class="header">', '<div id="masthead">', '<div class="logo site">']
_COMMENTS = ['<section class="comments">', '<div id="comments">', '<div class="comment thread">', '<ol class="commentlist">', '<div class="reply discussion">']


def _closed(opening: str, inner: str, label: str) -> str:
    tag = re.match(r"<(\w+)", opening)[1]
    return f'{opening[:-1]} data-part="{label}">{inner}</{tag}>'


def variant(source: str, rng: random.Random) -> str:
    """A page of other markup around, and inside, the same article; every added part names its label."""
    found = re.search(r"<article\b[^>]*>(.*?)(?:</article>|$)", source, re.S | re.I)
    inner = found[1] if found else ""
    words = _SPACE.sub(" ", re.sub(r"<[^>]*>", " ", inner)).split() or ["text"]

    def some(least: int, most: int) -> str:
        n, first = rng.randint(least, most), rng.randrange(len(words))
        return " ".join((words[first : first + n] or words)[:n])

    def links(n: int) -> str:
        return "".join(rng.choice(["<li><a href='/x'>{}</a></li>", "<a href='/x'>{}</a> ", "<div><a href='/x'>{}</a></div>"]).format(some(1, 4)) for _ in range(n))

    def paragraphs(n: int) -> str:
        return "".join(f"<p>{some(4, 60)}.</p>" for _ in range(n))

    def note() -> str:
        ways = [
            lambda: f"<div class='comment'><b>{some(1, 2)}</b><p>{some(3, 50)}.</p></div>",
            lambda: f"<div><b>{some(1, 2)}</b><p>{some(3, 50)}.</p></div>",
            lambda: f"<div>{some(1, 2)}<p>{some(3, 50)}.</p></div>",
            lambda: f"<li><span>{some(1, 2)}</span> {some(1, 2)}<p>{some(3, 50)}.</p></li>",
            lambda: f"<p>{some(3, 50)}.</p>",
        ]
        return "".join(rng.choice(ways)() for _ in range(rng.randint(1, 6)))

    def bare() -> str:
        """A line without an element of its own."""
        return f'<{RUN} data-part="0">{rng.choice(["{}", "{} |", "&copy; {}", "<a href=/x>{}</a>", "{} &raquo;"]).format(some(1, 6))}</{RUN}>'

    form = f"<label>{some(1, 3)}</label><input name='q'><button>{some(1, 1)}</button><p>{some(2, 12)}</p>"
    boiler = [
        lambda: _closed(rng.choice(_MENU), links(rng.randint(1, 12)), "0"),
        lambda: _closed(rng.choice(_BESIDE), rng.choice([links(rng.randint(1, 8)), f"<h3>{some(1, 4)}</h3>" + links(5), paragraphs(rng.randint(1, 3)), f"{some(1, 2)}: {some(1, 8)}"]), "0"),
        lambda: _closed(rng.choice(_NOTICE), some(4, 40), "0"),
        lambda: _closed(rng.choice(_ADVERT), rng.choice([some(2, 30), f"<p>{some(2, 30)}</p>"]), "0"),
        lambda: _closed("<form>", form, "0"),
        lambda: _closed(rng.choice(_COMMENTS), f"<h3>{some(1, 3)}</h3>{note()}", "0"),
        lambda: _closed(rng.choice(_HEADER), rng.choice([some(1, 6), f"<h1>{some(1, 5)}</h1>", links(4)]), "0"),
        lambda: _closed(rng.choice(_FOOTER), rng.choice([some(3, 40), links(6), f"<p>{some(3, 40)}</p>"]), "0"),
        lambda: _closed(rng.choice(["<noscript>", "<noframes>", "<object>", "<noembed>"]), rng.choice([some(3, 20), f"<p>{some(3, 20)}.</p>", links(1)]), "0"),
        lambda: _closed(rng.choice(["<section>", "<div>"]), f"<h3>{some(1, 3)}</h3>{note()}", "0"),
    ]
    good = [
        lambda: f"<h2>{some(1, 8)}</h2>",
        lambda: "<ul>" + "".join(f"<li>{some(3, 25)}</li>" for _ in range(rng.randint(2, 6))) + "</ul>",
        lambda: f"<blockquote>{some(5, 40)}</blockquote>",
        lambda: "<table>" + "".join(f"<tr><td>{some(1, 4)}</td><td>{some(1, 4)}</td></tr>" for _ in range(3)) + "</table>",
        lambda: f"<figure><img src=x><figcaption>{some(3, 15)}</figcaption></figure>",
        lambda: f"<p>{some(1, 3)}</p>",
        lambda: f"<p>{some(10, 80)} <a href='/y'>{some(1, 5)}</a> {some(3, 20)}.</p>",
        lambda: f"<pre>{some(3, 20)}</pre>",
        lambda: f"<xmp>{some(3, 20)}</xmp>",
        lambda: f"<p>{some(3, 20)} <math><mi>{some(1, 1)}</mi><mo>=</mo><mn>{some(1, 1)}</mn></math> {some(3, 20)}.</p>",
        lambda: f"<{shown}>{rng.choice([some(3, 30), paragraphs(1)])}</{shown.split()[0]}>" if (shown := rng.choice(["noscript", "object data='/z'", "noembed", "noframes"])) else "",
    ]
    inside = [part for part in re.split(r"(?=<(?:p|h\d|ul|div)\b)", inner) if part]
    if rng.random() < 0.3:  # short articles are articles too
        inside = inside[: rng.randint(1, 3)]
    elif rng.random() < 0.2:
        inside = [f"<h1>{some(1, 3)}.</h1><p>{rng.choice(['', '<b>'])}{some(1, 4)}.<br>"]
    for _ in range(rng.choice([0, 0, 1, 2, 4])):
        inside.insert(rng.randint(0, len(inside)), rng.choice(good)())
    for _ in range(rng.choice([0, 0, 1, 2])):
        inside.insert(rng.randint(0, len(inside)), rng.choice(boiler[1:6])())
    if rng.random() < 0.3:
        inside.insert(0, f"<header><h1>{some(2, 8)}</h1></header>")
    unwrapped = rng.random() < 0.3
    if unwrapped:  # parts of an article directly in the page
        body = "".join(part if "data-part=" in part[: part.find(">")] else re.sub(r"^<([a-z0-9]+)", r'<\1 data-part="1"', part) for part in inside)
    else:
        body = _closed(rng.choice(_CONTENT), "".join(inside), "1")
    if rng.random() < 0.4:
        body = rng.choice(["<div>{}</div>", "<div class='wrapper'>{}</div>", "<div id='page container'>{}</div>"]).format(body)
    edges = [*boiler, bare, bare]
    alone = rng.random() < (0.5 if unwrapped else 0.1)  # some pages are their article
    before = "" if alone else "".join(rng.choice(edges)() for _ in range(rng.randint(0, 4)))
    after = "" if alone else "".join(rng.choice(edges)() for _ in range(rng.randint(0, 5)))
    return f"<html><head><title>{some(2, 6)}</title></head><body>{before}{body}{after}</body></html>"


def as_article(source: str, rng: random.Random) -> str:
    """The words of a page that names no article as an article of paragraphs, in page order; empty if it has none."""
    page = parse(source)
    words = entities.escape(text_of(page, [not gone for gone in hidden(page)]), quote=False).split()
    parts, at = [f"<h1>{' '.join(words[:6])}</h1>"] if words and rng.random() < 0.7 else [], 0
    while at < len(words):
        size = rng.randint(3, 90)
        parts.append(f"<p>{' '.join(words[at : at + size])}</p>")
        at += size
    return f"<article>{''.join(parts)}</article>" if parts else ""


def labels(page: Page, rows: list[int]) -> np.ndarray | None:
    """1 for the article, what is in it and what holds it; None if the page does not name one."""
    inside = [False] * len(page.tag)
    named = [k for k in range(len(page.tag)) if page.part[k] == "1"] or [k for k in range(len(page.tag)) if page.tag[k] == "article"] or [k for k in range(len(page.tag)) if page.tag[k] == "main" or "main" in page.tokens[k]]
    if not named:
        return None
    starts = set(named)
    for k in range(1, len(page.tag)):
        inside[k] = k in starts or (inside[page.parent[k]] and page.part[k] != "0")
    for k in [k for k in range(len(page.tag)) if inside[k]]:
        while k > 0 and not inside[page.parent[k]]:
            k = page.parent[k]
            inside[k] = True
    return np.array([inside[k] for k in rows], np.float64)


def fit(pages: DataFrame, page_id: str = "page_id", html: str = "html", train_pages: int = TRAIN_PAGES, variants: int = VARIANTS, trees: int = TREES) -> Forest:
    """Trees fitted on about `train_pages` pages at most, chosen by a hash of their ids, and `variants` variants of each.

    Pages without a named article teach nothing while others name theirs. If none does, the trees learn from variants alone, whose
    articles are the words of the pages in paragraphs; if no page has words either, everything that shows as text is kept.
    """
    held = pages.where(F.col(html).isNotNull())
    every = max(1, -(-held.count() // train_pages))
    chosen = held.where(F.pmod(F.xxhash64(page_id), F.lit(every)) == 0).select(F.xxhash64(page_id), html).collect()
    found, marks = [], []

    def learn(texts: list[str]) -> None:
        for text in texts:
            page = parse(text)
            rows, values = features(page)
            label = labels(page, rows)
            if label is not None and len(rows):
                found.append(values)
                marks.append(label)

    sources = sorted((row[0], row[1]) for row in chosen)
    for number, source in sources:
        rng = random.Random(number)
        named = re.search(r"<article\b", source, re.I)
        learn([source, *(variant(source, rng) for _ in range(variants if named else 0))])
    known = bool(found)
    if not known:
        more = variants * max(1, train_pages // max(1, len(sources)))  # few pages make as many variants as many do
        for number, source in sources:
            rng = random.Random(number)
            learn([variant(made, rng) for made in [as_article(source, rng)] if made for _ in range(more)])
    if not found:
        return boost(np.zeros((0, WIDTH), np.float32), np.ones(0), 0)
    forest = boost(np.concatenate(found), np.concatenate(marks), trees)
    return forest if known else replace(forest, base=forest.base + DOUBT)


def main_texts(sources: list[str | None], forest: Forest) -> list[str]:
    pages = [parse(source or "") for source in sources]
    made = [features(page) for page in pages]
    odds = forest.predict(np.concatenate([values for _, values in made])) if made else np.zeros(0)
    out, at = [], 0
    for page, (rows, _) in zip(pages, made):
        out.append(text_of(page, decode(page, rows, odds[at : at + len(rows)])))
        at += len(rows)
    return out


def extract(pages: DataFrame, forest: Forest, html: str = "html") -> DataFrame:
    """`pages` with `_text` in place of the html: the main text, empty if there is none; null html is empty. `_text` may not be in use."""
    names = [name for name in pages.columns if name != html]
    if "_text" in names:
        raise ValueError("column name in use: _text")
    kinds = ", ".join([*(f"`{n}` {pages.schema[n].dataType.simpleString()}" for n in names), "_text string"])
    shared = pages.sparkSession.sparkContext.broadcast(forest)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = main_texts(part.column(html).to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(texts, pa.string())], names=[*names, "_text"])

    return pages.select(*[f"`{n}`" for n in names], html).mapInArrow(scan, kinds)
