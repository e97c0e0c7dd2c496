"""Main text of web pages: gradient-boosted trees over DOM-node features with hierarchical decoding.

Pages are parsed forgivingly (unclosed and stray tags, truncated pages, raw-text elements, comments). Each block is
a node with features of its tag, attribute tokens, depth, subtree density, siblings and ancestors. The trees, which
are trained on pages made here with known labels, give each node's odds of being main text. Decoding then finds the
best labelling of the whole tree in which a path from the root is first outside, then inside, then dropped: a node
inside a dropped one is never taken, and a taken node's parent is never dropped.

Null and empty pages give an empty text, as do pages without text; repeated pages give repeated rows; an empty
table gives no rows. Only the id, URL and html columns are read. Pages are parsed whole, whatever their size.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import BoostedTrees, fit
from .common import text_slices

# Fixed values of HTML: elements without content, with raw text, inline ones, and those whose start closes a paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style iframe textarea title".split())
#: Elements whose content is left out if they are closed; FOREIGN ones may close themselves, and end where HTML begins.
SKIPPED = frozenset("noscript template svg math object select".split())
FOREIGN = frozenset(("svg", "math"))
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Start tags that end foreign content, and elements of foreign content in which they do not.
BREAKS_OUT = CLOSES_P | frozenset("b big body br center code dd dt em embed head i img li listing meta nobr ruby s small span strong strike sub sup td th tr tt u var".split())
HTML_WITHIN = frozenset("foreignobject desc mi mo mn ms mtext annotation-xml".split())
#: An open element of the values is closed by a start tag of the key, unless one of SCOPES lies between.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
SCOPES = frozenset("html body table ul ol dl menu article aside section div td th".split())
TAG = re.compile(r"<(?:!--(.*?)(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(>|\Z))", re.S)
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)", re.S)
MARKS = re.compile(r"(?:class|id|role|itemprop|aria-label|hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[a-z]+")

#: Attribute tokens and tags that are features of their own.
TOKENS = (
    "content article post entry main body text story page blog news section prose"  # of main text, mostly
    " ad ads advert advertisement banner sponsor sponsored promo nav navbar menu navigation breadcrumb breadcrumbs header masthead top logo footer foot bottom copyright legal"
    " sidebar side widget aside related recommended popular share social follow cookie cookies consent notice alert warning gdpr popup modal dialog overlay newsletter subscribe signup login form search"
    " comment comments comm disqus reply replies reader respond discussion tags meta byline pagination pager skip hidden complementary contentinfo banner"
).split()
TOKENS = tuple(dict.fromkeys(TOKENS))
TAGS = ("html", "head", "body", "article", "main", "section", "div", "p", "h", "ul", "ol", "li", "nav", "header", "footer", "aside", "form", "table", "tr", "td", "blockquote", "pre", "figure", "dl", "button", "fieldset", "address", "other")
TAG_NUMBER = {t: i for i, t in enumerate(TAGS)} | {f"h{i}": TAGS.index("h") for i in range(1, 7)} | {"th": TAGS.index("td"), "tbody": TAGS.index("table"), "thead": TAGS.index("table"), "figcaption": TAGS.index("figure")}
ABOVE = ("article", "main", "section", "nav", "header", "footer", "aside", "form")
NUMBERS = 26


class Node:
    __slots__ = ("tag", "tokens", "parent", "depth", "children", "own", "chars", "linked", "tags", "paragraphs", "stops", "inputs", "order")

    def __init__(self, tag: str, tokens: frozenset, parent: int, depth: int, order: int) -> None:
        self.tag, self.tokens, self.parent, self.depth, self.order = tag, tokens, parent, depth, order
        self.children: list[int] = []
        self.own = self.chars = self.linked = self.tags = self.paragraphs = self.stops = self.inputs = 0


def attribute_tokens(raw: str) -> frozenset:
    if "=" not in raw:
        return frozenset()
    return frozenset(w for m in MARKS.finditer(raw) for w in WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", m[1] or m[2] or m[3] or "").lower()))


def skipped_ends(page: str, at: int) -> dict[int, int]:
    """Where the content of each SKIPPED element from at on ends, by where it begins; unclosed elements are not there."""
    ends: dict[int, int] = {}
    open_: list[tuple[str, int]] = []
    marks: list[str] = []  # the FOREIGN and HTML_WITHIN ones of them
    counts: dict[str, int] = dict.fromkeys(SKIPPED | HTML_WITHIN, 0)

    def pop(end: int, keep: frozenset | set) -> str:
        name, start = open_.pop()
        counts[name] -= 1
        if marks and name not in SKIPPED - FOREIGN:
            marks.pop()
        if name in keep:
            ends[start] = end
        return name

    while (begin := page.find("<", at)) >= 0:
        m = TAG.match(page, begin)
        if m and m[3] is None:
            at = m.end()
            continue
        if m is None or not m[5]:
            m = LOOSE_TAG.match(page, begin)
            if not m:
                at = begin + 1
                continue
            slash, name, raw = m[1], m[2], m[3]
        else:
            slash, name, raw = m[2], m[3], m[4]
        at, tag = m.end(), name.lower()
        within = marks[-1] if marks else None
        if slash:
            if counts.get(tag):
                while pop(at, {tag} & SKIPPED) != tag:
                    pass
            continue
        if within in FOREIGN and tag in BREAKS_OUT:
            while marks and marks[-1] in FOREIGN:
                pop(begin, FOREIGN)
            continue
        empty = raw.endswith("/") and (within in FOREIGN or tag in FOREIGN)
        if empty:
            continue
        if tag in RAW_TEXT:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            if end is None:
                if within in FOREIGN:
                    continue
                break
            at = page.find(">", end.start()) + 1 or len(page)
        elif tag in SKIPPED or (within and tag in HTML_WITHIN):
            open_.append((tag, at))
            counts[tag] += 1
            marks += [tag] * (tag in FOREIGN or tag in HTML_WITHIN)
    return ends


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block nodes, the root first and parents before children, and (node, text) in page order; "\\n" parts blocks."""
    nodes = [Node("#root", frozenset(), -1, 0, 0)]
    texts: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("#root", 0)]  # open elements with their block nodes
    links = 0
    skips: dict[int, int] | None = None
    at, n = 0, len(page)

    def text(piece: str) -> None:
        node = stack[-1][1]
        piece = html.unescape(piece) if "&" in piece else piece
        texts.append((node, piece))
        size = len(piece) - piece.count(" ") if not piece.isspace() else 0
        x = nodes[node]
        x.own += size
        if links:
            x.linked += size
        x.stops += piece.count(".") + piece.count(",")

    def close(k: int) -> None:
        nonlocal links
        for tag, node in stack[k:]:
            links -= tag == "a"
            if tag not in INLINE:
                texts.append((node, "\n"))
        del stack[k:]

    while at < n:
        begin = page.find("<", at)
        if begin < 0:
            text(page[at:])
            break
        m = TAG.match(page, begin)
        if m and m[3] is None:  # comment, doctype, processing instruction
            if begin > at:
                text(page[at:begin])
            at = m.end()
            continue
        name, raw, slash, ended = (m[3], m[4], m[2], m[5]) if m else (None, "", "", "")
        if m is None or not ended:
            loose = LOOSE_TAG.match(page, begin)
            if not loose:
                text(page[at : begin + 1])
                at = begin + 1
                continue
            m, slash, name, raw, ended = loose, loose[1], loose[2], loose[3], loose[4]
        if begin > at:
            text(page[at:begin])
        at = m.end()
        if not ended:  # the page ends within a tag
            break
        tag = name.lower()
        if slash:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
                if tag in INLINE and stack[k][0] in SCOPES:
                    break
            else:
                if tag not in INLINE:
                    texts.append((stack[-1][1], "\n"))
            continue
        top = stack[-1][1]
        nodes[top].tags += 1
        if tag in VOID:
            nodes[top].inputs += tag == "input"
            texts.append((top, "\n" if tag in ("br", "hr") else ""))
            continue
        if tag in SKIPPED:
            nodes[top].inputs += tag == "select"
            if not (raw.endswith("/") and tag in FOREIGN):
                skips = skipped_ends(page, begin) if skips is None else skips
                at = skips.get(at, at)
            continue
        if tag in RAW_TEXT:
            nodes[top].inputs += tag == "textarea"
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            if end is None:
                break
            at = page.find(">", end.start()) + 1 or n
            continue
        if tag in CLOSES_P or tag in CLOSES:
            shut = {"p"} if tag in CLOSES_P else CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in shut:
                    close(k)
                    break
                if stack[k][0] in SCOPES:
                    break
        tokens = attribute_tokens(raw)
        top = stack[-1][1]
        if tag in INLINE and not tokens:
            links += tag == "a"
            stack.append((tag, top))
            continue
        node = Node(tag, tokens, top, nodes[top].depth + 1, len(nodes))
        nodes[top].children.append(node.order)
        nodes.append(node)
        links += tag == "a"
        if tag not in INLINE:
            texts.append((top, "\n"))
        stack.append((tag, node.order))
    for x in reversed(nodes):
        x.chars += x.own
        x.paragraphs += x.tag == "p"
        if x.parent >= 0:
            up = nodes[x.parent]
            up.chars += x.chars
            up.linked += x.linked
            up.tags += x.tags
            up.paragraphs += x.paragraphs
            up.stops += x.stops
            up.inputs += x.inputs
    return nodes, texts


def features(nodes: list[Node]) -> np.ndarray:
    """A row a node: numbers, tag, tag of the parent, marked ancestors, own and inherited attribute tokens."""
    n, total = len(nodes), max(1, nodes[0].chars)
    out = np.zeros((n, NUMBERS + 2 * len(TAGS) + len(ABOVE) + 2 * len(TOKENS)), np.float32)
    at_parent, at_above, at_tokens = NUMBERS + len(TAGS), NUMBERS + 2 * len(TAGS), NUMBERS + 2 * len(TAGS) + len(ABOVE)
    for i, x in enumerate(nodes):
        row = out[i]
        chars, tags = x.chars, x.tags
        row[:12] = (x.depth, min(chars, 1000), chars / total, x.linked / (chars or 1), min(chars / (tags + 1), 500), min(x.own, 500), min(x.paragraphs, 20), x.stops / (chars or 1), x.inputs, min(len(x.children), 50), i / n, min(tags, 200))
        row[NUMBERS + TAG_NUMBER.get(x.tag, len(TAGS) - 1)] = 1
        for t in x.tokens:
            k = TOKEN_NUMBER.get(t)
            if k is not None:
                row[at_tokens + k] = 1
        if x.parent < 0:
            continue
        up = nodes[x.parent]
        siblings = up.children
        row[12:16] = (min(len(siblings), 50), chars / (up.chars or 1), up.linked / (up.chars or 1), min(up.paragraphs, 20))
        row[at_parent + TAG_NUMBER.get(up.tag, len(TAGS) - 1)] = 1
        above = out[x.parent]
        row[at_above:at_tokens] = above[at_above:at_tokens]
        if up.tag in ABOVE_NUMBER:
            row[at_above + ABOVE_NUMBER[up.tag]] = 1
        row[at_tokens + len(TOKENS) :] = np.maximum(above[at_tokens : at_tokens + len(TOKENS)], above[at_tokens + len(TOKENS) :])
    for x in nodes:
        if x.children:
            kids = x.children
            size = [nodes[k].chars for k in kids]
            tag = [nodes[k].tag for k in kids]
            alike = {t: tag.count(t) for t in set(tag)}
            most, mean = max(size), sum(size) / len(size)
            for j, k in enumerate(kids):
                before, after = (size[j - 1] if j else -1), (size[j + 1] if j + 1 < len(kids) else -1)
                out[k, 16:22] = (min(j, 50), j / len(kids), min(alike[tag[j]], 50), min(before, 1000), min(after, 1000), size[j] / (most or 1))
                out[k, 22:26] = (min(mean, 1000), nodes[kids[j - 1]].linked / (before or 1) if j else -1, nodes[kids[j + 1]].linked / (after or 1) if after >= 0 else -1, j == len(kids) - 1)
    return out


TOKEN_NUMBER = {t: i for i, t in enumerate(TOKENS)}
ABOVE_NUMBER = {t: i for i, t in enumerate(ABOVE)}
#: Log-odds that it takes to begin main text below a node that has none, and to drop a part of it.
ENTER, LEAVE = 2.0, 1.0


def decode(nodes: list[Node], margin: np.ndarray) -> list[bool]:
    """Whether each node's own text is main text: the best labelling whose paths are outside*, inside*, dropped*.

    Taking a node scores its log-odds, leaving it nothing; every step into main text and out of it has its price.
    """
    outside, inside, dropped = [0.0] * len(nodes), margin.tolist(), [0.0] * len(nodes)
    for x in reversed(nodes[1:]):
        i, up = x.order, x.parent
        outside[up] += max(outside[i], inside[i] - ENTER)
        inside[up] += max(inside[i], dropped[i] - LEAVE)
    state = [0] * len(nodes)
    for x in nodes[1:]:
        i, above = x.order, state[x.parent]
        if above == 0:
            state[i] = int(inside[i] - ENTER > outside[i])
        else:
            state[i] = 1 if above == 1 and inside[i] >= dropped[i] - LEAVE else 2
    return [s == 1 for s in state]


def main_text(texts: list[tuple[int, str]], taken: list[bool]) -> str:
    """White space and block bounds become single spaces; text inside a block joins as it stands."""
    return " ".join("".join([t if taken[i] else "\n" for i, t in texts]).split())


# ---- training pages ----

CONTENT_MARKS = ("content", "article", "post", "entry-content", "main", "story", "post-body", "article-body", "page-content", "text", "blog-post", "")
BOILERPLATE = (
    ("nav", ("nav", "menu", "navbar", "main-menu", "breadcrumb", "navigation")),
    ("header", ("header", "masthead", "site-header", "top", "logo")),
    ("footer", ("footer", "site-footer", "copyright", "legal", "bottom")),
    ("aside", ("sidebar", "side", "widget", "related", "popular", "recommended")),
    ("ad", ("ad", "ads", "advert", "banner-ad", "sponsored", "promo", "advertisement", "ad-box")),
    ("notice", ("cookie", "cookie-notice", "notice", "alert", "consent", "gdpr-popup", "warning", "modal")),
    ("form", ("form", "newsletter", "subscribe", "login", "search", "signup-form")),
    ("comments", ("comments", "comment", "comment-list", "reader-comments", "disqus", "replies", "respond", "discussion")),
    ("share", ("share", "social", "follow", "tags", "meta", "pagination")),
)


class PageMaker:
    """Pages with known main text; the tag that holds main text carries data-main."""

    def __init__(self, seed: int) -> None:
        self.rng = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        rng = self.rng
        out = " ".join("".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9))) + rng.choice(("", "", "", "", ".", ",", "###", "!!")) for _ in range(rng.randint(low, high)))
        return out + rng.choice((".", ".", "", " &amp; so."))

    def links(self) -> str:
        n = self.rng.randint(2, 8)
        items = [f'<a href="/{i}">{self.words(1, 3)}</a>' for i in range(n)]
        return self.rng.choice((lambda: "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>", lambda: " | ".join(items), lambda: "".join(f"<p>{x}</p>" for x in items)))()

    def mark(self, token: str) -> str:
        if not token:
            return self.rng.choice(("", "", ' class="row"', ' class="wrapper col-8"'))
        extra = self.rng.choice(("", "", " col-4", " box", " wide"))
        return self.rng.choice((f' class="{token}{extra}"', f' id="{token}"', f' class="{token}"', f" class='{extra.strip() or 'x'} {token}'"))

    def boilerplate(self, kind: str, tokens: tuple[str, ...]) -> str:
        rng = self.rng
        semantic = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "comments": "section"}.get(kind)
        plain = kind == "ad" or kind == "notice" or kind == "share"
        use = semantic if semantic and rng.random() < 0.6 else rng.choice(("div", "div", "section", "p" if plain else "div"))
        token = "" if use == semantic and kind != "comments" and rng.random() < 0.6 else rng.choice(tokens)
        body = {
            "nav": self.links,
            "header": lambda: rng.choice((f"<h1>{self.words(1, 5)}</h1>", f"<p>{self.words(2, 9)}</p>", self.links())),
            "footer": lambda: rng.choice((f"&copy; {self.words(2, 40)}", self.links(), f"<p>{self.words(3, 40)}</p>")),
            "aside": lambda: f"<h3>{self.words(1, 4)}</h3>" + rng.choice((self.links(), f"<p>{self.words(5, 60)}</p>")),
            "ad": lambda: rng.choice((self.words(3, 60), f'<a href="/x">{self.words(3, 12)}</a>')) if use == "p" else rng.choice((self.words(3, 60), f"<p>{self.words(3, 60)}</p>")),
            "notice": lambda: self.words(4, 50) + rng.choice(("", "<button>OK</button>")) if use == "p" else f"<p>{self.words(4, 50)}</p><button>OK</button>",
            "form": lambda: f"<label>{self.words(1, 4)}</label><input type=text><button>{self.words(1, 2)}</button>" + rng.choice(("", f"<p>{self.words(3, 30)}</p>")),
            "comments": lambda: f"<h3>{self.words(1, 3)}</h3>" * rng.randint(0, 1) + "".join(rng.choice((f"<p>{self.words(3, 70)}</p>", f'<div class="comment"><b>{self.words(1, 2)}</b><p>{self.words(3, 70)}</p></div>')) for _ in range(rng.randint(1, 5))),
            "share": lambda: self.words(1, 4) if use == "p" else self.links(),
        }[kind]()
        return f"<{use}{self.mark(token)}>{body}</{use}>"

    def content(self) -> str:
        rng = self.rng
        out = [f"<h1>{self.words(1, 10)}</h1>"] * (rng.random() < 0.8)
        for _ in range(rng.choice((0, 0, 1, 1, 2, 3, 6, 15, 40))):
            roll = rng.random()
            p = f"<p>{rng.choice(('', '<b>', '<i>x</i> '))}{self.words(1, rng.choice((5, 40, 70, 300)))}{rng.choice(('', '<br>', '</p>', '</p>'))}"
            if roll < 0.75:
                out.append(p)
            elif roll < 0.8:
                out.append(f"<h2>{self.words(1, 7)}</h2>")
            elif roll < 0.85:
                out.append("<ul>" + "".join(f"<li>{self.words(1, 15)}</li>" for _ in range(rng.randint(1, 5))) + "</ul>")
            elif roll < 0.88:
                out.append(f"<blockquote>{self.words(3, 40)}</blockquote>")
            elif roll < 0.9:
                out.append(f"<pre>{self.words(3, 40)}</pre>")
            elif roll < 0.92:
                out.append("<table><tr>" + "".join(f"<td>{self.words(1, 4)}</td>" for _ in range(4)) + "</tr></table>")
            elif roll < 0.94:
                out.append(f"<figure><img src=x><figcaption>{self.words(2, 12)}</figcaption></figure>")
            elif roll < 0.96:
                out.append(f"<section><h2>{self.words(1, 5)}</h2><p>{self.words(5, 50)}</p></section>")
            else:
                kind, tokens = rng.choice(BOILERPLATE[3:])
                out.append(f"<!--drop-->{self.boilerplate(kind, tokens)}<!--/drop-->")
        if not out:
            out = [f"<p>{self.words(1, 40)}</p>"]
        return "".join(out)

    def page(self) -> tuple[list[Node], list[bool]]:
        """Nodes, and which of them are main text (told by marks that are no features)."""
        rng = self.rng
        tag = rng.choice(("article", "article", "article", "main", "div", "div", "section"))
        mark = self.mark(rng.choice(CONTENT_MARKS) if tag in ("div", "section") or rng.random() < 0.3 else "")
        if tag in ("div", "section") and ("class" not in mark and "id" not in mark):
            mark = ' class="content"'
        body = f"<!--main-->\n<{tag}{mark}>{self.content()}</{tag}>\n<!--/main-->"
        for _ in range(rng.choice((0, 0, 0, 1, 2))):
            body = f"<{rng.choice(('div', 'main', 'section', 'div'))}{self.mark('')}>{body}</div>"
        pick = lambda n: [self.boilerplate(*rng.choice(BOILERPLATE)) for _ in range(n)]
        bare = rng.random() < 0.15
        before = [] if bare else [self.boilerplate(*BOILERPLATE[0])] * (rng.random() < 0.7) + pick(rng.randint(0, 3))
        after = [] if bare else pick(rng.randint(0, 3)) + [self.boilerplate(*BOILERPLATE[2])] * (rng.random() < 0.7)
        if rng.random() < 0.25:
            return labelled(rng.choice(("<body>", "", "<html><body>")) + "".join(before) + body + "".join(after))
        page = f"<!DOCTYPE html><html><head><title>{self.words(1, 6)}</title><style>p{{}}</style></head><body>{''.join(before)}{body}{''.join(after)}</body></html>"
        return labelled(page)


def labelled(page: str) -> tuple[list[Node], list[bool]]:
    """Parse a training page; its comments "main" and "drop" bound the labels."""
    cut = re.split(r"(<!--/?(?:main|drop)-->)", page)
    plain, bounds, inside, drop = "", [], False, False
    for part in cut:
        if part in ("<!--main-->", "<!--/main-->"):
            inside = part == "<!--main-->"
        elif part in ("<!--drop-->", "<!--/drop-->"):
            drop = part == "<!--drop-->"
        else:
            marks = "\x01" if inside and not drop else "\x02"
            plain += re.sub(r"<([a-zA-Z]\w*)", lambda m, k=marks: f"<{m[1]} data-k={k}", part)
            bounds.append(marks)
    kept: list[bool] = [False]
    spy = re.compile(r"data-k=(.)")
    original = attribute_tokens

    def tokens(raw: str) -> frozenset:
        m = spy.search(raw)
        return original(raw.replace(m[0], "") if m else raw) | ({"\x01"} if m and m[1] == "\x01" else frozenset())

    nodes = _parse_with(tokens, plain)
    for x in nodes[1:]:
        kept.append("\x01" in x.tokens)
        x.tokens = x.tokens - {"\x01"}
    return nodes, kept


def _parse_with(tokens, page: str) -> list[Node]:
    global attribute_tokens
    held, attribute_tokens = attribute_tokens, tokens
    try:
        return parse(page)[0]
    finally:
        attribute_tokens = held


@lru_cache(maxsize=2)
def train(pages: int = 300, seed: int = 1) -> BoostedTrees:
    maker = PageMaker(seed)
    made = [maker.page() for _ in range(pages)]
    x = np.concatenate([features(nodes)[1:] for nodes, _ in made])
    y = np.concatenate([np.array(kept[1:], float) for _, kept in made])
    return fit(x, y)


def extract(pages: list[str], model: BoostedTrees) -> list[str]:
    """Main texts; the nodes of all pages are scored together."""
    parsed = [parse(p) for p in pages]
    if not parsed:
        return []
    margins = model.margin(np.concatenate([features(nodes) for nodes, _ in parsed]))
    out, at = [], 0
    for nodes, texts in parsed:
        own = np.clip(margins[at : at + len(nodes)], -6, 6)
        at += len(nodes)
        out.append(main_text(texts, decode(nodes, own)))
    return out


def extract_main_text(pages: DataFrame, *, training_pages: int = 300, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page; no shuffle."""
    sent = pages.sparkSession.sparkContext.broadcast(train(training_pages))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, values in text_slices(batches, "html"):
            texts = extract(values, sent.value)
            yield pa.RecordBatch.from_arrays([rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(step, "page_id long, url string, text string, n_chars long")
