"""Main text of web pages: flat text blocks, judged by a small decision tree.

A page is read once, tag by tag, into *blocks*: the text between two block-level
tags, flat, without a document tree. Each block is measured (words, link
density, heading, list item, final punctuation, what its open elements are) and
so are its neighbours; a decision tree then tells main text from the rest. The
tree is trained on a small labelled table of blocks that this module holds as
page layouts (``TRAINING``): no page of the input is looked at for it.

What counts about the open elements of a block:

- ``main``: an article, a main element or one with such a role;
- ``frame``: an element that by its tag or role is no main text (nav, aside,
  footer, form, a header outside the main part, hidden elements ...);
- ``named``: an element whose class or id says so (ad, sidebar, comments ...);
- ``content``: an element whose class or id names it the content.

The innermost evidence counts, with two exceptions for broken pages: a wrapper
that holds the main element or all articles of its page is no frame, whatever
its name, and neither is a frame that is never closed and has an article inside.

Text rules: character references are decoded as HTML5 does (those that end
without a semicolon too), any run of white space as Python's ``str.split`` sees it
(no-break spaces included) becomes one space, a ``br`` is white space, blocks are trimmed and
joined in page order by one line feed. Comments, scripts, styles, titles and other raw text are no blocks.
A tag or comment that the page ends in is markup.

A null or empty page, or one without main text, gives an empty text. Pages are
independent rows: repeated ones each give a row, other columns are ignored.
Reading takes time in proportion to the page's length, whatever is unclosed.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import map_rows

# HTML elements by kind.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center col colgroup dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li link main menu meta nav noscript "
    "object ol optgroup option p pre script section select style summary table tbody td template textarea tfoot th thead title tr ul video audio".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style title textarea iframe noembed noframes xmp".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEMS = frozenset("li dt dd td th option".split())
MAIN_TAGS = frozenset("article main".split())
FRAME_TAGS = frozenset("nav aside footer form button select fieldset label dialog menu noscript template object svg head".split())
MAIN_ROLES = frozenset("main article".split())
FRAME_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
# Which open elements a start tag closes, and the elements beyond which it does not look.
CLOSES = {
    "li": ("li", ("ul", "ol", "menu", "dir")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)),
    "td": ("td th", ("table", "tr")),
    "th": ("td th", ("table", "tr")),
    "option": ("option", ("select",)),
}
CLOSES_P = BLOCK_TAGS - frozenset("body button caption col colgroup head html iframe label legend link meta noscript object option script style template title".split())

_NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adsense|adslot|dfp|advert\w*|sponsor\w*|promo\w*|banner\w*|nav|navbar|navigation|menu\w*|breadcrumb\w*|masthead|"
    r"footer\w*|sidebar\w*|aside|rail|widget\w*|cookie\w*|consent|gdpr|notices?|notification\w*|alert\w*|popup\w*|modal\w*|overlay|newsletter\w*|subscri\w*|"
    r"signup|login|share|sharing|social|related|recommend\w*|teaser\w*|comment\w*|disqus|respond|repl(?:y|ies)|search\w*|pagination|pager|toolbar|"
    r"copyright|disclaimer|legal|skip|topbar|donat\w*|paywall)(?=$|[\s_-])"
)
_NAMED_MAIN = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|comment\w*|repl(?:y|ies)|teaser\w*|related|recommend\w*)(?=$|[\s_-])")
_CONTENT = re.compile(r"(?:^|[\s_-])(?:content|article\w*|post|entry|story|main|body|text|prose)(?=$|[\s_-])")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
# A tag (quotes count only after "="), a comment up to its end or the page's, or another declaration.
_MARKUP = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>|[!?][^>]*+(?:>|\Z)|/[^a-zA-Z][^>]*+(?:>|\Z)|/>)",
    re.S,
)
_PLAIN_TAG = re.compile(r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>[^>]*+)>")
_OPENS = re.compile(r"</?[a-zA-Z]")
_ATTRIBUTE = re.compile(r"([^\s=\"'/]++)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'][^\s]*+)))?")
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW_TAGS}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after", "main", "frame", "named", "content",
    "heading", "item", "sentence", "page_has_main",
)


class Element:
    """An open element that tells what its text is; ``outer`` is the next such element around it."""

    __slots__ = ("after", "before", "closed", "content", "frame", "header", "main", "named", "outer", "state")

    def __init__(self, outer, before):
        self.outer, self.before, self.after = outer, before, None
        self.main = self.frame = self.named = self.content = self.header = self.closed = False
        self.state = None


@dataclass
class Block:
    text: str
    words: int
    links: float
    heading: bool
    item: bool
    element: Element | None
    at: int


def _evidence(name: str, rest: str, outer, seen) -> Element | None:
    """What a start tag says about its text; ``None`` if nothing."""
    e = Element(outer, seen)
    e.main, e.frame, e.header = name in MAIN_TAGS, name in FRAME_TAGS, name == "header"
    if rest and not rest.isspace():
        own = {}
        for key, a, b, c in _ATTRIBUTE.findall(rest):
            own.setdefault(key.lower(), unescape(a or b or c))
        role = own.get("role", "").strip().lower()
        e.main |= role in MAIN_ROLES
        e.frame |= role in FRAME_ROLES or "hidden" in own or own.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(own.get("style", "")))
        label = _CAMEL.sub("-", f"{own.get('class', '')} {own.get('id', '')}").lower()
        if not label.isspace() and name not in ("html", "body"):
            e.named = bool((_NAMED_MAIN if e.main else _NAMED).search(label))
            e.content = bool(_CONTENT.search(label))
    return e if e.main or e.frame or e.header or e.named or e.content else None


def read_blocks(html: str) -> tuple[list[Block], bool]:
    """The text blocks of a page in order, with the state of their elements, and whether it has a main part."""
    blocks: list[Block] = []
    stack: list[tuple[str, Element | None]] = []
    counts: dict[str, int] = {}
    elements: list[Element] = []
    pieces: list[str] = []
    linked: list[str] = []
    inner: Element | None = None
    mains = articles = 0
    context = None  # of the block's first text: element, heading, item, place

    def flush():
        nonlocal context
        if context is not None:
            words = "".join(pieces).split()
            if words:
                links = min(1.0, sum(len(x.split()) for x in linked) / len(words))
                blocks.append(Block(" ".join(words), len(words), links, *context[1:3], context[0], context[3]))
        pieces.clear()
        linked.clear()
        context = None

    def add(a: int, b: int):
        nonlocal context
        if a < b:
            text = unescape(html[a:b])
            if context is None and not text.isspace():
                context = (inner, any(counts.get(h) for h in HEADINGS), any(counts.get(i) for i in ITEMS), a)
            pieces.append(text)
            if counts.get("a"):
                linked.append(text)

    def pop(explicit: bool):
        nonlocal inner
        name, element = stack.pop()
        counts[name] -= 1
        if element is not None:
            element.closed, element.after, inner = explicit, (mains, articles), element.outer

    def close_implied(names, limits):
        depth = len(stack) - 1
        while depth >= 0 and stack[depth][0] not in limits and stack[depth][0] not in BLOCK_TAGS:
            depth -= 1
        if depth >= 0 and stack[depth][0] in names:
            while len(stack) > depth:
                pop(True)

    at, n, markup = 0, len(html), _MARKUP
    while at < n:
        found = html.find("<", at)
        if found < 0:
            add(at, n)
            break
        m = markup.match(html, found)
        if m is None:
            if _OPENS.match(html, found):
                # No end in sight: quotes may have swallowed it; from here on they no longer count.
                m = _PLAIN_TAG.match(html, found)
                if m is None:
                    add(at, found)
                    break
                markup = _PLAIN_TAG
            else:
                add(at, found + 1)
                at = found + 1
                continue
        add(at, found)
        at = m.end()
        if m.lastgroup is None:
            continue  # a comment or declaration
        name, rest = m["name"].lower(), m["rest"]
        if m["end"]:
            if name in BLOCK_TAGS:
                flush()
            if counts.get(name):
                while stack[-1][0] != name:
                    pop(False)
                pop(True)
            continue
        if name == "br":
            add_space = context is not None
            if add_space:
                pieces.append(" ")
            continue
        if name in BLOCK_TAGS:
            flush()
            if name in CLOSES_P and counts.get("p"):
                close_implied(("p",), ())
            if name in CLOSES:
                close_implied(CLOSES[name][0].split(), CLOSES[name][1])
        if name in RAW_TAGS:
            end = _ENDS[name].search(html, at)
            if end is None:
                break
            at = end.start()
            continue
        if name in VOID_TAGS or rest.endswith("/") and name not in BLOCK_TAGS:
            continue
        element = _evidence(name, rest, inner, (mains, articles))
        if element is not None:
            elements.append(element)
            inner = element
            mains += name == "main"
            articles += element.main
        stack.append((name, element))
        counts[name] = counts.get(name, 0) + 1
    flush()
    while stack:
        pop(False)
    for e in elements:  # outer ones come first
        _settle(e, articles)
    return blocks, articles > 0


def _settle(e: Element, articles: int) -> None:
    """The element's state ``(main, frame, named, content)``, from its own evidence and its surroundings'."""
    main, frame, named, content = e.outer.state if e.outer else (False, False, False, False)
    held = e.after[1] - e.before[1] - e.main
    wraps = e.after[0] > e.before[0] or (held > 0 and held == articles - e.main)
    void = not e.main and (wraps or (not e.closed and held > 0))
    frame = frame or ((e.frame or (e.header and not main)) and not void)
    named = named or (e.named and not void)
    e.state = (main or e.main, frame, named, (content or e.content) and not (frame or named))


def measure(blocks: list[Block], has_main: bool) -> np.ndarray:
    """The features of a page's blocks, a row each."""
    out = np.zeros((len(blocks), len(FEATURES)))
    for i, b in enumerate(blocks):
        main, frame, named, content = b.element.state if b.element else (False, False, False, False)
        out[i, 0:2] = b.words, b.links
        out[i, 6:14] = main, frame, named, content, b.heading, b.item, b.text[-1] in '.!?…。"”»:;', has_main
    out[1:, 2:4] = out[:-1, 0:2]
    out[:-1, 4:6] = out[1:, 0:2]
    return out


# --- the decision tree


def _split(x: np.ndarray, y: np.ndarray, least: int):
    """The split ``(feature, threshold)`` with the least Gini impurity, the first of equal ones."""
    best = (len(y) * 2.0 * y.mean() * (1 - y.mean()) - 1e-9, None)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        left = np.arange(1, len(y))
        right, l1 = len(y) - left, ones[:-1]
        r1 = ones[-1] - l1
        impurity = 2.0 * (l1 * (left - l1) / left + r1 * (right - r1) / right)
        impurity[(v[1:] == v[:-1]) | (left < least) | (right < least)] = np.inf
        if len(impurity) and impurity.min() < best[0]:
            k = int(impurity.argmin())
            best = (float(impurity[k]), (f, float((v[k] + v[k + 1]) / 2)))
    return best[1]


def grow(x: np.ndarray, y: np.ndarray, depth: int = 10, least: int = 3):
    """A binary decision tree: ``(feature, threshold, below, above)`` or the share of main text in a leaf."""
    at = _split(x, y, least) if depth and 0 < y.mean() < 1 else None
    if at is None:
        return float(y.mean())
    low = x[:, at[0]] <= at[1]
    return (*at, grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


def share_main(tree, x: np.ndarray) -> np.ndarray:
    """The leaf share of every row."""
    if isinstance(tree, float):
        return np.full(len(x), tree)
    low = x[:, tree[0]] <= tree[1]
    out = np.empty(len(x))
    out[low], out[~low] = share_main(tree[2], x[low]), share_main(tree[3], x[~low])
    return out


# --- the labelled table

# Layouts: "html" alone opens or closes elements; ("html", label, least words, most words) is a block, "{}" its text;
# a number after that repeats it up to so many times. A "." after the text is a sentence's end.
_P = ("<p>{}.</p>", 1, 1, 120, 9)
_LINKED = ('<p><a href="/l">{}</a></p>', 1, 1, 30, 4)
_MENU = ('<li><a href="/x">{}</a></li>', 0, 1, 3, 9)
TRAINING = (
    ["<body><nav><ul>", _MENU, '</ul></nav><div class="ad">', ("{}.", 0, 3, 12), "</div><article>", ("<h1>{}</h1>", 1, 1, 12), _P,
     "</article><footer>", ("{}.", 0, 4, 15), "</footer></body>"],
    ["<body><header>", ("<h2>{}</h2>", 0, 1, 4), ("<p>{}.</p>", 0, 3, 12), "</header><main>", ("<h1>{}</h1>", 1, 2, 10), _P, ("<h2>{}</h2>", 1, 1, 6), _P,
     "<ul>", ("<li>{}</li>", 1, 1, 20, 6), "</ul><blockquote>", ("{}.", 1, 5, 40), '</blockquote></main><aside><h3>', ("{}", 0, 1, 4), "</h3><ul>", _MENU,
     "</ul></aside><footer>", ("<p>{}.</p>", 0, 3, 30), "</footer></body>"],
    ['<body><div id="top"><ul class="menu">', _MENU, '</ul></div><div class="post-content">', ("<h1>{}</h1>", 1, 2, 10), _P, ("<p>{}:</p>", 1, 3, 12),
     "<ol>", ("<li>{}.</li>", 1, 2, 25, 5), '</ol></div><div class="comments"><h3>', ("{}", 0, 1, 4), "</h3>", ("<p>{}.</p>", 0, 2, 60, 6),
     '</div><div id="footer">', ("<p>{}</p>", 0, 2, 20), "</div></body>"],
    ["<body><div>", ('<a href="/">{}</a>', 0, 1, 3, 4), "</div><div><div>", ("<h1>{}</h1>", 1, 2, 9), ("<p>{}.</p>", 1, 12, 90, 8), "</div><div>",
     ('<a href="/y">{}</a>', 0, 1, 6, 6), "</div><div>", ("{}", 0, 1, 7), "</div></div></body>"],
    ["<body><table><tr><td>", ('<a href="/">{}</a>', 0, 1, 3), "</td><td>", ("<p>{}.</p>", 1, 15, 90, 8), "</td></tr><tr><td>", ("{}", 0, 2, 8), "</td></tr></table></body>"],
    ['<body><div role="banner">', ("<p>{}.</p>", 0, 2, 15), '</div><div role="main">', ("<h1>{}</h1>", 1, 1, 9), _P, "<table>", ("<tr><td>{}</td></tr>", 1, 1, 6, 5),
     '</table></div><div role="complementary">', ("<p>{}.</p>", 0, 8, 60, 3), '</div><div class="cookie-notice"><p>', ("{}.", 0, 6, 40), "</p><button>",
     ("{}", 0, 1, 2), "</button></div></body>"],
    ["<body><article>", ("<header><h1>{}</h1></header>", 1, 1, 12), _P, ("<figure><figcaption>{}</figcaption></figure>", 1, 1, 15),
     ('<p><a href="/z">{}</a> ', 1, 2, 6), ("{}.</p>", 1, 4, 40), '<div class="share">', ('<a href="/s">{}</a>', 0, 1, 2, 4), '</div><aside>', ("<p>{}.</p>", 0, 4, 60, 3),
     '</aside></article><section id="comments"><article class="comment">', ("<p>{}.</p>", 0, 2, 70, 4), "</article></section><form><label>", ("{}", 0, 1, 4),
     "</label></form></body>"],
    ['<body><main><article>', ("<h2>{}</h2>", 1, 1, 9), _P, "<pre>", ("{}", 1, 2, 40), '</pre></article></main><div class="related"><h4>', ("{}", 0, 1, 4), "</h4>",
     ('<div><a href="/r">{}</a></div>', 0, 2, 12, 5), '</div><div class="newsletter"><p>', ("{}.", 0, 5, 25), "</p></div></body>"],
    ["<body><article>", ('<p><a href="/l">{}</a></p>', 1, 1, 8, 4), ("<p>{}</p>", 1, 1, 5, 6), '<ul><li><a href="/l">', ("{}", 1, 1, 6), "</a></li></ul></article><div><p>",
     ("{}.", 0, 1, 30), '</p></div></body>'],
    ["<body><div><p>", ("{}.", 0, 2, 30), "</p></div><article>", ("<h1>{}</h1>", 1, 1, 8), _P],
    ["<body><nav>", ('<a href="/n">{}</a>', 0, 1, 3, 6), "</nav><article>", _LINKED, _P, _LINKED, ("<p>{}</p>", 1, 1, 30)],
    ["<body><main>", ("<h1>{}</h1>", 1, 1, 8), _LINKED, ("<p>{}.</p>", 1, 1, 30), _LINKED, '<p class="ad">', ('<a href="/n">{}</a>', 0, 1, 30), "</p>", _P, _LINKED,
     "</main><footer>", ('<a href="/n">{}</a>', 0, 1, 20), "</footer></body>"],
    ["<body><div>", ("{}", 0, 1, 8), "</div><main>", _P, ("<p>{}</p>", 1, 1, 4), "</main></body>"],
    ["<body><div>", ("<div>{}</div>", 0, 1, 5, 4), "</div><div>", ("<p>{}.</p>", 1, 14, 120, 6), "</div><div>", ("<div>{}</div>", 0, 1, 6, 4), "</div></body>"],
    ["<body>", ("<p>{}.</p>", 1, 12, 120, 6), "</body>"],
    ["<body>", ('<div><a href="/m">{}.</a></div>', 0, 1, 5, 6), ("<div>{}.</div>", 0, 2, 8), ('<div><a href="/m">{}</a></div>', 0, 1, 5, 3), ("<p>{}.</p>", 1, 16, 120, 4),
     ("<p>{}.</p>", 1, 1, 9), ("<p>{}.</p>", 1, 16, 120, 4), ("<p>{}</p>", 1, 20, 90), ('<div><a href="/m">{}.</a></div>', 0, 1, 9, 5), ("<div>{}.</div>", 0, 2, 9),
     ('<div><a href="/m">{}</a></div>', 0, 1, 5, 3), "</body>"],
    ["<body>", ("<div>{}</div>", 0, 1, 6, 3), ('<div><a href="/m">{}!</a></div>', 0, 1, 12, 4), ("<div>{}</div>", 1, 18, 150, 6), ('<div><a href="/m">{}</a> &middot;', 0, 1, 3, 3),
     ("{}.</div>", 0, 1, 3), "</body>"],
    [("{}", 1, 12, 150)],
    ["<body><header>", ("<p>{}.</p>", 0, 1, 50), "</header><nav>", ("<p>{}.</p>", 0, 1, 60, 2), "</nav>", ("<p>{}.</p>", 1, 20, 120, 6), "<aside>", ("<p>{}.</p>", 0, 1, 120, 4),
     "</aside><footer>", ("<p>{}.</p>", 0, 1, 120, 4), "</footer></body>"],
    ['<body><div class="sidebar"><div class="content">', ("<p>{}.</p>", 0, 1, 120, 3), '</div></div><div class="content">', _P, '</div><div class="ad"><div class="text">',
     ("<p>{}.</p>", 0, 1, 60, 2), "</div></div></body>"],
    ['<body><div class="entry-content"><h1>', ("{}", 1, 1, 8), "</h1>", _P, ("<p>{}</p>", 1, 1, 4), '</div><div class="sidebar"><p>', ("{}.", 0, 1, 50), "</p><ul>", _MENU, "</ul></div></body>"],
)
ROUNDS = 16  # renderings of every layout, with other lengths each
# Parts that stand in any order, for MIXED pages a round of each kind: (before, parts, after).
_FRAMES = (
    ('<div class="ad">{}.</div>', 0, 1, 60), ("<aside><p>{}.</p></aside>", 0, 1, 60), ('<div class="comments"><p>{}.</p></div>', 0, 1, 90),
    ('<nav><a href="/n">{}</a></nav>', 0, 1, 8), ("<footer>{}.</footer>", 0, 1, 60), ('<div id="sidebar">{}</div>', 0, 1, 40), ("<form>{}</form>", 0, 1, 20),
)
_CONTENT_PART = ('<div class="content"><p>{}.</p></div>', 1, 1, 90)
MIXED = (
    ("<body>", (*_FRAMES, *[("<p>{}.</p>", 1, 20, 120)] * 4, _CONTENT_PART), "</body>"),
    ("<body><article>", (*_FRAMES, *[("<p>{}.</p>", 1, 1, 120)] * 4, _LINKED[:4], ("<li>{}</li>", 1, 1, 20), ("<h2>{}</h2>", 1, 1, 9)), "</article></body>"),
    ("<body>", (*_FRAMES, ("<p>{}.</p>", 0, 1, 60), ("<h2>{}</h2>", 0, 1, 9)), ("<article><p>{}.</p></article>", 1, 1, 9)),
)
MIXED_PAGES, MIXED_PARTS = 6, 14


def _filler(rnd: random.Random, n: int) -> str:
    return " ".join("".join(rnd.choice(("ta", "lo", "mi", "ren", "su", "ka")) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def labelled_table(rounds: int = ROUNDS, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of every block of the training layouts."""
    rnd = random.Random(seed)
    xs, ys = [], []
    for _ in range(rounds):
        mixed = [(a, *rnd.choices(parts, k=MIXED_PARTS), z) for a, parts, z in MIXED for _ in range(MIXED_PAGES)]
        for layout in (*TRAINING, *mixed):
            page, labels = "", []
            for part in layout:
                if isinstance(part, str):
                    page += part
                    continue
                html, label, least, most, *times = part
                for _ in range(rnd.randint(1, times[0]) if times else 1):
                    labels.append((len(page), label))
                    page += html.replace("{}", _filler(rnd, rnd.randint(least, most)))
            blocks, has_main = read_blocks(page)
            xs.append(measure(blocks, has_main))
            ys += [[label for at, label in labels if at <= b.at][-1] for b in blocks]
    return np.concatenate(xs), np.array(ys, float)


@lru_cache(maxsize=1)
def trained_tree():
    return grow(*labelled_table())


# --- the operator


def main_texts(pages: list[str], tree) -> list[str]:
    """The main text of each page."""
    read = [read_blocks(p) for p in pages]
    x = np.concatenate([measure(*r) for r in read]) if read else np.zeros((0, len(FEATURES)))
    kept, out, at = share_main(tree, x) >= 0.5, [], 0
    for blocks, _ in read:
        out.append("\n".join(b.text for b, k in zip(blocks, kept[at : at + len(blocks)].tolist(), strict=True) if k))
        at += len(blocks)
    return out


def extract_text(pages: DataFrame, tree=None) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages (page_id, url, html)``."""
    tree = trained_tree() if tree is None else tree

    def run(batches):
        for b in batches:
            texts = []
            for html in b["html"]:
                texts += main_texts([html], tree)
            yield {"page_id": b["page_id"], "url": b["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return map_rows(rows, run, f"page_id {kind}, url string, text string, n_chars long")
