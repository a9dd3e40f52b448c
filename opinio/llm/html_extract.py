"""Main text of HTML pages by tree scoring.

A page becomes a tree (tolerant of missing end tags). Parts that are never
article text are left out: scripts, styles, forms, menus, headers, footers,
sidebars, notices, adverts, reader comments, by element, role, or class and
id words. Words of layout, topic or status (``no-sidebar``, ``category-social``,
``comments-open``) leave nothing out, and no words do so to ``article`` and
``main``, to a container of article words unless one stands alone (``sidebar``),
or to what holds most of the page's points where no article is beside it; the
same goes for a form, and an article's own header and lists of links are kept. Each paragraph earns points for its length and commas and passes
them to its ancestors (the parent in full, the grandparent half, further ones
less); a container's score is discounted by its link density. The best
container (raised to the ``article`` element around it, or to the one of several
like sections that it is in, and as long as its parent adds nothing but the kinds below) and those of its siblings that score
well or read like text are kept, with headings, ``pre``, figures, quotes, lists
and tables beside it that are not mostly links; their blocks are joined in page
order.

Character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by one newline; nothing else is cut. All
steps are linear in the page's length.

Defined results: null or empty html, and pages without text, give the empty
text; plain text without tags is one block; rows repeat as they come; extra
columns are not carried; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import arrow_map, distinct_names

BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary
table tbody td tfoot th thead tr ul caption""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math object canvas audio video textarea title head".split())
LEFT_OUT = frozenset("nav header footer aside form button select dialog menu search".split())
#: Of those, the ones that come back if they hold most of the page's points (a page that is one form).
SOFT = frozenset("form header".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
SCORED = frozenset("p pre td blockquote li dd".split())
CONTAINERS = frozenset("article main section div body td blockquote center table tbody tr ul ol dl".split())
#: Points that an element has of itself.
OWN = {"article": 25, "main": 10, "div": 5, "section": 5, "td": 3, "pre": 3, "blockquote": 3, "ul": -3, "ol": -3,
       "dl": -3}
#: What a start tag closes if it is open, and what ends the search for it.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
#: Kept beside the best container whatever they score, unless they are mostly links; headings in any case.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
BESIDE = frozenset("pre figure blockquote ul ol dl table details".split())
#: Deeper elements are not nested any further; their text is kept.
DEPTH = 256

_EDGE = r"(?:^|[\s_-])"
#: Class and id words of parts that are never article text.
NEVER = re.compile(_EDGE + r"(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|breadcrumbs?|comments?|commentlist|"
                   r"disqus\w*|cookies?|consent|gdpr|footer|masthead|menu|nav|navbar|navigation|newsletter|popup|modal|"
                   r"overlay|pager|pagination|related|recommend\w*|share|sharing|social|sidebar|subscribe|subscription|"
                   r"toolbar|widget|login|signup|replies|respond|outbrain|taboola)(?=$|[\s_-])")
#: The same, unless the element also has a word of article parts.
SELDOM = re.compile(_EDGE + r"(?:header|head|notice|alert|side|tags|search|print|hidden|skip|toc|foot|meta)(?=$|[\s_-])")
ARTICLE = re.compile(r"article|body|content|entry|main|post|story|text|column|page")
#: Those that name an article's container, not a layout.
STRONG = re.compile(r"article|body|content|entry|main|post|story")
#: First and last parts of words that tell of a layout, topic or status.
ABOUT = frozenset("no not non has have with without category cat tag topic layout template format".split())
STATE = frozenset("open opened closed enabled disabled on off".split())
#: Least share of the points that an article beside a part has for the part's words to count.
BESIDE_SHARE = 0.1

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|</?[a-zA-Z][^>]*\Z", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
CLOSING = {tag: re.compile(rf"</{tag}(?![a-zA-Z0-9])[^>]*(?:>|\Z)", re.I) for tag in RAW}
HEAD_END = re.compile(r"</head(?![a-zA-Z0-9])[^>]*>|<body(?![a-zA-Z0-9])", re.I)


class Node:
    __slots__ = ("tag", "parent", "items", "words", "score", "chars", "linked", "links", "out", "named")

    def __init__(self, tag: str, parent: Node | None, words: str = "", out: bool = False, named: bool = False):
        self.tag, self.parent, self.words = tag, parent, words
        self.out, self.named = out or named, named and not out  # named: left out by its words alone
        self.items: list[Node | str] = []
        self.score = 0.0
        self.chars = self.linked = self.links = 0  # of the subtree: characters, those in links, links


def _named(tag: str, text: str) -> bool:
    """Whether an element's class and id words leave it out."""
    if tag in ("article", "main", "body") or not (NEVER.search(text) or SELDOM.search(text)):
        return False
    words, never, strong = [], False, False
    for word in text.split():
        parts = word.replace("_", "-").split("-")
        if len(parts) > 1 and (parts[0] in ABOUT or parts[-1] in STATE):
            continue
        words.append(word)
        if m := NEVER.search(word):
            if m[0] == word:
                return True
            never = True
        elif STRONG.search(word) and not SELDOM.search(word):
            strong = True
    text = " ".join(words)
    return never and not (strong and tag in CONTAINERS) or bool(SELDOM.search(text)) and not ARTICLE.search(text)


def _attributes(raw: str) -> tuple[str, bool]:
    """Class and id words, and whether the element is left out by its role or style."""
    words, out = [], False
    for m in ATTRIBUTE.finditer(raw):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name in ("class", "id"):
            words.append(value)
        elif name == "role":
            out |= value in ROLES
        elif name == "hidden":
            out |= value != "until-found"
        elif name == "aria-hidden":
            out |= value == "true"
        else:
            out |= "display:none" in value.replace(" ", "")
    return " ".join(words), out


def parse(html: str) -> tuple[Node, list[Node]]:
    """The tree of a page, and its elements with every child before its parent."""
    root = node = Node("html", None)
    closed: list[Node] = []
    open_tags: dict[str, int] = {}
    depth, at, search = 0, 0, TOKEN.search

    def close() -> None:
        nonlocal node, depth
        own, up = node, node.parent
        open_tags[own.tag] -= 1
        depth -= 1
        closed.append(own)
        if not own.out:
            up.chars += own.chars
            up.linked += own.chars if own.tag == "a" else own.linked
            up.links += own.links + (own.tag == "a")
        node = up

    while (m := search(html, at)) is not None:
        start = m.start()
        if start > at:
            text = html[at:start]
            node.items.append(text)
            node.chars += len(text) if node.tag != "html" or text.strip() else 0
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            if open_tags.get(tag):
                while node.tag != tag:
                    close()
                close()
            elif tag in BLOCKS:
                node.items.append(Node("hr", node))
            continue
        if tag in RAW:
            if tag == "head":
                end = HEAD_END.search(html, at)
                at = end.start() if end and end[0].lower().startswith("<body") else end.end() if end else at
                continue
            raw = m[3] if m[2] else m[6]
            if not raw.endswith("/") or tag in ("script", "style", "textarea", "title"):
                end = CLOSING[tag].search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag == "html" or tag == "body" and open_tags.get("body"):
            continue
        if tag in BLOCKS and open_tags.get("p"):
            while node.tag != "p":
                close()
            close()
        if tag in CLOSES:
            ends, stops = CLOSES[tag]
            if any(open_tags.get(t) for t in ends):
                up = node
                while up.parent is not None and up.tag not in ends and up.tag not in stops:
                    up = up.parent
                if up.tag in ends:
                    while node is not up:
                        close()
                    close()
        if tag in VOID or depth >= DEPTH:
            node.items.append(Node("hr" if tag in BLOCKS else "br", node) if tag in BLOCKS or tag == "br" else "")
            continue
        raw = m[3] if m[2] else m[6]
        words, out = _attributes(raw) if raw else ("", False)
        soft = tag in SOFT and not open_tags.get("article")  # an article's header is its own, a form in it is not
        out = tag in LEFT_OUT and not soft and not (tag == "header" and open_tags.get("article")) or out and tag != "body"
        child = Node(tag, node, words, out, soft or bool(words) and _named(tag, words))
        node.items.append(child)
        node = child
        open_tags[tag] = open_tags.get(tag, 0) + 1
        depth += 1
    if at < len(html):
        node.items.append(html[at:])
        node.chars += len(html) - at
    while node is not root:
        close()
    closed.append(root)
    return root, closed


def _is_menu(node: Node) -> bool:
    """A list or box of links and little else."""
    return node.links >= 3 and node.tag in ("ul", "ol", "div", "section", "table") and node.linked >= 0.9 * node.chars


def _blocks(node: Node) -> Iterator[str]:
    """Decoded texts of the blocks under a node, in page order. Lists of links
    are left out, but for those of an article (its sources, say)."""
    whole = node.tag == "article"
    run: list[str] = []
    todo: list[Node | str | None] = [node]
    while todo:
        item = todo.pop()
        if item is None:
            if run:
                yield "".join(run)
                run = []
        elif isinstance(item, str):
            # Each text by itself: a reference does not go on behind a tag.
            run.append(unescape(item) if "&" in item else item)
        elif item.tag == "br":
            run.append(" ")
        elif not item.out and (item is node or whole or not _is_menu(item)):
            edge = item.tag in BLOCKS
            if edge:
                todo.append(None)
            todo.extend(reversed(item.items))
            if edge:
                todo.append(None)
    if run:
        yield "".join(run)


def text_of_node(node: Node) -> list[str]:
    """Trimmed, non-empty blocks."""
    return [t for raw in _blocks(node) if (t := " ".join(raw.split()))]


def _inside(node: Node) -> bool:
    """Whether the node or an element around it is left out."""
    while node is not None:
        if node.out:
            return True
        node = node.parent
    return False


def _own_text(node: Node) -> str:
    """Text of a paragraph without that of blocks within."""
    out: list[str] = []
    todo: list[Node | str] = list(reversed(node.items))
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
        elif not item.out and item.tag not in BLOCKS:
            todo.extend(reversed(item.items))
    return "".join(out)


def _hidden(closed: list[Node], named: bool) -> set[int]:
    """Elements in parts left out; with ``named``, also in those left out by words alone."""
    hidden: set[int] = set()
    for node in reversed(closed):  # parents first
        if node.out and (named or not node.named) or node.parent is not None and id(node.parent) in hidden:
            hidden.add(id(node))
    return hidden


def _readmit(closed: list[Node], points: dict[int, float]) -> None:
    """Parts left out by words alone that hold most of the points come back,
    unless an article that is not left out holds some."""
    total = sum(points.values())
    held: dict[int, float] = {}  # points of the subtree
    seen: dict[int, float] = {}  # those not left out
    top: dict[int, float] = {}  # most seen by an article's container of the subtree

    def article(node: Node) -> bool:
        return node.tag in ("article", "main") or node.tag in CONTAINERS and bool(STRONG.search(node.words))

    for node in closed:
        own = points.get(id(node), 0.0)
        held[id(node)] = held.get(id(node), 0.0) + own
        seen[id(node)] = seen.get(id(node), 0.0) + own
        if seen[id(node)] > top.get(id(node), 0.0) and article(node):
            top[id(node)] = seen[id(node)]
        if (up := node.parent) is not None and held[id(node)]:
            held[id(up)] = held.get(id(up), 0.0) + held[id(node)]
            if not node.out:
                seen[id(up)] = seen.get(id(up), 0.0) + seen[id(node)]
                top[id(up)] = max(top.get(id(up), 0.0), top.get(id(node), 0.0))
    most = top.get(id(closed[-1]), 0.0)
    for node in reversed(closed):
        if not node.named or held[id(node)] <= total / 2 or most >= BESIDE_SHARE * total or _inside(node.parent):
            continue
        node.out = node.named = False
        most = max(most, top.get(id(node), 0.0))
        up = node.parent
        while up is not None:
            up.chars += node.chars
            up.linked += node.chars if node.tag == "a" else node.linked
            up.links += node.links + (node.tag == "a")
            seen[id(up)] += seen[id(node)]
            if article(up):
                most = max(most, seen[id(up)])
            up = up.parent


def _score(closed: list[Node]) -> tuple[list[Node], dict[int, float]]:
    """Pass the paragraphs' points to their ancestors; the containers with
    points, and the points in each element's subtree."""
    hidden = _hidden(closed, False)
    points: dict[int, float] = {}
    for node in closed:
        if node.tag not in SCORED and not (node.tag in ("div", "section", "article", "body") and any(
                isinstance(x, str) and not x.isspace() and x for x in node.items)) or id(node) in hidden:
            continue
        text = _own_text(node).strip()
        if len(text) >= 25:
            points[id(node)] = 1 + text.count(",") + text.count("，") + text.count("、") + min(len(text) / 100, 3.0)
    if any(node.named for node in closed):
        _readmit(closed, points)
        hidden = _hidden(closed, True)
    for node in closed:
        if id(node) not in points or id(node) in hidden:
            continue
        up, level = (node.parent if node.tag in SCORED else node), 0
        while up is not None and level < 5:
            up.score += points[id(node)] / (1, 2, 6, 9, 12)[level]
            up, level = up.parent, level + 1
    found = []
    for node in closed:
        if node.tag in CONTAINERS and id(node) not in hidden and (node.score or node.tag in ("article", "main")):
            weight = OWN.get(node.tag, 0)
            if node.words:
                weight += 25 * bool(ARTICLE.search(node.words))
            node.score = (node.score + weight) * (1 - node.linked / max(1, node.chars))
            found.append(node)
    held: dict[int, float] = {}
    for node in closed:
        if own := held.get(id(node), 0.0) + (points.get(id(node), 0.0) if id(node) not in hidden else 0.0):
            held[id(node)] = own
            if node.parent is not None:
                held[id(node.parent)] = held.get(id(node.parent), 0.0) + own
    return found, held


def _section(best: Node, held: dict[int, float]) -> Node:
    """The ancestor of the best container that is one of several like sections:
    elements of one kind under one parent, of which the others together hold
    at least half as many points."""
    node = best
    while (up := node.parent) is not None:
        others = sum(held.get(id(x), 0.0) for x in up.items
                     if isinstance(x, Node) and x is not node and x.tag == node.tag and not x.out)
        if node.tag in CONTAINERS and node.tag != "body" and 2 * others >= held.get(id(node), 0.0) > 0:
            best = node
        node = up
    return best


def _beside(node: Node | str) -> bool:
    """Whether a node beside the best container is kept whatever it scores: of the
    kinds that articles are made of, or a box of nothing else."""
    todo = [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            if item and not item.isspace():
                return False
        elif item.out or _is_menu(item):
            return False
        elif item.tag in BESIDE:
            if 2 * item.linked > item.chars:
                return False
        elif item.tag in ("div", "section"):
            todo.extend(item.items)
        elif item.tag not in HEADINGS and item.tag not in ("hr", "br"):
            return False
    return True


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    root, closed = parse(html)
    found, held = _score(closed)
    best = max(found, key=lambda n: n.score, default=None)
    if best is None or best.score <= 0:
        return "\n".join(text_of_node(root))
    up = best
    while up is not None:
        if up.tag == "article" and not up.out:
            best = up
        up = up.parent
    if best.parent is None or best.tag == "body":
        return "\n".join(text_of_node(best))
    least = max(10.0, 0.2 * best.score)
    if best.tag != "article":
        best = _section(best, held)
    while best.parent.tag in CONTAINERS and best.parent.tag != "body" and all(
            x is best or (x.isspace() or not x if isinstance(x, str) else _beside(x)) for x in best.parent.items):
        best = best.parent
    scored = {id(n) for n in found}
    out: list[str] = []
    for item in best.parent.items:
        if item is best:
            out += text_of_node(item)
        elif isinstance(item, str) or item.out or _is_menu(item):
            continue
        elif id(item) in scored and item.score + (best.words != "" and item.words == best.words) * least >= least:
            out += text_of_node(item)
        elif _beside(item):
            out += text_of_node(item)
        elif item.tag == "p":
            share = item.linked / max(1, item.chars)
            blocks = text_of_node(item)
            size = sum(map(len, blocks))
            if size > 80 and share < 0.25 or size and not share and blocks[-1].endswith((".", "!", "?", "。")):
                out += blocks
    return "\n".join(out)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """One row per page: id, url, ``text``, ``n_chars`` (code points); an output
    that has the id's or the url's name gets a ``_``."""
    names = distinct_names(id_col, url_col, "text", "n_chars")
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names)

    kinds = [*(pages.schema[c].dataType.simpleString() for c in (id_col, url_col)), "string", "bigint"]
    return arrow_map(rows, run, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))
